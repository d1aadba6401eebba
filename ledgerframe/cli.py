"""Verify a log: ``python -m ledgerframe.cli [--json | --out FOLDER] (--key HEX | --key-file FILE) LOG CHECKPOINTS``.

``--out`` lets the executors write the report, of any length, into a folder, and prints the status alone.

Exit code 0: nothing fatal was found; 1: something was; 2: the log couldn't be read, or wrong use.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .functions import ed25519
from .operators import verify
from .sources import jsonl


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="ledgerframe")
    parser.add_argument("log")
    parser.add_argument("checkpoints")
    how = parser.add_mutually_exclusive_group()
    how.add_argument("--json", action="store_true")
    how.add_argument("--out")
    key = parser.add_mutually_exclusive_group(required=True)
    key.add_argument("--key")
    key.add_argument("--key-file")
    given = parser.parse_args(args)
    spark = spark or SparkSession.builder.appName("verify").getOrCreate()
    try:
        if given.key_file:
            with open(given.key_file) as f:
                public = ed25519.read_public_key(f.read())
        else:
            public = ed25519.read_public_key(given.key)
        entries, torn = jsonl.read_entries(spark, given.log)
        checkpoints = jsonl.read_checkpoints(spark, given.checkpoints)
        if given.out:
            status = verify.write_report(entries, checkpoints, public, given.out, torn)
            print(status)
            return int("FAILED" in status)
        report = verify.report(entries, checkpoints, public, torn)
    except (OSError, ValueError) as e:
        print(e, file=sys.stderr)
        return 2
    print(report.json() if given.json else report.text(), end="\n" if given.json else "")
    return int(any(e["Severity"] != "advisory" for e in report.errors))


if __name__ == "__main__":
    sys.exit(main())
