"""Intermediate tables in the folder that all executors share.

A table written here survives the loss of any executor and cuts the lineage of what reads it. The folder is
``spark.checkpoint.dir`` of the session; only where that is unset (tests, notebooks) a temporary one is made.
"""

from __future__ import annotations

import contextlib
import contextvars
import re
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder: ``spark.checkpoint.dir``. A session in one process that sets none gets a temporary folder;
    on a cluster such a folder would be the driver's alone, so there it must be set."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="ledgerframe-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


#: Held while an intermediate table is written: its shuffle files go when the write ends, since readers use the table,
#: and Python workers get texts in batches of a few megabytes.
_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}
_lock = threading.Lock()
_held: dict[int, tuple[int, dict[str, str]]] = {}


@contextlib.contextmanager
def writing(spark: SparkSession) -> Iterator[None]:
    """Settings for a write; writes of several threads share them, and the last to end restores what was set before."""
    with _lock:
        count, before = _held.get(id(spark), (0, {}))
        if not count:
            before = {k: spark.conf.get(k) for k in _WRITING}
            for k, v in _WRITING.items():
                spark.conf.set(k, v)
        _held[id(spark)] = count + 1, before
    try:
        yield
    finally:
        with _lock:
            count, before = _held.pop(id(spark))
            if count > 1:
                _held[id(spark)] = count - 1, before
            else:
                for k, v in before.items():
                    spark.conf.set(k, v)


_made: contextvars.ContextVar[list[Scratch] | None] = contextvars.ContextVar("made", default=None)


@contextlib.contextmanager
def temporary() -> Iterator[None]:
    """Operators called inside keep their intermediate tables until the block ends, when nothing may read them."""
    made: list[Scratch] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for scratch in made:
            scratch.drop("")


class Scratch:
    """Named parquet tables of one run of one operator, each in a folder that no other run uses."""

    def __init__(self, spark: SparkSession, operator: str):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/{operator}-{uuid.uuid4().hex}"
        if (made := _made.get()) is not None:
            made.append(self)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}".rstrip("/")

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return it as read back."""
        with writing(self.spark):
            df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        for name in names:
            target = jvm.org.apache.hadoop.fs.Path(self.path(name))
            target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
