"""Planted keys that hold separators or padding, or have no upper-case letters."""

import base64
import random
import string

from ledgerframe.llm import secret_scan


def test_padded_and_lower_case_keys_are_found(spark):
    rng, rows = random.Random(4), []
    pick = lambda symbols, n: "".join(rng.choice(symbols) for _ in range(n))
    low, up = string.ascii_lowercase + string.digits, string.ascii_uppercase + string.digits
    for _ in range(60):
        for n in (16, 32):
            rows.append("key " + base64.b64encode(rng.randbytes(n)).decode() + " end")
        rows += [f"sig={pick(low, 32)} end", f"sk_live_{pick(low, 32)}", f"a /{base64.b64encode(rng.randbytes(33)).decode()}", f"KEY_{pick(up, 32)}"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r.doc_id for r in secret_scan.scan(docs).collect() if r.n_entropy}
    for kind in range(6):
        mine = [k for k in range(len(rows)) if k % 6 == kind]
        assert sum(k in found for k in mine) >= 0.75 * len(mine), kind


def test_separators_and_repeats_are_not(spark):
    texts = ["-" * 40, "=" * 30, "/" * 30, "_-_-" * 10, "123e4567-e89b-12d3-a456-426614174000", "an_ordinary_name_of_a_function_without_digits"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.doc_id for r in secret_scan.scan(docs).collect() if r.n_entropy] == []
