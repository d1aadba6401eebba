"""What has to grow with the rows, and what must not."""

import secrets
from unittest.mock import Mock

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from ledgerframe.functions import ed25519 as E
from ledgerframe.functions.jsonbytes import json_string
from ledgerframe.operators import chain, records, stage
from ledgerframe.sources import jsonl
from ledgerframe.streaming import assemble


def test_tasks_grow_with_rows(spark, monkeypatch):
    """Chains and ranges are dealt over more tasks where there are more rows, and small ones aren't merged again."""
    monkeypatch.setattr(stage, "ROWS", 10)
    df = spark.range(400).select(F.col("id").cast("string").alias("trace_id"), F.lit(0).alias("seq_in_trace"), "id", F.col("id").alias("start_time_unix_nano"), F.lit("s").alias("span_id"))
    assert chain.in_chain_order(df).rdd.getNumPartitions() == 40
    assert records.with_sequence(df).rdd.getNumPartitions() == 40
    rows = stage.numbered(df, "id", name="place", before=("trace_id",))
    assert rows.select(F.spark_partition_id()).distinct().count() > 8
    assert [(r.place, r._before and int(r._before.trace_id)) for r in rows.orderBy("id").collect()] == [(k, k - 1 if k else None) for k in range(400)]


@pytest.mark.parametrize("rows", [3, 1000])
def test_ties_keep_their_order(spark, monkeypatch, rows):
    monkeypatch.setattr(stage, "ROWS", rows)
    df = spark.range(60).select((F.col("id") % 4).alias("a"), (-F.col("id")).alias("b"))
    got = stage.numbered(df, "a", name="place", before=("b",), ties=("b",)).orderBy("place").collect()
    assert [(r.a, r.b) for r in got] == sorted((k % 4, -k) for k in range(60))
    assert [r._before and r._before.b for r in got] == [None, *[r.b for r in got][:-1]]


def test_json_strings_are_little_code(spark):
    """A record has a dozen: written out, each had 37 replacements."""
    plan = spark.range(1).select(json_string(F.col("id").cast("string")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("replace(") < 5


@pytest.mark.skipif(E._openssl() is None, reason="no OpenSSL here")
def test_openssl_gives_the_same(monkeypatch):
    key = secrets.token_bytes(32)
    public, messages = E.public_key(key), [secrets.token_bytes(k) for k in range(40)]
    signed = [E.sign(key, m) for m in messages]
    assert signed == [E._sign(key, m) for m in messages]
    bad = [s if k % 3 else s[:k] + bytes([s[k] ^ 1]) + s[k + 1 :] for k, s in enumerate(signed)]
    bad[1], bad[2] = bad[1][:32] + (int.from_bytes(bad[1][32:], "little") + E.Q).to_bytes(32, "little"), b"x"
    assert E.verify_many(public, messages, bad) == E._verify_many(public, messages, bad)
    # points of small order, and others that are written in ways that the standard doesn't allow
    odd = [x.to_bytes(32, "little") for x in (0, 1, E.P - 1, E.P, E.P + 1, 1 | 1 << 255, (E.P - 1) | 1 << 255)]
    for p in odd:
        assert E.verify_many(p, [b"m"] * len(odd), [r + bytes(32) for r in odd]) == E._verify_many(p, [b"m"] * len(odd), [r + bytes(32) for r in odd])
    monkeypatch.setattr(E, "_openssl", lambda: None)
    assert E.sign(key, b"m") == E._sign(key, b"m") and E.verify(public, b"m", E._sign(key, b"m"))


def test_lines_are_numbered_where_they_are_read(spark, tmp_path):
    """No line is moved for its number: only the counts of the splits meet in a window."""
    for name, text in (("a", "x\n\n \t y\n"), ("b", "\nz\x0b\n")):
        (tmp_path / name).write_text(text)
    rows = jsonl.numbered(jsonl.lines(spark, str(tmp_path)))
    assert sorted(map(tuple, rows.collect())) == [(1, "x"), (2, "y"), (3, "z")]
    assert "row_number" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_made_after_dealing(spark):
    """What is costly is worked out once, when the rows are in their ranges."""
    got = stage.numbered(spark.range(5), "id", name="place", before=("twice",), made=lambda rows: rows.withColumn("twice", 2 * F.col("id")))
    assert [(r.place, r.twice, r._before and r._before.twice) for r in got.orderBy("place").collect()] == [(k, 2 * k, 2 * k - 2 if k else None) for k in range(5)]


def test_what_comes_with_its_root_is_not_written_to_the_state():
    a = assemble.Assembler(1000)
    a.handle, a.spans, a.open, a.emitted = Mock(), Mock(), Mock(), Mock()
    a.open.exists.return_value = a.emitted.exists.return_value = False
    rows = [Row(span_id="b", parent_span_id="a", arrival=2, payload="y"), Row(span_id="a", parent_span_id="", arrival=1, payload="x")]
    out = list(a.handleInputRows(("t",), iter(rows), Mock()))
    assert [(r.span_id, r.segment) for r in out] == [("a", "complete"), ("b", "complete")]
    assert not a.spans.method_calls and not a.handle.method_calls and a.emitted.update.called
