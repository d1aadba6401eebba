"""The registered queries over a whole small table: against their SQL, or against plain versions."""

import glob
import os
import zlib

import brute
import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__
from ledgerframe.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple("null" if r[k] is None else str(r[k]).lower() if isinstance(r[k], bool) else str(r[k]) for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, duck, name):
    df = __spark_entry__.queries()[name](spark, SF)
    rel = duck.sql(__spark_entry__.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert plain(df.collect(), df.columns) == plain(rel.fetchall(), rel.columns)


def run(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    return [r.asDict() for r in __spark_entry__.queries()[name](spark, SF).collect()], {r.doc_id: r for r in docs}


def test_quality_rules(spark):
    rows, docs = run(spark, "op2_quality_rules")
    assert len(rows) == len(docs)
    for r in rows:
        stats = brute.statistics(docs[r["doc_id"]].text)
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == stats
        assert r["base_failed"] == (stats[0] < 50 or 100 * stats[4] > 50 * stats[0])
        assert r["kept"] == (not r["base_failed"] and r["rule"] is None)


def test_token_output(spark):
    rows, docs = run(spark, "op4_token_output")
    model, start = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        ids = [*model.encode(docs[r["doc_id"]].text or "", add_special_tokens=False).ids, 0]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(rows) == len(docs)


def test_language_id(spark):
    rows, docs = run(spark, "op5_language_id")
    assert len(rows) == len(docs)
    for r in rows:
        doc = docs[r["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(doc.doc_id).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in doc.text or ""))


def test_url_filter(spark):
    rows, _ = run(spark, "op8_url_filter")
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        rest = pages[r["page_id"]].split("://", 1)[1] if "://" in (pages[r["page_id"]] or "") else ""
        end = min((k for k in map(rest.find, "?#") if k >= 0), default=len(rest))
        host, slash, path = rest[:end].partition("/")
        host, path = host.translate(brute.LOWER), slash + path
        fits = [(h + p, v) for v, h, p in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, None))
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["confidence"] is not None else "allow"))
