import hashlib
import random
import string

import brute
from pyspark.sql import functions as F

from ledgerframe.llm import decontaminate, quality_rules, secret_scan

SF = "/root/testdata/sf0.001"


def test_statistics(frame, documents):
    got = {r.doc_id: tuple(r)[1:6] for r in quality_rules.statistics(frame.drop("n_words")).collect()}
    assert got == {d: brute.statistics(t) for d, t in documents}


def test_rules_are_learned_and_used(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 5 == 0, F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(70)), lambda k: F.concat(F.lit("w#"), (k * F.col("id")).cast("string"))))).otherwise(F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(70)), lambda k: F.concat(F.lit("word"), (k * F.col("id") + 3).cast("string"))))).alias("text"))
    labels = docs.where("doc_id % 2 = 0 and doc_id > 0").select("doc_id", (F.col("doc_id") % 5 != 0).cast("int").alias("quality"))
    out = quality_rules.judge(docs.where("doc_id > 0"), labels)
    assert out.where((F.col("doc_id") % 5 == 0) == F.col("kept")).count() == 0
    assert quality_rules.judge(docs.where("doc_id > 0"), labels.limit(0)).where("rule is not null").count() == 0
    assert quality_rules.judge(docs.limit(0), labels).count() == 0


def test_rejections_hold_on_the_table(spark):
    out = quality_rules.judge(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    met = out.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("rule is not null")
    wrong, all_ = met.select(F.sum("quality"), F.count("*")).first()
    assert all_ and wrong <= 0.1 * all_


def test_secrets(frame, documents):
    out = secret_scan.scan(frame).collect()
    for r in out:
        text = dict(documents)[r.doc_id]
        base = brute.base_spans(text)
        more = brute.entropy_spans(text, secret_scan.CANDIDATE, secret_scan.ALLOWED, secret_scan.CLASSES, secret_scan.WINDOW)
        assert r.spans == brute.written(base + more)
        assert r.base_sha256 == hashlib.sha256(brute.written(base).encode()).hexdigest()
    assert sum(r.n_entropy for r in out) and sum(r.n_assign for r in out)


def test_leaks(spark, frame, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = brute.leaks(documents, items, decontaminate.needed, decontaminate.STRETCH)
    out = decontaminate.decontaminate(frame, spark.createDataFrame([*items, (99, None), (98, "words that are nowhere here")], "item_id long, text string"))
    assert {r.doc_id: r["items"] for r in out.collect() if r.contaminated} == {d: sorted(i) for d, i in want.items()}
    assert out.count() == len(documents)


def test_leaks_with_substitutions(spark):
    passage = [f"word{k}" for k in range(25)]
    changed = list(passage)
    changed[4] = changed[9] = changed[14] = changed[19] = "x"
    docs = spark.createDataFrame([(1, "a b " + " ".join(changed) + " c"), (2, " ".join(passage[:6])), (None, " ".join(passage)), (3, " ".join(passage[::-1]))], "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(passage))], "item_id long, text string")
    got = {r.doc_id: r.contaminated for r in decontaminate.decontaminate(docs, bench).collect()}
    assert got == {1: True, 2: False, None: False, 3: False}
    assert decontaminate.decontaminate(docs, bench.limit(0)).where("contaminated").count() == 0


def test_many_matches_and_long_candidates(spark):
    """Folds go over blocks; what they find is that of one fold."""
    rng = random.Random(4)
    letters = string.ascii_letters + string.digits
    many = " ".join(f"token={''.join(rng.choices(letters, k=9))}" for _ in range(900))
    long = "".join(rng.choice(letters) if k % 90 < 60 else "aA1"[k % 3] for k in range(3000))
    docs = [(1, many), (2, "x " + long + " y"), (3, None), (4, "".join(rng.choices("0123456789abcdef", k=700)))]
    for r in secret_scan.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        text = dict(docs)[r.doc_id]
        want = brute.base_spans(text) + brute.entropy_spans(text, secret_scan.CANDIDATE, secret_scan.ALLOWED, secret_scan.CLASSES, secret_scan.WINDOW)
        assert r.spans == brute.written(want)


def test_long_text_with_repeats(spark):
    text = " ".join(f"w{k * k % 611}" for k in range(40_000))
    (got,) = quality_rules.statistics(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert tuple(got)[1:6] == brute.statistics(text)
