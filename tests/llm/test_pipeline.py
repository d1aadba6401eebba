"""The pipeline's stages, each on what its predecessor kept, against plain versions."""

import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from ledgerframe.llm import decontaminate

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r.doc_id, r.text) for r in docs.collect()] if k < 5 else []
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert docs.columns == columns
            seen[name] = (before, Counter(r.doc_id for r in docs.collect()))
        else:
            seen[name] = (before, docs.collect())
    before, kept = seen["quality rules"]
    for d, t in before:
        n, _, _, _, again = brute.statistics(t)
        assert d not in kept or not (n < 50 or 100 * again > 50 * n)
    assert len(kept) > 0.5 * sum(brute.statistics(t)[0] >= 50 for _, t in before)
    before, kept = seen["n-gram jaccard join"]
    assert set(kept) == {d for d, (_, top) in brute.components(before, 5, 4, 5).items() if d == top}
    before, kept = seen["benchmark decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = brute.leaks(before, items, decontaminate.needed, decontaminate.STRETCH)
    assert set(kept) == {d for d, _ in before} - set(leaked)
    before, kept = seen["mixing sources"]
    assert set(kept) <= {d for d, _ in before} and max(kept.values()) <= 3
    before, rows = seen["token output"]
    model, start, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for d, t in sorted(before):
        ids = [*model.encode(t, add_special_tokens=False).ids, 0]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows) == sorted(want)


def test_run_is_registered(spark):
    assert corpus_pipeline.ORACLE_SQL is None
    out = __spark_entry__.queries()["pipeline"](spark, SF)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 0


EDGE = "doc_id long, text string, lang string, source string, n_chars long, _id long, copies long, row string, digest string"


def test_stages_decide_on_rows(spark, tmp_path):
    """Rows without an id, that repeat an id or a text, or hold nothing; and columns with the names that stages use."""
    long = lambda seed: " ".join(f"{seed}word{k}" for k in range(60))
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").where("text is not null").first().text
    rows = [(None, long("a")), (None, long("a")), (3, long("a")), (3, long("a")), (2, long("a") + " tail"), (5, long("b")), (5, long("c")), (6, None), (7, ""), (8, "few words"), (None, bench + " " + long("d")), (9, long("e") + " " + bench)]
    docs = spark.createDataFrame([(d, t, "en", "s", 1, 77, 88, "r", "g") for d, t in rows], EDGE)
    key = lambda df: sorted(((r.doc_id or 0), r.text or "") for r in df.collect())
    as_key = lambda some: sorted(((d or 0), t or "") for d, t in some)
    kept = corpus_pipeline.quality(spark, docs, SF)
    assert kept.columns == docs.columns and key(kept) == as_key(r for r in rows if len(brute.words(r[1])) >= 50)
    assert {(r["_id"], r.copies, r.row, r.digest) for r in kept.collect()} == {(77, 88, "r", "g")}
    kept.write.parquet(str(tmp_path / "0"))
    docs = spark.read.parquet(str(tmp_path / "0"))
    kept = corpus_pipeline.near_duplicates(spark, docs, SF)
    one = [(2, long("a") + " tail"), (5, long("b")), (5, long("c")), (None, bench + " " + long("d")), (9, long("e") + " " + bench)]
    assert kept.columns == docs.columns and key(kept) == as_key(one)
    clean = corpus_pipeline.decontamination(spark, kept, SF)
    assert clean.columns == docs.columns and key(clean) == as_key(one[:3])
    # two rows of one id with texts of other sizes and sources have copies of their own
    mixed = spark.createDataFrame([(1, long("x"), "en", "s"), (1, long("y") + " more", "en", "t"), (1, None, "en", None), (None, long("z"), "en", None), (None, "", "en", "s")], "doc_id long, text string, lang string, source string")
    taken = corpus_pipeline.mixture(spark, mixed, SF)
    assert taken.columns == mixed.columns
    counts = Counter((r.doc_id, r.text) for r in taken.collect())
    assert max(counts.values()) <= 3 and (1, None) not in counts and (None, "") not in counts
    for stage in (corpus_pipeline.quality, corpus_pipeline.near_duplicates, corpus_pipeline.decontamination, corpus_pipeline.mixture, corpus_pipeline.tokens):
        assert stage(spark, docs.limit(0), SF).count() == 0
    tokens = corpus_pipeline.tokens(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    assert Counter(r.doc_id for r in tokens.collect()) == Counter(d for d, _ in rows)
