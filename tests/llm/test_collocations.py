"""Collocations against a plain version, and the perfect hash behind them."""

import re
from collections import Counter

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerframe.llm import collocations, textops
from ledgerframe.llm.perfect_hash import PerfectHash

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def plain(docs, least, top):
    """Rows of the contract from (lang, text) by counting every phrase."""
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(brute.LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    found = {key: a for key, a in f.items() if a >= least}
    inside = {}
    for (lang, w), a in found.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                key = lang, w[i : i + k]
                inside[key] = max(inside.get(key, 0), a)
    rows = {}
    for (lang, w), a in found.items():
        if len(w) < 2 or 100 * inside.get((lang, w), 0) >= 100 * a:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        rows.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    out = []
    for lang, some in rows.items():
        for rank, (s, a, p, l, r) in enumerate(sorted(some)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def rows(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.fixture(scope="module")
def hard():
    """Nulls, empty and long texts, phrases within phrases, repeats, pieces of one word, a clash of languages."""
    texts = [("en", None), (None, "a b a b c. " * 30), ("und", "a b c, a b c d e f\tg!b a" * 20), ("en", ""), ("en", " \n . , ")]
    texts += [("en", "The quick Brown fox the QUICK brown: fox " * 40), ("de", "x x x x x x x y x x x;x x " * 50), ("fr", "où est où est. est où est " * 30)]
    texts += [("en", " ".join(f"w{k % 7} w{k % 11}" for k in range(40_000))), ("en", "." * 300 + "one;two;three " * 200)]
    return texts + texts[5:7]


@pytest.mark.parametrize(("least", "top", "keys", "slice_bytes"), [(100, 2000, collocations.KEYS, 1 << 20), (10, 10, 30, 500)])
def test_hard_cases(spark, hard, least, top, keys, slice_bytes, monkeypatch):
    """Also with a few keys a perfect hash, so that words and phrases take many rounds."""
    monkeypatch.setattr(textops, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(collocations, "KEYS", keys)
    docs = hard if keys > 100 else [(a, (b or "")[:3000]) for a, b in hard]
    df = spark.createDataFrame([(k, a, b, None, "x") for k, (a, b) in enumerate(docs)], "doc_id long, lang string, text string, n string, word string").repartition(3)
    got = rows(collocations.collocations(df, least=least, top=top, keys=keys))
    assert got == plain(docs, least, top) and got


def test_real_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = [(r.lang, r.text) for r in df.collect()]
    assert rows(collocations.collocations(df, least=8, top=50)) == plain(docs, 8, 50)


def test_empty(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(df).collect() == []
    assert collocations.collocations(spark.createDataFrame([(None, None), ("en", "a b")], "lang string, text string")).collect() == []


@given(st.lists(st.integers(0, 9), max_size=40))
@settings(max_examples=100, deadline=None)
def test_tight_keeps_neighbours(numbers):
    some = np.array(numbers, np.uint32)
    pairs = lambda x: [(int(a), int(b)) for a, b in zip(x[:-1], x[1:]) if a and b]
    assert pairs(collocations.tight(some)) == pairs(some)


def test_perfect_hash():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 100_000, dtype=np.uint64))
    h = PerfectHash(keys)
    slots = h.slots(keys)
    assert np.array_equal(np.sort(slots), np.arange(len(keys))) and np.array_equal(h.keys[slots], keys)
    other = np.setdiff1d(rng.integers(0, 1 << 63, 100_000, dtype=np.uint64), keys)
    assert (h.slots(other) == -1).all()
    assert len(PerfectHash(keys[:0]).slots(other)) == len(other) and PerfectHash(keys[:1]).slots(keys[:1]).tolist() == [0]
