"""Spelling variants against a plain version: real tables, hard cases, and tries so small that all are cut again."""

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerframe.llm import queries, spelling

SF = "/root/testdata/sf0.001"
COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def rows(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_registered_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = rows(queries.queries()["op13_spelling_variants"](spark, SF))
    assert got == brute.spelling(brute.vocabulary(docs)) and any(r[1] for r in got)


@pytest.fixture(scope="module")
def hard():
    """Nulls, an empty text, a run of 3,000 letters with its variants, runs of one letter, accents, repeated rows."""
    long = "abcdefghij" * 300
    texts = [None, "", "  ", f"{long} {long} {long} {long}x {long}x {long}x {long[1:]} " * 2, "aaaaa aaaaaa aaaaaaa " * 7, "Éclair éclair ÉCLAIR eclair " * 9]
    texts += ["colour color colours colour colour Colour " * 5, "abcde abcdf abcdg bbcde abde abcdee xabcde " * 4, "word_word word-word wordword " * 3]
    docs = [(k, t) for k, t in enumerate(texts)]
    return docs + docs[6:8] + [(None, "colour colours coulour " * 40), (6, "other text colors colors colors")]


@pytest.mark.parametrize("most", [1, 3, spelling.TRIE])
def test_hard_cases(spark, hard, most):
    df = spark.createDataFrame([(d, t, None, 1) for d, t in hard], "doc_id long, text string, n string, word int").repartition(3)
    assert rows(spelling.variants(df, most=most)) == brute.spelling(brute.vocabulary(hard))


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert rows(spelling.variants(df)) == []


@given(st.sets(st.text("abé", min_size=0, max_size=6), max_size=40))
@settings(max_examples=150, deadline=None)
def test_active_nodes(words):
    words = sorted(words)
    raw = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    a, b = spelling.Tries(np.zeros(len(words), np.int64), raw, np.cumsum(size) - size, size).near()
    got = [(words[x], words[y]) for x, y in zip(a, b)]
    assert len(got) == len(set(got)) and set(got) == {(x, y) for x in words for y in words if brute.near(x, y)}


def test_words_of_many_tries(spark):
    """Each pair is found once, though its words meet in several tries when these are cut to the last."""
    words = [(w, k + 3) for k, w in enumerate(sorted({a + b + c + "xyz" + a for a in "abc" for b in ("", "a", "b", "ab") for c in "aabbc"}))]
    got = [(r.word, r.near, r.near_n) for r in spelling.near_words(spark.createDataFrame(words, "word string, n long"), most=2).collect()]
    n = dict(words)
    assert len(got) == len(set(got)) and set(got) == {(x, y, n[y]) for x in n for y in n if brute.near(x, y)}
