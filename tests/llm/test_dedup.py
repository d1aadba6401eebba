import random
from collections import defaultdict

import brute
import pytest

from ledgerframe.llm import block_dedup, jaccard_join, suffix_dedup


def test_jaccard_components(frame, documents):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(frame, shingle=4, threshold=(85, 100)).collect()}
    assert got == brute.components(documents, 4, 85, 100)


def test_jaccard_edges(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, None), (3, "A b c d e f")], "doc_id long, text string")
    got = sorted(((r.doc_id or 0), r.component_id) for r in jaccard_join.jaccard_components(docs).collect())
    assert got == [(0, None), (1, 1), (1, 1), (2, 2), (3, 1)]
    assert jaccard_join.jaccard_components(docs.limit(0)).count() == 0


def test_window_repeats(frame, documents):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in block_dedup.remove_repeats(frame).collect()}
    assert got == brute.window_repeats(documents)


@pytest.mark.parametrize("group", [50_000, 3])
def test_byte_repeats(frame, documents, group):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(frame, group=group).collect()}
    assert got == brute.byte_repeats(documents)


def test_repeats_of_edge_rows(spark):
    docs = spark.createDataFrame([(None, "x " * 300), (4, None), (4, "x " * 300)], "doc_id long, text string")
    assert {(r.doc_id, r.n_removed) for r in suffix_dedup.remove_repeats(docs).collect()} == {(None, 0), (4, 0), (4, 600)}
    assert {(r.doc_id, r.n_words, r.n_removed) for r in block_dedup.remove_repeats(docs).collect()} == {(None, 300, 0), (4, 0, 0), (4, 300, 299)}
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == block_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_groups_are_maximal_repeats(spark):
    """Every group has two occurrences or more, all with the same bytes, that differ on both sides or end there; each
    string of the length that occurs twice lies in one, with all its occurrences."""
    rng = random.Random(3)
    letters = "abcd"
    draw = lambda n: "".join(rng.choices(letters, k=n))
    shared, other = draw(260), draw(230)
    docs = [(1, draw(150) + shared + draw(90)), (2, draw(40) + shared[20:] + draw(200)), (3, shared + other), (4, draw(10) + other + draw(5)), (5, draw(400)), (6, "xyz" * 200), (None, shared)]
    got = defaultdict(set)
    for r in suffix_dedup.groups(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        got[r.g, r.part].add((r.doc_id, r.start, r.end))
    text = {d: t for d, t in docs if d}
    covered = {d: set() for d in text}
    for places in got.values():
        assert len(places) > 1 and len({text[d][a:b] for d, a, b in places}) == 1
        assert all(b - a >= 200 for _, a, b in places)
        for d, a, b in places:
            covered[d] |= set(range(a, b))
    seen = defaultdict(list)
    for d, t in text.items():
        for k in range(len(t) - 199):
            seen[t[k : k + 200]].append((d, k))
    for places in (p for p in seen.values() if len(p) > 1):
        whole = [g for g in got.values() if all(any(e == d and a <= k and k + 200 <= b for e, a, b in g) for d, k in places)]
        assert whole
    assert covered == {d: {k + j for p in seen.values() if len(p) > 1 for e, k in p if e == d for j in range(200)} for d in text}


@pytest.mark.parametrize("group", [50_000, 3])
def test_byte_repeats_of_near_copies(spark, group):
    """Families whose members differ at many places, so that trees are deep on both sides."""
    rng = random.Random(9)
    docs = []
    for family in range(3):
        base = [rng.choice("abcdefgh ") for _ in range(900)]
        for _ in range(25):
            text = list(base)
            for k in rng.sample(range(900), rng.randrange(6)):
                text[k] = "#"
            docs.append((len(docs), "".join(text[rng.randrange(200) :])))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), group=group).collect()}
    assert got == brute.byte_repeats(docs)
