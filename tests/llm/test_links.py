"""Components and numbers of links of the Jaccard join, against all pairs."""

import random
from collections import Counter

import brute
import numpy as np
import pytest

from ledgerframe.llm import jaccard_join, regions


def degrees(docs, size, num, den):
    sets = {d: brute.shingles(t, size) for d, t in docs}
    out = Counter({d: 0 for d in sets})
    for a in sets:
        for b in sets:
            n = len(sets[a] & sets[b])
            out[a] += a != b and n > 0 and den * n >= num * (len(sets[a]) + len(sets[b]) - n)
    return dict(out)


def families(rng, count, members, base_words=90, edits=3):
    docs = []
    for family in range(count):
        base = [f"f{family}w{k}" for k in range(base_words)]
        for _ in range(members):
            text = list(base[: rng.randrange(base_words - 20, base_words + 1)])
            for k in rng.sample(range(len(text)), rng.randrange(edits)):
                text[k] = f"x{rng.randrange(10**9)}"
            docs += [(len(docs) + k, " ".join(text)) for k in range(rng.choice((1, 1, 3)))]
    return docs


@pytest.mark.parametrize("most", [1024, 7])
def test_links_of_dense_families(spark, monkeypatch, most):
    """With seven members to a task, rounds of cells and tiles go through Spark."""
    monkeypatch.setattr(jaccard_join, "MEMBERS", most)
    docs = families(random.Random(8), 4, 25)
    docs += [(5000, "nothing like it at all here"), (5001, ""), (5002, None)]
    want = degrees(docs, 4, 85, 100)
    assert max(want.values()) > 20
    out = jaccard_join.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"), shingle=4, threshold=(85, 100)).collect()
    assert {r.doc_id: r.n_links for r in out} == want
    assert {r.doc_id: r.component_id for r in out} == {d: top for d, (_, top) in brute.components(docs, 4, 85, 100).items()}


@pytest.mark.parametrize("most", [1024, 60, 11])
def test_chain_of_near_copies(spark, monkeypatch, most):
    """Each document is near the next ones alone, and cells have true borders. With room for 60 members the chain is
    taken apart into its slices, none of which is cut."""
    monkeypatch.setattr(jaccard_join, "MEMBERS", most)
    words = [f"w{k}" for k in range(700)]
    docs = [(k, " ".join(words[4 * k : 4 * k + 100])) for k in range(140)]
    out = jaccard_join.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_links for r in out} == degrees(docs, 5, 4, 5)
    assert {r.component_id for r in out} == {0}


def pairs_of(sets, num, den):
    n = len(sets)
    return np.array([sum(j != i and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]) for j in range(n)) for i in range(n)])


@pytest.mark.parametrize("kind", ["family", "chain", "mixed"])
def test_cells_decide_each_pair_once(kind):
    rng = random.Random(5)
    if kind == "family":
        base = list(range(120))
        sets = [set(rng.sample(base, 112)) | {1000 * k + j for j in range(3)} for k in range(1, 90)]
    elif kind == "chain":
        sets = [set(range(3 * k, 3 * k + 60)) for k in range(150)]
    else:
        sets = [set(range(1000 * (k % 12), 1000 * (k % 12) + 70)) | {10**6 + k + j for j in range(k % 5)} | {7, 8} for k in range(160)]
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    region = regions.Members(arrays, np.ones(len(sets), np.int64), [np.zeros(0, np.int64)] * len(sets), 4, 5)
    region.decide_all()
    assert (region.degree == pairs_of(sets, 4, 5)).all()
    # more than one round, and for what has any shape less work than all pairs
    assert region.rounds > 2


def test_same_id_with_two_texts(spark):
    a, b = " ".join(f"a{k}" for k in range(50)), " ".join(f"b{k}" for k in range(50))
    docs = [(1, a), (1, b), (2, a + " tail"), (3, b + " tail"), (0, b)]
    for part in (1, 3):
        out = jaccard_join.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string").repartition(part)).collect()
        assert sorted((r.doc_id, r.component_id, r.n_links) for r in out) == [(0, 0, 2), (1, 0, 2), (1, 1, 1), (2, 1, 1), (3, 0, 2)]


def test_regions_of_sf001_elect_several_pivots(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    elected = []
    kept = regions.Members.measure

    def watched(self, pivots, index):
        elected.append(len(pivots))
        return kept(self, pivots, index)

    sets = list(jaccard_join.shingle_sets(*_flat([r.text or "" for r in docs.select("text").collect()]), 4))
    regions.Members.measure = watched
    try:
        region = regions.Members(sets, np.ones(len(sets), np.int64), [np.zeros(0, np.int64)] * len(sets), 85, 100)
        region.decide_all()
    finally:
        regions.Members.measure = kept
    assert sum(n > 1 for n in elected) > 10
    sets = [set(s.tolist()) for s in sets]
    index = {}
    for k, s in enumerate(sets):
        for g in s:
            index.setdefault(g, []).append(k)
    want = np.zeros(len(sets), np.int64)
    for k, s in enumerate(sets):
        for o, n in Counter(o for g in s for o in index[g]).items():
            want[k] += o != k and 100 * n >= 85 * (len(s) + len(sets[o]) - n)
    assert (region.degree == want).all()


def _flat(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw])))
