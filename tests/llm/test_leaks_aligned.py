"""Decontamination against a version that slides every item along every document, without seeds."""

import itertools
import random

import brute
import pytest

from ledgerframe.llm import decontaminate


def aligned(docs, items, stretch=20, share=75):
    """{doc_id: set of items} of all alignments: the threshold on each stretch, or on the whole of a shorter item."""
    found = {}
    for (d, t), (i, x) in itertools.product(docs, items):
        w, x = ([y.lower() for y in brute.words(z)] for z in (t, x))
        size = min(stretch, len(x))
        if not size:
            continue
        for shift in range(-len(x), len(w)):
            eq = [int(0 <= shift + k < len(w) and w[shift + k] == x[k]) for k in range(len(x))]
            if max(sum(eq[k : k + size]) for k in range(len(x) - size + 1)) >= (size if size < decontaminate.LEAST else size * share / 100):
                found.setdefault(d, set()).add(i)
    return found


def _copies(rng, words, n):
    """Copies of a passage with words replaced: every 5th, 4th or 3rd, or n of them at random."""
    fresh = lambda: f"x{rng.randrange(10**9)}"
    for period, start in [(p, s) for p in (3, 4, 5) for s in range(p)]:
        yield [fresh() if k % period == start else w for k, w in enumerate(words)]
    for _ in range(n if len(words) > 2 else 0):
        gone = set(rng.sample(range(len(words)), rng.randrange(1, len(words) // 3 + 1)))
        yield [fresh() if k in gone else w for k, w in enumerate(words)]


def test_every_pattern_within_the_threshold_is_found(spark):
    rng = random.Random(5)
    items = [(k, " ".join(f"I{k}w{j}" for j in range(n))) for k, n in enumerate((0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 30, 59))]
    docs, common = [], [f"c{k}" for k in range(9)]
    for _, text in items:
        for copy in _copies(rng, text.split(), 12):
            around = [rng.choices(common, k=rng.randrange(30)) for _ in range(2)]
            docs.append((len(docs), " ".join([*around[0], *copy, *around[1]])))
    # pieces of a long item: too short, and just long enough
    docs += [(1000 + n, " ".join(items[-1][1].split()[7 : 7 + n])) for n in range(12, 20)]
    want = aligned(docs, items)
    assert len(docs) > len(want) > 150
    out = decontaminate.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id: set(r["items"]) for r in out.collect() if r.contaminated} == want


def test_every_fifth_and_fourth_word_replaced(spark):
    words = [f"w{k}" for k in range(60)]
    docs = [(p, " ".join("x" if k % p == 2 else w for k, w in enumerate(words))) for p in (3, 4, 5)]
    out = decontaminate.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(words))], "item_id long, text string"))
    assert {r.doc_id: (r.contaminated, r.equal) for r in out.collect()} == {3: (False, 0), 4: (True, 15), 5: (True, 16)}


@pytest.mark.parametrize("size", range(5, 21))
def test_masks_hit_whatever_words_are_replaced(size):
    used = [0] if size >= decontaminate.STRETCH else [1] if size > decontaminate.TEN else [1, 2]
    at = [sum(1 << (o + k) for k, c in enumerate(m) if c == "1") for m in (decontaminate.MASKS[u] for u in used) for o in range(size - len(m) + 1)]
    for gone in itertools.combinations(range(size), size - decontaminate.needed(size)):
        left = (1 << size) - 1 - sum(1 << k for k in gone)
        assert any(left & m == m for m in at)
    assert any("0" in m for m in decontaminate.MASKS)


def test_short_items_in_many_places(spark):
    """A word that fills documents meets its item once for each of them; ties and repeated rows count once."""
    docs = [(1, "The the THE " * 500), (1, "the"), (2, "of the x of"), (3, "ofthe"), (4, None), (5, ""), (6, "x of the"), (6, "x of the")]
    items = [(1, "the"), (2, "of The"), (3, "the the the the"), (4, ""), (5, None), (6, "the"), (7, "of the x y")]
    frames = spark.createDataFrame([(*d, "n") for d in docs], "doc_id long, text string, item string"), spark.createDataFrame(items, "item_id long, text string")
    hits = sorted(tuple(r) for r in decontaminate.overlaps(*frames).distinct().collect())
    assert {(d, i) for d, i, *_ in hits} == {(1, 1), (1, 3), (1, 6), (2, 1), (2, 2), (2, 6), (6, 1), (6, 2), (6, 6)}
    assert (2, 2, 0, 0, 2) in hits and (6, 1, 2, 0, 1) in hits
    out = decontaminate.decontaminate(*frames)
    assert sorted((r.doc_id, r["items"], r.equal) for r in out.where("contaminated").collect()) == [(1, [1, 3, 6], 4)] * 2 + [(2, [1, 2, 6], 2)] + [(6, [1, 2, 6], 2)] * 2
    assert out.count() == len(docs)


def test_more_seeds_than_are_broadcast(spark, monkeypatch):
    rng = random.Random(6)
    items = [(k, " ".join(f"I{k}w{j}" for j in range(n))) for k, n in enumerate((6, 12, 25, 25, 2, 1))]
    items += [(9, items[2][1])]
    docs = [(k, "a b " + " ".join(c)) for k, c in enumerate(c for _, t in items for c in _copies(rng, t.split(), 4))]
    docs += [(500, None), (501, ""), (502, items[3][1]), (502, items[3][1])]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {r.doc_id: r["items"] for r in decontaminate.decontaminate(*frames).collect()}
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", 0)
    assert {r.doc_id: r["items"] for r in decontaminate.decontaminate(*frames).collect()} == want
    assert want[502] == [3] and any(9 in x and 2 in x for x in want.values())
