"""Context-tree weighting against a plain recursion, and the scores of the registered query."""

import math
import pickle
import zlib
from collections import Counter

import brute
import numpy as np
import pytest

from ledgerframe.llm import context_tree as C
from ledgerframe.llm import queries, textops
from ledgerframe.llm.store import Scratch

SF = "/root/testdata/sf0.001"


def strings(text):
    """Symbols of a text with the bytes before each."""
    raw = bytes([255] * C.ORDER) + (text or "").translate(brute.LOWER).encode() + b"\xff"
    return [raw[i - C.ORDER : i + 1] for i in range(C.ORDER, len(raw))]


class Plain:
    """The same by dictionaries: counts of all contexts of all decisions, and the definition of the weighted mix."""

    def __init__(self, texts, most):
        every = [s for t in texts for s in strings(t)]
        self.least = max(1, -(-len(every) // most))
        self.counts = {}
        for s in every:
            for j in range(8):
                so_far, bit = 1 << j | s[-1] >> 8 - j, s[-1] >> 7 - j & 1
                for depth in range(C.ORDER + 1):
                    self.counts.setdefault((so_far, s[C.ORDER - depth : C.ORDER]), [0, 0])[bit] += 1
        self.kept = {k for k, c in self.counts.items() if sum(c) >= self.least}
        self.children = {}
        for so_far, context in self.kept:
            if context:
                self.children.setdefault((so_far, context[1:]), []).append((so_far, context))
        self.memo = {}

    @staticmethod
    def estimate(z, o):
        return math.lgamma(z + 0.5) + math.lgamma(o + 0.5) - math.lgamma(z + o + 1) - math.log(math.pi)

    def rest(self, node):
        z, o = self.counts[node]
        for c in self.children[node]:
            z, o = z - self.counts[c][0], o - self.counts[c][1]
        return z, o

    def weighted(self, node):
        if node not in self.memo:
            own = self.estimate(*self.counts[node])
            if node in self.children:
                below = sum(self.weighted(c) for c in self.children[node]) + self.estimate(*self.rest(node))
                own = np.logaddexp(own, below) - math.log(2)
            self.memo[node] = own
        return self.memo[node]

    def chance(self, node, context):
        """Chance of a one at a node that is kept, in the whole context."""
        z, o = self.counts[node]
        own = (o + 0.5) / (z + o + 1)
        if node not in self.children:
            return own
        weight = math.exp(self.estimate(z, o) - math.log(2) - self.weighted(node))
        deeper = node[0], context[C.ORDER - len(node[1]) - 1 :]
        if deeper in self.kept:
            return weight * own + (1 - weight) * self.chance(deeper, context)
        z, o = self.rest(node)
        return weight * own + (1 - weight) * (o + 0.5) / (z + o + 1)

    def bits(self, s):
        out = 0
        for j in range(8):
            root, bit = (1 << j | s[-1] >> 8 - j, b""), s[-1] >> 7 - j & 1
            one = self.chance(root, s[: C.ORDER]) if root in self.kept else 0.5
            out -= math.log2(one if bit else 1 - one)
        return out


TEXTS = ["the cat sat on the mat, the cat sat.", "The dog sat on the log!", "", None, "élan été é", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaab" * 3]


@pytest.mark.parametrize("most", [1 << 18, 20, 3])
def test_against_recursion(spark, most):
    model, plain = C.learn(spark.createDataFrame([(t,) for t in TEXTS], "text string").repartition(3), most), Plain(TEXTS, most)
    asked = [s for t in [*TEXTS, "the unseen text \U0001f642 zzzz"] for s in strings(t)]
    got = model.bits(np.array([int.from_bytes(s, "big") for s in asked], np.uint64))
    assert np.allclose(got, [plain.bits(s) for s in asked], rtol=1e-9)


def test_chances_sum_to_one(spark):
    model = C.learn(spark.createDataFrame([(t,) for t in TEXTS], "text string"))
    for context in (b"\xff" * C.ORDER, b"t the", b"zzzzz", b"aaaaa"):
        grams = np.array([int.from_bytes(context + bytes([x]), "big") for x in range(256)], np.uint64)
        assert abs(np.exp2(-model.bits(grams)).sum() - 1) < 1e-9


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 7, 1000.5, 1e9])
    assert np.allclose(C.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-12)


def plain_rows(docs):
    train = [(d, t) for d, t in docs if d is not None and zlib.crc32(str(d).encode()) % 7 != 2]
    tokens = lambda t: [*brute.words((t or "").translate(brute.LOWER)), ""]
    c = Counter(w for _, t in train for w in tokens(t))
    n, v = sum(c.values()), len(c)
    for d, t in docs:
        w = tokens(t)
        yield d, (d is not None and zlib.crc32(str(d).encode()) % 7 == 2, len(w), sum(c[x] > 0 for x in w), n), sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)


def check(got, docs):
    want = sorted(plain_rows(docs), key=repr)
    rows = sorted(((r.doc_id, (r.held_out, r.n_tokens, r.n_known, r.train_tokens), r.base_score, r.score) for r in got), key=lambda r: repr(r[:3]))
    assert len(rows) == len(want)
    by = lambda x: (repr(x[:2]), round(x[2], 4))
    for a, b in zip(sorted(rows, key=by), sorted(want, key=by), strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-6 * max(1, abs(b[2]))


def test_registered_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.queries()["op12_lm_scoring"](spark, SF).collect()
    check(got, docs)
    train = [t for d, t in docs if zlib.crc32(str(d).encode()) % 7 != 2]
    plain, texts = Plain(train, C.NODES), dict(docs)
    for r in sorted(got, key=lambda r: r.n_tokens)[:40]:
        bits = sum(plain.bits(s) for s in strings(texts[r.doc_id]))
        assert abs(r.score + bits * math.log10(2)) < 1e-4 * max(1, bits)
    # texts that it hasn't seen take less than a third of their bytes, hardly more than those that it has
    unseen = [r.bits_per_byte for r in got if r.held_out and r.n_tokens > 20]
    assert sum(unseen) / len(unseen) < 8 / 3


@pytest.mark.parametrize("common", [C.COMMON, 8])
def test_hard_cases(spark, common, monkeypatch):
    """Nulls, repeats of an id with other texts, long texts cut in small steps, words that only unlearned texts have."""
    monkeypatch.setattr(textops, "SLICE_BYTES", 100)
    monkeypatch.setattr(C, "_STEP", 77)
    docs = list(enumerate(TEXTS * 3)) + [(None, "the cat"), (None, None), (1, "another text of one id"), (1, "another text of one id"), (50, "x" * 5000), (51, "a b " * 2000), (52, "\n\n\x0b a\x1fb \x00 ")]
    df = spark.createDataFrame([(d, t, None, "x") for d, t in docs], "doc_id long, text string, score double, row string").repartition(3)
    got = C.score(df, common=common).collect()
    check(got, docs)
    by = {}
    for r in got:
        by.setdefault((r.n_tokens, round(r.base_score, 6), r.bits_per_byte), set()).add(round(r.score, 9))
    assert all(len(x) == 1 for x in by.values()) and all(r.score < 0 for r in got)


def test_empty(spark):
    assert C.score(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    r = C.score(spark.createDataFrame([(None, "ab")], "doc_id long, text string")).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (2, 0, 0, 0) and abs(r.bits_per_byte - 8) < 1e-9


def test_all_depths_are_counted(spark, tmp_path):
    grams = spark.createDataFrame([(int.from_bytes(s, "big"), 1) for s in strings("abcab")], "gram long, n long")
    counts = C.nodes(grams, 1, Scratch(spark, "test"))
    assert [int((z + o).sum()) for _, z, o in counts] == [6 * 8] * (C.ORDER + 1)


def test_what_never_came_has_a_chance():
    """Bytes that a model of a billion like symbols has never seen, in a task that got it from the driver."""
    n = 1e9
    so_far = [1 << j | 0x61 >> 8 - j for j in range(8)]
    ones = np.array([n * (0x61 >> 7 - j & 1) for j in range(8)])
    inner = np.array([c << 8 | b for c in [0x61] for b in so_far], np.uint64)
    model = C.Model([(np.array(so_far, np.uint64), n - ones, ones), (inner, n - ones, ones)])
    grams = np.array([int.from_bytes(b"aaaaa" + bytes([x]), "big") for x in range(256)], np.uint64)
    got = pickle.loads(pickle.dumps(model)).bits(grams)
    assert np.isfinite(got).all() and (got > 0).all() and np.allclose(got, model.bits(grams)) and abs(np.exp2(-got).sum() - 1) < 1e-9


@pytest.mark.parametrize("hot", [C.HOT, 3, 0])
def test_rare_contexts_are_told_apart(spark, hot):
    """Contexts that came once in more than 2**18 symbols; strings looked up in the task and by a join."""
    docs = list(enumerate([*TEXTS, "another cat on another mat", "a cot, a mut", "y" * (1 << 18)] * 2))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    plain = Plain([t for d, t in docs if zlib.crc32(str(d).encode()) % 7 != 2], 1 << 62)
    costs = {s: plain.bits(s) for s in {s for _, t in docs for s in strings(t)}}
    got = {r.doc_id: r.score for r in C.score(df, hot=hot).collect()}
    assert len(got) == len(docs)
    for d, t in docs:
        bits = sum(costs[s] for s in strings(t))
        assert abs(got[d] + bits * math.log10(2)) < 1e-9 * max(1, bits), (d, t and t[:30])
