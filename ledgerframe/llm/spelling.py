"""Spelling variants: words at edit distance one of each other, found by a self-join of vocabulary tries.

The vocabulary is cut into tries by prefix. Two words at distance one, the shorter of m code points, agree up to the
first place i where they differ and, but for one code point, after it. So they share their first h code points (i >= h)
or their last m - h (i < h): with h in the middle, every pair meets in exactly one of two tries, one below a shared
prefix and one before a shared ending. A trie of too many words is cut again in the middle of what its words don't
share, as often as it takes; at the end one or two free code points are left, which the alphabet bounds.

Inside a trie, every node has a set of active nodes, those at distance one of it. A child's set follows from its
parent's: active nodes step on by the child's code point, and the parent, the siblings and the child's own children are
active by one deletion, replacement or insertion. Two words are near if the node of one is active for the other's. All
nodes of one depth, of all tries in a block of rows, take this step together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import Scratch

#: Words of a trie that one step of a task takes; larger tries are cut. It is also the number of rows that are worked on
#: together.
TRIE = 20_000
#: Code points fit in so many bits.
_BITS = 21
RUN = r"[A-Za-zÀ-ÿ]+"


def lowered(run: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    plain = F.lower(run)
    upper = "".join(map(chr, range(65, 91)))
    return F.when(run.rlike(r"[À-Þ]"), F.translate(run, upper, upper.lower())).otherwise(plain)


def vocabulary(docs: DataFrame, text: str = "text", key: str = "doc_id", shortest: int = 5, least: int = 3) -> DataFrame:
    """(word, n): runs of letters in lower case, with one code point deleted in about one of 97 (see the contract of the
    query), that have ``shortest`` code points and occur ``least`` times. A null id counts as an empty one."""
    run = F.explode(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({RUN})"), F.lit(1)))
    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"), run.alias("run")).where(F.length("run") >= shortest)
    rows = rows.select("k", lowered(F.col("run")).alias("run")).withColumn("h", F.crc32(F.encode(F.concat("k", F.lit(":"), "run"), "UTF-8")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % 97 == 0, cut).otherwise(F.col("run")).alias("word")
    return rows.select(word).where(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows (word, n, m, lo, hi) with the key of their trie: all that its words share. Pairs of the trie differ first at
    a place from ``lo`` on and before ``hi``."""
    pre = F.substring("word", F.lit(1), F.col("lo"))
    after = F.greatest(F.col("m") - F.col("hi"), F.lit(0))
    post = F.when(after > 0, F.substring("word", F.length("word") - after + 1, after)).otherwise("")
    # words are letters, so a space can't be part of them
    return rows.withColumn("trie", F.concat_ws(" ", "m", "lo", "hi", pre, post))


def _halves(rows: DataFrame) -> DataFrame:
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    both = F.array(F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi").alias("hi")))
    return _keyed(rows.select("word", "n", "m", F.explode(both).alias("x")).select("word", "n", "m", "x.lo", "x.hi"))


def tries(words: DataFrame, scratch: Scratch, most: int) -> DataFrame:
    """Every word (word, n) once for each trie it belongs to: (word, n, m, lo, hi, trie), at most ``most`` words a trie,
    but for those that can't be cut further."""
    bases = F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("m")
    rows = words.select("word", "n", bases).withColumns({"lo": F.lit(0), "hi": F.col("m") + 1})
    done, step = None, 0
    while True:
        rows = scratch.keep(_halves(rows), f"cut-{step}")
        large = rows.groupBy("trie").agg(F.count(F.lit(1)).alias("c"), F.first(F.col("hi") - F.col("lo")).alias("free")).where((F.col("c") > most) & (F.col("free") > 1))
        large = scratch.keep(large.select("trie"), f"large-{step}")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        fine = rows.join(large, "trie", "left_anti").select(*rows.columns)
        done = fine if done is None else done.unionByName(fine)
        rows, step = rows.join(large, "trie", "left_semi").select("word", "n", "m", "lo", "hi"), step + 1


class Tries:
    """The tries of a block of words: node numbers grow with depth, and a node's children stand together."""

    def __init__(self, trie: np.ndarray, points: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        """``trie``: number of each word's trie, from 0; its free code points are points[start : start + size]."""
        self.roots = int(trie.max()) + 1 if len(trie) else 0
        now = trie.astype(np.int64)
        keys, base, depth = [], self.roots, 0
        single = np.full(self.roots, -1, np.int64)
        few = np.bincount(trie, minlength=self.roots)
        single[trie] = np.arange(len(trie))
        single[few > 1] = -1
        singles = [single]
        live = np.arange(len(trie))
        while len(live := live[sizes[live] > depth]):
            key = now[live] << _BITS | points[starts[live] + depth]
            found, own, many = np.unique(key, return_inverse=True, return_counts=True)
            keys.append(found)
            now[live] = base + own
            single = np.full(len(found), -1, np.int64)
            single[own] = live
            # a node of several words is no word's own; one that ends a word and leads on has several
            single[many > 1] = -1
            singles.append(single)
            base, depth = base + len(found), depth + 1
        self.key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        self.parent, self.point = self.key >> _BITS, self.key & (1 << _BITS) - 1
        self.single = np.concatenate(singles)
        self.first = np.searchsorted(self.parent, np.arange(base + 1))
        self.word = np.full(base, -1, np.int64)
        self.word[now] = np.arange(len(trie))
        self.depths = np.cumsum([0, *[len(s) for s in singles]])

    def children(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index into ``nodes`` and child, for all their children."""
        n = self.first[nodes + 1] - self.first[nodes]
        each = np.repeat(np.arange(len(nodes)), n)
        return each, self.roots + self.first[nodes][each] + np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)

    def step(self, nodes: np.ndarray, points: np.ndarray) -> np.ndarray:
        """The child of each node by a code point, or -1."""
        if not len(self.key):
            return np.full(len(nodes), -1)
        key = nodes << _BITS | points
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.roots + at, -1)

    def _useful(self, u: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Different pairs, without those below which there is only one word."""
        ok = (w >= 0) & ((self.single[u] < 0) | (self.single[u] != self.single[w]))
        both = np.unique(u[ok] << 32 | w[ok])
        return both >> 32, both & 0xFFFFFFFF

    def near(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of words at distance one, in both orders."""
        roots = np.arange(self.roots)
        each, below = self.children(roots)
        u, w = self._useful(roots[each], below)
        out = []
        for depth in range(1, len(self.depths)):
            nodes = np.arange(self.depths[depth - 1], self.depths[depth])
            # what is active for the parent steps on with the child
            a, b = np.searchsorted(u, nodes), np.searchsorted(u, nodes + 1)
            each, child = self.children(nodes)
            n = (b - a)[each]
            pair = np.repeat(a[each], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            child_of = np.repeat(child, n)
            stepped = self.step(w[pair], self.point[child_of - self.roots])
            # one edit here: the parent, the siblings and the children of the child
            some = child[self.single[nodes][each] < 0]
            up = self.parent[some - self.roots]
            sib_of, sibling = self.children(up)
            own, below = self.children(child)
            u = np.concatenate((child_of, some, some[sib_of], child[own]))
            w = np.concatenate((stepped, up, sibling, below))
            ok = u != w
            u, w = self._useful(u[ok], w[ok])
            ends = (self.word[u] >= 0) & (self.word[w] >= 0)
            out.append(np.stack((self.word[u[ends]], self.word[w[ends]])))
        # an empty remainder is a root that is a word itself
        first = self.word[:self.roots]
        if (first >= 0).any():
            at = np.flatnonzero(first >= 0)
            each, below = self.children(at)
            ends = self.word[below] >= 0
            out.append(np.stack((first[at[each[ends]]], self.word[below[ends]])))
        found = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
        return found[0], found[1]


def _pairs(words: list[str], n: np.ndarray, trie: np.ndarray, m: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.RecordBatch:
    """Pairs of words that are near and meet in one of the given tries, in both orders."""
    raw = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    length = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(length) - length
    size = length - lo - np.maximum(m - hi, 0)
    a, b = Tries(trie, raw, starts + lo, size).near()
    # pairs of two longer words belong to the next length, pairs that agree up to ``hi`` to another trie
    ok = (length[a] == m[a]) | (length[b] == m[b])
    a, b = a[ok], b[ok]
    agree = np.zeros(len(a), bool)
    bounded = np.flatnonzero(hi[a] <= m[a])
    for x in bounded:
        agree[x] = words[a[x]][: hi[a[x]]] == words[b[x]][: hi[a[x]]]
    a, b = a[~agree], b[~agree]
    named = pa.array(words, pa.string())
    return pa.RecordBatch.from_arrays([named.take(pa.array(a)), named.take(pa.array(b)), pa.array(n[b])], names=["word", "near", "near_n"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of rows that come sorted by trie, some ``TRIE`` rows and whole tries at a time."""

    def worked(table: pa.Table) -> pa.RecordBatch:
        keys = table.column("trie").combine_chunks().dictionary_encode()
        number = lambda c: table.column(c).to_numpy().astype(np.int64)
        return _pairs(table.column("word").to_pylist(), number("n"), keys.indices.to_numpy().astype(np.int64), number("m"), number("lo"), number("hi"))

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(x.num_rows for x in held) < TRIE:
            continue
        table = pa.Table.from_batches(held)
        last = table.column("trie")[-1]
        same = np.asarray(pc.equal(table.column("trie"), last).combine_chunks().to_numpy(zero_copy_only=False))
        start = int(np.flatnonzero(same)[0])
        if start:
            yield worked(table.slice(0, start))
        held = table.slice(start).to_batches()
    if held:
        yield worked(pa.Table.from_batches(held))


def near_words(words: DataFrame, most: int = TRIE) -> DataFrame:
    """(word, near, near_n): the pairs of (word, n) at distance one, in both orders, each once."""
    scratch = Scratch(words.sparkSession, "tries")
    rows = tries(words, scratch, most).repartition("trie").sortWithinPartitions("trie")
    return scratch.keep(rows.mapInArrow(_joined, "word string, near string, near_n long"), "near")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the links (word, form) end. Each round doubles the length of what it follows, and a chain is
    no longer than counts can be doubled, so there are few."""
    scratch = Scratch(forms.sparkSession, "forms")
    now = scratch.keep(forms.select("word", F.col("form").alias("root")), "step-0")
    step = 0
    while True:
        step += 1
        then = now.select(F.col("word").alias("_at"), F.col("root").alias("_to"))
        out = now.join(then, F.col("root") == F.col("_at"), "left")
        out = scratch.keep(out.select("word", F.coalesce("_to", "root").alias("root"), F.col("_to").isNotNull().alias("moved")), f"step-{step}")
        now = out.select("word", "root")
        if out.where("moved").isEmpty():
            return now
        scratch.drop(f"step-{step - 1}")


def variants(docs: DataFrame, text: str = "text", key: str = "doc_id", shortest: int = 5, least: int = 3, most: int = TRIE) -> DataFrame:
    """One row (word, form, root, n, n_near, form_n) for each word of ``vocabulary``.

    A word's form is its near word of largest n (ties: the smallest), if that is twice the word's own at least; its root
    is where its forms end, itself if it has none. Null and empty texts have no words; an empty table gives no rows;
    repeated rows count as often as they occur; a null id counts as an empty one; other columns are ignored.
    """
    words = Scratch(docs.sparkSession, "vocabulary").keep(vocabulary(docs, text, key, shortest, least), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best")
    near = near_words(words, most).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    met = words.join(near, "word", "left")
    has = -F.col("best.n") >= 2 * F.col("n")
    met = Scratch(docs.sparkSession, "nearest").keep(
        met.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best.near")).alias("form"), F.when(has, -F.col("best.n")).alias("form_n")),
        "words",
    )
    ends = roots(met.where("form is not null").select("word", "form"))
    return met.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
