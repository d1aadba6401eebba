"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to three bytes with the counts of what followed. A text costs, under a
language, the sum of exact code lengths: a byte seen in the longest context costs -log2(count / (total + distinct)), else
the escape -log2(distinct / (total + distinct)) and what it costs in the next shorter context; below order zero all 257
symbols cost the same. The statistics are frozen, so a worker works out each code length once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .store import Scratch

ORDER = 3
_PAD = 10


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts in lower case (A-Z and the accented Latin letters of two bytes), three line ends before each; the offsets."""
    low = T.LOWER[data]
    up = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)) + 1
    low[up] += 32
    n = len(offsets) - 1
    off = offsets + ORDER * np.arange(n + 1)
    out = np.full(len(data) + ORDER * n, _PAD, np.uint8)
    out[np.arange(len(data)) + ORDER * np.repeat(np.arange(1, n + 1), np.diff(offsets))] = low
    return out, off


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = T.columns(batch, "text")
        langs = np.array(batch.column(batch.schema.get_field_index("lang")).to_pylist(), object)
        names, index = np.unique(langs, return_inverse=True)
        for a, b, some, off in T.slices(data, offsets):
            out, at = padded(some, off)
            wide = out.astype(np.uint64)
            key = (wide[:-3] << 24 | wide[1:-2] << 16 | wide[2:-1] << 8 | wide[3:]) if len(out) > 3 else np.zeros(0, np.uint64)
            own = np.repeat(index[a:b], np.diff(at))
            inside = np.ones(len(out), bool)
            for k in range(ORDER):
                inside[at[:-1] + k] = False
            key = key[inside[3:]] | own[3:][inside[3:]].astype(np.uint64) << np.uint64(32)
            key, n = np.unique(key, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(names[(key >> np.uint64(32)).astype(np.int64)]), pa.string()),
                    pa.array((key & np.uint64(0xFFFFFFFF)).astype(np.int64)),
                    pa.array(n),
                ],
                names=["lang", "gram", "n"],
            )


class Tree:
    """Frozen counts of one language: for each order the contexts, with what followed them, and the strings."""

    def __init__(self, grams: np.ndarray, n: np.ndarray):
        self.orders = []
        for order in range(ORDER, -1, -1):
            keys, where = np.unique(grams & np.uint32((1 << 8 * (order + 1)) - 1 & 0xFFFFFFFF), return_inverse=True)
            n = np.bincount(where, n, len(keys))
            contexts, own = np.unique(keys >> np.uint32(8), return_inverse=True)
            self.orders.append((keys, n, contexts, np.bincount(own, n), np.bincount(own)))
            grams = keys

    def bits(self, keys: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each string of four after the three before it."""
        out, open_ = np.zeros(len(keys)), np.arange(len(keys))
        for order, (strings, n, contexts, total, kinds) in zip(range(ORDER, -1, -1), self.orders, strict=True):
            key = keys[open_] & np.uint32((1 << 8 * (order + 1)) - 1 & 0xFFFFFFFF)
            at = np.minimum(np.searchsorted(contexts, key >> np.uint32(8)), len(contexts) - 1)
            seen = contexts[at] == key >> np.uint32(8)
            string = np.minimum(np.searchsorted(strings, key), len(strings) - 1)
            found = strings[string] == key
            whole = total[at] + kinds[at]
            out[open_[found]] += np.log2(whole[found] / n[string[found]])
            escaped = seen & ~found
            out[open_[escaped]] += np.log2(whole[escaped] / kinds[at[escaped]])
            open_ = open_[~found]
        out[open_] += np.log2(257.0)
        return out


class Model:
    """The trees of all languages, and the code lengths of the strings of four bytes that were asked for."""

    #: Slots of the table of strings, and strings kept.
    SLOTS, KEEP = 1 << 21, 1 << 20

    def __init__(self, langs: list[str], grams: list[tuple[np.ndarray, np.ndarray]]):
        self.langs = langs
        self.trees = [Tree(g.astype(np.uint32), n.astype(np.float64)) for g, n in grams]
        self.slots = None

    def __getstate__(self):
        return {"langs": self.langs, "trees": self.trees, "slots": None}

    def clear(self) -> None:
        self.slots = np.full(self.SLOTS, -1, np.int32)
        self.keys, self.costs = np.zeros(0, np.uint32), np.zeros((0, len(self.langs)), np.float32)
        # strings whose slot another one has, sorted, and their numbers
        self.rest, self.rest_number = np.zeros(0, np.uint32), np.zeros(0, np.int32)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """Row of ``costs`` for each string; those never asked for are worked out and added."""
        if self.slots is None or len(self.keys) > self.KEEP:
            self.clear()
        slot = ((keys * np.uint32(0x9E3779B1)) >> np.uint32(32 - 21)).astype(np.int32)
        out = self.slots[slot]
        other = out < 0
        if len(self.keys):
            other |= self.keys[out] != keys
        if not other.any():
            return out
        uniq, first, each = np.unique(keys[other], return_index=True, return_inverse=True)
        at = np.searchsorted(self.rest, uniq)
        inside = at < len(self.rest)
        known = np.zeros(len(uniq), bool)
        known[inside] = self.rest[at[inside]] == uniq[inside]
        number = np.empty(len(uniq), np.int32)
        number[known] = self.rest_number[at[known]]
        new = np.flatnonzero(~known)
        number[new] = len(self.keys) + np.arange(len(new))
        self.keys = np.concatenate((self.keys, uniq[new]))
        self.costs = np.concatenate((self.costs, np.stack([t.bits(uniq[new]) for t in self.trees], axis=1).astype(np.float32)))
        place = slot[np.flatnonzero(other)[first[new]]]
        _, winner = np.unique(place, return_index=True)
        free = np.zeros(len(new), bool)
        free[winner] = True
        free &= self.slots[place] < 0
        self.slots[place[free]] = number[new[free]]
        late = new[~free]
        self.rest, self.rest_number = np.concatenate((self.rest, uniq[late])), np.concatenate((self.rest_number, number[late]))
        order = np.argsort(self.rest, kind="stable")
        self.rest, self.rest_number = self.rest[order], self.rest_number[order]
        out[other] = number[each]
        return out

    def bits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length in bits of each text under each language."""
        out, at = padded(data, offsets)
        if not len(data):
            return np.zeros((len(offsets) - 1, len(self.langs)))
        wide = out.astype(np.uint32)
        number = np.zeros(len(out), np.int32)
        number[ORDER:] = self.numbers(wide[:-3] << np.uint32(24) | wide[1:-2] << np.uint32(16) | wide[2:-1] << np.uint32(8) | wide[3:])
        cost = self.costs[number]
        for k in range(ORDER):
            cost[at[:-1] + k] = 0
        return np.add.reduceat(cost, at[:-1], axis=0, dtype=np.float64)


def learn(train: DataFrame, docs_per_lang: int = 2000) -> Model | None:
    """A model from rows (doc_id, text, lang), or None without any.

    About ``docs_per_lang`` documents of each language are counted (those whose hash is low), which bounds what the
    driver gathers and ships: the different strings of four bytes of so many texts, some 100,000 a language at 8 bytes.
    All that was counted is kept. A language whose texts are all empty can't be learned.
    """
    # written first, so that Spark sees how small it is and need not shuffle texts to meet it
    many = Scratch(train.sparkSession, "languages").keep(train.groupBy("lang").agg(F.count(F.lit(1)).alias("many")), "many")
    share = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) / float(1 << 20)
    some = train.join(many, "lang").where(share < docs_per_lang / F.col("many")).select("text", "lang")
    counts = some.mapInArrow(_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    if not len(counts):
        return None
    langs = sorted(counts["lang"].unique())
    return Model(langs, [(g["gram"].to_numpy(), g["n"].to_numpy()) for g in (counts[counts["lang"] == x] for x in langs)])


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """One row (key, held_out, lang_pred, score, bits_per_byte) for each row of ``docs``.

    The model learns from rows that are not held out and have a key, a text and a language. ``score`` is the share of
    the best language in the sum of 2 ** -bits over all. A text that is null or has no letter is ``und`` with score
    zero, as is every text when nothing could be learned. Rows that repeat are predicted alike; other columns are
    ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"), held_out(F.col(key)).alias("held_out"))
    model = learn(rows.where("not held_out and lang is not null and text is not null and doc_id is not null").select("doc_id", "text", "lang"))
    asked = rows.select("doc_id", "held_out", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has"), "text")
    kind = dict(docs.dtypes)[key]
    if model is None:
        return asked.select(F.col("doc_id").alias(key), "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("bits_per_byte"))
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.langs, "und"], object)
        size = max(1 << 16, min(T.SLICE_BYTES, (1 << 23) // len(model.langs)))
        for batch in batches:
            data, offsets = T.columns(batch, "text")
            bits = np.concatenate([model.bits(some, off) for _, _, some, off in T.slices(data, offsets, size)]) if batch.num_rows else np.zeros((0, len(names) - 1))
            has = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            best = bits.argmin(axis=1) if len(bits) else np.zeros(0, np.int64)
            least = bits.min(axis=1) if len(bits) else np.zeros(0)
            score = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
            per = least / np.maximum(np.diff(offsets), 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(list(names[np.where(has, best, -1)]), pa.string()),
                    pa.array(np.where(has, score, 0.0)),
                    pa.array(np.where(has, per, np.nan), mask=~has),
                ],
                names=[key, "held_out", "lang_pred", "score", "bits_per_byte"],
            )

    return asked.mapInArrow(run, f"{key} {kind}, held_out boolean, lang_pred string, score double, bits_per_byte double")
