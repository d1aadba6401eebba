"""Phrase collocation mining: exact counts of frequent phrases, and the cuts that explain them worst.

A phrase is frequent only if the phrases of one word less at both its ends are (Apriori). So texts become streams of the
numbers of frequent words, and a phrase of k words is a pair of neighbouring numbers of phrases of k - 1 words: a 64-bit
key without any collision. Each length takes three passes over the stream, none of which shuffles texts or keys by
occurrence:

1. keys are counted by hash bucket in an array of a task, and the arrays are summed as a tree: a key whose bucket stays
   under the threshold can't be frequent;
2. the different keys of the other buckets are the candidates;
3. a minimal perfect hash of the candidates, with stored keys, goes to the tasks, which count occurrences by slot
   (bincount), again summed as a tree, and write the slots of all positions as the stream of the next length.

Candidates are hashed up to ``keys`` at a time; more take more rounds of the third pass, so a task's memory and what is
broadcast don't grow with the data. The buckets are one for 32 words, 2**26 at most: beyond some seven billion words they
rule out less and less, and the number of rounds grows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .perfect_hash import PerfectHash
from .store import Scratch

_U = np.uint64
#: Candidates of one perfect hash: 32 MB of keys, and as much of counts in a task.
KEYS = 1 << 22
#: Bytes of frequent words that are looked up together.
WORD_BYTES = 64 << 20
LONGEST = 5

_PIECE = np.zeros(256, bool)
_PIECE[[*b".,;:!?", 10, 11, 12, 13]] = True
_BREAK = _PIECE.copy()
_BREAK[[9, 32]] = True
#: Positions that a task gathers before it counts them, and places of a chunk of an array that is summed.
_HELD, _CHUNK = 1 << 21, 1 << 13
#: Chunks, by hash, in which keys are united.
_UNITED = 1 << 8
_STREAM = "chunk int, salt int, part binary, carried binary"


def _words(some: np.ndarray, off: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Words of a block of texts, and where one begins another piece."""
    found, starts = T.split(some, off, _BREAK)
    piece = np.searchsorted(np.flatnonzero(_PIECE[some]), starts) + np.searchsorted(off, starts, "right")
    new = np.zeros(len(starts), bool)
    new[1:] = piece[1:] != piece[:-1]
    return found, new


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array, np.ndarray]]:
    """Language, words and piece starts of every block of the batch, one language at a time."""
    langs = batch.column(batch.schema.get_field_index("lang"))
    for lang in pc.unique(langs).to_pylist():
        data, offsets = T.columns(batch.filter(pc.equal(langs, lang)), "text")
        for _, _, some, off in T.blocks(data, offsets, T.SLICE_BYTES, _PIECE):
            yield lang, *_words(some, off)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, found, _ in _by_lang(batch):
            n = pc.value_counts(found)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), n.field(0).cast(pa.string()), n.field(1)], names=["lang", "word", "n"])


def tight(stream: np.ndarray) -> np.ndarray:
    """A stream with one zero between stretches of numbers, and without numbers that stand alone."""
    some = np.zeros(len(stream) + 2, bool)
    some[1:-1] = stream != 0
    some[1:-1] &= some[:-2] | some[2:]
    keep = some[1:-1] | some[:-2]
    return np.where(some[1:-1], stream, 0)[keep].astype(stream.dtype)


def _row(chunk: int, part: np.ndarray | None, carried: np.ndarray | None = None) -> pa.RecordBatch:
    salt = TaskContext.get().partitionId() % 16
    raw = [pa.array([None if x is None else x.tobytes()], pa.binary()) for x in (part, carried)]
    return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([salt], pa.int32()), *raw], names=["chunk", "salt", "part", "carried"])


def _chunks(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for chunk in range(-(-len(counts) // _CHUNK)):
        part = counts[chunk * _CHUNK : (chunk + 1) * _CHUNK]
        if part.any():
            yield _row(chunk, part)


def _tree(parts: DataFrame, kind: str, add: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """Chunks (chunk, part) of what ``add`` makes of the arrays of all tasks: of each chunk sixteen results first, then
    theirs; a task takes one array after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = total = None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["chunk", "salt", "part"])

        for batch in batches:
            for chunk, salt, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                part = np.frombuffer(raw, kind)
                if (chunk, salt) == now:
                    total = add(total, part)
                    continue
                if now is not None:
                    yield out()
                now, total = (chunk, salt), part
        if now is not None:
            yield out()

    for salt in (F.col("salt"), F.lit(0)):
        rows = parts.select("chunk", salt.alias("salt"), "part")
        parts = rows.repartition("chunk", "salt").sortWithinPartitions("chunk", "salt").mapInArrow(run, "chunk int, salt int, part binary")
    return parts.select("chunk", "part")


def _capped(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of bytes, 255 at most."""
    return np.minimum(a.astype(np.uint16) + b, 255).astype(np.uint8)


class Pairs:
    """Keys of the neighbours in a stream, where both are frequent."""

    def __init__(self, frequent: np.ndarray | None):
        #: Packed bits by number; None: all are.
        self.frequent = frequent

    def numbers(self, raw: bytes) -> np.ndarray:
        out = np.frombuffer(raw, np.uint32)
        if self.frequent is None:
            return out
        kept = self.frequent[out >> np.uint32(3)] >> (out & np.uint32(7)).astype(np.uint8) & np.uint8(1)
        return tight(out * kept)

    def keys(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions that begin a pair, and the keys of the pairs."""
        at = np.flatnonzero((numbers[:-1] != 0) & (numbers[1:] != 0)) if len(numbers) else np.zeros(0, np.int64)
        return at, numbers[at].astype(_U) << _U(32) | numbers[at + 1]


def _gathered(batches: Iterator[pa.RecordBatch], pairs: Pairs) -> Iterator[np.ndarray]:
    """Keys of all streams of a task, many at a time."""
    held, n = [], 0
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            _, keys = pairs.keys(pairs.numbers(raw))
            held.append(keys)
            n += len(keys)
            if n >= _HELD:
                yield np.concatenate(held)
                held, n = [], 0
    if n:
        yield np.concatenate(held)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (T.mix(keys * _U(0x9E3779B97F4A7C15)) >> _U(20) & _U(buckets - 1)).astype(np.int64)


def _bucket_counts(stream: DataFrame, pairs: Callable[[], Pairs], buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.uint8)
        for keys in _gathered(batches, pairs()):
            at, n = np.unique(_bucket(keys, buckets), return_counts=True)
            counts[at] = np.minimum(counts[at] + n, 255)
        yield from _chunks(counts)

    return _tree(stream.select("part").mapInArrow(run, _STREAM), "uint8", _capped)


def _candidates(stream: DataFrame, pairs: Callable[[], Pairs], bits: Callable[[], np.ndarray]) -> DataFrame:
    """The different keys of full buckets: tasks send sorted arrays of theirs, and the arrays are united as a tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = bits()
        for keys in _gathered(batches, pairs()):
            at = _bucket(keys, 8 * len(full))
            found = np.unique(keys[(full[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)])
            chunk = _bucket(found, _UNITED)
            order = np.argsort(chunk, kind="stable")
            ends = np.searchsorted(chunk[order], np.arange(_UNITED + 1))
            for k in np.flatnonzero(np.diff(ends)):
                yield _row(int(k), found[order[ends[k] : ends[k + 1]]])

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(1).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(raw, np.int64))], names=["key"])

    return _tree(stream.select("part").mapInArrow(run, _STREAM), "uint64", np.union1d).mapInArrow(single, "key long")


def _slot_counts(stream: DataFrame, pairs: Callable[[], Pairs], hashed: Callable[[], PerfectHash], base: int, final: bool) -> DataFrame:
    """Counts by slot in chunks, and as chunk -1 the streams: the numbers (``base`` and slot) of the pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, pair = hashed(), pairs()
        counts, held, n = np.zeros(len(mine.keys), np.int64), [], 0
        for batch in batches:
            for raw, carried in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                numbers = pair.numbers(raw)
                at, keys = pair.keys(numbers)
                slots = mine.slots(keys)
                known = slots >= 0
                out = np.zeros(len(numbers), np.uint32) if carried is None else np.frombuffer(carried, np.uint32).copy()
                out[at[known]] = slots[known] + base
                held.append(slots[known])
                n += len(held[-1])
                if n >= _HELD:
                    counts += np.bincount(np.concatenate(held), minlength=len(counts))
                    held, n = [], 0
                if final:
                    out = tight(out)
                    if len(out):
                        yield _row(-1, out)
                else:
                    yield _row(-1, numbers, out)
        if n:
            counts += np.bincount(np.concatenate(held), minlength=len(counts))
        yield from _chunks(counts)

    return stream.select("part", "carried").mapInArrow(run, _STREAM)


def _packed(numbers: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(-(-size // 8) * 8, bool)
    out[numbers] = True
    return np.packbits(out, bitorder="little")


def _longer(stream: DataFrame, frequent: np.ndarray | None, least: int, buckets: int, keys: int, scratch: Scratch, k: int):
    """The frequent phrases of k words (number, prefix, suffix, a), their stream, and which of its numbers are frequent;
    None where there is no candidate."""
    context = stream.sparkSession.sparkContext
    known = context.broadcast(frequent)
    pairs = lambda: Pairs(known.value)

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.packbits(np.frombuffer(x, np.uint8) >= min(least, 255), bitorder="little").tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.binary())], names=["chunk", "bits"])

    bits = np.zeros(buckets // 8, np.uint8)
    for r in _bucket_counts(stream, pairs, buckets).mapInArrow(full, "chunk int, bits binary").toArrow().to_pylist():
        some = np.frombuffer(r["bits"], np.uint8)
        bits[r["chunk"] * _CHUNK // 8 :][: len(some)] = some
    passed = context.broadcast(bits)
    candidates = scratch.keep(_candidates(stream, pairs, lambda: passed.value), f"candidates-{k}")
    many = candidates.count()
    if not many:
        return None
    if many >= 1 << 32:
        raise ValueError("more than 2**32 candidates: raise the threshold or split the table")
    rounds, base, tables = -(-many // keys), 1, []
    for j in range(rounds):
        part = candidates.where(F.pmod(F.xxhash64("key"), F.lit(rounds)) == j).toArrow().column("key").to_numpy()
        hashed = context.broadcast(PerfectHash(part.view(_U)))
        out = scratch.keep(_slot_counts(stream, pairs, lambda h=hashed: h.value, base, j == rounds - 1), f"slots-{k}-{j}")
        sums = _tree(out.where("chunk >= 0"), "int64", np.add)

        def read(batches: Iterator[pa.RecordBatch], h=hashed, base=base) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for chunk, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    n = np.frombuffer(raw, np.int64)
                    slot = np.flatnonzero(n >= least)
                    key = h.value.keys[chunk * _CHUNK + slot]
                    columns = [chunk * _CHUNK + slot + base, (key >> _U(32)).astype(np.int64), (key & _U(0xFFFFFFFF)).astype(np.int64), n[slot]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["number", "prefix", "suffix", "a"])

        tables.append(scratch.keep(sums.mapInArrow(read, "number long, prefix long, suffix long, a long"), f"phrases-{k}-{j}"))
        # numbers of the next round's table follow those of this one; its stream carries both
        stream, base = out.where("chunk < 0"), base + len(part)
        if rounds > 1:
            pairs = lambda: Pairs(None)
    found = tables[0]
    for t in tables[1:]:
        found = found.unionByName(t)
    return found, stream, _packed(found.select("number").toArrow().column("number").to_numpy(), base + 1)


def _encoded(docs: DataFrame, words: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Streams of the numbers of frequent words, and the words (number, lang, word, n)."""
    spark = docs.sparkSession
    size = words.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("word")).alias("bytes")).first()
    rounds = max(1, -(-size.n // KEYS), -(-(size.bytes or 0) // WORD_BYTES))
    base, tables = 1, []
    rows = docs.withColumn("numbers", F.lit(None).cast("binary"))
    for j in range(rounds):
        part = words.where(F.pmod(F.xxhash64("lang", "word"), F.lit(rounds)) == j).toArrow()
        part = part.append_column("number", pa.array(np.arange(base, base + len(part)), pa.int64()))
        tables.append(scratch.keep(spark.createDataFrame(part), f"words-{j}"))
        by = {}
        for lang in pc.unique(part.column("lang")).to_pylist():
            some = part.filter(pc.equal(part.column("lang"), lang))
            by[lang] = some.column("word").combine_chunks().cast(pa.large_utf8()), some.column("number").to_numpy().astype(np.uint32)
        shared = spark.sparkContext.broadcast(by)
        final = j == rounds - 1

        def run(batches: Iterator[pa.RecordBatch], shared=shared, final=final) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                # each text apart only where another round has to find its numbers again
                for some in [batch] if rounds == 1 else [batch.slice(i, 1) for i in range(batch.num_rows)]:
                    before = some.column(2)[0].as_py() if some.num_rows else None
                    done = []
                    for lang, found, new in _by_lang(some):
                        known, numbers = shared.value.get(lang, (None, None))
                        out = np.zeros(len(found), np.uint32)
                        if known is not None:
                            at = pc.index_in(found, value_set=known)
                            ok = np.asarray(at.is_valid())
                            out[ok] = numbers[at.drop_null().to_numpy()]
                        spaced = np.zeros(len(out) + int(new.sum()) + 1, np.uint32)
                        spaced[np.arange(len(out)) + np.cumsum(new)] = out
                        if rounds == 1:
                            if len(short := tight(spaced)):
                                yield _row(-1, short)
                        else:
                            done.append(spaced)
                    if rounds > 1 and some.num_rows:
                        whole = np.concatenate(done) if done else np.zeros(0, np.uint32)
                        if before is not None:
                            whole = np.maximum(whole, np.frombuffer(before, np.uint32))
                        if final:
                            yield _row(-1, tight(whole))
                        else:
                            yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array([whole.tobytes()], pa.binary())], names=["lang", "text", "numbers"])

        rows = scratch.keep(rows.mapInArrow(run, _STREAM if final else "lang string, text string, numbers binary"), f"numbers-{j}")
        base += len(part)
    found = tables[0]
    for t in tables[1:]:
        found = found.unionByName(t)
    return rows, found


def phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, keys: int = KEYS) -> tuple[list[DataFrame], DataFrame]:
    """Frequent phrases and languages.

    The first: for each length from 1 on, as long as there are any, (number, lang, phrase, last, a, left, right, kept):
    ``left`` holds the counts of its first 1, 2, ... words, ``right`` those of its last 1, 2, ...; ``kept`` is false if a
    phrase of one word more that holds it is as frequent. The second: (lang, n), the words of each language.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "collocations")
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(text, F.lit("")).alias("text"))
    counts = rows.mapInArrow(_counted, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts = scratch.keep(counts, "counts")
    langs = scratch.keep(counts.groupBy("lang").agg(F.sum("n").alias("n")), "langs")
    words = scratch.keep(counts.where(F.col("n") >= least), "frequent")
    total = langs.agg(F.sum("n")).first()[0] or 0
    scratch.drop("counts")
    buckets = min(max(1 << 16, 1 << (total // 32).bit_length()), 1 << 26)
    stream, numbered = _encoded(rows, words, scratch)
    levels = [numbered.select("number", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), F.col("n").alias("a"), F.array("n").alias("left"), F.array("n").alias("right"))]
    frequent = None
    for k in range(2, LONGEST + 1):
        found = _longer(stream, frequent, least, buckets, keys, scratch, k)
        if found is None:
            break
        table, stream, frequent = found
        before = levels[-1]
        prefix = before.select(F.col("number").alias("prefix"), "lang", F.col("phrase").alias("_head"), F.col("left").alias("_left"))
        suffix = before.select(F.col("number").alias("suffix"), "last", F.col("right").alias("_right"))
        whole = table.join(prefix, "prefix").join(suffix, "suffix").select(
            "number", "prefix", "suffix", "lang", F.concat_ws(" ", "_head", "last").alias("phrase"), "last", "a",
            F.concat("_left", F.array("a")).alias("left"), F.concat("_right", F.array("a")).alias("right"),
        )
        levels.append(scratch.keep(whole, f"level-{k}"))
    out = []
    for this, longer in zip(levels, [*levels[1:], None], strict=True):
        if longer is None:
            out.append(this.withColumn("kept", F.lit(True)))
            continue
        holds = longer.select(F.explode(F.array("prefix", "suffix")).alias("number"), F.col("a").alias("_a")).groupBy("number").agg(F.max("_a").alias("_a"))
        out.append(this.join(holds, "number", "left").withColumn("kept", F.coalesce(F.col("_a") < F.col("a"), F.lit(True))).drop("_a"))
    return [x.select("number", "lang", "phrase", "last", "a", "left", "right", "kept") for x in out], langs


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, top: int = 2000, keys: int = KEYS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of two to five words.

    The contract of the query says how words, pieces, counts and scores are made. Null texts are empty, a null language
    is ``und``; an empty table, or one without frequent phrases, gives no rows; repeated rows count as often as they
    occur; other columns are ignored.
    """
    levels, langs = phrases(docs, text, lang, least, keys)
    wide = "decimal(38,0)"
    rows = []
    for k, level in enumerate(levels[1:], 2):
        cuts = [
            F.struct(
                F.expr(f"(cast(1000 as {wide}) * a * n) div (cast(left[{j - 1}] as decimal(19,0)) * cast(right[{k - j - 1}] as decimal(19,0)))").alias("score"),
                F.lit(j).alias("j"),
                F.col("left")[j - 1].alias("l"),
                F.col("right")[k - j - 1].alias("r"),
            )
            for j in range(1, k)
        ]
        some = level.where("kept").join(langs, "lang").withColumn("cut", F.array_min(F.array(*cuts)))
        rows.append(some.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"))
    if not rows:
        return docs.sparkSession.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    found = rows[0]
    for r in rows[1:]:
        found = found.unionByName(r)
    place = F.expr("row_number() over (partition by lang order by score desc, a desc, phrase)")
    found = found.withColumn("rank", place.cast("long")).where(F.col("rank") <= top)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
