"""Substring deduplication of word windows by fixed-block anchors.

Every text is a reference: its non-overlapping blocks of ten words are indexed by hash. Every rolling window of ten
words of every text probes the index. A window of twenty words that occurs twice holds a whole block of the other
occurrence, whatever its offset, so its place is hit on both sides. Hits are extended to the windows of twenty words
around them; those are compared whole, by two hashes of 61 bits, and what the later ones of a kind cover, run by run, is
removed. Blocks meet by a quick one, as a false hit only makes a candidate more.

Probes are as many as words, so they go through the join in PASSES passes by ranges of the hash, which bounds the disk
that shuffles hold at any time; each pass handles its range completely.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .store import Scratch

_U = np.uint64
PASSES = 3


def _spread(counts: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(counts)), counts)


def _grams(window: int, block: int, aligned: bool, part: int, parts: int):
    """(h, doc, pos) of all rolling windows of ``block`` words, or of the aligned blocks, in one range of the hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = T.columns(batch, "text")
            docs, prints = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
            for a, b, some, off in T.slices(data, offsets):
                starts, ends, first = T.words(some, off)
                at = T.gram_starts(first, block)
                h = T.quick_hashes(T.quick_words(some, starts, ends), at, at + block)
                n = np.diff(first)
                row = _spread(n)[at] if len(at) else np.zeros(0, np.int64)
                pos = at - first[row]
                ok = n[row] >= window
                if aligned:
                    ok &= pos % block == 0
                if parts > 1:
                    ok &= ((h >> _U(32)) * _U(parts)) >> _U(32) == part
                yield pa.RecordBatch.from_arrays([pa.array(h[ok].view(np.int64)), pa.array(docs[a:b][row[ok]]), pa.array(prints[a:b][row[ok]]), pa.array(pos[ok].astype(np.int32))], names=["h", "doc", "print", "pos"])

    return run


def _marked(first: np.ndarray, marks: pa.Array, window: int, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and position of every window of ``window`` words that holds a marked block."""
    n = np.diff(first)
    flat = marks.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    row = _spread(np.diff(marks.offsets.to_numpy()))
    last = n - window  # last start of each text
    diff = np.zeros(int(first[-1]) + len(n) + 1, np.int32)
    base = first[:-1] + np.arange(len(n))  # one more slot for each text
    hi = np.maximum(np.minimum(flat, last[row]) + 1, 0)
    lo = np.minimum(np.maximum(flat - (window - block), 0), hi)
    np.add.at(diff, base[row] + lo, 1)
    np.add.at(diff, base[row] + hi, -1)
    on = np.flatnonzero(np.cumsum(diff) > 0)
    row = np.searchsorted(base, on, "right") - 1
    return row, on - base[row]


def _candidates(window: int, block: int):
    """(h, h2, doc, pos) of the first place of each marked window content in each text; the content by two hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = T.columns(batch, "text")
            docs, prints = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
            marks = batch.column(batch.schema.get_field_index("marks"))
            for a, b, some, off in T.slices(data, offsets):
                starts, ends, first = T.words(some, off)
                row, pos = _marked(first, marks.slice(a, b - a), window, block)
                begin = first[row] + pos
                both = [T.range_hash(T.prefix_sums(T.bytes_hashes(some, starts, ends, k), k), begin, begin + window) for k in (0, 1)]
                order = np.lexsort((pos, both[1], both[0], row))
                new = np.ones(len(order), bool)
                for x in (row, *both):
                    new[1:] &= x[order][1:] == x[order][:-1]
                new[1:] = ~new[1:]
                keep = order[new]
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(h[keep].view(np.int64)) for h in both], pa.array(docs[a:b][row[keep]]), pa.array(prints[a:b][row[keep]]), pa.array(pos[keep].astype(np.int32))],
                    names=["h", "h2", "doc", "print", "pos"],
                )

    return run


def _removal(window: int, block: int):
    """Counts and digest of each text without the words of marked windows that are no first place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = T.columns(batch, "text")
            marks, firsts = (batch.column(batch.schema.get_field_index(c)) for c in ("marks", "firsts"))
            for a, b, some, off in T.slices(data, offsets):
                _, _, first = T.words(some, off)
                row, pos = _marked(first, marks.slice(a, b - a), window, block)
                own = firsts.slice(a, b - a)
                known = (_spread(np.diff(own.offsets.to_numpy())) << 40) | own.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                later = ~np.isin((row << 40) | pos, known)
                diff = np.zeros(int(first[-1]) + 1, np.int32)
                np.add.at(diff, first[row[later]] + pos[later], 1)
                np.add.at(diff, first[row[later]] + pos[later] + window, -1)
                keep = np.cumsum(diff[:-1]) == 0
                n = np.diff(first)
                left = np.diff(np.concatenate(([0], np.cumsum(keep)))[first])
                raw = some.tobytes()
                sha = []
                for k in range(b - a):
                    w = raw[off[k] : off[k + 1]].split()
                    if left[k] < n[k]:
                        w = list(compress(w, keep[first[k] : first[k + 1]].tolist()))
                    sha.append(hashlib.sha256(b" ".join(w)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n), pa.array(n - left), pa.array(sha, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256"],
                )

    return run


_PLACES = "h long, doc long, print long, pos int"
#: What tells the rows of a table: the id and a print of the text, so that rows of one id with other texts are others.
_ROW = ["doc", "print"]


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = 20, passes: int = PASSES) -> DataFrame:
    """One row (key, n_words, n_removed, kept_sha256) per row of ``docs``: words covered by a window of ``window`` words
    whose sequence also starts earlier (a smaller key, or the same text further left) are removed.

    Null texts have no words. Rows with a null key take no part and keep all words. Rows that repeat a key and differ in
    their texts are ordered by a digest of these; rows that repeat both are the same text, which stays in each. Other columns are ignored, and an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "blocks")
    block = window // 2
    digest = F.conv(F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, 15), 16, 10).cast("long")
    rows = docs.select(F.col(key).cast("long").alias("doc"), digest.alias("print"), F.col(text).alias("text"))
    texts = rows.where("doc is not null and text is not null")
    marks = []
    for part in range(passes):
        index = texts.mapInArrow(_grams(window, block, True, part, passes), _PLACES).groupBy("h").agg(
            F.count(F.lit(1)).alias("n"),
            F.min("doc").alias("d"),
            F.min("print").alias("q"),
            F.min("pos").alias("p"),
        )
        index = scratch.keep(index, f"index-{part}")
        probes = texts.mapInArrow(_grams(window, block, False, part, passes), _PLACES)
        # a block that only meets itself is no hit
        hit = probes.join(index.hint("shuffle_hash"), "h").where("n > 1 or doc <> d or print <> q or pos <> p").select(*_ROW, "pos")
        marks.append(scratch.keep(hit, f"marks-{part}"))
        scratch.drop(f"index-{part}")
    found = marks[0]
    for m in marks[1:]:
        found = found.unionByName(m)
    by_doc = scratch.keep(found.groupBy(*_ROW).agg(F.collect_list("pos").alias("marks")), "marks")
    scratch.drop(*[f"marks-{k}" for k in range(passes)])
    near = texts.join(by_doc, _ROW).select(*_ROW, "text", "marks")
    places = near.mapInArrow(
        _candidates(window, block),
        "h long, h2 long, doc long, print long, pos int",
    ).groupBy("h", "h2").agg(F.min(F.struct(*_ROW, "pos")).alias("first")).select("first.*")
    firsts = scratch.keep(places.groupBy(*_ROW).agg(F.collect_list("pos").alias("firsts")), "firsts")
    none = F.array().cast("array<int>")
    whole = rows.join(by_doc, _ROW, "left").join(firsts, _ROW, "left").select(
        F.col("doc").alias("doc_id"),
        "text",
        F.coalesce("marks", none).alias("marks"),
        F.coalesce("firsts", none).alias("firsts"),
    )
    out = whole.mapInArrow(_removal(window, block), "doc_id long, n_words long, n_removed long, kept_sha256 string")
    return out.withColumnRenamed("doc_id", key) if key != "doc_id" else out
