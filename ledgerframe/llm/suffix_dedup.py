"""Exact substring deduplication by the common-prefix interval tree of an enhanced suffix array.

Texts are bytes. Suffixes that matter are anchored: an anchor is the minimum hash of 64 bytes within some 137 positions,
so every string of 200 bytes holds one at a place that depends on its content alone. Suffixes that start with the same
64 bytes as another make enhanced suffix arrays, one for each range of the hash of those bytes: they are sorted,
neighbours' common prefixes are taken, and one scan with a stack closes the intervals of the common-prefix tree. An
interval is a right-maximal repeat with all its occurrences, not only neighbours. Whether it can be extended to the left
is tested within it: its members' left sides, nearest byte first, are sorted and scanned in the same way, and a node of
that second tree is left-diverse, as its members differ in the byte before it (or it ends there). A node of both trees
with 200 bytes or more is a maximal repeat group; it is put out with all its occurrences where no other group covers
more around the anchor of one of them.

Equal surroundings (136 bytes to the left and 200 to the right) are one suffix and, if they occur twice, a group of
their own. They are equal by two independent hashes of 61 bits, that of the 64 bytes and that of the whole; all else is
compared byte by byte. What still shares its first bytes with more than ``group`` other surroundings is too large for
one task: there, all strings of 200 bytes around the anchors are compared by hash in one aggregation, which is exact
as well and gives the same spans, as one group for each string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .store import Scratch

GRAM = 64
#: Surroundings that one task sorts together, for suffixes with the same first bytes.
GROUP = 50_000
#: Bytes of surroundings that a task gathers before it works on them; suffixes with the same first bytes stay together.
_GATHER = 8 << 20
#: Places whose bytes are cut at once, and members of intervals that are compared at once.
_PLACES, _MEMBERS = 1 << 11, 1 << 16


def _anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = T.columns(batch, "text")
            docs, prints = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
            for a, b, some, off in T.slices(data, offsets):
                n = len(some)
                if n < length:
                    continue
                sums, other = T.prefix_sums(some), T.prefix_sums(some, 1)
                starts = np.arange(n - GRAM + 1)
                gram = T.range_hash(sums, starts, starts + GRAM)
                at = T.anchors(gram, length - GRAM + 1)
                row = np.searchsorted(off, at, "right") - 1
                begin, end = off[row], off[row + 1]
                ok = (at + GRAM <= end) & (end - begin >= length)
                at, row, begin, end = at[ok], row[ok], begin[ok], end[ok]
                left, right = np.minimum(at - begin, length - GRAM), np.minimum(end - at, length)
                around = T.range_hash(other, at - left, at + right) ^ T.mix(left.astype(np.uint64) + np.uint64(1))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(gram[at].view(np.int64)),
                        pa.array(around.view(np.int64)),
                        pa.array(docs[a:b][row]),
                        pa.array(prints[a:b][row]),
                        pa.array((at - begin).astype(np.int32)),
                        pa.array(left.astype(np.int32)),
                        pa.array(right.astype(np.int32)),
                    ],
                    names=["g", "cx", "doc", "print", "at", "l", "r"],
                )

    return run


_ANCHORS = "g long, cx long, doc long, print long, at int, l int, r int"
#: What tells the rows of a table: the id and a print of the text, so that rows of one id with other texts are others.
_ROW = ["doc", "print"]


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g, cx, lefts, rights): the bytes around each place of a text; the left side reversed, nearest byte first."""

    def cut(data: np.ndarray, start: np.ndarray, size: np.ndarray, step: int) -> pa.Array:
        """Binary array of the bytes from each start on, forwards or backwards."""
        ends = np.concatenate(([0], np.cumsum(size)))
        within = np.arange(ends[-1]) - np.repeat(ends[:-1], size)
        return pa.Array.from_buffers(
            pa.large_binary(),
            len(size),
            [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[np.repeat(start, size) + step * within])],
        ).cast(pa.binary())

    for batch in batches:
        data, offsets = T.columns(batch, "text")
        places = batch.column(batch.schema.get_field_index("places"))
        row = np.repeat(np.arange(batch.num_rows), places.value_lengths().to_numpy(zero_copy_only=False))
        flat = places.flatten()
        for k in range(0, len(flat), _PLACES):
            some = flat.slice(k, _PLACES)
            g, cx, at, left, right = (some.field(n).to_numpy(zero_copy_only=False) for n in ("g", "cx", "at", "l", "r"))
            at = offsets[:-1][row[k : k + _PLACES]] + at
            sides = [cut(data, at - 1, left, -1), cut(data, at, right, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(cx), *sides], names=["g", "cx", "lefts", "rights"])


class Table:
    """Strings as rows of one byte matrix, with comparisons of many pairs at once."""

    def __init__(self, strings: list[bytes], width: int):
        self.size = np.fromiter(map(len, strings), np.int64, len(strings))
        joined = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8)
        self.bytes = joined.reshape(len(strings), width)
        self.order = np.lexsort((self.size, np.ascontiguousarray(self.bytes).view(f"S{width}").ravel()))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of rows a and b."""
        out = np.empty(len(a), np.int64)
        for k in range(0, len(a), 1 << 15):
            x, y = a[k : k + (1 << 15)], b[k : k + (1 << 15)]
            differ = self.bytes[x] != self.bytes[y]
            out[k : k + (1 << 15)] = np.minimum(np.where(differ.any(axis=1), differ.argmax(axis=1), self.bytes.shape[1]), np.minimum(self.size[x], self.size[y]))
        return out


def tree(lcp: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(depth, first, last, above, node) of a common-prefix tree: its intervals with a depth of ``least`` or more, closed
    by one scan with a stack, the depth of the interval around each (-1: none), and for each place of ``lcp`` the interval
    whose depth it is (-1: none).

    ``lcp[i]`` is the common prefix of the suffixes i and i + 1; the interval holds the suffixes first to last.
    """
    depth, first, last, above, node = [], [], [], [], np.full(len(lcp), -1, np.int64)
    stack: list[tuple[int, int, list[int]]] = []
    for i, d in enumerate([*lcp.tolist(), -1]):
        begin = i
        while stack and stack[-1][0] > d:
            high, begin, links = stack.pop()
            node[links] = len(depth)
            depth.append(high)
            first.append(begin)
            last.append(i)
            above.append(max(stack[-1][0] if stack else -1, d if d >= least else -1))
        if d >= least:
            if stack and stack[-1][0] == d:
                stack[-1][2].append(i)
            else:
                stack.append((d, begin, [i]))
    return *(np.array(x, np.int64) for x in (depth, first, last, above)), node


def repeat_groups(lefts: list[bytes], rights: list[bytes], length: int = 200, every: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(group, member, left, right): maximal repeat groups of ``length`` bytes or more among suffixes, each with all
    its members, and how far it reaches to the left and right of their anchors.

    Of the groups that hold a suffix those are given that reach furthest to its left (of these furthest to its right),
    and the other way round; all other groups cover nothing more. With ``every``, those are given as well that hold all
    occurrences of any string of ``length`` bytes.
    """
    n = len(lefts)
    right, left = Table(rights, length), Table(lefts, length - GRAM)
    sa = right.order
    lcp = right.common(sa[:-1], sa[1:]) if n > 1 else np.zeros(0, np.int64)
    rank = np.empty(n, np.int64)
    rank[left.order] = np.arange(n)
    depth, first, last, around, _ = tree(lcp, GRAM)
    size = last - first + 1
    ends = np.cumsum(size)
    # for each member the deepest left-diverse node in each right-maximal interval; the best of these, in both orders
    best, best_node = np.full((2, n), -1), np.full((2, n), -1)
    parts: list[tuple] = []
    more_nodes = [np.zeros(0, np.int64)]
    nodes = a = 0
    while a < len(depth):  # a bounded number of members at a time
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + _MEMBERS, "right")))
        many = size[a:b]
        own = np.repeat(np.arange(a, b), many)
        member = sa[first[own] + np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many)]
        order = np.lexsort((rank[member], own))
        own, member = own[order], member[order]
        near = left.common(member[:-1], member[1:])
        near[own[:-1] != own[1:]] = -1
        e, lo, hi, above, node = tree(near, 0)
        # a member's deepest node is that of the nearer of its two neighbours
        before, after = np.append([-1], near), np.append(near, -1)
        mine = np.where(after >= before, np.append(node, -1), np.append([-1], node))
        on = np.flatnonzero(mine >= 0)
        reach_l, reach_r = e[mine[on]], depth[own[on]]
        ok = reach_l + reach_r >= length
        on, reach_l, reach_r = on[ok], reach_l[ok], reach_r[ok]
        for k, key in enumerate((reach_l << 10 | reach_r, reach_r << 10 | reach_l)):
            more = np.argsort(key, kind="stable")
            more = more[key[more] > best[k][member[on[more]]]]
            best[k][member[on[more]]] = key[more]  # the last of several, which is the largest, stays
            best_node[k][member[on[more]]] = nodes + mine[on[more]]
        if len(on):
            parts.append((nodes, member.astype(np.int32), lo, hi, e, depth[own[lo]]))
        if every and len(e):
            # a string that begins o bytes before the anchor has its occurrences in the widest interval and node that
            # are as deep as its two sides; o ranges over those for which this interval is the widest
            d, wider = depth[own[lo]], np.maximum(around[own[lo]], GRAM - 1)
            more_nodes.append(nodes + np.flatnonzero((e + d >= length) & (above + wider < length - 1)))
        nodes += len(e)
        a = b
    chosen = np.unique(np.concatenate((best_node[best_node >= 0], *more_nodes)))
    out = [(np.zeros(0, np.int64),) * 4]
    for begin, member, lo, hi, e, d in parts:
        used = chosen[(chosen >= begin) & (chosen < begin + len(lo))] - begin
        span = hi[used] - lo[used] + 1
        at = np.repeat(lo[used], span) + np.arange(span.sum()) - np.repeat(np.cumsum(span) - span, span)
        out.append((np.repeat(begin + used, span), member[at].astype(np.int64), np.repeat(e[used], span), np.repeat(d[used], span)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _tree(length: int, every: bool):
    def flush(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows)
        group, member, left, right = repeat_groups(t.column("lefts").to_pylist(), t.column("rights").to_pylist(), length, every)
        g, cx = (t.column(c).to_numpy()[member] for c in ("g", "cx"))
        return pa.RecordBatch.from_arrays(
            [pa.array(g), pa.array(group), pa.array(cx), pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32))],
            names=["g", "part", "cx", "l", "r"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by g; what is gathered is cut where g changes."""
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.nbytes
            if size > _GATHER:
                g = batch.column(0).to_numpy()
                cut = int(np.searchsorted(g, g[-1], "left"))
                if cut or len(held) > 1 and held[-2].column(0)[-1].as_py() != g[0]:
                    yield flush([*held[:-1], batch.slice(0, cut)])
                    held, size = [batch.slice(cut)], batch.slice(cut).nbytes
        if held:
            yield flush(held)

    return run


def _strings(length: int):
    """(h, g, cx, o): every string of ``length`` bytes around an anchor, o bytes of it to the left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, cx, left, right in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sums = T.prefix_sums(np.frombuffer(left[::-1] + right, np.uint8))
                o = np.arange(max(0, length - len(right)), len(left) + 1)
                h = T.range_hash(sums, len(left) - o, len(left) - o + length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(np.full(len(o), g)), pa.array(np.full(len(o), cx)), pa.array(o.astype(np.int32))],
                    names=["h", "g", "cx", "o"],
                )

    return run


def _removal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = T.columns(batch, "text")
        froms, tos = (batch.column(batch.schema.get_field_index(c)) for c in ("froms", "tos"))
        for a, b, some, off in T.slices(data, offsets):
            f = froms.slice(a, b - a)
            many = np.diff(f.offsets.to_numpy())
            base = off[:-1] + np.arange(b - a)  # one more slot for each text, so that runs end with it
            shift = np.repeat(base, many)
            diff = np.zeros(len(some) + b - a + 1, np.int32)
            most = np.repeat(np.diff(off), many)
            for at, by in ((f, 1), (tos.slice(a, b - a), -1)):
                np.add.at(diff, shift + np.minimum(at.flatten().to_numpy(zero_copy_only=False), most), by)
            gone = np.cumsum(diff) > 0
            edge = np.flatnonzero(gone[1:] & ~gone[:-1]) + 1
            if gone[0]:
                edge = np.concatenate(([0], edge))
            spans = np.bincount(np.searchsorted(base, edge, "right") - 1, minlength=b - a)
            total = np.concatenate(([0], np.cumsum(gone)))
            removed = total[base + np.diff(off)] - total[base]
            raw, sha = some.tobytes(), []
            for k in range(b - a):
                text = raw[off[k] : off[k + 1]]
                if removed[k]:
                    text = some[off[k] : off[k + 1]][~gone[base[k] : base[k] + len(text)]].tobytes()
                sha.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(np.diff(off)), pa.array(removed), pa.array(spans), pa.array(sha, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )


def _anchored(texts: DataFrame, scratch: Scratch, length: int, group: int, every: bool = False) -> tuple[DataFrame, DataFrame]:
    """Anchors (g, cx, doc, print, at), and groups (g, part, cx, l, r) of their surroundings."""
    anchors = scratch.keep(texts.mapInArrow(_anchors(length), _ANCHORS), "anchors")
    one = F.min(F.struct("doc", "print", "at", "l", "r")).alias("one")
    around = scratch.keep(anchors.groupBy("g", "cx").agg(F.count(F.lit(1)).alias("n"), one).select("g", "cx", "n", "one.*"), "around")
    shared = scratch.keep(around.groupBy("g").agg(F.count(F.lit(1)).alias("k")).where("k > 1"), "shared")
    places = around.join(shared.select("g"), "g").groupBy(*_ROW).agg(F.collect_list(F.struct("g", "cx", "at", "l", "r")).alias("places"))
    bytes_of = texts.join(places, _ROW).select("text", "places")
    sides = scratch.keep(bytes_of.mapInArrow(_surroundings, "g long, cx long, lefts binary, rights binary"), "sides")
    large = shared.where(F.col("k") > group)
    none = large.isEmpty()
    small = sides if none else sides.join(large, "g", "left_anti")
    found = small.repartition("g").sortWithinPartitions("g").mapInArrow(_tree(length, every), "g long, part long, cx long, l int, r int")
    if not none:
        strings = sides.join(large, "g", "left_semi").mapInArrow(_strings(length), "h long, g long, cx long, o int")
        strings = scratch.keep(strings, "strings")
        # the same string around another anchor is no second occurrence
        again = scratch.keep(strings.groupBy("h", "g", "o").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "again")
        found = found.unionByName(
            strings.join(again, ["h", "g", "o"]).select(
                "g",
                F.xxhash64("h", "o").alias("part"),
                "cx",
                F.col("o").alias("l"),
                (F.lit(length) - F.col("o")).alias("r"),
            )
        )
    same = around.where("n > 1").select("g", F.col("cx").alias("part"), "cx", "l", "r")
    return anchors.select("g", "cx", *_ROW, "at"), same.unionByName(found)


def _rows(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(doc, print, text) of every row; the print is 60 bits of a digest, and null texts have the same."""
    digest = F.conv(F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, 15), 16, 10).cast("long")
    return docs.select(F.col(key).cast("long").alias("doc"), digest.alias("print"), F.col(text).alias("text"))


def _usable(rows: DataFrame, length: int) -> DataFrame:
    return rows.where(f"doc is not null and length(text) >= {length // 4}")


def groups(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = 200, group: int = GROUP) -> DataFrame:
    """(g, part, key, print, start, end): maximal repeat groups, one row for each occurrence of each group (g, part);
    ``print`` tells rows of one key with other texts apart. Every string of ``length`` bytes that occurs twice lies in a
    group that holds all its occurrences.

    Groups are as far as the surroundings of their anchor see them: 136 bytes to its left and 200 to its right. A longer
    repeat is a chain of such groups. Rows with a null key or text take no part.
    """
    scratch = Scratch(docs.sparkSession, "suffixes")
    anchors, found = _anchored(_usable(_rows(docs, text, key), length), scratch, length, group, every=True)
    met = anchors.join(scratch.keep(found, "groups"), ["g", "cx"])
    return met.select("g", "part", F.col("doc").alias(key), "print", (F.col("at") - F.col("l")).alias("start"), (F.col("at") + F.col("r")).alias("end"))


def repeats(rows: DataFrame, scratch: Scratch, length: int, group: int) -> DataFrame:
    """(doc, print, start, end): spans of bytes that maximal repeat groups cover, one for each anchor in any."""
    anchors, found = _anchored(_usable(rows, length), scratch, length, group)
    # all groups of a suffix hold its anchor, so together they cover one span around it
    hit = scratch.keep(found.groupBy("g", "cx").agg(F.max("l").alias("hl"), F.max("r").alias("hr")), "hit")
    return anchors.join(hit, ["g", "cx"]).select(*_ROW, (F.col("at") - F.col("hl")).alias("start"), (F.col("at") + F.col("hr")).alias("end"))


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = 200, group: int = GROUP) -> DataFrame:
    """One row (key, n_bytes, n_removed, n_spans, kept_sha256) per row of ``docs``: bytes covered by a string of
    ``length`` bytes that also starts anywhere else in the table are removed.

    Null texts are empty. Rows with a null key take no part and keep all bytes. Rows that repeat a key are rows like any
    others: equal ones are copies of each other, and of different ones each is judged on its own. Other columns are
    ignored, and an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "suffixes")
    rows = _rows(docs, text, key)
    spans = repeats(rows, scratch, length, group)
    by_doc = scratch.keep(spans.groupBy(*_ROW).agg(F.collect_list("start").alias("froms"), F.collect_list("end").alias("tos")), "spans")
    scratch.drop("anchors", "around", "sides", "shared")
    none = F.array().cast("array<int>")
    whole = rows.join(by_doc, _ROW, "left").select(F.col("doc").alias("doc_id"), "text", F.coalesce("froms", none).alias("froms"), F.coalesce("tos", none).alias("tos"))
    out = whole.mapInArrow(_removal, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumnRenamed("doc_id", key) if key != "doc_id" else out
