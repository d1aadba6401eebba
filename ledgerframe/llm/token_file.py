"""Token ids as directly addressable codes in Parquet segments.

An id is split into chunks of eight bits. Level 0 holds the low chunk of every token; a bitmap says which tokens go on,
and level 1 holds the next chunk of those alone, and so on. A rank directory (ones before every 512 bits) tells where a
token's chunk lies on the next level, so any token is read by one look at each level, without decoding a block.
A file is a Parquet table of segments (whole documents, in ascending key order, about a million tokens each); Spark's
commit protocol writes it, so a lost executor leaves no half-written segment.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textops as T

_BLOCK = 512
SEGMENT_TOKENS = 1 << 20
#: Tokens of a stretch whose positions are read together.
ASKED = 1 << 16
_SCHEMA = "part int, seq int, n_tokens long, n_nulls long, doc_ids binary, doc_tokens binary, chunks array<binary>, more array<binary>, ranks array<binary>"


def pack(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """Chunks, continuation bitmaps and rank directories, one per level."""
    chunks, more, ranks = [], [], []
    rest = ids.astype(np.uint32)
    while True:
        chunks.append((rest & 255).astype(np.uint8).tobytes())
        on = rest > 255
        bits = np.packbits(on, bitorder="little")
        ones = np.zeros(-(-len(on) // _BLOCK) + 1, np.uint32)
        if len(on):
            ones[1:] = np.cumsum(np.add.reduceat(on.astype(np.uint32), np.arange(0, len(on), _BLOCK)))
        more.append(bits.tobytes())
        ranks.append(ones.astype("<u4").tobytes())
        rest = rest[on] >> 8
        if not len(rest):
            return chunks, more, ranks


_ONES = np.array([bin(k).count("1") for k in range(256)], np.uint32)


def access(chunks: list[bytes], more: list[bytes], ranks: list[bytes], at: np.ndarray) -> np.ndarray:
    """The ids at any positions of a segment, each by its rank on every level."""
    at = np.asarray(at, np.int64)
    out = np.zeros(len(at), np.uint32)
    live = np.arange(len(at))
    for level, (c, m, r) in enumerate(zip(chunks, more, ranks, strict=True)):
        out[live] |= np.frombuffer(c, np.uint8)[at].astype(np.uint32) << np.uint32(8 * level)
        bits, ones = np.frombuffer(m, np.uint8), np.frombuffer(r, "<u4")
        on = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        live, at = live[on], at[on]
        if not len(at):
            break
        byte, block = at >> 3, at // _BLOCK
        rank = ones[block].astype(np.int64)
        for k in range(_BLOCK // 8):  # bytes of the block before the token's own
            b = block * (_BLOCK // 8) + k
            before = b < byte
            if not before.any():
                break
            rank[before] += _ONES[bits[b[before]]]
        rank += _ONES[bits[byte] & ((1 << (at & 7)) - 1).astype(np.uint8)]
        at = rank
    return out


def unpack(chunks: list[bytes], more: list[bytes]) -> np.ndarray:
    """All ids of a segment, from the last level up."""
    above = None
    for c, m in zip(reversed(chunks), reversed(more), strict=True):
        own = np.frombuffer(c, np.uint8).astype(np.uint32)
        if above is not None:
            on = np.unpackbits(np.frombuffer(m, np.uint8), count=len(own), bitorder="little").view(bool)
            own[on] |= above << np.uint32(8)
        above = own
    return above if above is not None else np.zeros(0, np.uint32)


# What a byte is to the cuts of a text; the second byte of an accented Latin letter counts as one.
_SPACE, _PLAIN, _POINT, _LETTER = 1, 2, 4, 8
_KINDS = bytes(
    _SPACE * (not T._SOLID[k]) | _PLAIN * (32 < k < 127) | _POINT * (32 < k < 127 and not chr(k).isalnum()) | _LETTER * (k < 128 and chr(k).isalpha())
    for k in range(256)
)


class Encoder:
    """Ids of whole texts; each distinct piece is tokenized once.

    A text is cut before white space that follows a character which is surely none, and before punctuation that follows
    a letter: byte-level pre-tokenization always splits there, so the ids of the pieces in order are the ids of the
    text. Special tokens of the file hold no white space, but letters before punctuation, so texts near ``<|`` are cut
    at white space alone. For the same reason new pieces that begin with white space and end with a plain character are
    tokenized many in a row, as one text; the bytes of its tokens tell where each piece ends.
    """

    #: Pieces kept between batches.
    KEEP = 1 << 22
    #: Pieces tokenized as one text.
    ROW = 256

    def __init__(self, blob: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_buffer(blob)
        # a character of a token of the vocabulary stands for a byte, added tokens stand as they are
        width = {k: len(x) for x, k in self.model.get_vocab(with_added_tokens=False).items()}
        width |= {k: len(x.content.encode()) for k, x in self.model.get_added_tokens_decoder().items()}
        self.width = np.zeros(max(width, default=0) + 1, np.int64)
        self.width[list(width)] = list(width.values())
        self.clear()

    def clear(self) -> None:
        self.hash, self.where, self.ids, self.off = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.check = np.zeros(0, np.uint64)

    def _ids(self, texts: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]

    def _singly(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = self._ids(pieces)
        size = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((x for f in found for x in f), np.uint32, int(size.sum())), size

    def _in_rows(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and sizes of pieces that may stand side by side."""
        raw = data.tobytes()
        at = off[:: self.ROW].tolist() + [int(off[-1])]
        ids = np.concatenate([np.zeros(0, np.uint32)] + [np.array(x, np.uint32) for x in self._ids([raw[a:b] for a, b in zip(at, at[1:]) if a < b])])
        ends = np.cumsum(self.width[ids])
        last = np.searchsorted(ends, off[1:])
        if len(ids) and ends[-1] == len(raw) and (ends[last] == off[1:]).all():
            return ids, np.diff(last, prepend=-1)
        return self._singly([raw[a:b] for a, b in zip(off.tolist(), off[1:].tolist())])

    def _tokenized(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and sizes of pieces, in any company."""
        data, off = _content(pieces)
        kinds = np.frombuffer(_KINDS, np.uint8)
        last = data[off[1:] - 1]
        beside = (kinds[data[off[:-1]]] & _SPACE > 0) & ((kinds[last] & _PLAIN > 0) | (last >= 0x80) & (data[off[1:] - 2] == 0xC3))
        if not beside.any():
            return self._singly(pieces.to_pylist())
        rows, others = np.flatnonzero(beside), np.flatnonzero(~beside)
        ids, size = self._in_rows(*_content(pieces.take(pa.array(rows))))
        if not len(others):
            return ids, size
        more, sizes = self._singly(pieces.take(pa.array(others)).to_pylist())
        order = np.argsort(np.concatenate((rows, others)))
        size = np.concatenate((size, sizes))
        start = (np.cumsum(size) - size)[order]
        return _ranges(np.concatenate((ids, more)), start, size[order]), size[order]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids before each text."""
        n = len(data)
        cut = np.zeros(n, bool)
        if n > 1:
            raw = data.tobytes()
            kinds = np.frombuffer(raw.translate(_KINDS), np.uint8)
            if raw.find(0xC3) >= 0:
                kinds = kinds.copy()
                accent = np.flatnonzero(data[:-1] == 0xC3) + 1
                kinds[accent] = np.where((data[accent] == 0x97) | (data[accent] == 0xB7), _PLAIN, _PLAIN | _LETTER)  # two are signs
            # a kind shifted by a bit is the kind that may follow it
            follows = (kinds[:-1] & _PLAIN) >> 1
            if b"<|" not in raw:
                follows |= (kinds[:-1] & _LETTER) >> 1
            cut[1:] = (kinds[1:] & follows) != 0
        cut[offsets[:-1][offsets[:-1] < n]] = True
        starts = np.flatnonzero(cut)
        # equal pieces are found by their content, those of earlier slices by two hashes
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, n)), pa.py_buffer(data)]).dictionary_encode()
        each, uniq = pieces.indices.to_numpy(), pieces.dictionary
        ids, size = self._looked_up(uniq)
        start = (np.cumsum(size) - size)[each]
        size = size[each]
        before = np.concatenate(([0], np.cumsum(size)))
        return _ranges(ids, start, size), before[np.searchsorted(starts, offsets)]

    def _looked_up(self, uniq: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and sizes of different pieces, from the table or new."""
        some, off = _content(uniq)
        h = T.bytes_hashes(some, off[:-1], off[1:])
        check = T.quick_words(some, off[:-1], off[1:])
        order = np.argsort(h)
        uniq_h = h[order]
        if (uniq_h[1:] == uniq_h[:-1]).any():
            # the table can't tell these apart
            return self._tokenized(uniq)
        if len(self.hash) > self.KEEP:
            self.clear()
        at = np.searchsorted(self.hash, uniq_h)
        known = np.zeros(len(order), bool)
        inside = at < len(self.hash)
        known[inside] = self.hash[at[inside]] == uniq_h[inside]
        if (self.check[self.where[at[known]]] != check[order[known]]).any():
            self.clear()
            return self._looked_up(uniq)
        new = np.flatnonzero(~known)
        if len(new):
            more, size = self._tokenized(uniq.take(pa.array(order[new])))
            place = len(self.off) - 1 + np.arange(len(new))
            self.off = np.concatenate((self.off, self.off[-1] + np.cumsum(size)))
            self.ids = np.concatenate((self.ids, more))
            self.check = np.concatenate((self.check, check[order[new]]))
            self.where = np.insert(self.where, at[new], place)
            self.hash = np.insert(self.hash, at[new], uniq_h[new])
            at += np.cumsum(~known) - ~known
        piece = np.zeros(len(order), np.int64)
        piece[order] = self.where[at]
        size = self.off[piece + 1] - self.off[piece]
        return _ranges(self.ids, self.off[piece], size), size


def _content(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of large binaries and its n + 1 offsets, from 0 on."""
    _, off, data = pieces.buffers()
    off = np.frombuffer(off, np.int64)[pieces.offset : pieces.offset + len(pieces) + 1] if len(pieces) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]] if off[-1] > off[0] else np.zeros(0, np.uint8), off - off[0]


def _ranges(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """values[start : start + size] of all ranges, one after another."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    narrow = np.int32 if max(total, len(values)) < 1 << 31 else np.int64
    return values[np.repeat((start - (ends - size)).astype(narrow), size) + np.arange(total, dtype=narrow)]


_ENCODERS: dict[int, Encoder] = {}


def _encode(shared, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        blob = shared.value
        encoder = _ENCODERS.setdefault(zlib.crc32(blob), None) or _ENCODERS.__setitem__(zlib.crc32(blob), Encoder(blob)) or _ENCODERS[zlib.crc32(blob)]
        part, seq = TaskContext.get().partitionId(), 0
        keys, sizes, parts, held, nulls = [], [], [], 0, 0

        def segment() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            c, m, r = pack(ids)
            row = {
                "part": part,
                "seq": seq,
                "n_tokens": len(ids),
                "n_nulls": nulls,
                "doc_ids": np.concatenate(keys).astype("<i8").tobytes(),
                "doc_tokens": np.concatenate(sizes).astype("<i8").tobytes(),
                "chunks": c,
                "more": m,
                "ranks": r,
            }
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), *[pa.list_(pa.binary())] * 3]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), kinds, strict=True)], names=list(row))

        for batch in batches:
            data, offsets = T.columns(batch, "text")
            key = batch.column(0).fill_null(0).to_numpy().astype(np.int64)
            absent = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            for a, b, some, off in T.slices(data, offsets, 4 << 20):
                ids, before = encoder.encode(some, off)
                out = np.insert(ids, before[1:], end_id)
                keys.append(key[a:b])
                sizes.append(np.diff(before) + 1)
                parts.append(out)
                held += len(out)
                nulls += int(absent[a:b].sum())
                if held >= SEGMENT_TOKENS:
                    yield segment()
                    seq, keys, sizes, parts, held, nulls = seq + 1, [], [], [], 0, 0
        if parts:
            yield segment()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, text: str = "text", key: str = "doc_id") -> None:
    """Write the ids of all texts, each followed by ``end_id``, in ascending key order as a token file at ``path``.

    ``tokenizer`` is the file of a tokenizers model with byte-level pre-tokenization; the driver reads it once and
    ships it. A null or empty text has the end id alone. Rows without a key come first; a segment tells how many of
    its documents have none. Rows that repeat a key follow one another, in the order of their texts' digests. An empty
    table gives a file without segments. Other columns are ignored.
    """
    spark = docs.sparkSession
    with open(tokenizer, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # rows that repeat an id are dealt by their texts, so that a file has one order and no id is too large for a task
    rows = rows.withColumn("print", F.xxhash64("text")).repartitionByRange("doc_id", "print").sortWithinPartitions("doc_id", "print").drop("print")
    rows.mapInArrow(_encode(shared, end_id), _SCHEMA).write.mode("overwrite").parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(row["chunks"], row["more"]).astype("<u4")
            size = np.frombuffer(row["doc_tokens"], "<i8")
            ends = np.cumsum(size)
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), size.tolist(), strict=True)]
            k = len(size)
            keys = pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=np.arange(k) < row["n_nulls"])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["part"]] * k, pa.int32()),
                    pa.array([row["seq"]] * k, pa.int32()),
                    keys,
                    pa.array(ends - size),
                    pa.array(size),
                    pa.array(crc, pa.int64()),
                ],
                names=["part", "seq", "doc_id", "off", "n_tokens", "ids_crc32"],
            )


def _bases(segments: DataFrame) -> DataFrame:
    """(part, seq, base): tokens before each segment; totals of parts are summed first, so no window holds all segments."""
    sizes = segments.select("part", "seq", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("t")).select("part", (F.sum("t").over(Window.orderBy("part")) - F.col("t")).alias("before"))
    inner = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    return sizes.select("part", "seq", inner.alias("own")).join(parts, "part").select("part", "seq", (F.col("own") + F.col("before")).alias("base"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of a token file, from its decoded ids."""
    segments = spark.read.schema(_SCHEMA).parquet(path)
    rows = segments.select("part", "seq", "n_nulls", "doc_ids", "doc_tokens", "chunks", "more").mapInArrow(
        _documents,
        "part int, seq int, doc_id long, off long, n_tokens long, ids_crc32 long",
    )
    return rows.join(_bases(segments), ["part", "seq"]).select("doc_id", (F.col("off") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def read_tokens(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """(position, id) for a table of token ``position``s of the whole file; positions beyond it give no row.

    Positions find their segment by the multiples of SEGMENT_TOKENS that it touches; what is asked of a segment is dealt
    in lists of at most ASKED positions, so that a segment is read once for each list and no list is too large.
    """
    segments = spark.read.schema(_SCHEMA).parquet(path)
    touched = F.sequence(F.floor(F.col("base") / SEGMENT_TOKENS), F.floor((F.col("base") + F.col("n_tokens") - 1) / SEGMENT_TOKENS))
    placed = segments.select("part", "seq", "n_tokens").join(_bases(segments), ["part", "seq"]).withColumn("cell", F.explode(touched))
    asked = positions.select("position", F.floor(F.col("position") / SEGMENT_TOKENS).alias("cell"))
    met = asked.join(placed, "cell").where("position >= base and position < base + n_tokens").select("part", "seq", (F.col("position") - F.col("base")).alias("at"), "base")
    # a list covers one stretch of a segment, which has ASKED tokens; positions asked twice come back twice
    stretch = F.floor(F.col("at") / ASKED)
    lists = met.groupBy("part", "seq", "base", stretch.alias("stretch"), "at").agg(F.count(F.lit(1)).alias("times"))
    lists = lists.groupBy("part", "seq", "base", "stretch").agg(F.collect_list(F.struct("at", "times")).alias("asked"))
    rows = lists.join(segments.select("part", "seq", "chunks", "more", "ranks"), ["part", "seq"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                at = np.array([x["at"] for x in r["asked"]], np.int64)
                times = np.array([x["times"] for x in r["asked"]], np.int64)
                ids = access(r["chunks"], r["more"], r["ranks"], at).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(r["base"] + at), pa.array(ids), pa.array(times)], names=["position", "id", "times"])

    read = rows.select("base", "asked", "chunks", "more", "ranks").mapInArrow(run, "position long, id long, times long")
    return read.select("position", "id", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("_n")).drop("_n")
