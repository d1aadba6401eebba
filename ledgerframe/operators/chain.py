"""Hash chains of traces and the checkpoints that commit to their tips."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ed25519
from ..functions.jsonbytes import canonical_record, checkpoint_payload, genesis_seed, sha256_hex
from .stage import dealt_over, kept

ZERO_HASH = "0" * 64
EMPTY_BATCH = "EMPTY_BATCH"


def in_chain_order(rows: DataFrame, *ties: str) -> DataFrame:
    """Rows dealt by trace and sorted along each chain, for functions that stream with one hash of state: a trace of any
    length needs no memory of its own. A chain is serial, so the entries of one trace do pass through one task."""
    return rows.repartition(dealt_over(rows), "trace_id").sortWithinPartitions("trace_id", "seq_in_trace", *ties)


def _texts(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


def chain_tips(records: DataFrame) -> DataFrame:
    """(trace_id, entry_count, tip_hash): an ordered fold of each trace, sha256(bytes + previous hash), from its seed.

    The tip of a trace whose seed can't be made is null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trace, count, now = None, 0, None
        for batch in batches:
            done = []
            for t, seed, text in zip(*_texts(batch, "trace_id", "_seed", "_bytes"), strict=True):
                if t != trace:
                    if count:
                        done.append((trace, count, now and now.hex()))
                    trace, count, now = t, 0, seed and bytes.fromhex(seed)
                count += 1
                now = now and hashlib.sha256(text.encode() + now).digest()
            yield _tips(done)
        if count:
            yield _tips([(trace, count, now and now.hex())])

    def _tips(done: list[tuple]) -> pa.RecordBatch:
        t, n, h = zip(*done, strict=True) if done else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(t, pa.string()), pa.array(n, pa.int64()), pa.array(h, pa.string())], names=["trace_id", "entry_count", "tip_hash"])

    rows = records.select("trace_id", "seq_in_trace", genesis_seed(F.col("trace_id"), F.col("schema_version")).alias("_seed"), canonical_record().alias("_bytes"))
    return in_chain_order(rows).mapInArrow(run, "trace_id string, entry_count long, tip_hash string")


SIGNED = ("entry_hash", "prev_hash", "key_id", "algorithm", "signature")


def hash_entries(records: DataFrame, key: bytes | None = None, text: str | None = None) -> DataFrame:
    """``records`` with entry_hash, prev_hash and, given a private key, key_id, algorithm and signature.

    All columns go through the stream, so nothing is joined back; ``text`` names one more, the bytes of the record. Entries
    of a trace whose seed can't be made have null hashes.
    """
    public = ed25519.public_key(key) if key else b""
    rows = records.select("*", *([canonical_record().alias(text)] if text else []))
    own = len(rows.columns)
    by = hashlib.sha256(public).hexdigest() if key else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trace, prev = None, None
        for batch in batches:
            out: list[tuple] = []
            for t, seed, record in zip(*_texts(batch, "trace_id", "_seed", text or "_bytes"), strict=True):
                if t != trace:
                    trace, prev = t, seed
                if prev is None:
                    out.append((None, None, by, "ed25519" if key else "", ""))
                    continue
                payload = record.encode() + bytes.fromhex(prev)
                now = hashlib.sha256(payload).hexdigest()
                sig = base64.b64encode(ed25519.sign(key, payload)).decode() if key else ""
                out.append((now, prev, by, "ed25519" if key else "", sig))
                prev = now
            more = zip(*out, strict=True) if out else [()] * len(SIGNED)
            yield pa.RecordBatch.from_arrays([*batch.columns[:own], *[pa.array(x, pa.string()) for x in more]], names=[*batch.schema.names[:own], *SIGNED])

    schema = T.StructType([*rows.schema.fields, *[T.StructField(n, T.StringType()) for n in SIGNED]])
    rows = rows.select("*", genesis_seed(F.col("trace_id"), F.col("schema_version")).alias("_seed"), *[canonical_record().alias("_bytes")] * (not text))
    return in_chain_order(rows).mapInArrow(run, schema)


def checkpoint_batches(sealed: DataFrame, every: int = 100) -> DataFrame:
    """``sealed`` (trace_id, seal_no, from 0) with the checkpoint that commits to each, one for ``every`` traces."""
    return sealed.withColumn("checkpoint_seq", F.floor(F.col("seal_no") / every) + 1)


def checkpoints(tips: DataFrame, timestamp: Column, key_id: str = "", version: str = "v3", prev: str = ZERO_HASH) -> DataFrame:
    """Unsigned checkpoints in order, from tips (trace_id, tip_hash, entry_count, checkpoint_seq): tips sorted by
    trace, each checkpoint linked to the payload hash of the one before; ``prev`` is that of the last one committed.

    The link is a recursion over a sequence that is serial by definition and small (one row for a hundred traces). The
    payloads are made in parallel and written first; then they stream through one sorted partition that holds one hash.
    """
    fields = [F.col("tip_hash"), F.col("entry_count").cast("long").alias("entry_count")]
    by = tips.groupBy("checkpoint_seq").agg(F.array_sort(F.collect_list(F.struct("trace_id", *fields))).alias("trace_tips"))
    names = ["schema_version", "checkpoint_seq", "timestamp", "prev_checkpoint_hash", "trace_tips", "key_id", "algorithm"]
    open_ = by.select(
        F.lit(version).alias("schema_version"),
        "checkpoint_seq",
        timestamp.alias("timestamp"),
        F.lit("@prev@").alias("prev_checkpoint_hash"),
        "trace_tips",
        F.lit(key_id).alias("key_id"),
        F.lit("ed25519").alias("algorithm"),
    )
    open_ = kept(open_.withColumn("_payload", checkpoint_payload()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = prev
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                out.append(last)
                last = hashlib.sha256(text.replace('"@prev@"', f'"{last}"', 1).encode()).hexdigest()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["checkpoint_seq", "prev_checkpoint_hash"])

    ordered = open_.select("checkpoint_seq", "_payload").repartition(1).sortWithinPartitions("checkpoint_seq")
    kind = dict(open_.dtypes)["checkpoint_seq"]
    links = ordered.mapInArrow(run, f"checkpoint_seq {kind}, prev_checkpoint_hash string")
    return open_.drop("prev_checkpoint_hash").join(links, "checkpoint_seq").select(*names)


def payload_hashes(lines: DataFrame, order: str = "line_no", first: str = ZERO_HASH) -> DataFrame:
    """Checkpoint rows with the hash of their payload and the one they should link to: that of the line before, or
    ``first``. Lines have consecutive numbers, so each meets the one before it by number."""
    hashed = lines.withColumn("payload_hash", sha256_hex(checkpoint_payload()))
    before = hashed.select((F.col(order) + 1).alias("_next"), F.col("payload_hash").alias("_before"))
    return hashed.join(before, F.col(order) == F.col("_next"), "left").withColumn("expected_prev", F.coalesce("_before", F.lit(first))).drop("_next", "_before")


def trim_pending(pending: DataFrame, keep: int) -> DataFrame:
    """The newest ``keep`` pending tips by seal_no; all of them where ``keep`` is not positive."""
    return pending if keep <= 0 else pending.orderBy(F.col("seal_no").desc()).limit(keep)


def drop_pending(pending: DataFrame) -> tuple[DataFrame, int]:
    """No pending tips, and how many there were."""
    return pending.limit(0), pending.count()


def still_pending(tips: DataFrame, pending: DataFrame) -> DataFrame:
    """Tips that wait for a checkpoint themselves; another tip of their trace doesn't count."""
    return tips.join(pending.select("trace_id", "tip_hash").distinct(), ["trace_id", "tip_hash"], "left_semi")


def covered(pending: DataFrame, committed: DataFrame) -> DataFrame:
    """Pending tips that a committed checkpoint doesn't cover."""
    return pending.join(committed.select("trace_id", "tip_hash"), ["trace_id", "tip_hash"], "left_anti")


def pending_sets(pending: DataFrame) -> DataFrame:
    """(trace_id, tips): the distinct pending tips of each trace, sorted."""
    return pending.groupBy("trace_id").agg(F.array_sort(F.collect_set("tip_hash")).alias("tips"))


def next_retry(failures: Column, pending: Column, cap: Column) -> Column:
    """Number of pending tips at which a failed checkpoint is tried again: one more at first, then twice as many with at
    most 1024 more, never above the cap (if there is one)."""
    more = F.when(failures > 1, F.least(pending * 2, pending + 1024)).otherwise(pending + 1)
    return F.when(cap > 0, F.least(more, cap)).otherwise(more)


def effective(value: Column, default: Column) -> Column:
    """A setting, or its default where it is null or zero."""
    return F.coalesce(F.nullif(value, F.lit(0)), default)


def _folded(hashes: Column, levels: int) -> Column:
    """An array of hex digests, folded so many levels up its tree: neighbours hash together, the last of an odd number
    rises unchanged."""

    def level(nodes: Column, _: Column) -> Column:
        both = lambda i: F.sha2(F.concat(F.unhex(F.lit("01")), F.unhex(F.get(nodes, 2 * i)), F.unhex(F.get(nodes, 2 * i + 1))), 256)
        places = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int"))
        return F.transform(places, lambda i: F.when(2 * i + 1 < F.size(nodes), both(i)).otherwise(F.get(nodes, 2 * i)))

    return F.aggregate(F.sequence(F.lit(1), F.lit(levels)), hashes, level)


def merkle_root(leaves: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Root of the RFC 6962 tree over (leaf_no, leaf), hex digests of 32 bytes, for each group of ``by`` columns.

    A leaf hashes with a zero byte before it, a node with a one; a node without a sibling rises unchanged, which gives
    the tree of that paper. Leaves meet in aligned blocks, which fold to one node each, and those fold to the root: two
    shuffles for any number of leaves, and no task holds more than about its square root.
    """
    by = by or []
    rows = leaves.select(*by, F.col("leaf_no").cast("long").alias("n"), F.sha2(F.concat(F.unhex(F.lit("00")), F.unhex("leaf")), 256).alias("h"))
    most = rows.agg(F.max("n")).first()[0]
    levels = int(most).bit_length() if most else 0
    low = max(1, -(-levels // 2))
    for height in (low, max(1, levels - low)):
        inside = F.transform(F.array_sort(F.collect_list(F.struct("n", "h"))), lambda x: x["h"])
        rows = rows.groupBy(*by, F.shiftright("n", height).alias("m")).agg(inside.alias("nodes")).select(*by, F.col("m").alias("n"), F.get(_folded(F.col("nodes"), height), F.lit(0)).alias("h"))
    return rows.select(*by, F.col("h").alias("root"))


def batch_roots(batches: DataFrame, leaves: DataFrame, by: list[str]) -> DataFrame:
    """(by, root, reject) of every batch: its Merkle root, or EMPTY_BATCH where it has no leaf."""
    found = batches.select(*by).distinct().join(merkle_root(leaves, by), by, "left")
    return found.withColumn("reject", F.when(F.col("root").isNull(), EMPTY_BATCH))
