"""Sealing of assembled traces: sequence, hash chain, signatures, log, quarantine and linked checkpoints.

A batch of the stream is sealed as a whole. What passes from batch to batch (the last checkpoint, the tips that wait for
one, counters) is one row, written last; a batch reads the row of the batch before it. All writes of a batch are folders
that carry its number, so a batch that is repeated after a failure replaces what it wrote and nothing else; those of
earlier batches are merged by eights, so that a log of any length has few files. Tables that a
batch needs on its way go with it, so a stream of any length has a constant number of working folders.

A stream begins with ``begin``, where a write-ahead log of unfinished traces and uncommitted tips is there to be taken
over, and ends with ``finish``, which seals what is still open and commits the last tips.
"""

from __future__ import annotations

import base64
import datetime
import math
import time
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import ed25519
from ..functions.jsonbytes import canonical_checkpoint, canonical_entry, canonical_record, checkpoint_payload, genesis_seed, json_string, sha256_hex
from ..operators import chain, records, wal
from ..operators.stage import delete, kept, listed, numbered, work
from ..sources import jsonl
from . import assemble
from .segments import Ledger


@dataclass(frozen=True)
class Settings:
    """Checked settings; zeros stand for the defaults. ``state_path`` is the folder of the stream's own state,
    ``key_path`` the file of the private key (PEM); a log without a key is not signed."""

    log_path: str
    checkpoint_path: str
    state_path: str = ""
    key_path: str = ""
    timeout_ms: float = 30_000
    checkpoint_interval: int = 100
    max_pending: int = 0
    min_retry_ms: int = 1000

    def __post_init__(self):
        if not self.log_path or not self.checkpoint_path:
            raise ValueError("log_path and checkpoint_path are required")
        paths = [p.rstrip("/") for p in (self.log_path, self.checkpoint_path, self.state, self.quarantine_path, self.key_path) if p]
        if len(set(paths)) < len(paths):
            raise ValueError("paths must differ")
        if self.timeout_ms < 0 or self.checkpoint_interval < 0 or self.min_retry_ms < 0:
            raise ValueError("settings can't be negative")
        if 0 < self.timeout_ms < 1:
            raise ValueError("a timeout is at least a millisecond")
        if 0 < self.max_pending < self.interval:
            raise ValueError("max_pending can't be less than the checkpoint interval")

    @property
    def interval(self) -> int:
        return self.checkpoint_interval or 100

    @property
    def pending_cap(self) -> int:
        """Tips that may wait for a checkpoint; negative settings switch the cap off."""
        return self.max_pending if self.max_pending > 0 else 0 if self.max_pending < 0 else 10 * self.interval

    @property
    def timeout(self) -> int:
        return int(self.timeout_ms) or 30_000

    @property
    def quarantine_path(self) -> str:
        return f"{self.log_path.rstrip('/')}.quarantine"

    @property
    def segments_path(self) -> str:
        return f"{self.log_path.rstrip('/')}.segments"

    @property
    def state(self) -> str:
        return self.state_path or f"{self.checkpoint_path.rstrip('/')}.state"

    def key(self) -> bytes | None:
        if not self.key_path:
            return None
        with open(self.key_path) as f:
            return ed25519.read_private_pem(f.read())


TIP = "trace_id string, tip_hash string, entry_count long, seal_no long"
#: What passes from batch to batch. Counters: traces sealed, spans that came late, records set aside, tips dropped at the
#: cap, checkpoints written. ``failures`` and ``retry_at`` are of the checkpoint that couldn't be written.
PASSED = (
    "batch long, seq long, prev_hash string, sealed long, late long, quarantined long, cap_dropped long, failures int, "
    f"retry_at long, tried_ms long, pending array<struct<{TIP.replace(' string', ':string').replace(' long', ':long')}>>"
)


def _now() -> str:
    return datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


#: Rows of state that are kept: those of the last batches.
_STATES = 4
#: How a failed write of checkpoints looks.
_FAILED = (OSError, Py4JError, PySparkException)
#: Names of what isn't a batch of the stream: what was taken over before the first, and the end after some batch.
_BEGIN, _END = "-begin", "_end"


class Sealer:
    """Seals one batch of the stream after the other; a function for ``foreachBatch``.

    ``spans`` is the schema of the spans that ``assemble.carried`` packed: the columns that ``records.to_records`` reads,
    and schema_version where spans bring one of their own.
    """

    def __init__(self, settings: Settings, spans: T.StructType, key: bytes | None = None, stamp: Callable[[], str] = _now):
        self.settings, self.spans, self.stamp = settings, spans, stamp
        self.key_bytes = key if key is not None else settings.key()
        self.key_id = ed25519.key_id(ed25519.public_key(self.key_bytes)) if self.key_bytes else ""

    def _states(self, spark: SparkSession) -> list[str]:
        return [n for n in listed(spark, self.settings.state) if n.startswith("batch=")]

    def passed(self, spark: SparkSession, batch_id: int | str) -> dict:
        """What the last batch before ``batch_id`` left; without any, what the checkpoint file tells."""
        s = self.settings
        before = [n for n in self._states(spark) if n < jsonl.batch_name(batch_id)]
        if before:
            return spark.read.schema(PASSED).parquet(f"{s.state.rstrip('/')}/{max(before)}").first().asDict(recursive=True)
        out = {
            "batch": -1,
            "seq": 0,
            "prev_hash": chain.ZERO_HASH,
            "sealed": 0,
            "late": 0,
            "quarantined": 0,
            "cap_dropped": 0,
            "failures": 0,
            "retry_at": 0,
            "tried_ms": 0,
            "pending": [],
        }
        last = jsonl.last_checkpoint(spark, s.checkpoint_path).select("checkpoint_seq", sha256_hex(checkpoint_payload()).alias("h")).first()
        return out | ({"seq": last.checkpoint_seq, "prev_hash": last.h} if last else {})

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        """Seal a batch of assembled spans (the columns of ASSEMBLED). An empty one changes nothing."""
        spark = batch.sparkSession
        with work(spark):
            seen = Observation()
            late = F.col("segment") == "late"
            rows = kept(batch.observe(seen, F.count(F.lit(1)).alias("spans"), F.count_if(late).alias("late")))
            if not seen.get["spans"]:
                return
            passed = self.passed(spark, batch_id)
            # a trace that was emitted is closed: what comes late is counted and dropped
            self._seal(spark, self._undrained(rows.where(~late)), batch_id, passed | {"late": passed["late"] + seen.get["late"]})

    def _seal(self, spark: SparkSession, rows: DataFrame, batch_id: int | str, passed: dict, final: bool = False) -> None:
        # read for the quarantine, for the number of tasks and for the log
        made = kept(records.last_wins(self._records(assemble.restored(rows, self._schema)), F.col("arrival")))
        set_aside = self._quarantine(made, batch_id)
        ledger = Ledger(spark, self.settings.segments_path)
        ledger.compact(jsonl.batch_name(batch_id))
        for path in (self.settings.log_path, self.settings.checkpoint_path, self.settings.quarantine_path):
            jsonl.compact(spark, path, jsonl.batch_name(batch_id))
        tips = ledger.add(self._log(made, batch_id), batch_id).drop("segment_no")
        passed = passed | {"batch": batch_id if isinstance(batch_id, int) else passed["batch"], "quarantined": passed["quarantined"] + set_aside}
        passed = self._checkpoint(spark, passed, tips, batch_id, final)
        spark.createDataFrame([passed], PASSED).coalesce(1).write.mode("overwrite").parquet(jsonl.batch_path(self.settings.state, batch_id))
        for name in self._states(spark)[:-_STATES]:
            delete(spark, f"{self.settings.state}/{name}")

    @property
    def _drained(self) -> str:
        return f"{self.settings.state.rstrip('/')}/drained"

    def _undrained(self, rows: DataFrame) -> DataFrame:
        """Spans without those that an end of the stream has sealed, which may come out of its state once more. An end
        that didn't come to its row of state is taken back: it begins with its list of spans."""
        spark, s = rows.sparkSession, self.settings
        states = self._states(spark)
        for name in listed(spark, self._drained):
            if name in states or states and name < states[0]:
                gone = spark.read.schema("trace_id string, span_id string").parquet(f"{self._drained}/{name}")
                rows = rows.join(gone, ["trace_id", "span_id"], "left_anti").select(*rows.columns)
            else:
                for path in (s.log_path, s.checkpoint_path, s.quarantine_path, self._drained):
                    delete(spark, f"{path.rstrip('/')}/{name}")
                delete(spark, f"{s.segments_path}/level-0_{name}")
        return rows

    def begin(self, spark: SparkSession, lines: DataFrame) -> DataFrame:
        """Take over a write-ahead log (``jsonl.read_wal``) before the first batch: the initial state of the stream.

        Tips of sealed traces that no checkpoint covers wait for one again. Unfinished traces of versions that agree with
        the current one stay open, and what the stream brings is added to them; those that must keep their version are
        sealed at once, others are quarantined, and to both nothing is added for a while.
        """
        if any(n != jsonl.batch_name(_BEGIN) for n in self._states(spark)):
            raise ValueError("the stream has begun")
        with work(spark):
            passed = self.passed(spark, _BEGIN)
            committed = jsonl.read_checkpoints(spark, self.settings.checkpoint_path).select(F.explode("trace_tips").alias("t")).select("t.trace_id", "t.tip_hash")
            waiting = numbered(kept(chain.covered(wal.restored_tips(lines), committed)), "line_no")
            count = waiting.count()
            cap = self.settings.pending_cap
            tips = chain.trim_pending(waiting, cap).select("trace_id", "tip_hash", "entry_count", "seal_no").orderBy("seal_no").collect()
            passed |= {"pending": [t.asDict() for t in tips], "sealed": count, "cap_dropped": count - len(tips)}
            fates = kept(wal.replay(lines).select("trace_id", "action", "has_root"))
            spans = kept(assemble.carried_records(wal.deduplicated(lines)).join(fates, "trace_id"))
            whole = F.when(F.col("has_root"), "complete").otherwise("partial").alias("segment")
            self._seal(spark, spans.where("action <> 'restamp'").select(*assemble.SPAN.fieldNames(), whole), _BEGIN, passed)
            closed = [F.lit(None).cast(f.dataType).alias(f.name) for f in assemble.HELD]
            initial = spans.where("action = 'restamp'").select(*assemble.SPAN.fieldNames(), F.lit("open").alias("segment"))
            initial = initial.unionByName(fates.where("action <> 'restamp'").select("trace_id", *closed, F.lit(assemble.CLOSED).alias("segment")))
            path = f"{self.settings.state.rstrip('/')}/initial"
            initial.write.mode("overwrite").parquet(path)
        return spark.read.schema(assemble.ASSEMBLED).parquet(path)

    def finish(self, spark: SparkSession, checkpoint: str) -> None:
        """End a stopped stream: seal the traces that it still holds, and commit the tips that wait, in a last checkpoint
        that may be short.

        Done twice, nothing changes. The state of the stream stays as it is; a stream that is started again from there
        doesn't seal the same spans once more, and what comes to these traces is another segment. An end that fails on
        its way can be repeated, or is taken back by the next batch.
        """
        states = self._states(spark)
        last = states[-1].removeprefix("batch=") if states else "-"
        if last.endswith(_END):
            return
        committed = [int(n) for n in listed(spark, f"{checkpoint.rstrip('/')}/commits") if n.isdigit()]
        if last.isdigit() and int(last) > max(committed, default=-1):
            raise ValueError("the last batch isn't committed: start the stream once more before its end")
        name = f"{last}{_END}"
        with work(spark):
            rows = kept(self._undrained(assemble.flushed(spark, checkpoint)))
            rows.select("trace_id", "span_id").write.mode("overwrite").parquet(f"{self._drained}/{jsonl.batch_name(name)}")
            self._seal(spark, rows, name, self.passed(spark, name), final=True)

    @property
    def _schema(self) -> T.StructType:
        """The schema of packed spans, of which some are records already."""
        return T.StructType([*self.spans.fields, T.StructField(assemble.RECORD, jsonl.RECORD)])

    def _records(self, spans: DataFrame) -> DataFrame:
        """Records with the version at which their trace is sealed, and why it can't be (null: it can)."""
        old = F.col(assemble.RECORD)
        given = "schema_version" in self.spans.names
        if given:
            spans = spans.withColumnRenamed("schema_version", "_version")
        made = records.to_records(spans)
        # what was a record before it came keeps its fields
        fields = {f.name: F.when(old.isNotNull(), old[f.name].cast(made.schema[f.name].dataType)).otherwise(F.col(f.name)) for f in jsonl.RECORD.fields if f.name in made.columns and f.name != "schema_version"}
        own = F.coalesce(old["schema_version"], *[F.col("_version")] * given, F.lit(records.CURRENT_VERSION))
        made = kept(made.withColumns(fields | {"schema_version": own}).drop("_version", assemble.RECORD))
        fate = records.traces(made).select("trace_id", "versions", records.disposition(F.col("versions")).alias("fate"))
        rows = made.join(fate, "trace_id")
        version = F.when(F.col("fate") == "restamp", records.CURRENT_VERSION).otherwise(F.col("schema_version"))
        why = F.when(F.col("fate") == "quarantine", "mixed or unknown versions").when(genesis_seed(F.col("trace_id"), version).isNull(), "no chain can start from its trace_id")
        return rows.withColumns({"reason": why, "schema_version": F.when(why.isNull(), version).otherwise(F.col("schema_version"))})

    def _quarantine(self, made: DataFrame, batch_id: int | str) -> int:
        """Write the records that can't be sealed, by trace and span id; how many there are."""
        bad = made.where("reason is not null")
        text = lambda name, value: F.concat(F.lit(f'"{name}":'), value)
        versions = F.concat(F.lit("["), F.array_join(F.transform("versions", json_string), ","), F.lit("]"))
        line = F.concat_ws(
            ",",
            text("trace_id", json_string(F.col("trace_id"))),
            text("quarantined_at", json_string(F.lit(self.stamp()))),
            text("reason", json_string(F.col("reason"))),
            text("schema_versions", versions),
            text("current_schema_version", json_string(F.lit(records.CURRENT_VERSION))),
            text("record", canonical_record()),
        )
        lines = kept(bad.withColumn("seq_in_trace", F.lit(0)).select("trace_id", "span_id", F.concat(F.lit("{"), line, F.lit("}")).alias("line")))
        n = lines.count()
        if n:
            jsonl.write_batch(lines, self.settings.quarantine_path, batch_id, "trace_id", "span_id")
        return n

    def _log(self, made: DataFrame, batch_id: int | str) -> DataFrame:
        """Append the entries of the traces that can be sealed; their tips."""
        good = records.with_sequence(made.where("reason is null").drop("reason", "versions", "fate", "arrival", "segment"))
        lines = kept(chain.hash_entries(good, self.key_bytes, "text").select("trace_id", "seq_in_trace", "entry_hash", canonical_entry(record=F.col("text")).alias("line")))
        jsonl.write_batch(lines, self.settings.log_path, batch_id, "trace_id", "seq_in_trace")
        return lines.groupBy("trace_id").agg(F.max_by("entry_hash", "seq_in_trace").alias("tip_hash"), F.count(F.lit(1)).alias("entry_count"))

    def _checkpoint(self, spark: SparkSession, passed: dict, tips: DataFrame, batch_id: int | str, final: bool = False) -> dict:
        """Commit the pending tips in full checkpoints, at the end all of them. Tips of a checkpoint that can't be written
        stay pending up to the cap, where the oldest are dropped and counted, and are tried again later and later; at the
        end the failure is raised."""
        s = self.settings
        new = numbered(tips, "trace_id").withColumn("seal_no", F.col("seal_no") + passed["sealed"])
        n_new = tips.count()
        pending = kept(new.unionByName(spark.createDataFrame([tuple(t.values()) for t in passed["pending"]], TIP)))
        waiting = n_new + len(passed["pending"])
        out = passed | {"sealed": passed["sealed"] + n_new}
        now = int(time.time() * 1000)
        capped = 0 < s.pending_cap <= waiting and passed["failures"] > 0
        full = -(-waiting // s.interval) if final else waiting // s.interval
        ready = final or waiting >= passed["retry_at"] and not (capped and now - passed["tried_ms"] < s.min_retry_ms)
        if full and ready:
            ranked = numbered(pending, "seal_no", name="place").withColumn("checkpoint_seq", F.floor(F.col("place") / s.interval) + 1 + passed["seq"])
            due = ranked.where(F.col("place") < full * s.interval)
            try:
                out |= {"prev_hash": self._commit(due, passed["prev_hash"], batch_id), "seq": passed["seq"] + full, "failures": 0, "retry_at": 0, "tried_ms": now}
                pending, waiting = ranked.where(F.col("place") >= full * s.interval).drop("place", "checkpoint_seq"), max(0, waiting - full * s.interval)
            except _FAILED:
                # the log holds the entries; their tips wait for the next try
                if final:
                    raise
                failures = passed["failures"] + 1
                at = spark.range(1).select(chain.next_retry(F.lit(failures), F.lit(waiting), F.lit(s.pending_cap))).first()[0]
                out |= {"failures": failures, "retry_at": at, "tried_ms": now}
        if 0 < s.pending_cap < waiting:
            out["cap_dropped"] += waiting - s.pending_cap
            pending = chain.trim_pending(pending, s.pending_cap)
        # no more than the cap, or less than an interval, of tips
        out["pending"] = [r.asDict() for r in pending.select("trace_id", "tip_hash", "entry_count", "seal_no").orderBy("seal_no").collect()]
        return out

    def _commit(self, due: DataFrame, prev: str, batch_id: int | str) -> str:
        """Sign and append checkpoints; the payload hash of the last one, worked out before anything is appended."""
        key = self.key_bytes

        @F.pandas_udf("string")
        def signed(payload: pd.Series) -> pd.Series:
            return payload.map(lambda p: base64.b64encode(ed25519.sign(key, p.encode())).decode())

        cps = chain.checkpoints(due, F.lit(self.stamp()), self.key_id, prev=prev)
        sign: Column = signed(checkpoint_payload()) if key else F.lit("")
        lines = kept(cps.withColumn("signature", sign).select("checkpoint_seq", sha256_hex(checkpoint_payload()).alias("h"), canonical_checkpoint().alias("line")))
        last = lines.agg(F.max_by("h", "checkpoint_seq")).first()[0]
        jsonl.write_batch(lines, self.settings.checkpoint_path, batch_id, "checkpoint_seq")
        return last


def start(spans: DataFrame, settings: Settings, checkpoint: str, key: bytes | None = None, arrival: str | None = None, wal_lines: DataFrame | None = None, **trigger) -> StreamingQuery:
    """Assemble and seal a stream of spans; ``checkpoint`` is the stream's checkpoint folder. ``wal_lines``, where the
    stream begins, is a write-ahead log to take over."""
    spark = spans.sparkSession
    sealer = Sealer(settings, spans.schema, key)
    begun = f"{settings.state.rstrip('/')}/initial"
    initial = None
    if wal_lines is not None:
        # a stream that is started again has to be given the state that it began with
        has = "_SUCCESS" in listed(spark, begun)
        initial = spark.read.schema(assemble.ASSEMBLED).parquet(begun) if has else sealer.begin(spark, wal_lines)
    assembled = assemble.assemble(assemble.carried(spans, arrival), settings.timeout, initial)
    writer = assembled.writeStream.foreachBatch(sealer).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(**trigger) if trigger else writer).start()


def drain(query: StreamingQuery, seconds: float = math.inf) -> None:
    """Stop a stream once it has taken in all that its source held, however long that takes, if not ``seconds``. Its timers keep it busy, so it never ends by itself:
    the sign is a second batch without input, as the first may be one that an earlier stop had broken off."""
    end = time.monotonic() + seconds
    while query.isActive and time.monotonic() < end:
        rows = [p.numInputRows for p in query.recentProgress]
        if rows.count(0) >= 2 and rows[-1] == 0:
            break
        time.sleep(0.2)
    if failed := query.exception():
        raise failed
    query.stop()


def finish(spark: SparkSession, settings: Settings, spans: T.StructType, checkpoint: str, key: bytes | None = None, stamp: Callable[[], str] = _now) -> None:
    """End a stream that ``start`` started and that was stopped for good; ``spans`` is the schema of its spans."""
    Sealer(settings, spans, key, stamp).finish(spark, checkpoint)


def segments(spark: SparkSession, settings: Settings) -> DataFrame:
    """(trace_id, segment_no, tip_hash, entry_count) of every chain that was sealed."""
    return Ledger(spark, settings.segments_path).rows()
