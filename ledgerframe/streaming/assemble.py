"""Streaming trace assembly.

Spans of a trace are held in state until its root has come (with all spans of the same batch) or until it was idle for
``timeout_ms`` of processing time; then the trace is emitted once. Spans that come later pass through marked as late
while the emission is remembered, which is for twice the timeout from the emission on, however many late spans come.
After that a span starts its trace anew. Time is that of arrival: there is no watermark.

A span is appended to a list in RocksDB, so a batch costs what its own spans cost, however many are held; the memory of
an emission is a value that the store forgets by itself.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..sources import jsonl

SPAN = T.StructType(
    [
        T.StructField("trace_id", T.StringType()),
        T.StructField("span_id", T.StringType()),
        T.StructField("parent_span_id", T.StringType()),
        T.StructField("arrival", T.LongType()),
        T.StructField("payload", T.StringType()),
    ]
)
ASSEMBLED = T.StructType([*SPAN.fields, T.StructField("segment", T.StringType())])
_NAMES = ASSEMBLED.fieldNames()
#: What is held of a span.
HELD = T.StructType(SPAN.fields[1:])
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: The segment of a row of an initial state that marks a trace as emitted.
CLOSED = "closed"
#: The field of a payload that holds a record, for what was one before it came.
RECORD = "_record"


def carried(spans: DataFrame, arrival: str | None = None) -> DataFrame:
    """Spans of any columns in the columns of SPAN: the whole span is the payload, as JSON. ``arrival`` orders spans of
    one id; without it, it is the time at which the batch is read."""
    when = F.unix_millis(F.current_timestamp()) if arrival is None else F.col(arrival).cast("long")
    return spans.select("trace_id", "span_id", "parent_span_id", when.alias("arrival"), F.to_json(F.struct("*")).alias("payload"))


def carried_records(lines: DataFrame) -> DataFrame:
    """Records of a write-ahead log (``jsonl.read_wal``) in the columns of SPAN. They count as having arrived before
    anything of a stream, in the order of their lines."""
    fields = [f.name for f in jsonl.RECORD.fields]
    record = F.struct(*[F.col(n) for n in fields]).alias(RECORD)
    when = (F.col("line_no") - F.lit(1 << 62)).cast("long").alias("arrival")
    return lines.select("trace_id", "span_id", "parent_span_id", when, F.to_json(F.struct("trace_id", "span_id", "parent_span_id", record)).alias("payload"))


def restored(assembled: DataFrame, schema: T.StructType) -> DataFrame:
    """The spans that ``carried`` packed, with arrival and segment."""
    return assembled.select("arrival", "segment", F.from_json("payload", schema).alias("x")).select("x.*", "arrival", "segment")


class Assembler(StatefulProcessor):
    """Holds spans by trace: ``spans``, appended as they come; ``open``, when the trace's timer goes off; ``emitted``,
    which is there for as long as the emission is remembered."""

    def __init__(self, timeout_ms: int):
        self.timeout = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spans = handle.getListState("spans", HELD)
        self.open = handle.getValueState("open", "timer_ms long")
        self.emitted = handle.getValueState("emitted", "at_ms long", ttlDurationMs=2 * self.timeout)

    def _hold(self, spans: list[tuple], now: int) -> None:
        """Append spans and let the trace's timer start anew."""
        if spans:
            self.spans.appendList(spans)
        self._stop_timer()
        self.open.update((now + self.timeout,))
        self.handle.registerTimer(now + self.timeout)

    def _stop_timer(self) -> bool:
        """Whether the trace is open, which it is if it has spans in state; its timer no longer goes off."""
        if not self.open.exists():
            return False
        self.handle.deleteTimer(self.open.get()[0])
        return True

    def _emit(self, key, now: int, held: bool = True, come: list[tuple] = (), segment: str | None = None) -> Iterator[Row]:
        """All spans that are held and that have come, of each id the last to arrive; the segment by whether there is a
        root, if none is given. What comes with its root is never written to the state."""
        last: dict[str, tuple] = {}
        for span, parent, arrival, payload in itertools.chain(self.spans.get() if held else (), come):
            if span not in last or last[span][1] <= arrival:
                last[span] = parent, arrival, payload
        if segment is None:
            segment = "complete" if any(not parent for parent, _, _ in last.values()) else "partial"
        if held:
            self.spans.clear()
            self.open.clear()
        self.emitted.update((now,))
        for span, rest in sorted(last.items()):
            yield Row(**dict(zip(_NAMES, (key[0], span, *rest, segment), strict=True)))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        come = sorted(((r.span_id, r.parent_span_id, int(r.arrival), r.payload) for r in rows), key=lambda s: s[2])
        if self.emitted.exists():
            for span in come:
                yield Row(**dict(zip(_NAMES, (key[0], *span, "late"), strict=True)))
        elif any(not parent for _, parent, _, _ in come):
            yield from self._emit(key, now, self._stop_timer(), come, "complete")
        else:
            self._hold(come, now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._emit(key, timerValues.getCurrentProcessingTimeInMs())

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        now = timerValues.getCurrentProcessingTimeInMs()
        if initialState.segment == CLOSED:
            self.emitted.update((now,))
        else:
            self._hold([(initialState.span_id, initialState.parent_span_id, int(initialState.arrival), initialState.payload)], now)

    def close(self) -> None:
        pass


def assemble(spans: DataFrame, timeout_ms: int = 30_000, initial: DataFrame | None = None) -> DataFrame:
    """Streaming spans (the columns of SPAN) as assembled traces with their segment: complete, partial or late.

    ``initial`` (the columns of ASSEMBLED) is what a stream that begins holds already: spans of open traces, and rows
    with the segment ``closed`` for traces to which nothing may be added while an emission would be remembered. A
    session gets RocksDB as its state store, which lists and times to live need.
    """
    spans.sparkSession.conf.set(_STORE, _ROCKS)
    by = spans.where("trace_id <> ''").select(*SPAN.fieldNames()).groupBy("trace_id")
    begin = None if initial is None else initial.where("trace_id <> ''").select(*ASSEMBLED.fieldNames()).groupBy("trace_id")
    return by.transformWithState(Assembler(timeout_ms), ASSEMBLED, "Append", "ProcessingTime", begin)


def flushed(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What a stopped stream still holds of open traces, in the columns of ASSEMBLED, as partial segments (as complete
    ones, where an initial state had the root).

    The state is read from the stream's checkpoint folder; it is not changed. ``seal.finish`` seals these traces so that
    a stream that is started again doesn't seal them once more.
    """
    spark.conf.set(_STORE, _ROCKS)
    held = spark.read.format("statestore").option("stateVarName", "spans").load(checkpoint)
    spans = held.select("key.trace_id", "list_element.*")
    last = spans.groupBy("trace_id", "span_id").agg(F.max(F.struct("arrival", "parent_span_id", "payload")).alias("x")).select("trace_id", "span_id", "x.*")
    rooted = last.groupBy("trace_id").agg(F.bool_or(F.coalesce("parent_span_id", F.lit("")) == "").alias("root"))
    return last.join(rooted, "trace_id").select(*SPAN.fieldNames(), F.when(F.col("root"), "complete").otherwise("partial").alias("segment"))
