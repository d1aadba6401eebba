"""Emission of assembled traces for what comes after: one row for each resource and scope of a trace's segment, with its
spans nested in it. Each batch of the stream is a folder of Parquet files, which a repetition of the batch replaces."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.stage import kept, work
from ..sources import jsonl, otlp
from . import assemble

#: What the columns of a span are nested under, and therefore isn't in the nested spans.
OUTSIDE = {*otlp.SCOPE_KEY, "resource_attributes", "scope_attributes", "arrival"}


def scopes(assembled: DataFrame, spans: T.StructType) -> DataFrame:
    """Assembled spans (the columns of ASSEMBLED) by resource and scope; ``spans`` is the schema that ``otlp.spans`` gives,
    with any columns besides. Late spans make rows of their own segment."""
    return otlp.regrouped(assemble.restored(assembled, spans), *[c for c in spans.names if c not in OUTSIDE])


def start(spans: DataFrame, path: str, checkpoint: str, timeout_ms: int = 30_000, arrival: str | None = None, **trigger) -> StreamingQuery:
    """Assemble a stream of spans (``otlp.spans``) and write the rows of ``scopes`` to ``path``, a folder for each batch
    that emits something. A trace of a segment is emitted in one batch, so no row is ever completed by a later one."""

    def emit(batch: DataFrame, batch_id: int) -> None:
        with work(batch.sparkSession):
            seen = Observation()
            rows = kept(batch.observe(seen, F.count(F.lit(1)).alias("spans")))
            if seen.get["spans"]:
                scopes(rows, spans.schema).write.mode("overwrite").parquet(jsonl.batch_path(path, batch_id))

    assembled = assemble.assemble(assemble.carried(spans, arrival), timeout_ms)
    writer = assembled.writeStream.foreachBatch(emit).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(**trigger) if trigger else writer).start()
