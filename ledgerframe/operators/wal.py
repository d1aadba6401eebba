"""Write-ahead-log lines: replay, compaction and what becomes of unfinished traces, as windows and joins.

Lines have line_no, type ('span' or 'sealed'), trace_id, the fields of the record (spans), tip_hash and entry_count
(seals).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .chain import still_pending
from .records import disposition, traces


def live_spans(lines: DataFrame) -> DataFrame:
    """Span lines after the last seal of their trace: what replay buffers again."""
    last = F.max(F.when(F.col("type") == "sealed", F.col("line_no"))).over(Window.partitionBy("trace_id"))
    return lines.withColumn("_last", last).where((F.col("type") == "span") & (F.col("line_no") > F.coalesce("_last", F.lit(-1)))).drop("_last")


def restored_tips(lines: DataFrame) -> DataFrame:
    """(line_no, trace_id, tip_hash, entry_count) of seals with a tip, in line order."""
    return lines.where("type = 'sealed' and tip_hash <> ''").select("line_no", "trace_id", "tip_hash", "entry_count")


def deduplicated(lines: DataFrame) -> DataFrame:
    """Live spans, the last line of each span id."""
    w = Window.partitionBy("trace_id", "span_id").orderBy(F.col("line_no").desc())
    return live_spans(lines).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def replay(lines: DataFrame) -> DataFrame:
    """(trace_id, n_spans, has_root, versions, action) of every trace that replay finds unfinished."""
    return traces(deduplicated(lines)).withColumn("action", disposition(F.col("versions")))


def restamped(lines: DataFrame, version: str = "v3") -> DataFrame:
    """Live spans of traces that replay keeps open, in the current version."""
    keep = replay(lines).where("action = 'restamp'").select("trace_id")
    return deduplicated(lines).join(keep, "trace_id", "left_semi").withColumn("schema_version", F.lit(version))


def compact(lines: DataFrame, pending: DataFrame) -> DataFrame:
    """Lines that a rewritten log keeps, in order (phase, line_no): first the seals whose tip still waits for a
    checkpoint, then the live spans."""
    seals = still_pending(lines.where("type = 'sealed'"), pending).select(*lines.columns)
    return seals.withColumn("phase", F.lit(0)).unionByName(live_spans(lines).withColumn("phase", F.lit(1)))
