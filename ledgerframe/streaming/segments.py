"""The ledger of sealed traces: which segment of its trace every chain of the log is.

A trace that is delivered again after the memory of its emission has ended is sealed as a chain of its own under the same
id. Its segment number, from 0, tells the chains apart. Each batch writes a small sorted table with bloom filters; tables
are merged by eights into larger ones, so that there are few, and each row is rewritten as often as the logarithm of
their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import stage
from ..sources import jsonl

ROW = "trace_id string, segment_no int, tip_hash string, entry_count long"
#: Tables of one level that are merged into one of the next.
FAN = 8


def _write(rows: DataFrame, path: str) -> None:
    sorted_rows = rows.select("trace_id", "segment_no", "tip_hash", "entry_count").repartitionByRange("trace_id").sortWithinPartitions("trace_id")
    sorted_rows.write.mode("overwrite").option("parquet.bloom.filter.enabled#trace_id", "true").parquet(path)


class Ledger:
    """Tables ``level-<level>_<name of the last batch in it>`` in a folder; level 0 is one batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _tables(self) -> list[tuple[int, str, str]]:
        """(level, last batch, name) of all tables, in the order of their batches."""
        names = [n for n in stage.listed(self.spark, self.path) if n.startswith("level-")]
        return sorted(((int(n[6:].split("_", 1)[0]), n.split("_", 1)[1], n) for n in names), key=lambda t: t[1])

    def rows(self, before: str | None = None) -> DataFrame:
        """All rows (ROW), or those of the batches before one of this name. A row that a merge has written while its
        sources were still there counts once."""
        names = [n for _, last, n in self._tables() if before is None or last < before]
        if not names:
            return self.spark.createDataFrame([], ROW)
        return self.spark.read.schema(ROW).parquet(*[f"{self.path}/{n}" for n in names]).distinct()

    def add(self, tips: DataFrame, batch_id: int | str) -> DataFrame:
        """Tips (trace_id, tip_hash, entry_count) with their segment_no, written as the table of a batch. A batch that is
        repeated replaces its table, and gets the same numbers."""
        name = jsonl.batch_name(batch_id)
        seen = self.rows(name).join(tips.select("trace_id"), "trace_id", "left_semi").groupBy("trace_id").agg((F.max("segment_no") + 1).alias("_next"))
        numbered = tips.join(seen, "trace_id", "left").withColumn("segment_no", F.coalesce("_next", F.lit(0)).cast("int")).drop("_next")
        path = f"{self.path}/level-0_{name}"
        _write(numbered, path)
        return self.spark.read.schema(ROW).parquet(path)

    def compact(self, before: str) -> None:
        """Merge tables of batches before the one of this name, which are never repeated, where a level has ``FAN``."""
        level = 0
        while True:
            tables = [t for t in self._tables() if t[1] < before]
            if not any(t[0] >= level for t in tables):
                return
            some = [t for t in tables if t[0] == level]
            if len(some) >= FAN:
                rows = self.spark.read.schema(ROW).parquet(*[f"{self.path}/{t[2]}" for t in some]).distinct()
                _write(rows, f"{self.path}/level-{level + 1}_{some[-1][1]}")
                for _, _, name in some:
                    stage.delete(self.spark, f"{self.path}/{name}")
            level += 1
