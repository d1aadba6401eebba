"""Tables in the middle of a job: written once to the shared checkpoint folder, so that what reads them doesn't work
them out again and a lost executor costs no more than a task."""

from __future__ import annotations

import contextlib
import contextvars
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows that one task sorts, of a kilobyte or so each.
ROWS = 50_000
#: The folder of the work that is under way, for tables that go when it ends.
_work: contextvars.ContextVar[str | None] = contextvars.ContextVar("work", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder: ``spark.checkpoint.dir``. A session in one process that sets none gets a temporary folder,
    which on a cluster would be the driver's alone."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        found = spark.conf.get("spark.checkpoint.dir", None)
        if not found and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(found or tempfile.mkdtemp(prefix="ledgerframe-"))
    return context.getCheckpointDir()


def folder(spark: SparkSession, path: str):
    """A path and its file system, for listing and deleting."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none where there is no folder."""
    target, fs = folder(spark, path)
    return sorted(str(x.getPath().getName()) for x in fs.listStatus(target)) if fs.exists(target) else []


def delete(spark: SparkSession, path: str) -> None:
    target, fs = folder(spark, path)
    fs.delete(target, True)


@contextlib.contextmanager
def work(spark: SparkSession) -> Iterator[None]:
    """Tables that are kept inside go when the block ends; nothing may read them then."""
    path = f"{shared_dir(spark).rstrip('/')}/work-{uuid.uuid4().hex}"
    token = _work.set(path)
    try:
        yield
    finally:
        _work.reset(token)
        delete(spark, path)


def kept(df: DataFrame) -> DataFrame:
    """``df``, written as a table in ``spark.checkpoint.dir``, which inside ``work`` goes with it. What reads it reads the
    columns it needs, which a checkpoint of serialized rows doesn't allow."""
    spark = df.sparkSession
    path = f"{_work.get() or shared_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt_over(df: DataFrame) -> int:
    """Over how many tasks to deal ``df``. The number grows with the rows and is given to Spark, which would merge
    parts by their compressed size, a fraction of what sorting them takes, down to one for each core."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS))


def numbered(df: DataFrame, *order: str, name: str = "seal_no", before: tuple[str, ...] = (), ties: tuple[str, ...] = (), made: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``df`` with the place of each row in the given order, from 0, and the columns ``before`` of the row before it in
    the struct ``_before`` (null for the first row).

    Rows are dealt by ranges of the order, sorted and numbered within, where ``ties`` order what is equal; only one row of
    each range, its count and its last row, meets the others in a window. Ranges are found by a look at ``df``, which is
    worked out twice: what takes long is better kept before, or left to ``made``, which gets the rows when they are dealt.
    """
    many = dealt_over(df)
    whole = (*order, *ties)
    # an increasing id has the place within the part in its lower 33 bits
    own = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranges = df.repartitionByRange(many, *order)
    dealt = kept((made(ranges) if made else ranges).sortWithinPartitions(*whole).withColumns({"_part": F.spark_partition_id(), "_own": own}))
    counts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    if before:
        ends = F.broadcast(counts.select("_part", (F.col("_n") - 1).alias("_own")))
        last = dealt.join(ends, ["_part", "_own"]).select("_part", F.struct(*before).alias("_last"))
        counts = counts.join(last, "_part")
    parts = Window.orderBy("_part")
    edges = [(F.sum("_n").over(parts) - F.col("_n")).alias("_start"), *[F.lag("_last").over(parts).alias("_edge")] * bool(before)]
    rows = dealt
    if before:
        within = Window.partitionBy("_part").orderBy("_own")
        rows = rows.repartition(many, "_part").withColumn("_before", F.lag(F.struct(*before)).over(within))
    # one row a range
    rows = rows.join(F.broadcast(counts.select(F.col("_part").alias("_p"), *edges)), F.col("_part") == F.col("_p"))
    if before:
        rows = rows.withColumn("_before", F.coalesce("_before", "_edge"))
    return rows.withColumn(name, (F.col("_own") + F.col("_start")).cast("long")).drop("_part", "_p", "_own", "_start", "_edge")
