"""Mixing sources to target weights by Pareto order sampling.

A source's target is met by expected copies of each document, in proportion to its importance. The whole part of the
expectation is allocated for certain; the rest is an inclusion probability p. Documents are ranked by their random odds
u / (1 - u) over the odds p / (1 - p), and the lowest ranks are taken until the words that are left for the sample are
used up: a sample of fixed size with unequal probabilities. Random numbers are digests of keys, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .native import words
from .store import Scratch

#: No document is taken more often than this.
MOST = 3
WEIGHTS = (5, 2, 1)
#: Bits of a rank decided by each of three rounds of counting.
_STEP = 10


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in code-point order, null last, weigh WEIGHTS in turn and share all words; no target passes MOST times its
    source, and what a source can't take is shared by weight among the others. With sources in order of the size per
    weight at which they are full, those that are full come first, and the share of one unit of weight is what they
    leave over the weight of the rest: the first position at which the next source isn't full gives it.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    rows = sizes.withColumn("weight", F.get(F.lit(list(map(float, WEIGHTS))), F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHTS)))))
    full = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(
        "*",
        (
            (
                F.sum("source_size").over(every) - MOST * F.coalesce(F.sum("source_size").over(before), F.lit(0))
            ) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        ).alias("unit"),
    )
    fits = F.col("unit") * F.col("weight") <= MOST * F.col("source_size")
    ranked = rows.withColumn("unit", F.when(fits, F.col("unit"))).withColumn("at", F.row_number().over(full))
    ranked = ranked.withColumn("unit", F.min(F.when(F.col("unit").isNotNull(), F.struct("at", "unit"))).over(every)["unit"])
    return ranked.select(
        "source",
        "source_size",
        F.least(MOST * F.col("source_size").cast("double"), F.coalesce(F.col("unit") * F.col("weight"), F.lit(float("inf")))).alias("target"),
    )


def _copies(levels: DataFrame) -> DataFrame:
    """(source, importance, expected): copies of a document, min(MOST, c * importance), whose words make the target."""
    down = Window.partitionBy("source").orderBy(F.col("importance").desc())
    before = down.rowsBetween(Window.unboundedPreceding, -1)
    after = down.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rest = F.col("target") - MOST * F.coalesce(F.sum("level_size").over(before), F.lit(0))
    c = F.try_divide(rest, F.sum(F.col("level_size") * F.col("importance")).over(after))
    rows = levels.withColumn("c", c).withColumn("at", F.row_number().over(down))
    fits = F.when(F.col("c") * F.col("importance") <= MOST, F.struct("at", "c"))
    rows = rows.withColumn("c", F.min(fits).over(Window.partitionBy("source"))["c"])
    return rows.select(
        "source",
        "importance",
        F.greatest(F.lit(0.0), F.least(F.lit(float(MOST)), F.coalesce(F.col("c") * F.col("importance"), F.lit(float(MOST))))).alias("expected"),
    )


def _uniform(*keys: Column) -> Column:
    """A number in (0, 1) from a digest of the keys."""
    x = F.conv(F.substring(F.md5(F.concat_ws(":", *[k.cast("string") for k in keys])), 1, 13), 16, 10).cast("long")
    return (x + 0.5) / float(1 << 52)


def default_importance(size: Column) -> Column:
    """1 to 4 by the length of a document: longer documents are somewhat more likely to be taken or repeated."""
    return F.when(size < 50, 1).when(size < 200, 2).when(size < 800, 3).otherwise(4)


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", importance: Column | None = None) -> DataFrame:
    """One row (key, source, size, print, source_size, target, copies, taken) for each row of ``docs``.

    ``size`` is the number of words (0 for null), ``print`` the text's digest, ``copies`` how often the mix takes the document and ``taken`` their
    product. ``importance`` is a small positive integer computed from ``size``. Random numbers come from key and text:
    rows that repeat a key with other texts, or have none, are sampled on their own; rows that repeat both share one
    rank. So ``copies`` depends on key, text and source alone. A null source is a source of its own; empty documents
    are never taken. An empty table gives an empty result. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    size = F.size(words(F.col(text))).cast("long")
    rows = docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), size.alias("size"), F.md5(text).alias("print"))
    rows = scratch.keep(rows.withColumn("importance", default_importance(F.col("size")) if importance is None else importance), "sizes")
    levels = rows.groupBy("source", "importance").agg(F.sum("size").alias("level_size"))
    goal = scratch.keep(targets(levels.groupBy("source").agg(F.sum("level_size").alias("source_size"))), "targets")
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    wanted = levels.join(goal, same(levels, goal)).select(levels["source"], "importance", "level_size", "target")
    plan = _copies(wanted)
    plan = plan.join(goal, same(plan, goal)).select(plan["source"], "importance", "expected", "source_size", "target")
    plan = scratch.keep(plan, "plan")
    small = plan.withColumnsRenamed({"source": "_s", "importance": "_i"})
    odds = rows.join(small, rows["source"].eqNullSafe(small["_s"]) & (rows["importance"] == small["_i"])).drop("_s", "_i")
    u = _uniform(F.col("doc_id"), F.col("print"))
    odds = odds.withColumn("whole", F.floor("expected")).withColumn("p", F.col("expected") - F.col("whole"))
    rank = (u / (1 - u)) / (F.col("p") / (1 - F.col("p")))
    # the rank as a number of 3 * _STEP bits: its share in the whole line of odds
    bits = F.floor(rank / (1 + rank) * float(1 << 3 * _STEP)).cast("long")
    odds = odds.withColumn("rank", F.when((F.col("p") > 0) & (F.col("size") > 0), F.least(bits, F.lit((1 << 3 * _STEP) - 1))))
    odds = scratch.keep(odds, "ranks")
    # words left for the sample: cut the line of ranks where they are used up, ten bits at a time
    left = odds.groupBy("source").agg(F.first("target").alias("target"), F.sum(F.col("whole") * F.col("size")).alias("sure")).select(
        "source",
        (F.col("target") - F.col("sure")).alias("room"),
        F.lit(0).cast("long").alias("cut"),
    )
    left = scratch.keep(left, "room-0")
    for step in range(3):
        shift = (2 - step) * _STEP
        here = left.withColumnRenamed("source", "_s")
        inside = odds.where("rank is not null").select("source", "size", "rank").join(here, F.col("source").eqNullSafe(F.col("_s")))
        inside = inside.where(F.call_function("shiftright", "rank", F.lit(shift + _STEP)) == F.call_function("shiftright", "cut", F.lit(shift + _STEP)))
        bins = inside.groupBy("source", "room", "cut", F.call_function("shiftright", "rank", F.lit(shift)).alias("bin")).agg(F.sum("size").alias("words"))
        up = Window.partitionBy("source").orderBy("bin")
        bins = bins.withColumn("upto", F.sum("words").over(up)).withColumn("before", F.col("upto") - F.col("words"))
        # the first bin that doesn't fit; the last round takes it if that comes closer
        over = bins.where("upto > room").groupBy("source").agg(F.min(F.struct("bin", "before", "words", "room")).alias("x")).select(F.col("source").alias("_s"), "x.*")
        joined = left.join(over.drop("room"), F.col("source").eqNullSafe(F.col("_s")), "left")
        if step < 2:
            left = joined.select(
                "source",
                F.when(F.col("bin").isNull(), F.col("room")).otherwise(F.col("room") - F.col("before")).alias("room"),
                F.when(
                    F.col("bin").isNull(),
                    F.lit(1 << 3 * _STEP).cast("long"),
                ).otherwise(F.call_function("shiftleft", F.col("bin"), F.lit(shift))).alias("cut"),
            )
        else:
            rest = F.col("room") - F.col("before")
            closer = F.col("words") - rest < rest
            left = joined.select(
                "source",
                F.lit(0.0).alias("room"),
                F.when(F.col("bin").isNull(), F.col("cut") + (1 << _STEP)).otherwise(F.col("bin") + closer.cast("int")).alias("cut"),
            )
        left = scratch.keep(left, f"room-{step + 1}")
    ends = left.select(F.col("source").alias("_s"), "cut")
    out = odds.join(ends, F.col("source").eqNullSafe(F.col("_s")), "left")
    copies = (F.col("whole") + F.coalesce((F.col("rank") < F.col("cut")).cast("int"), F.lit(0))).cast("long")
    copies = F.when(F.col("size") > 0, copies).otherwise(0)
    return out.select(
        F.col("doc_id").alias(key),
        F.col("source").alias(source),
        "size",
        "print",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )
