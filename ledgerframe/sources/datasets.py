"""The provided tables as spans: a user's events, an order with its lines, a conversation with its turns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.stage import dealt_over


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hex_id(number: Column, width: int) -> Column:
    return F.lower(F.lpad(F.hex(number), width, "0"))


def _attributes(*pairs: tuple[str, Column]) -> Column:
    """Array of (key, value); pairs without a value are left out."""
    return F.filter(F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in pairs]), lambda a: a["value"].isNotNull())


def _nanos(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp")) * 1000


def event_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trace: a user; span: an event; the first event of a user is the root."""
    e = table(spark, sf_dir, "events")
    e = e.repartition(dealt_over(e), "user_id")
    first = F.first("event_id").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    kind = F.col("event_type")
    operation = F.when(kind == "click", "execute_tool").when(kind == "purchase", "tool_call").when(kind == "signup", "handoff").when(kind == "view", "chat")
    return e.select(
        hex_id(F.col("user_id"), 32).alias("trace_id"),
        hex_id(F.col("event_id"), 16).alias("span_id"),
        F.when(F.col("event_id") == first, F.lit("")).otherwise(hex_id(first, 16)).alias("parent_span_id"),
        kind.alias("name"),
        (F.col("event_id") % 7).cast("int").alias("kind"),
        _nanos("ts").alias("start_time_unix_nano"),
        (_nanos("ts") + 1000 * (F.col("event_id") % 500)).alias("end_time_unix_nano"),
        F.when(kind == "error", 2).when(kind == "purchase", 1).otherwise(0).alias("status_code"),
        _attributes(
            ("zz.other", F.lit("dropped")),
            ("gen_ai.system", F.lit("<own>")),
            ("gen_ai.operation.name", operation),
            ("gen_ai.guardrail.name", F.when(F.col("event_id") % 11 == 0, F.concat(F.lit("guard-"), (F.col("event_id") % 3).cast("string")))),
            ("gen_ai.operation.name", F.lit("second")),
        ).alias("attributes"),
        "event_id",
    )


def order_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trace: an order; spans: the order (root) and its lines, of which some repeat; with all columns of a line, whose
    order stands for their arrival."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    trace = lambda c: hex_id(F.col(c), 32).alias("trace_id")
    root = o.select(
        trace("o_orderkey"),
        F.lit("0" * 15 + "f").alias("span_id"),
        F.lit("").alias("parent_span_id"),
        F.concat(F.lit("order "), F.col("o_orderstatus")).alias("name"),
        F.lit(2).alias("kind"),
        _nanos("o_orderdate").alias("start_time_unix_nano"),
        _nanos("o_orderdate").alias("end_time_unix_nano"),
        F.lit(1).alias("status_code"),
        F.lit("").alias("arrival"),
    )
    arrival = F.concat_ws(
        "|",
        *[F.col(c).cast("string") for c in ("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")],
        F.round(F.col("l_quantity") * 100).cast("long").cast("string"),
        F.round(F.col("l_extendedprice") * 100).cast("long").cast("string"),
        F.round(F.col("l_discount") * 100).cast("long").cast("string"),
        F.round(F.col("l_tax") * 100).cast("long").cast("string"),
        _nanos("l_shipdate").cast("string"),
    )
    lines = li.select(
        trace("l_orderkey"),
        hex_id(F.col("l_linenumber"), 16).alias("span_id"),
        F.lit("0" * 15 + "f").alias("parent_span_id"),
        F.concat(F.lit("line "), F.col("l_returnflag")).alias("name"),
        F.lit(3).alias("kind"),
        _nanos("l_shipdate").alias("start_time_unix_nano"),
        _nanos("l_shipdate").alias("end_time_unix_nano"),
        F.lit(0).alias("status_code"),
        arrival.alias("arrival"),
    )
    return root.unionByName(lines).withColumn("attributes", F.array().cast("array<struct<key:string,value:string>>"))


def conversation_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trace: a conversation; span: a turn, the first the root; names are the turns' texts."""
    c = table(spark, sf_dir, "conversations")
    return c.select(
        hex_id(F.col("conv_id"), 32).alias("trace_id"),
        hex_id(F.col("turn"), 16).alias("span_id"),
        F.when(F.col("turn") == 0, F.lit("")).otherwise(F.lit("0" * 16)).alias("parent_span_id"),
        F.coalesce("text", F.lit("")).alias("name"),
        F.lit(1).alias("kind"),
        (F.col("turn") * 1000).alias("start_time_unix_nano"),
        (F.col("turn") * 1000 + 500).alias("end_time_unix_nano"),
        F.lit(0).alias("status_code"),
        _attributes(("gen_ai.operation.name", F.when(F.col("role") == "user", "transfer"))).alias("attributes"),
    )


def wal_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as write-ahead-log lines: every event whose number ends in 97 seals its user's trace, and versions vary."""
    e = table(spark, sf_dir, "events")
    seal = F.col("event_id") % 100 == 97
    version = F.when(F.col("user_id") % 10 < 5, F.lit("v3")).when(
        F.col("user_id") % 10 < 7,
        F.when(F.col("event_id") % 2 == 0, "v2").otherwise("v3"),
    ).when(F.col("user_id") % 10 < 8, F.lit("v1")).when(F.col("user_id") % 10 < 9, F.when(F.col("event_id") % 3 == 0, "v1").otherwise("v3")).otherwise(F.lit("v99"))
    return e.select(
        F.col("event_id").alias("line_no"),
        F.when(seal, "sealed").otherwise("span").alias("type"),
        hex_id(F.col("user_id"), 32).alias("trace_id"),
        F.when(~seal, hex_id(F.col("event_id") % 13, 16)).alias("span_id"),
        F.when(~seal, F.when(F.col("event_id") % 13 == 0, F.lit("")).otherwise(F.lit("0" * 16))).alias("parent_span_id"),
        F.when(~seal, version).alias("schema_version"),
        F.when(seal, F.when(F.col("event_id") % 3 == 0, F.lit("")).otherwise(F.sha2(F.encode(F.col("event_id").cast("string"), "UTF-8"), 256))).alias("tip_hash"),
        F.when(seal, F.col("event_id") % 5).alias("entry_count"),
    )
