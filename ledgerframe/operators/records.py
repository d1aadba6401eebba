"""Spans to audit records: projection with an allowlist, classification, deduplication and order within the trace."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stage import dealt_over

# Attributes that a record keeps, in the order of their output.
ALLOWED = (
    "gen_ai.guardrail.action",
    "gen_ai.guardrail.name",
    "gen_ai.guardrail.reason",
    "gen_ai.guardrail.severity",
    "gen_ai.operation.name",
    "gen_ai.request.model",
    "gen_ai.response.model",
    "gen_ai.system",
    "gen_ai.usage.input_tokens",
    "gen_ai.usage.output_tokens",
)
# Names of span kinds and status codes by number.
KINDS = ("Unspecified", "Internal", "Server", "Client", "Producer", "Consumer")
STATUSES = ("Unset", "Ok", "Error")
CURRENT_VERSION = "v3"
VERSIONS = ("v1", "v2", "v3")
RESTAMPABLE = ("v2", "v3")


def attribute(attributes: Column, key: str) -> Column:
    """Value of the first entry with the key, or null."""
    return F.get(F.filter(attributes, lambda a: a["key"] == key), F.lit(0))["value"]


def selected_attributes(attributes: Column) -> Column:
    """Allowed entries in the order of the list, the first of each key; null when there is none."""
    first = lambda k: F.get(F.filter(attributes, lambda a: a["key"] == k), F.lit(0))
    found = F.filter(F.transform(F.lit(list(ALLOWED)), first), lambda a: a.isNotNull())
    return F.when(F.size(found) > 0, found)


def name_of(code: Column, names: tuple[str, ...]) -> Column:
    return F.coalesce(F.when(code >= 0, F.get(F.lit(list(names)), code)), F.lit(""))


def audit_kind(attributes: Column, status_code: Column) -> Column:
    """First that holds: a guardrail name is present (even empty), a tool or handoff operation, an error status."""
    op = attribute(attributes, "gen_ai.operation.name")
    return (
        F.when(F.exists(attributes, lambda a: a["key"] == "gen_ai.guardrail.name"), "guardrail")
        .when(op.isin("execute_tool", "tool_call"), "tool")
        .when(op.isin("handoff", "transfer"), "handoff")
        .when(status_code == 2, "error")
        .otherwise("task")
    )


def to_records(spans: DataFrame, version: str = CURRENT_VERSION) -> DataFrame:
    """Records without a sequence number yet; other columns of ``spans`` that records lack are kept after them."""
    kept = [
        c for c in spans.columns if c not in {"name", "kind", "status_code", "attributes"} and c not in {
            "trace_id",
            "span_id",
            "parent_span_id",
            "start_time_unix_nano",
            "end_time_unix_nano",
        }
    ]
    a = F.coalesce(F.col("attributes"), F.array().cast(spans.schema["attributes"].dataType))
    return spans.where("trace_id <> ''").select(
        F.lit(version).alias("schema_version"),
        "trace_id",
        "span_id",
        F.coalesce("parent_span_id", F.lit("")).alias("parent_span_id"),
        F.col("start_time_unix_nano").cast("decimal(20,0)").alias("start_time_unix_nano"),
        F.col("end_time_unix_nano").cast("decimal(20,0)").alias("end_time_unix_nano"),
        F.col("name").alias("span_name"),
        name_of(F.col("kind"), KINDS).alias("otel_kind"),
        F.coalesce(attribute(a, "gen_ai.operation.name"), F.lit("")).alias("gen_ai_operation"),
        audit_kind(a, F.col("status_code")).alias("audit_kind"),
        selected_attributes(a).alias("selected_attributes"),
        name_of(F.col("status_code"), STATUSES).alias("status"),
        *kept,
    )


def last_wins(records: DataFrame, *arrival: Column) -> DataFrame:
    """One record for each (trace_id, span_id): the last in the order of ``arrival``, which must be total."""
    w = Window.partitionBy("trace_id", "span_id").orderBy(*[c.desc() for c in arrival])
    return records.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def with_sequence(records: DataFrame) -> DataFrame:
    """``seq_in_trace`` from 0 by (start time, span id)."""
    w = Window.partitionBy("trace_id").orderBy("start_time_unix_nano", "span_id")
    return records.repartition(dealt_over(records), "trace_id").withColumn("seq_in_trace", F.row_number().over(w) - 1)


def traces(records: DataFrame) -> DataFrame:
    """(trace_id, n_spans, has_root, versions) of each trace."""
    return records.groupBy("trace_id").agg(
        F.count(F.lit(1)).alias("n_spans"),
        F.bool_or(F.col("parent_span_id") == "").alias("has_root"),
        F.array_sort(F.collect_set("schema_version")).alias("versions"),
    )


def open_traces(records: DataFrame, sealed: DataFrame) -> DataFrame:
    """Records of traces that aren't sealed yet."""
    return records.join(sealed.select("trace_id"), "trace_id", "left_anti")


def late_spans(records: DataFrame, emitted: DataFrame) -> DataFrame:
    """Records of traces that were emitted before."""
    return records.join(emitted.select("trace_id"), "trace_id", "left_semi")


def disposition(versions: Column) -> Column:
    """What replay does with a trace of these schema versions: restamp, seal at its own version, or quarantine."""
    within = lambda names: F.size(F.array_except(versions, F.lit(list(names)))) == 0
    return F.when(within(RESTAMPABLE), "restamp").when((F.size(versions) == 1) & within(VERSIONS), "seal").otherwise("quarantine")


def quarantined(records: DataFrame, reason: str, at: str) -> DataFrame:
    """Dead-letter rows of the traces that replay sets aside, with their versions."""
    bad = traces(records).where(disposition(F.col("versions")) == "quarantine").select("trace_id", "versions")
    return records.join(bad, "trace_id").withColumns({"reason": F.lit(reason), "quarantined_at": F.lit(at)})
