"""OTLP spans from JSON lines, one export request a line, as files or as a stream.

The nesting of resources, scopes and spans is a fixed schema that Spark parses and explodes. Attribute values may nest
without limit, which no schema can hold: they stay JSON text, and one Arrow function gives their plain text.
"""

from __future__ import annotations

import base64
import json
import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.jsonbytes import json_string
from ..functions.profile import es6

_ATTRIBUTES = "attributes array<struct<key:string,value:string>>"
_SPAN = f"traceId:string,spanId:string,parentSpanId:string,name:string,kind:string,startTimeUnixNano:string,endTimeUnixNano:string,{_ATTRIBUTES.replace(' ', ':', 1)},status:struct<code:string>"
_SCOPE = f"scope:struct<name:string,version:string,{_ATTRIBUTES.replace(' ', ':', 1)}>,schemaUrl:string,spans:array<struct<{_SPAN}>>"
REQUEST = f"resourceSpans array<struct<resource:struct<{_ATTRIBUTES.replace(' ', ':', 1)}>,schemaUrl:string,scopeSpans:array<struct<{_SCOPE}>>>>"
# Names that the JSON form may give for the numbers of kinds and status codes.
KIND_NAMES = ("SPAN_KIND_UNSPECIFIED", "SPAN_KIND_INTERNAL", "SPAN_KIND_SERVER", "SPAN_KIND_CLIENT", "SPAN_KIND_PRODUCER", "SPAN_KIND_CONSUMER")
STATUS_NAMES = ("STATUS_CODE_UNSET", "STATUS_CODE_OK", "STATUS_CODE_ERROR")


def double_text(x: float) -> str:
    """Text of a double: as a JSON number, whole ones without a point; what JSON can't hold says so."""
    if math.isnan(x) or math.isinf(x):
        return "json: unsupported value: " + ("NaN" if math.isnan(x) else "+Inf" if x > 0 else "-Inf")
    return "-0" if x == 0 and math.copysign(1, x) < 0 else es6(x)


def _plain(value):
    """A typed value as plain JSON data; doubles as tokens that are written as they are."""
    if not isinstance(value, dict) or not value:
        return None
    tag, x = next(iter(value.items()))
    if tag == "intValue":
        return int(x)
    if tag == "doubleValue":
        return _Token(double_text(float(x)))
    if tag == "arrayValue":
        return [_plain(v) for v in (x or {}).get("values", [])]
    if tag == "kvlistValue":
        return {e.get("key", ""): _plain(e.get("value")) for e in (x or {}).get("values", [])}
    return x


class _Token(float):
    """A double that is written by its text."""

    def __new__(cls, text: str):
        new = super().__new__(cls, 0)
        new.text = text
        return new


def _written(value) -> str:
    if isinstance(value, _Token):
        return value.text
    if isinstance(value, dict):
        return "{" + ",".join(f"{_written(k)}:{_written(value[k])}" for k in sorted(value, key=str.encode)) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_written, value)) + "]"
    out = json.dumps(value, ensure_ascii=False)
    for c in "<>&\u2028\u2029":
        out = out.replace(c, f"\\u{ord(c):04x}")
    return out


def value_text(raw: str | None) -> str:
    """Text of a typed value given as JSON: strings as they are, bytes in base64, lists and maps as JSON."""
    value = json.loads(raw) if raw else None
    plain = _plain(value)
    if plain is None:
        return ""
    if isinstance(plain, str):
        if "bytesValue" in value:
            return base64.b64encode(base64.b64decode(plain)).decode()
        return plain
    return _written(plain)


@F.pandas_udf(T.ArrayType(T.StringType()))
def value_texts(values: pd.Series) -> pd.Series:
    """``value_text`` of every value of an array."""
    return values.map(lambda xs: None if xs is None else [value_text(x) for x in xs])


def _number(token: Column, names: tuple[str, ...]) -> Column:
    """An enumeration's number from its JSON form, a number or a name; 0 where it is missing."""
    named = F.array_position(F.lit(list(names)), token) - 1
    return F.coalesce(F.when(token.rlike("^[0-9]+$"), token.cast("int")).when(named >= 0, named.cast("int")), F.lit(0))


def spans(requests: DataFrame, column: str = "value") -> DataFrame:
    """Spans of a table or stream of export requests in JSON, one row each, with their resource and scope.

    A request that isn't JSON, or without spans, gives no row. Attributes are (key, value) with the value's text, in
    their order, repeats included. Works on streams, as it has no state.
    """
    request = F.from_json(F.col(column), REQUEST)
    one = requests.select(F.explode(request["resourceSpans"]).alias("r")).select("r", F.explode("r.scopeSpans").alias("s")).select("r", "s", F.explode("s.spans").alias("x"))
    none = F.array().cast("array<struct<key:string,value:string>>")
    raw = one.select(
        F.coalesce("x.traceId", F.lit("")).alias("trace_id"),
        F.coalesce("x.spanId", F.lit("")).alias("span_id"),
        F.coalesce("x.parentSpanId", F.lit("")).alias("parent_span_id"),
        F.coalesce("x.name", F.lit("")).alias("name"),
        _number(F.col("x.kind"), KIND_NAMES).alias("kind"),
        F.coalesce(F.col("x.startTimeUnixNano").cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)")).alias("start_time_unix_nano"),
        F.coalesce(F.col("x.endTimeUnixNano").cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)")).alias("end_time_unix_nano"),
        _number(F.col("x.status.code"), STATUS_NAMES).alias("status_code"),
        *[F.coalesce(c, none).alias(n) for n, c in (("_a", F.col("x.attributes")), ("_r", F.col("r.resource.attributes")), ("_s", F.col("s.scope.attributes")))],
        F.coalesce("s.scope.name", F.lit("")).alias("scope_name"),
        F.coalesce("s.scope.version", F.lit("")).alias("scope_version"),
        F.coalesce("r.schemaUrl", F.lit("")).alias("resource_schema"),
        F.coalesce("s.schemaUrl", F.lit("")).alias("scope_schema"),
    )
    texts = raw.withColumn("_t", value_texts(F.transform(F.concat("_a", "_r", "_s"), lambda a: a["value"])))
    n, m = F.size("_a"), F.size("_r")
    put = lambda pairs, first: F.transform(pairs, lambda a, k: F.struct(a["key"].alias("key"), F.get(F.col("_t"), k + first).alias("value")))
    named = {"attributes": put(F.col("_a"), F.lit(0)), "resource_attributes": put(F.col("_r"), n), "scope_attributes": put(F.col("_s"), n + m)}
    return texts.withColumns(named).drop("_a", "_r", "_s", "_t")


def attributes_key(attributes: Column) -> Column:
    """One text for equal sets of attributes, whatever their order: quoted pairs, sorted, none of which can run over
    into the next."""
    pair = F.transform(attributes, lambda a: F.concat(json_string(a["key"]), F.lit("="), json_string(a["value"])))
    return F.array_join(F.array_sort(pair), "\x01")


SCOPE_KEY = ("trace_id", "segment", "resource_schema", "resource_key", "scope_schema", "scope_name", "scope_version", "scope_key")


def regrouped(assembled: DataFrame, *span_columns: str) -> DataFrame:
    """Assembled spans as they are emitted: one row for each resource and scope of a trace's segment, with its spans in
    the order of their ids. ``span_columns`` are what a span keeps."""
    keyed = assembled.withColumns({"resource_key": attributes_key(F.col("resource_attributes")), "scope_key": attributes_key(F.col("scope_attributes"))})
    spans_of = F.array_sort(F.collect_list(F.struct("span_id", *[c for c in span_columns if c != "span_id"])))
    return keyed.groupBy(*SCOPE_KEY).agg(
        F.any_value("resource_attributes").alias("resource_attributes"),
        F.any_value("scope_attributes").alias("scope_attributes"),
        spans_of.alias("spans"),
    )
