"""Canonical JSON bytes of records, log entries and checkpoints, as Spark columns.

``to_json`` can't be used: it drops nulls and escapes differently. Objects are written field by field, in fixed order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that a JSON string escapes and what is written for them, in the order of replacement.
ESCAPES = [
    ("\\", "\\\\"),
    ('"', '\\"'),
    ("\b", "\\b"),
    ("\f", "\\f"),
    ("\n", "\\n"),
    ("\r", "\\r"),
    ("\t", "\\t"),
    *[(chr(k), f"\\u{k:04x}") for k in range(32) if chr(k) not in "\b\f\n\r\t"],
    ("<", "\\u003c"),
    (">", "\\u003e"),
    ("&", "\\u0026"),
    ("\u2028", "\\u2028"),
    ("\u2029", "\\u2029"),
]

# Fields of a record in the order of its bytes.
RECORD_FIELDS = (
    "schema_version",
    "trace_id",
    "span_id",
    "parent_span_id",
    "seq_in_trace",
    "start_time_unix_nano",
    "end_time_unix_nano",
    "span_name",
    "otel_kind",
    "gen_ai_operation",
    "audit_kind",
    "selected_attributes",
    "status",
)
NUMERIC_TIME_VERSIONS = ("v1", "v2")


def json_string(value: Column) -> Column:
    """A quoted JSON string. Texts without any special character, nearly all, skip the replacements, which are a loop
    over a constant array: written out, those of a record's fields are more code than the JVM compiles."""
    pairs = F.array(*[F.struct(F.lit(raw).alias("raw"), F.lit(written).alias("written")) for raw, written in ESCAPES])
    out = F.aggregate(pairs, value, lambda text, e: F.replace(text, e["raw"], e["written"]))
    special = value.rlike(r'[\\"\x00-\x1f<>&\u2028\u2029]')
    return F.concat(F.lit('"'), F.when(special, out).otherwise(value), F.lit('"'))


def json_attributes(value: Column) -> Column:
    """An array of (key, value) objects; null stays ``null`` and an empty array ``[]``."""
    item = lambda x: F.concat(F.lit('{"key":'), json_string(x["key"]), F.lit(',"value":'), json_string(x["value"]), F.lit("}"))
    return F.coalesce(F.concat(F.lit("["), F.array_join(F.transform(value, item), ","), F.lit("]")), F.lit("null"))


def numeric_times(version: Column) -> Column:
    """Whether records of a version write times as numbers."""
    return version.isin(*NUMERIC_TIME_VERSIONS)


def canonical_record(get=F.col) -> Column:
    """Bytes (as text) of a record; ``get(name)`` gives a field. v1 and v2 write times as numbers, later versions as
    strings."""
    number = numeric_times(get("schema_version"))
    parts = []
    for k, name in enumerate(RECORD_FIELDS):
        parts.append(F.lit(("," if k else "{") + f'"{name}":'))
        value = get(name)
        if name == "seq_in_trace":
            parts.append(value.cast("string"))
        elif name == "selected_attributes":
            parts.append(json_attributes(value))
        elif name.endswith("_unix_nano"):
            parts.append(F.when(number, value.cast("string")).otherwise(F.concat(F.lit('"'), value.cast("string"), F.lit('"'))))
        else:
            parts.append(json_string(value))
    return F.concat(*parts, F.lit("}"))


def canonical_entry(get=F.col, record: Column | None = None) -> Column:
    """A log line: the record (its bytes, where they are there) and its signature block (fields key_id, algorithm,
    entry_hash, signature)."""
    signed = F.concat(*[x for k, n in enumerate(("key_id", "algorithm", "entry_hash", "signature")) for x in (F.lit(("," if k else "") + f'"{n}":'), json_string(get(n)))])
    return F.concat(F.lit('{"record":'), canonical_record(get) if record is None else record, F.lit(',"signed":{'), signed, F.lit("}}"))


def checkpoint_payload(get=F.col) -> Column:
    """What a checkpoint signs: all its fields but the signature, tips in stored order."""
    tip = lambda t: F.concat(
        F.lit('{"trace_id":'),
        json_string(t["trace_id"]),
        F.lit(',"tip_hash":'),
        json_string(t["tip_hash"]),
        F.lit(',"entry_count":'),
        t["entry_count"].cast("string"),
        F.lit("}"),
    )
    return F.concat(
        F.lit('{"schema_version":'), json_string(get("schema_version")),
        F.lit(',"checkpoint_seq":'), get("checkpoint_seq").cast("string"),
        F.lit(',"timestamp":'), json_string(get("timestamp")),
        F.lit(',"prev_checkpoint_hash":'), json_string(get("prev_checkpoint_hash")),
        F.lit(',"trace_tips":['), F.array_join(F.transform(get("trace_tips"), tip), ","),
        F.lit('],"key_id":'), json_string(get("key_id")),
        F.lit(',"algorithm":'), json_string(get("algorithm")), F.lit("}"),
    )


def canonical_checkpoint(get=F.col) -> Column:
    """A checkpoint line: the payload with the signature."""
    payload = checkpoint_payload(get)
    return F.concat(F.substring(payload, F.lit(1), F.length(payload) - 1), F.lit(',"signature":'), json_string(get("signature")), F.lit("}"))


def sha256_hex(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def genesis_seed(trace_id: Column, version: Column) -> Column:
    """Hex seed of a chain, null where no chain can start: an empty version, or an id that isn't hex of even
    length (``unhex`` alone would pad odd ones)."""
    ok = trace_id.rlike("^([0-9a-fA-F]{2})*$") & (version != "")
    return F.when(ok, F.sha2(F.concat(F.unhex(trace_id), F.encode(version, "UTF-8")), 256))
