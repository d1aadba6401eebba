"""Registered queries of the audit operators over the provided tables; names follow the operator inventory."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ed25519
from ..functions.jsonbytes import canonical_checkpoint, canonical_entry, canonical_record, genesis_seed, json_attributes, json_string, numeric_times, sha256_hex
from ..functions.profile import id_check, unix_nano_column
from ..operators import chain, records, stage, verify, wal
from ..sources import datasets, jsonl, otlp
from ..streaming import assemble, seal

Query = Callable[[SparkSession, str], DataFrame]
_FOUND: dict[str, Query] = {}
_STAMP = "2026-01-01T00:00:00Z"
#: A key for made-up logs, no secret.
_KEY = bytes(range(32))


def query(f: Query) -> Query:
    _FOUND[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    return dict(_FOUND)


def _records(spark: SparkSession, sf: str) -> DataFrame:
    return records.to_records(datasets.event_spans(spark, sf))


def _sequenced(spark: SparkSession, sf: str) -> DataFrame:
    return records.with_sequence(_records(spark, sf))


def _tips(spark: SparkSession, sf: str) -> DataFrame:
    return stage.numbered(stage.kept(chain.chain_tips(_sequenced(spark, sf))), "trace_id")


def _batches(spark: SparkSession, sf: str) -> DataFrame:
    return chain.checkpoint_batches(_tips(spark, sf), 20)


def _checkpoints(spark: SparkSession, sf: str) -> DataFrame:
    return chain.checkpoints(_batches(spark, sf), F.lit(_STAMP), "k")


def _user(trace: str = "trace_id"):
    return F.conv(F.substring(trace, 17, 16), 16, 10).cast("long")


def _tampered(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """A log with edited and repeated entries and missing traces, and checkpoints with some made-up tips and links."""
    sealed = stage.kept(chain.hash_entries(_sequenced(spark, sf)))
    log = sealed.where(_user() % 7 != 3).withColumn("span_name", F.when(F.col("event_id") % 997 == 0, F.lit("edited")).otherwise(F.col("span_name")))
    log = log.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.when(F.col("event_id") % 991 == 0, 2).otherwise(1)))).drop("_copy")
    tips = sealed.groupBy("trace_id").agg(F.count(F.lit(1)).alias("entry_count"), F.max_by("entry_hash", "seq_in_trace").alias("tip_hash"))
    b = chain.checkpoint_batches(stage.numbered(stage.kept(tips), "trace_id"), 20).withColumn("tip_hash", F.when(F.col("seal_no") % 13 == 5, F.lit("a" * 64)).otherwise(F.col("tip_hash")))
    cps = chain.checkpoints(b, F.lit(_STAMP), "k").withColumn("line_no", F.col("checkpoint_seq")).withColumn("signature", F.lit(""))
    return log, stage.kept(_unlinked(cps))


def _unlinked(cps: DataFrame) -> DataFrame:
    """Checkpoints of which every third links to nothing."""
    return cps.withColumn("prev_checkpoint_hash", F.when(F.col("checkpoint_seq") % 3 == 2, F.lit("b" * 64)).otherwise(F.col("prev_checkpoint_hash")))


def _contradicted(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    log, cps = _tampered(spark, sf)
    return verify.cross_checks(stage.kept(verify.chain_states(log, None)), cps).where(F.col("kind") == kind)


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the session's checkpoints."""
    stage.kept(spark.range(0))
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


@query
def ag10_chain_tips(spark, sf):
    return chain.chain_tips(_sequenced(spark, sf))


@query
def ag9_chain_hashes(spark, sf):
    return chain.hash_entries(_sequenced(spark, sf)).select("trace_id", F.col("seq_in_trace").cast("long").alias("seq"), "entry_hash", "prev_hash")


@query
def prj1_span_to_record(spark, sf):
    return _records(spark, sf).select(
        "schema_version",
        "trace_id",
        "span_id",
        "parent_span_id",
        F.col("start_time_unix_nano").cast("string").alias("start_ns"),
        F.col("end_time_unix_nano").cast("string").alias("end_ns"),
        "span_name",
        "otel_kind",
        "gen_ai_operation",
        "audit_kind",
        "status",
    )


@query
def prj2_selected_attributes(spark, sf):
    return _records(spark, sf).select("span_id", json_attributes(F.col("selected_attributes")).alias("attributes_json"))


@query
def prj4_operation_counts(spark, sf):
    return _records(spark, sf).groupBy("gen_ai_operation").agg(F.count("*").alias("n"))


@query
def prj5_audit_kind_counts(spark, sf):
    return _records(spark, sf).groupBy("audit_kind", "status").agg(F.count("*").alias("n"))


@query
def prj6_kind_names(spark, sf):
    return _records(spark, sf).groupBy("otel_kind").agg(F.count("*").alias("n"))


@query
def prj9_key_fingerprint(spark, sf):
    users = datasets.table(spark, sf, "events").select("user_id").distinct()
    public = F.unhex(sha256_hex(F.concat(F.lit("key"), F.col("user_id").cast("string"))))
    return users.select("user_id", ed25519.key_ids(public).alias("key_id"))


@query
def flt1_nonempty_traces(spark, sf):
    spans = datasets.event_spans(spark, sf).withColumn("trace_id", F.when(_user() % 9 == 0, F.lit("")).otherwise(F.col("trace_id")))
    return records.to_records(spans).groupBy(F.col("span_name").alias("event_type")).agg(F.count("*").alias("n"))


@query
def flt2_roots(spark, sf):
    return _records(spark, sf).where("parent_span_id = ''").select("trace_id", "span_id")


@query
def flt4_version_classes(spark, sf):
    v = datasets.table(spark, sf, "events").select(F.concat(F.lit("v"), (F.col("user_id") % 6).cast("string")).alias("schema_version")).distinct()
    x = F.col("schema_version")
    return v.select(x, numeric_times(x).alias("numeric_times"), x.isin(*records.RESTAMPABLE).alias("restampable"), x.isin(*records.VERSIONS).alias("implemented"))


@query
def flt7_fatal_count(spark, sf):
    s = F.when(F.col("event_id") % 3 == 0, "advisory").when(F.col("event_id") % 3 == 1, "odd")
    return verify.summary(datasets.table(spark, sf, "events").select(s.alias("severity"))).select("fatal")


@query
def jn1_entry_count_mismatch(spark, sf):
    return _contradicted(spark, sf, "entry_count_mismatch").select("checkpoint_seq", "trace_id", "entry_count", "logged")


@query
def jn2_tip_unverifiable(spark, sf):
    return _contradicted(spark, sf, "tip_hash_unverifiable").select("checkpoint_seq", "trace_id", "tip_hash")


@query
def jn3_tip_mismatch(spark, sf):
    return _contradicted(spark, sf, "tip_hash_mismatch").select("checkpoint_seq", "trace_id", "tip_hash", "tip")


@query
def jn4_wal_compact(spark, sf):
    lines = datasets.wal_lines(spark, sf)
    pending = wal.restored_tips(lines).where("line_no % 4 = 1")
    return wal.compact(lines, pending).select("phase", "line_no", "trace_id")


@query
def jn5_open_traces(spark, sf):
    r = _records(spark, sf)
    sealed = r.where(_user() % 3 == 0).select("trace_id").distinct()
    return records.open_traces(r, sealed).groupBy("trace_id").agg(F.count("*").alias("n"))


@query
def jn6_late_spans(spark, sf):
    r = _records(spark, sf)
    return records.late_spans(r, r.where(_user() % 3 == 0).select("trace_id").distinct()).select("trace_id", "span_id")


@query
def jn7_own_tip_pending(spark, sf):
    t = _tips(spark, sf)
    return chain.still_pending(t, t.where("seal_no % 4 = 2")).select("trace_id", "tip_hash")


@query
def jn8_uncovered_traces(spark, sf):
    return verify.uncovered_traces(_records(spark, sf), _checkpoints(spark, sf).where("checkpoint_seq % 2 = 1"))


@query
def ag1_entries_by_trace(spark, sf):
    return _records(spark, sf).groupBy("trace_id").agg(
        F.count("*").alias("n"),
        F.min("start_time_unix_nano").cast("long").alias("first_ns"),
        F.max("end_time_unix_nano").cast("long").alias("last_ns"),
    )


def _orders(spark, sf):
    r = records.to_records(datasets.order_spans(spark, sf))
    return records.last_wins(r, F.col("arrival"), F.col("span_name"), F.col("start_time_unix_nano"))


@query
def ag2_dedupe_last_wins(spark, sf):
    return _orders(spark, sf).select("trace_id", "span_id", "span_name", "arrival")


@query
def ag3_processed(spark, sf):
    traces = _records(spark, sf).agg(F.countDistinct("trace_id").alias("traces")).withColumn("checkpoints", F.lit(0).cast("long"))
    cps = _checkpoints(spark, sf).agg(F.count("*").alias("checkpoints")).withColumn("traces", F.lit(0).cast("long"))
    return traces.unionByName(cps).agg(F.sum("traces").alias("traces"), F.sum("checkpoints").alias("checkpoints"))


@query
def ag4_duplicate_segments(spark, sf):
    return verify.duplicate_segments(_tampered(spark, sf)[0])


@query
def ag5_other_key_ids(spark, sf):
    e = datasets.table(spark, sf, "events")
    entries = e.select(F.concat(F.lit("key"), (F.col("event_id") % 5).cast("string")).alias("key_id"))
    cps = e.select(F.when(F.col("user_id") % 2 == 0, "").otherwise(F.concat(F.lit("cp"), (F.col("user_id") % 4).cast("string"))).alias("key_id"))
    return verify.other_key_ids(entries, cps, "key0")


@query
def ag6_version_sets(spark, sf):
    return wal.replay(datasets.wal_lines(spark, sf)).select("trace_id", "n_spans", F.array_join("versions", ",").alias("versions"))


@query
def ag7_restampable(spark, sf):
    return wal.replay(datasets.wal_lines(spark, sf)).select("trace_id", (F.col("action") == "restamp").alias("restampable"))


@query
def ag8_has_root(spark, sf):
    return records.traces(_orders(spark, sf)).select("trace_id", "has_root", "n_spans")


@query
def ag11_merkle_root(spark, sf):
    e = datasets.table(spark, sf, "events")
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    leaves = e.select("user_id", place.alias("leaf_no"), sha256_hex(F.col("event_id").cast("string")).alias("leaf"))
    return chain.batch_roots(e.select("user_id"), leaves.where("user_id % 5 <> 0"), ["user_id"])


@query
def ag12_status_lines(spark, sf):
    e = datasets.table(spark, sf, "events").groupBy("user_id").agg(
        F.count_if((F.col("event_type") == "error") & (F.col("event_id") % 5 == 0)).alias("f"),
        F.count_if((F.col("event_type") == "view") & (F.col("event_id") % 7 == 0)).alias("a"),
    )
    return e.select("user_id", verify.status_line(F.col("f"), F.col("a")).alias("status"))


@query
def ag13_pending_sets(spark, sf):
    return chain.pending_sets(wal.restored_tips(datasets.wal_lines(spark, sf))).select("trace_id", F.array_join("tips", ",").alias("tips"))


@query
def wn1_seq_in_trace(spark, sf):
    return _sequenced(spark, sf).select("trace_id", "span_id", F.col("seq_in_trace").cast("long").alias("seq"))


@query
def wn3_checkpoint_link(spark, sf):
    return _checkpoints(spark, sf).select("checkpoint_seq", "prev_checkpoint_hash")


@query
def wn4_adjacent_duplicates(spark, sf):
    e = datasets.table(spark, sf, "events").select("user_id", (F.col("event_id") % 50).alias("seq"))
    return verify.repeated_numbers(e, "user_id", "seq")


@query
def wn5_checkpoint_batches(spark, sf):
    return _batches(spark, sf).select("trace_id", F.col("checkpoint_seq").cast("long").alias("checkpoint_seq"))


@query
def wn6_wal_replay(spark, sf):
    return wal.live_spans(datasets.wal_lines(spark, sf)).select("line_no", "trace_id", "span_id", "schema_version")


@query
def vf1_chain_states(spark, sf):
    states = verify.chain_states(_tampered(spark, sf)[0], None)
    return states.select("trace_id", F.col("n").cast("long").alias("n"), F.when(F.col("dup"), "dup").when(F.col("error").isNotNull(), "bad").otherwise("ok").alias("state"))


@query
def vf2_signatures(spark, sf):
    """A signed log in which every 97th entry was edited, every 89th names another algorithm, and every 83rd has no
    signature that can be read: the first error of each chain."""
    log = chain.hash_entries(_sequenced(spark, sf), _KEY).withColumns(
        {
            "span_name": F.when(F.col("event_id") % 97 == 0, "edited").otherwise(F.col("span_name")),
            "algorithm": F.when(F.col("event_id") % 89 == 0, "rsa").otherwise(F.col("algorithm")),
            "signature": F.when(F.col("event_id") % 83 == 0, "?").otherwise(F.col("signature")),
        }
    )
    return verify.chain_states(stage.kept(log), ed25519.public_key(_KEY)).select("trace_id", F.col("n").cast("long").alias("n"), "error", F.col("tip").isNotNull().alias("verified"))


@query
def vf3_checkpoint_links(spark, sf):
    cps = _unlinked(_checkpoints(spark, sf).withColumn("line_no", F.col("checkpoint_seq")))
    return verify.bad_links(cps).select("checkpoint_seq", "prev_checkpoint_hash", "expected_prev")


@query
def vf4_findings(spark, sf):
    return verify.findings(*_tampered(spark, sf), public=None).groupBy("trace_id", "kind", "severity").agg(F.count("*").alias("n"))


@query
def vf6_key_id_mismatch(spark, sf):
    log = _tampered(spark, sf)[0].withColumn("key_id", F.when(F.col("event_id") % 5 == 1, "other").when(F.col("event_id") % 5 == 2, "").otherwise("signer"))
    return verify.odd_key_ids(log, verify.chain_states(log, None), "signer").select("trace_id", "span_id", "key_id")


@query
def so2_checkpoint_tips(spark, sf):
    tip = lambda t: F.concat(
        F.lit('{"trace_id":'),
        json_string(t["trace_id"]),
        F.lit(',"tip_hash":'),
        json_string(t["tip_hash"]),
        F.lit(',"entry_count":'),
        t["entry_count"].cast("string"),
        F.lit("}"),
    )
    return _checkpoints(spark, sf).select("checkpoint_seq", F.concat(F.lit("["), F.array_join(F.transform("trace_tips", tip), ","), F.lit("]")).alias("tips_json"))


@query
def so4_sorted_spans(spark, sf):
    return _records(spark, sf).groupBy("trace_id").agg(F.array_join(F.array_sort(F.collect_list("span_id")), ",").alias("spans"))


@query
def src4_last_checkpoint(spark, sf):
    line = canonical_checkpoint()
    lines = _checkpoints(spark, sf).withColumn("signature", F.lit("")).select(
        "checkpoint_seq",
        F.when(F.col("checkpoint_seq") % 4 == 0, F.substring(line, 1, 90)).otherwise(line).alias("line"),
    )
    path = _folder(spark, "checkpoints")
    jsonl.write_batch(lines, path, 0, "checkpoint_seq")
    return jsonl.last_checkpoint(spark, path).select("checkpoint_seq", "prev_checkpoint_hash")


@query
def tk1_trim_pending(spark, sf):
    return chain.trim_pending(_tips(spark, sf), 25).select("trace_id", F.col("seal_no").cast("long").alias("seal_no"))


@query
def tk3_fragment_prefix(spark, sf):
    c = datasets.table(spark, sf, "conversations")
    return c.select("conv_id", "turn", F.hex(jsonl.dropped_prefix(F.encode("text", "UTF-8"))).alias("prefix"))


@query
def st1_claimed_keys(spark, sf):
    e = datasets.table(spark, sf, "events")
    entries = e.select(F.concat(F.lit("key"), (F.col("event_id") % 5).cast("string")).alias("key_id"))
    return verify.claimed_key_ids(entries, e.select(F.concat(F.lit("cp"), (F.col("user_id") % 4).cast("string")).alias("key_id")))


@query
def st3_uncommitted(spark, sf):
    b = _batches(spark, sf)
    return chain.covered(b, b.where("checkpoint_seq <= 2")).select("trace_id", "tip_hash")


@query
def fn1_canonical_bytes(spark, sf):
    b = _sequenced(spark, sf).select("span_id", canonical_record().alias("bytes"))
    return b.select("span_id", sha256_hex(F.col("bytes")).alias("digest"), F.octet_length("bytes").cast("long").alias("n_bytes"))


@query
def fn1_json_strings(spark, sf):
    return datasets.table(spark, sf, "conversations").select("conv_id", "turn", json_string(F.col("text")).alias("quoted"))


@query
def fn3_unixnano_parse(spark, sf):
    n = F.col("event_id").cast("string")
    m = F.col("event_id") % 6
    x = F.when(
        m == 0,
        F.concat(F.lit('"'), n, F.lit('"')),
    ).when(m == 1, F.concat(F.lit("0"), n)).when(m == 2, "18446744073709551615").when(m == 3, '"18446744073709551616"').when(m == 4, "null").otherwise(F.concat(n, F.lit(".0")))
    return datasets.table(spark, sf, "events").select("event_id", unix_nano_column(x).alias("nanos"))


@query
def fn4_genesis_seed(spark, sf):
    u = datasets.table(spark, sf, "events").select("user_id").distinct()
    trace = datasets.hex_id(F.col("user_id"), 32)
    trace = F.when(F.col("user_id") % 4 == 3, F.substring(trace, 1, 31)).otherwise(trace)
    return u.select("user_id", genesis_seed(trace, F.concat(F.lit("v"), (F.col("user_id") % 3 + 1).cast("string"))).alias("seed"))


@query
def fn9_finding_labels(spark, sf):
    u = datasets.table(spark, sf, "events").select("user_id").distinct()
    m = F.col("user_id") % 3
    trace, kind = F.when(m == 0, F.col("user_id").cast("string")).otherwise(""), F.when(m == 1, "torn_trailing_line").otherwise("checkpoint")
    return u.select("user_id", verify.label_column(trace, kind).alias("label"))


@query
def fn10_backoff(spark, sf):
    e = datasets.table(spark, sf, "events").select((F.col("event_id") % 4).alias("f"), (F.col("event_id") % 3000).alias("p"), (F.col("event_id") % 5000).alias("c"))
    return e.select("f", "p", chain.next_retry(F.col("f"), F.col("p"), F.col("c")).alias("retry_at"))


@query
def fn11_defaults(spark, sf):
    return datasets.table(spark, sf, "events").select("event_id", chain.effective(F.col("event_id") % 4, F.lit(100)).cast("long").alias("interval_of"))


@query
def fn13_id_checks(spark, sf):
    n = F.hex("event_id")
    x = F.when(F.col("event_id") % 3 == 0, F.lower(F.lpad(n, 16, "0"))).when(F.col("event_id") % 3 == 1, F.concat(F.upper(F.lpad(n, 15, "F")), F.lit("A"))).otherwise(n)
    return datasets.table(spark, sf, "events").select("event_id", id_check(x, 16).alias("code"))


@query
def ss6_scope_groups(spark, sf):
    pair = lambda k, v: F.array(F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")))
    spans = datasets.event_spans(spark, sf).withColumns(
        {
            "segment": F.lit("complete"),
            "resource_schema": F.lit(""),
            "scope_schema": F.lit(""),
            "scope_name": F.concat(F.lit("s"), (F.col("event_id") % 3).cast("string")),
            "scope_version": F.lit("1"),
            "resource_attributes": pair("host", F.col("event_id") % 2),
            "scope_attributes": pair("x", F.lit("y")),
        }
    )
    out = otlp.regrouped(spans, "span_id", "name")
    return out.select("trace_id", "resource_key", "scope_name", F.array_join("spans.span_id", ",").alias("spans"))


@query
def ss11_disposition(spark, sf):
    return wal.replay(datasets.wal_lines(spark, sf)).select("trace_id", "n_spans", "has_root", F.array_join("versions", ",").alias("versions"), "action")


@query
def ss13_restored_tips(spark, sf):
    return wal.restored_tips(datasets.wal_lines(spark, sf))


@query
def snk4_quarantine(spark, sf):
    q = records.quarantined(wal.deduplicated(datasets.wal_lines(spark, sf)), "mixed or unknown versions", _STAMP)
    return q.select("trace_id", "span_id", "line_no", F.array_join("versions", ",").alias("versions"), "reason")


@query
def src1_span_ingest(spark, sf):
    return records.to_records(otlp.spans(_requests(spark, sf))).select(
        "trace_id",
        "span_id",
        "parent_span_id",
        F.col("start_time_unix_nano").cast("string").alias("start_ns"),
        "span_name",
        "otel_kind",
        "status",
        "audit_kind",
        json_attributes(F.col("selected_attributes")).alias("attributes_json"),
    )


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    """The events as export requests in JSON, one for each user, with attributes of all kinds."""
    e = datasets.event_spans(spark, sf)
    text = F.transform("attributes", lambda a: F.struct(a["key"].alias("key"), F.struct(a["value"].alias("stringValue")).alias("value")))
    typed = lambda key, kind, value: F.struct(F.lit(key).alias("key"), F.struct(value.alias(kind)).alias("value"))
    more = [
        ("gen_ai.usage.input_tokens", "intValue", F.col("event_id").cast("string")),
        ("gen_ai.usage.output_tokens", "doubleValue", F.col("event_id") / 4),
        ("gen_ai.request.model", "boolValue", F.col("event_id") % 2 == 0),
    ]
    named = [F.to_json(F.array(typed(*m))) for m in more]
    joined = F.concat(F.to_json(text), *named)
    attributes = F.regexp_replace(joined, r"\]\[", ",")
    one = F.concat(
        F.lit('{"attributes":'),
        attributes,
        F.lit(","),
        F.substring(
            F.to_json(
                F.struct(
                    F.col("trace_id").alias("traceId"),
                    F.col("span_id").alias("spanId"),
                    F.col("parent_span_id").alias("parentSpanId"),
                    "name",
                    "kind",
                    F.col("start_time_unix_nano").cast("string").alias("startTimeUnixNano"),
                    F.col("end_time_unix_nano").alias("endTimeUnixNano"),
                    F.struct(F.col("status_code").alias("code")).alias("status"),
                )
            ),
            2,
            1 << 20,
        ),
    )
    by = e.select("trace_id", one.alias("x")).groupBy("trace_id").agg(F.array_join(F.collect_list("x"), ",").alias("x"))
    return by.select(F.concat(F.lit('{"resourceSpans":[{"scopeSpans":[{"scope":{"name":"s"},"spans":['), "x", F.lit("]}]}]}")).alias("value"))


@query
def prj3_attribute_text(spark, sf):
    e = datasets.table(spark, sf, "events").select("event_id", (F.col("event_id") % 7).alias("m"))
    n = F.col("event_id").cast("string")
    tag = lambda kind, x: F.concat(F.lit(f'{{"{kind}":'), x, F.lit("}"))
    quote = lambda x: F.concat(F.lit('"'), x, F.lit('"'))
    raw = F.when(F.col("m") == 0, tag("stringValue", quote(n))).when(F.col("m") == 1, tag("intValue", quote(n))).when(F.col("m") == 2, tag("doubleValue", (F.col("event_id") / 4).cast("string"))).when(
        F.col("m") == 3,
        tag("boolValue", (F.col("event_id") % 2 == 0).cast("string")),
    ).when(F.col("m") == 4, tag("bytesValue", quote(F.base64(F.encode(n, "UTF-8")))))
    items = tag("arrayValue", F.concat(F.lit('{"values":['), tag("intValue", n), F.lit(',{"stringValue":"<x>"}]}')))
    raw = raw.when(F.col("m") == 5, items).otherwise(F.lit("{}"))
    return e.select("event_id", otlp.value_texts(F.array(raw))[0].alias("text"))


@query
def fn7_attributes_key(spark, sf):
    e = datasets.table(spark, sf, "events")
    pair = lambda k, v: F.struct(F.lit(k).alias("key"), v.cast("string").alias("value"))
    given = F.when(
        F.col("event_id") % 2 == 0,
        F.array(pair("b", F.col("event_type")), pair("a", F.col("user_id"))),
    ).otherwise(F.array(pair("a", F.col("user_id")), pair("b", F.col("event_type"))))
    return e.groupBy(otlp.attributes_key(given).alias("attributes")).agg(F.count("*").alias("n"))


@query
def tk4_drop_pending(spark, sf):
    left, dropped = chain.drop_pending(_tips(spark, sf))
    return left.agg(F.count("*").alias("pending")).withColumn("dropped", F.lit(dropped).cast("long"))


@query
def ss8_sealed_batches(spark, sf):
    """Three batches of traces, the last one twice, sealed one after the other, read back and verified."""
    spans = datasets.event_spans(spark, sf).drop("event_id")
    settings = seal.Settings(path := _folder(spark, "sealed"), f"{path}.checkpoints", checkpoint_interval=20)
    sealer = seal.Sealer(settings, T.StructType(spans.schema.fields), stamp=lambda: _STAMP)
    packed = stage.kept(assemble.carried(spans, "start_time_unix_nano").withColumn("segment", F.lit("complete")))
    for k in (0, 1, 2, 2):
        sealer(packed.where(_user() % 3 == k), k)
    entries, torn = jsonl.read_entries(spark, settings.log_path)
    cps = jsonl.read_checkpoints(spark, settings.checkpoint_path)
    found = verify.findings(entries, cps, None, torn).count()
    tips = cps.select("checkpoint_seq", F.size("trace_tips").alias("tips"))
    passed = sealer.passed(spark, 3)
    per = tips.agg(F.count("*").alias("checkpoints"), F.coalesce(F.sum("tips"), F.lit(0)).alias("covered"))
    return per.withColumns(
        {
            "findings": F.lit(found).cast("long"),
            "entries": F.lit(entries.count()).cast("long"),
            "pending": F.lit(len(passed["pending"])).cast("long"),
            "sealed": F.lit(passed["sealed"]).cast("long"),
        }
    )


@query
def ss10_segments(spark, sf):
    """Three batches of traces; one trace in six comes with each of them, as a segment of its own."""
    spans = datasets.event_spans(spark, sf).drop("event_id")
    settings = seal.Settings(path := _folder(spark, "segments"), f"{path}.checkpoints", checkpoint_interval=20)
    sealer = seal.Sealer(settings, T.StructType(spans.schema.fields), stamp=lambda: _STAMP)
    packed = stage.kept(assemble.carried(spans, "start_time_unix_nano").withColumn("segment", F.lit("complete")))
    for k in range(3):
        sealer(packed.where((_user() % 3 == k) | (_user() % 6 == 0)), k)
    return seal.segments(spark, settings).select("trace_id", F.col("segment_no").cast("long").alias("segment_no"), "entry_count")


@query
def ss17_finished_stream(spark, sf):
    """A stream over the events, in which one trace in four has lost its root, to its end: all traces are sealed and
    covered by checkpoints, the last of them short."""
    spans = datasets.event_spans(spark, sf).drop("event_id").where((_user() % 4 != 1) | (F.col("parent_span_id") != ""))
    path = _folder(spark, "finished")
    spans.write.parquet(f"{path}-in")
    settings = seal.Settings(path, f"{path}.checkpoints", checkpoint_interval=20, timeout_ms=3_600_000)
    stream = spark.readStream.schema(spans.schema).parquet(f"{path}-in")
    seal.drain(seal.start(stream, settings, f"{path}-stream", arrival="start_time_unix_nano"))
    seal.finish(spark, settings, spans.schema, f"{path}-stream")
    entries, torn = jsonl.read_entries(spark, settings.log_path)
    cps = jsonl.read_checkpoints(spark, settings.checkpoint_path)
    pending = len(seal.Sealer(settings, spans.schema).passed(spark, 1 << 30)["pending"])
    counts = cps.agg(F.count("*").alias("checkpoints"), F.coalesce(F.sum(F.size("trace_tips")), F.lit(0)).cast("long").alias("covered"))
    return counts.withColumns(
        {
            "entries": F.lit(entries.count()).cast("long"),
            "findings": F.lit(verify.findings(entries, cps, None, torn).count()).cast("long"),
            "pending": F.lit(pending).cast("long"),
        }
    )


@query
def ss12_restamped(spark, sf):
    return wal.restamped(datasets.wal_lines(spark, sf)).select("line_no", "trace_id", "span_id", "schema_version")


@query
def src2_conversation_log(spark, sf):
    """Conversations as traces: sealed lines written as text, read back strictly, with their hashes."""
    made = records.with_sequence(records.to_records(datasets.conversation_spans(spark, sf)))
    path = _folder(spark, "log")
    jsonl.write_batch(chain.hash_entries(made).select("trace_id", "seq_in_trace", canonical_entry().alias("line")), path, 0, "trace_id", "seq_in_trace")
    entries, torn = jsonl.read_entries(spark, path)
    return entries.select("line_no", "trace_id", "span_id", "span_name", "audit_kind", F.lit(torn).cast("string").alias("torn"))
