"""Published hashes, parsing cases and verification scenarios of the audit operators."""

import base64
import hashlib
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerframe.functions import ed25519, profile
from ledgerframe.functions.jsonbytes import canonical_entry, canonical_record, canonical_checkpoint, checkpoint_payload, genesis_seed, sha256_hex
from ledgerframe.operators import chain, records, stage, verify, wal
from ledgerframe.sources import jsonl, otlp

KEY = bytes(range(32))
PUBLIC = ed25519.public_key(KEY)
TRACE = "01010101010101010101010101010101"
V3 = '{"schema_version":"v3","trace_id":"01010101010101010101010101010101","span_id":"0102030405060708","parent_span_id":"","seq_in_trace":0,"start_time_unix_nano":"1764547200123456789","end_time_unix_nano":"1764547200987654321","span_name":"gen_ai.chat","otel_kind":"Client","gen_ai_operation":"chat","audit_kind":"task","selected_attributes":[{"key":"gen_ai.operation.name","value":"chat"},{"key":"gen_ai.request.model","value":"gpt-4o"},{"key":"gen_ai.system","value":"openai"}],"status":"Ok"}'
SPANS = "trace_id string, span_id string, parent_span_id string, name string, kind int, start_time_unix_nano decimal(20,0), end_time_unix_nano decimal(20,0), status_code int, attributes array<struct<key:string,value:string>>"


def span(spark, *rows):
    return spark.createDataFrame([(*r[:5], Decimal(r[5]), Decimal(r[6]), *r[7:]) for r in rows], SPANS)


def test_record_bytes(spark):
    attrs = [("gen_ai.system", "openai"), ("gen_ai.request.model", "gpt-4o"), ("other", "x"), ("gen_ai.operation.name", "chat"), ("gen_ai.system", "second")]
    got = records.with_sequence(records.to_records(span(spark, (TRACE, "0102030405060708", None, "gen_ai.chat", 3, Decimal("1764547200123456789"), Decimal("1764547200987654321"), 1, attrs), ("", "00", "", "x", 9, Decimal(1), Decimal(1), 7, []))))
    assert [r.b for r in got.select(canonical_record().alias("b")).collect()] == [V3]


def test_seeds_need_whole_hex(spark):
    rows = spark.createDataFrame([(TRACE, "v3"), (TRACE[:-1], "v3"), ("zz", "v3"), ("AB", "v3"), (TRACE, "")], "t string, v string").select(genesis_seed(F.col("t"), F.col("v")).alias("s")).collect()
    assert [r.s is None for r in rows] == [False, True, True, False, True]


@pytest.mark.parametrize(
    "version, times, first, tip, checkpoint",
    [
        ("v1", (1000000000, 2000000000, 2000000000, 3000000000), "fc388777ccc984fd3c0ab20488ae456dad1295621b420aeb7b949c6d125f54dc", "a0415a08bbac8ad89462cae146a727dbcfb3022b3f1e5870886fb2deb1538f9c", "00e33afee48e7ad89a9f9bed4d4b529b39070a5dde68a845d139adb2fe9e0f8c"),
        ("v2", (1000000000, 2000000000, 2000000000, 3000000000), "55cdd65168375131856de86680f57f2171101dd22efc0a0e4a6abf59bbdfb90a", "3e5adf011183ce2128aeca9d337ddf60ea867dbd96f47c16c77e876b36fbc63c", "8a36993bfd3c08102774dddfede52c85fb4db8054b3270ae30fbc24970f5bf79"),
    ],
)
def test_published_chain(spark, version, times, first, tip, checkpoint):
    rows = [(TRACE, "a" * 16, "b" * 16, "child.span", 3, times[0], times[1], 1, []), (TRACE, "b" * 16, "", "root.span", 3, times[2], times[3], 1, [])]
    made = records.with_sequence(records.to_records(span(spark, *rows), version))
    hashed = chain.hash_entries(made).orderBy("seq_in_trace").collect()
    assert [r.entry_hash for r in hashed] == [first, tip]
    tips = chain.chain_tips(made)
    assert tips.first().tip_hash == tip
    cps = chain.checkpoints(tips.withColumn("checkpoint_seq", F.lit(1)), F.lit("2026-06-22T00:00:00Z"), "PLACEHOLDER", version)
    assert cps.select(sha256_hex(checkpoint_payload())).first()[0] == checkpoint


def test_keys_and_signatures():
    # the first vector of RFC 8032
    seed = bytes.fromhex("9d61b19deffd5a60ba844af492ec2cc44449c5697b326919703bac031cae7f60")
    public = ed25519.public_key(seed)
    assert public.hex() == "d75a980182b10ab7d54bfed3c964073a0ee172f3daa62325af021a68f707511a"
    sig = ed25519.sign(seed, b"")
    assert sig.hex().startswith("e5564300c360ac729086e2cc806e828a")
    assert ed25519.verify(public, b"", sig) and not ed25519.verify(public, b"x", sig) and not ed25519.verify(public, b"", sig[:-1])
    assert ed25519.read_private_pem(ed25519.private_pem(seed)) == seed
    assert ed25519.read_public_key(ed25519.public_pem(public)) == ed25519.read_public_key(public.hex()) == public
    with pytest.raises(ValueError):
        ed25519.read_private_pem(ed25519.public_pem(public))


def test_times():
    good = {"1764547200123456789": "1764547200123456789", '"1764547200123456789"': "1764547200123456789", "0": "0", '"18446744073709551615"': "18446744073709551615", "null": "0"}
    for text, want in good.items():
        assert profile.unix_nano(json.loads(text)) == want
    for text in ("-1", '"-1"', '"1e9"', '"1_000"', '""', "true", "{}", '"18446744073709551616"', '"01"'):
        with pytest.raises(ValueError):
            profile.unix_nano(json.loads(text))


def test_time_tokens_as_columns(spark):
    cases = {"0": "0", '"7"': "7", "null": "0", "-1": None, "01": None, '"01"': None, "1.5": None, "18446744073709551615": "18446744073709551615", "18446744073709551616": None, '"1': None, "99999999999999999999999": None}
    got = spark.createDataFrame([(k,) for k in cases], "x string").select("x", profile.unix_nano_column(F.col("x")).alias("n")).collect()
    assert {r.x: r.n for r in got} == cases


@pytest.mark.parametrize("failures, pending, cap, at", [(1, 10, 2**30, 11), (1, 5000, 2**30, 5001), (2, 10, 2**30, 20), (5, 64, 2**30, 128), (5, 1024, 2**30, 2048), (5, 1025, 2**30, 2049), (50, 200000, 2**30, 201024), (5, 400, 1000, 800), (5, 600, 1000, 1000), (5, 1000, 1000, 1000), (1, 1000, 1000, 1000)])
def test_backoff(spark, failures, pending, cap, at):
    assert spark.range(1).select(chain.next_retry(F.lit(failures), F.lit(pending), F.lit(cap))).first()[0] == at


def test_profile():
    base = {"trace_id": "0" * 32, "span_id": "0" * 16, "parent_span_id": "", "name": "n", "kind": 0, "start_time_unix_nano": "0", "end_time_unix_nano": "0", "status_code": 0}
    body, digest, attrs = profile.canonical_span(json.dumps(base))
    assert attrs == "44136fa355b3678a1146ad16f7e8649e94fb4fc21fe77e8310c060f61caaff8a" and len(digest) == 64 and body.startswith('{"attributes_sha256":')
    assert [profile.es6(x) for x in (1e21, 1e16, 5e-7, 1e-6, 123.456, -0.0, 1e20, -2.5)] == ["1e+21", "10000000000000000", "5e-7", "0.000001", "123.456", "0", "100000000000000000000", "-2.5"]
    assert profile.jcs({"\ue000": 1, "😀": 2, "a": [True, None, "\u001f"]}) == '{"a":[true,null,"\\u001f"],"😀":2,"\ue000":1}'
    bad = {"KIND_OUT_OF_RANGE": {"kind": 6}, "STATUS_OUT_OF_RANGE": {"status_code": 3}, "ID_BAD_LENGTH": {"span_id": "00"}, "ID_NOT_LOWERCASE_HEX": {"trace_id": "A" * 32}, "TIMESTAMP_NOT_STRING": {"start_time_unix_nano": 5}, "TIMESTAMP_NOT_DECIMAL": {"end_time_unix_nano": "01"}, "INT_OUT_OF_RANGE": {"attributes": {"a": {"i": str(2**63)}}}, "BAD_WRAPPER": {"attributes": {"a": {"q": 1}}}}
    for code, change in bad.items():
        with pytest.raises(profile.Reject, match=code):
            profile.canonical_span(json.dumps(base | change))
    with pytest.raises(profile.Reject, match="DUPLICATE_ATTRIBUTE_KEY"):
        profile.canonical_span(json.dumps(base | {"attributes": [["a", {"s": "x"}], ["a", {"s": "y"}]]}))


@pytest.mark.parametrize(
    "name, span_id, attrs, span_hash, attrs_hash",
    [
        ("GET /", "b7ad6b7169203331", "{}", "81d96745dfebfb00594c190fc5d3c10da2427b2738c93cf4bb001dd5f44d5903", "44136fa355b3678a1146ad16f7e8649e94fb4fc21fe77e8310c060f61caaff8a"),
        ("café 🚀", "5555555555555555", '[["é",{"s":"second"}],["\\ue000private",{"s":"last"}],["😀",{"s":"third"}],["z",{"s":"first"}]]', "4c2386f6aab04c76648b8578bc332fa0e5adfdff29a5e926f82f95c483847556", "7d0e0a0f036b1def8df2769f6437c71c8d8a4c60a5b334c38733637b4be0288f"),
    ],
)
def test_published_profile_hashes(name, span_id, attrs, span_hash, attrs_hash):
    span = {"trace_id": "0af7651916cd43dd8448eb211c80319c", "span_id": span_id, "parent_span_id": "", "name": name, "kind": 0, "start_time_unix_nano": "1754300000000000000", "end_time_unix_nano": "1754300000123456789", "status_code": 0}
    _, got, got_attrs = profile.canonical_span(json.dumps(span)[:-1] + ', "attributes": ' + attrs + "}")
    assert (got, got_attrs) == (span_hash, attrs_hash)


def test_profile_as_column(spark):
    rows = spark.createDataFrame([("{}",), ("not json",)], "x string").select(profile.span_profile("x").alias("p")).select("p.*").collect()
    assert [r.reject for r in rows] == ["KIND_OUT_OF_RANGE", "BAD_WRAPPER"]


def test_merkle_root_equals_the_recursion(spark):
    import hashlib

    def root(xs):
        if len(xs) == 1:
            return hashlib.sha256(b"\0" + xs[0]).digest()
        k = 1
        while k * 2 < len(xs):
            k *= 2
        return hashlib.sha256(b"\1" + root(xs[:k]) + root(xs[k:])).digest()

    leaves = [hashlib.sha256(bytes([n])).digest() for n in range(1, 67)]
    for n in (1, 2, 3, 7, 66):
        df = spark.createDataFrame([(k, x.hex()) for k, x in enumerate(leaves[:n])], "leaf_no long, leaf string")
        assert chain.merkle_root(df).first().root == root(leaves[:n]).hex()
    assert chain.merkle_root(spark.createDataFrame([], "leaf_no long, leaf string")).count() == 0
    none = chain.batch_roots(spark.createDataFrame([("b",)], "batch string"), spark.createDataFrame([], "batch string, leaf_no long, leaf string"), ["batch"])
    assert [tuple(r) for r in none.collect()] == [("b", None, "EMPTY_BATCH")]


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    """Paths of a signed log of four traces and of its two checkpoints."""
    place = tmp_path_factory.mktemp("log")
    rows = [(f"{t:032x}", f"{s:016x}", "" if s == 0 else f"{0:016x}", f"span <{s}>", 1, 10 * s, 10 * s + 5, 1, [("gen_ai.operation.name", "chat")]) for t in range(4) for s in range(3)]
    sealed = chain.hash_entries(records.with_sequence(records.to_records(span(spark, *rows))), KEY)
    entries = [r.line for r in sealed.orderBy("trace_id", "seq_in_trace").select(canonical_entry().alias("line")).collect()]
    tips = chain.chain_tips(sealed).withColumn("checkpoint_seq", (F.conv("trace_id", 16, 10).cast("long") / 2).cast("long") + 1)
    cps = chain.checkpoints(tips, F.lit("2026-01-01T00:00:00Z"), ed25519.key_id(PUBLIC)).orderBy("checkpoint_seq").select("*", checkpoint_payload().alias("p")).collect()
    schema = "schema_version string, checkpoint_seq long, timestamp string, prev_checkpoint_hash string, trace_tips array<struct<trace_id:string,tip_hash:string,entry_count:long>>, key_id string, algorithm string, signature string"
    signed = spark.createDataFrame([(*r[:-1], base64.b64encode(ed25519.sign(KEY, r.p.encode())).decode()) for r in cps], schema)
    checkpoints = [r.line for r in signed.orderBy("checkpoint_seq").select(canonical_checkpoint().alias("line")).collect()]
    return place, entries, checkpoints


def kinds(spark, log, entries, checkpoints, public=PUBLIC, tail="\n"):
    place = log[0] / str(len(list(log[0].iterdir())))
    place.mkdir()
    (place / "log").write_text("\n".join(entries) + tail)
    (place / "cp").write_text("\n".join(checkpoints) + "\n")
    rows, torn = jsonl.read_entries(spark, str(place / "log"))
    found = verify.findings(rows, jsonl.read_checkpoints(spark, str(place / "cp")), public, torn)
    return [r.kind for r in found.collect()], rows, place


def test_clean_log_and_reordered_lines(spark, log):
    _, entries, checkpoints = log
    assert kinds(spark, log, entries, checkpoints)[0] == []
    assert kinds(spark, log, [entries[-1], "", *entries[:-1]], checkpoints)[0] == []


def test_tampering(spark, log):
    _, e, c = log
    assert kinds(spark, log, [e[0].replace("span", "spam"), *e[1:]], c)[0] == ["chain", "tip_hash_unverifiable"]
    assert kinds(spark, log, [*e, e[4]], c)[0] == ["duplicate_trace_segment", "entry_count_mismatch", "tip_hash_unverifiable"]
    assert kinds(spark, log, e[:-1], c)[0] == ["entry_count_mismatch", "tip_hash_mismatch"]
    assert kinds(spark, log, e[3:], c)[0] == ["entry_count_mismatch"]
    assert kinds(spark, log, e, c[1:])[0] == ["checkpoint"]
    other = [e[0].replace(ed25519.key_id(PUBLIC), "k" * 64), *e[1:]]
    assert kinds(spark, log, other, c)[0] == ["key_id_field_mismatch"]
    wrong = kinds(spark, log, e, c, ed25519.public_key(bytes(32)))[0]
    assert sorted(set(wrong)) == ["chain", "checkpoint", "tip_hash_unverifiable"]


def test_torn_lines(spark, log):
    _, e, c = log
    assert kinds(spark, log, [*e, e[0][:40]], c, tail="")[0] == ["torn_trailing_line"]
    with pytest.raises(jsonl.MalformedLine):
        kinds(spark, log, [e[0][:40], *e[1:]], c)
    rows, torn = jsonl.read_entries(spark, "/nowhere/at/all")
    assert rows.count() == 0 and torn is None


def test_report(spark, log):
    _, e, c = log
    _, rows, place = kinds(spark, log, [e[0].replace(ed25519.key_id(PUBLIC), "k" * 64), *e[1:]], c)
    made = verify.report(rows, jsonl.read_checkpoints(spark, str(place / "cp")), PUBLIC)
    assert made.traces == 4 and made.checkpoints == 2 and made.status() == "Status: OK (1 advisory finding(s))"
    assert "key_id_field_mismatch (advisory)" in made.text() and json.loads(made.json())["OtherClaimedKeyIDs"] == ["k" * 64]
    assert json.loads(verify.Report(0, 0, [], []).json())["Errors"] is None
    assert jsonl.last_checkpoint(spark, str(place / "cp")).first().checkpoint_seq == 2


def test_tail_repair(tmp_path):
    assert jsonl.torn_tail(b"") == jsonl.torn_tail(b"{}\n") == ("none", 0)
    file = tmp_path / "log"
    file.write_bytes(b'{"a":1}\n{"b":')
    assert jsonl.repair_tail(str(file)) == {"action": "truncate", "bytes": 5, "dropped": b'{"b":'} and file.read_bytes() == b'{"a":1}\n'
    file.write_bytes(b'{"a":1}\n{"b":2}')
    assert jsonl.repair_tail(str(file))["action"] == "terminate" and file.read_bytes().endswith(b"}\n")
    assert jsonl.torn_tail(b"x" * 50, 20)[0] == "refuse"


def _wal(spark, *rows):
    out = []
    for k, (kind, trace, tip) in enumerate(rows):
        out.append((k, kind, trace, f"s{k}" if kind == "span" else None, "" if kind == "span" else None, "v3" if kind == "span" else None, tip, 1 if tip is not None else None))
    return spark.createDataFrame(out, "line_no long, type string, trace_id string, span_id string, parent_span_id string, schema_version string, tip_hash string, entry_count long")


def test_wal_segments(spark):
    lines = _wal(spark, ("span", "a", None), ("sealed", "a", "h1"), ("span", "a", None), ("sealed", "b", ""), ("span", "b", None))
    assert [r.line_no for r in wal.live_spans(lines).orderBy("line_no").collect()] == [2, 4]
    assert [r.tip_hash for r in wal.restored_tips(lines).collect()] == ["h1"]
    pending = spark.createDataFrame([("a", "h1")], "trace_id string, tip_hash string")
    assert [(r.phase, r.line_no) for r in wal.compact(lines, pending).orderBy("phase", "line_no").collect()] == [(0, 1), (1, 2), (1, 4)]
    assert [(r.phase, r.line_no) for r in wal.compact(lines, pending.limit(0)).orderBy("phase", "line_no").collect()] == [(1, 2), (1, 4)]


def test_dispositions(spark):
    cases = {("v2",): "restamp", ("v3",): "restamp", ("v2", "v3"): "restamp", ("v1",): "seal", ("v99",): "quarantine", ("v1", "v3"): "quarantine"}
    df = spark.createDataFrame([(list(k),) for k in cases], "v array<string>")
    assert [r[0] for r in df.select(records.disposition(F.col("v"))).collect()] == list(cases.values())


def test_quoting_of_untrusted_text():
    assert verify.quoted("a" * 64, 128) == f'"{"a" * 64}"'
    assert verify.quoted('x"\\\n\x1b\x7fé😀', 128) == r'"x\"\\\n\x1b\x7f\u00e9\U0001f600"'
    # cut between characters, with what was left out
    assert verify.quoted("é" * 5, 5) == r'"\u00e9\u00e9" [truncated: 6 more byte(s)]'


def test_many_other_key_ids(spark):
    made = verify.Report(0, 0, [], [f"{k:02d}" for k in range(13)])
    text = made.text()
    assert "claims 13 key_id" in text and '"09"' in text and '"10"' not in text and "3 more" in text


def test_lines_of_several_files_keep_their_order(spark, tmp_path):
    for k, part in enumerate((["a", "b"], ["c"], ["", "d", "e"])):
        jsonl.write_batch(spark.createDataFrame([(j, x) for j, x in enumerate(part)], "n int, line string"), str(tmp_path / "log"), k, "n")
    assert [tuple(r) for r in jsonl.numbered(jsonl.lines(spark, str(tmp_path / "log"))).orderBy("line_no").collect()] == [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e")]


def test_write_ahead_log_lines(spark, tmp_path):
    line = '{"type":"span","trace_id":"t","record":{"schema_version":"v3","trace_id":"t","span_id":"s","seq_in_trace":0,"start_time_unix_nano":"5"}}'
    (tmp_path / "wal").write_text("\n".join([line, "torn {", '{"type":"sealed","trace_id":"t","tip_hash":"h","entry_count":1}', line[:30]]) + "\n")
    rows = jsonl.read_wal(spark, str(tmp_path / "wal"))
    assert [(r.line_no, r.type, r.span_id, r.tip_hash) for r in rows.orderBy("line_no").collect()] == [(1, "span", "s", ""), (3, "sealed", "", "h")]
    assert wal.live_spans(rows).count() == 0 and wal.restored_tips(rows).count() == 1


def test_torn_checkpoint_is_dropped(spark, log):
    place, _, c = log
    (place / "torn").write_text("\n".join(c) + "\n" + c[0][:50])
    assert jsonl.read_checkpoints(spark, str(place / "torn")).count() == len(c)


def test_gaps_in_checkpoint_numbers(spark, log):
    _, e, c = log
    _, rows, place = kinds(spark, log, e, c)
    (place / "gap").write_text(c[1] + "\n")
    cps = jsonl.read_checkpoints(spark, str(place / "gap"))
    assert verify.findings(rows, cps, PUBLIC).count() == 1
    assert [r.kind for r in verify.findings(rows, cps, PUBLIC, strict_seq=True).collect()] == ["checkpoint"] * 2


def test_long_chain_has_one_tip(spark):
    """One trace of many entries, dealt over many partitions, and others between."""
    n = 3000
    rows = spark.range(n).select(F.lit("ab" * 16).alias("trace_id"), F.lpad(F.hex("id"), 16, "0").alias("span_id"), F.lit("").alias("parent_span_id"), F.lit("n").alias("name"), F.lit(1).alias("kind"), F.col("id").cast("decimal(20,0)").alias("start_time_unix_nano"), F.col("id").cast("decimal(20,0)").alias("end_time_unix_nano"), F.lit(1).alias("status_code"), F.array().cast("array<struct<key:string,value:string>>").alias("attributes"))
    made = records.with_sequence(records.to_records(rows.repartition(9)))
    hashed = chain.hash_entries(made)
    tip = chain.chain_tips(made).first()
    assert tip.entry_count == n and tip.tip_hash == hashed.where(f"seq_in_trace = {n - 1}").first().entry_hash
    assert verify.chain_states(hashed, None).first().tip == tip.tip_hash
    broken = hashed.withColumn("span_name", F.when(F.col("seq_in_trace") == 1234, "x").otherwise(F.col("span_name")))
    state = verify.chain_states(broken, None).first()
    assert state.tip is None and state.error.startswith("entry 1234: ")


def test_numbers_of_rows(spark):
    df = spark.createDataFrame([(f"{k * 7919 % 1000:04d}",) for k in range(1000)], "x string").repartition(6)
    assert [r.seal_no for r in stage.numbered(df, "x").orderBy("x").collect()] == list(range(1000))
    assert stage.numbered(df.limit(0), "x").count() == 0


def test_typed_values():
    cases = {
        '{"stringValue":"a<b"}': "a<b", '{"intValue":"12"}': "12", '{"intValue":-3}': "-3", '{"boolValue":true}': "true", '{"doubleValue":1.0}': "1", '{"doubleValue":0.25}': "0.25",
        '{"doubleValue":1e21}': "1e+21", '{"doubleValue":"NaN"}': "json: unsupported value: NaN", '{"doubleValue":-0.0}': "-0", '{"bytesValue":"3q2+7w=="}': "3q2+7w==", "{}": "", None: "",
        '{"arrayValue":{"values":[{"intValue":"1"},{"stringValue":"<"},{"doubleValue":2.0},{}]}}': '[1,"\\u003c",2,null]',
        '{"kvlistValue":{"values":[{"key":"b","value":{"boolValue":false}},{"key":"a","value":{"arrayValue":{}}}]}}': '{"a":[],"b":false}',
    }
    for raw, want in cases.items():
        assert otlp.value_text(raw) == want


def test_spans_of_export_requests(spark):
    span = {"traceId": TRACE, "spanId": "0102030405060708", "name": "gen_ai.chat", "kind": "SPAN_KIND_CLIENT", "startTimeUnixNano": "1764547200123456789", "endTimeUnixNano": 1764547200987654321, "status": {"code": 1}, "attributes": [{"key": "gen_ai.system", "value": {"stringValue": "openai"}}, {"key": "gen_ai.request.model", "value": {"stringValue": "gpt-4o"}}, {"key": "gen_ai.operation.name", "value": {"stringValue": "chat"}}]}
    request = {"resourceSpans": [{"schemaUrl": "u", "resource": {"attributes": [{"key": "host", "value": {"intValue": "7"}}]}, "scopeSpans": [{"scope": {"name": "lib", "version": "2"}, "spans": [span, {"name": "bare"}]}]}]}
    rows = otlp.spans(spark.createDataFrame([(json.dumps(request),), ("not json",), ("{}",), (None,)], "value string"))
    assert rows.count() == 2
    made = records.with_sequence(records.to_records(rows.drop("resource_attributes", "scope_attributes")))
    assert [r.b for r in made.select(canonical_record().alias("b")).collect()] == [V3]
    out = otlp.regrouped(rows.where("trace_id <> ''").withColumn("segment", F.lit("complete")), "span_id", "name").first()
    assert out.resource_key == '"host"="7"' and out.scope_name == "lib" and [s.name for s in out.spans] == ["gen_ai.chat"]


def test_new_keys_differ():
    a, b = ed25519.new_key(), ed25519.new_key()
    assert a != b and len(a) == 32 and ed25519.verify(ed25519.public_key(a), b"m", ed25519.sign(a, b"m"))


def serial_state(rows, public):
    """What walking one chain entry by entry gives: (dup, error, tip)."""
    rows = sorted(rows, key=lambda r: (r["seq_in_trace"], r["schema_version"], r["bytes"], r["entry_hash"]))
    dup = any(a["seq_in_trace"] == b["seq_in_trace"] for a, b in zip(rows, rows[1:]))
    seed = rows[0]["seed"]
    if seed is None:
        return dup, "the chain has no seed: its trace_id is no hex, or its schema_version is empty", None
    prev, error = bytes.fromhex(seed), None
    for k, r in enumerate(rows):
        payload = r["bytes"].encode() + prev
        prev = hashlib.sha256(payload).digest()
        if r["schema_version"] != rows[0]["schema_version"]:
            error = f"schema_version {r['schema_version']} in a chain of {rows[0]['schema_version']}"
        elif public and not ed25519.verify(public, payload, base64.b64decode(r["signature"])):
            error = "signature verification failed"
        elif r["entry_hash"] != prev.hex():
            error = f"stored hash {r['entry_hash']}, its content gives {prev.hex()}"
        if error:
            return dup, f"entry {k}: {error}", None
    return dup, None, None if dup else prev.hex()


@pytest.mark.parametrize("signed", [False, True])
def test_parallel_check_is_the_serial_one(spark, signed):
    """Chains with edits, exchanged hashes, other versions, repeats, lost entries and ids without a seed, over many
    ranges, so that chains and what is wrong in them lie across borders."""
    pair = F.array().cast("array<struct<key:string,value:string>>")
    spans = spark.range(600).select(
        F.when(F.col("id") % 17 == 16, "xyz").otherwise(F.lpad(F.hex(F.col("id") % 17), 32, "0")).alias("trace_id"), F.lpad(F.hex("id"), 16, "0").alias("span_id"), F.lit("").alias("parent_span_id"), F.lit("n").alias("name"), F.lit(1).alias("kind"),
        F.col("id").cast("decimal(20,0)").alias("start_time_unix_nano"), F.col("id").cast("decimal(20,0)").alias("end_time_unix_nano"), F.lit(1).alias("status_code"), pair.alias("attributes"),
    )
    log = chain.hash_entries(records.with_sequence(records.to_records(spans)), KEY if signed else None)
    t, k = F.conv(F.substring("trace_id", 31, 2), 16, 10).cast("int"), F.col("seq_in_trace")
    log = log.withColumns({
        "span_name": F.when((t == 1) & (k == 0) | (t == 2) & (k == 34) | (t == 3) & k.isin(9, 20), "edited").otherwise(F.col("span_name")),
        "schema_version": F.when((t == 4) & (k == 7) | (t == 5) & (k == 0), "v2").otherwise(F.col("schema_version")),
        "entry_hash": F.when((t == 6) & (k == 11), F.upper("entry_hash")).when((t == 7) & (k == 12), "no hash").otherwise(F.col("entry_hash")),
    })
    log = log.where(~((t == 8) & (k == 5) | (t == 9) & (k == 0) | (t == 10) & (k > 20))).unionByName(log.where((t == 11) & (k == 3))).unionByName(log.where((t == 3) & (k == 30)))
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        log = stage.kept(log.repartition(7))
        public = PUBLIC if signed else None
        states = verify.chain_states(log, public)
        got = {r.trace_id: (r.dup, r.error, r.tip) for r in states.collect()}
        plan = states._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    rows = log.select("trace_id", "seq_in_trace", "schema_version", "entry_hash", "signature", canonical_record().alias("bytes"), genesis_seed(F.col("trace_id"), F.col("schema_version")).alias("seed")).collect()
    by = {}
    for r in rows:
        by.setdefault(r.trace_id, []).append(r.asDict())
    assert got == {x: serial_state(v, public) for x, v in by.items()}
    assert ("ArrowEvalPython" in plan) == signed and "MapInArrow" not in plan


def test_many_signatures_at_once():
    messages = [b"%d" % k for k in range(40)]
    signatures = [ed25519.sign(KEY, m) for m in messages]
    changed = list(signatures)
    changed[3] = changed[4]
    changed[7] = changed[7][:63]
    changed[9] = changed[9][:32] + (int.from_bytes(changed[9][32:], "little") + ed25519.Q).to_bytes(32, "little")
    changed[11] = bytes([changed[11][0] ^ 1]) + changed[11][1:]
    changed[12] = changed[12][:31] + bytes([changed[12][31] ^ 128]) + changed[12][32:]
    assert ed25519.verify_many(PUBLIC, messages, signatures) == [True] * 40
    assert [k for k, ok in enumerate(ed25519.verify_many(PUBLIC, messages, changed)) if not ok] == [3, 7, 9, 11, 12]
    assert ed25519.verify_many(b"\2" * 31, messages, signatures) == [False] * 40 and ed25519.verify_many(PUBLIC, [], []) == []
    # the second vector of RFC 8032
    seed = bytes.fromhex("4ccd089b28ff96da9db6c346ec114e0f5b8a319f35aba624da8cf6ed4fb8a6fb")
    assert ed25519.public_key(seed).hex() == "3d4017c3e843895a92b70aa74d1b7ebc9c982ccf2ec4968cc0cd55f12af4660c"
    assert ed25519.sign(seed, b"\x72").hex() == "92a009a9f0d4cab8720e820b5f642540a2b27b5416503f8fb3762223ebdb69da085ac1e43e15996e458f3613d0f11d8c387b2eaeb4302aeeb00d291612bb0c00"


def test_roots_of_trees_of_any_size(spark):
    """Sizes around powers of two, against the recursion of the paper; leaves in any order, over many groups."""

    def root(leaves):
        if len(leaves) == 1:
            return hashlib.sha256(b"\0" + leaves[0]).digest()
        k = 1 << (len(leaves) - 1).bit_length() - 1
        return hashlib.sha256(b"\1" + root(leaves[:k]) + root(leaves[k:])).digest()

    leaf = lambda g, n: hashlib.sha256(f"{g}.{n}".encode()).digest()
    sizes = [1, 2, 3, 4, 5, 7, 8, 9, 31, 32, 33, 100, 255, 257, 600]
    rows = [(g, n, leaf(g, n).hex()) for g in sizes for n in range(g)]
    df = spark.createDataFrame(rows, "g int, leaf_no long, leaf string").repartition(7)
    found = chain.merkle_root(df, ["g"])
    assert {r.g: r.root for r in found.collect()} == {g: root([leaf(g, n) for n in range(g)]).hex() for g in sizes}
    assert chain.merkle_root(df.where("g = 1")).first().root == root([leaf(1, 0)]).hex()
    planned = chain.merkle_root(df, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert planned.count("Exchange hashpartitioning") == 2


def test_report_written_by_executors(spark, log, capsys):
    """The files of the folder, in order, are the text of the report; the status is what the command line goes by."""
    from ledgerframe import cli

    _, e, c = log
    other = [x.replace(ed25519.key_id(PUBLIC), f"{k:064d}") for k, x in enumerate(e)]
    for entries, most in ((e, 10), (other[:5] + [e[5].replace("span", "spam")] + other[6:], 3)):
        _, rows, place = kinds(spark, log, entries, c)
        cps = jsonl.read_checkpoints(spark, str(place / "cp"))
        status = verify.write_report(rows, cps, PUBLIC, str(place / "report"), most_ids=most)
        made = verify.report(rows, cps, PUBLIC)
        text = "".join(f.read_text() for f in sorted((place / "report").glob("part=*/part-*")))
        assert text == made.text(most_ids=most) and status == made.status()
        code = cli.main(["--key", PUBLIC.hex(), "--out", str(place / "again"), str(place / "log"), str(place / "cp")], spark)
        assert code == int("FAILED" in status) and capsys.readouterr().out.splitlines()[-1] == status
