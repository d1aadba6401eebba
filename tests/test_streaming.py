"""Assembly with its timers, and sealed batches that the verifier reads."""

import json
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerframe import cli
from ledgerframe.functions import ed25519
from ledgerframe.operators import stage, verify
from ledgerframe.sources import jsonl, otlp
from ledgerframe.streaming import assemble, emit, seal

KEY = bytes(range(32))
PUBLIC = ed25519.public_key(KEY)
SPANS = "trace_id string, span_id string, parent_span_id string, name string, kind int, start_time_unix_nano decimal(20,0), end_time_unix_nano decimal(20,0), status_code int, attributes array<struct<key:string,value:string>>, schema_version string"


@pytest.fixture
def one_partition(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")


class Stream:
    """A stream of SPAN rows through the assembly into memory."""

    def __init__(self, spark, place, name, timeout_ms):
        self.spark, self.place, self.name, self.n = spark, place, name, 0
        (place / "in").mkdir()
        stream = assemble.assemble(spark.readStream.schema(assemble.SPAN).parquet(str(place / "in")), timeout_ms)
        self.query = stream.writeStream.format("memory").queryName(name).option("checkpointLocation", str(place / "cp")).outputMode("append").start()

    def put(self, *rows):
        self.n += 1
        self.spark.createDataFrame(rows, assemble.SPAN).coalesce(1).write.parquet(str(self.place / f"made-{self.n}"))
        for f in (self.place / f"made-{self.n}").glob("part-*"):
            f.rename(self.place / "in" / f"{self.n}.parquet")

    def rows(self, n):
        """The output once it has n rows; timers keep such a query busy, so it never counts as processed."""
        end = time.monotonic() + 90
        while self.spark.table(self.name).count() < n and time.monotonic() < end:
            time.sleep(0.3)
        return [tuple(r) for r in self.spark.table(self.name).collect()]


def test_roots_late_spans_and_flush(spark, tmp_path, one_partition):
    s = Stream(spark, tmp_path, "assembled", 600_000)
    try:
        s.put(("t1", "b", "a", 1, "x"), ("t1", "a", "", 2, "y"), ("t1", "b", "a", 3, "again"), ("t2", "c", "z", 4, "w"), ("", "d", "", 5, "v"))
        complete = [("t1", "a", "", 2, "y", "complete"), ("t1", "b", "a", 3, "again", "complete")]
        assert sorted(s.rows(2)) == complete
        s.put(("t1", "e", "a", 6, "u"))
        assert sorted(s.rows(3)) == [*complete, ("t1", "e", "a", 6, "u", "late")]
    finally:
        s.query.stop()
    assert [tuple(r) for r in assemble.flushed(spark, str(tmp_path / "cp")).collect()] == [("t2", "c", "z", 4, "w", "partial")]


def test_timers(spark, tmp_path, one_partition):
    """An idle trace is emitted as partial; its memory ends two timeouts after that, whatever late spans come; then a
    root starts it anew."""
    s = Stream(spark, tmp_path, "timed", 4000)
    try:
        s.put(("t", "b", "a", 1, "x"))
        assert s.rows(1) == [("t", "b", "a", 1, "x", "partial")]
        emitted = time.monotonic()
        s.put(("t", "c", "a", 2, "y"))
        assert s.rows(2)[1][5] == "late"
        while time.monotonic() < emitted + 5:
            time.sleep(0.2)
        s.put(("t", "d", "a", 3, "z"))
        assert s.rows(3)[2][5] == "late"
        while time.monotonic() < emitted + 9.5:
            time.sleep(0.2)
        s.put(("t", "a", "", 4, "root"))
        assert s.rows(4)[3] == ("t", "a", "", 4, "root", "complete")
    finally:
        s.query.stop()


def packed(spark, *rows, segment="complete"):
    """Assembled spans from (trace, span, parent, version) rows."""
    made = [(t, s, p, f"n {s}", 1, Decimal(k), Decimal(k + 5), 1, [("gen_ai.operation.name", "chat")], v) for k, (t, s, p, v) in enumerate(rows)]
    return assemble.carried(spark.createDataFrame(made, SPANS), "start_time_unix_nano").withColumn("segment", F.lit(segment))


def traces(numbers, version=None):
    return [(f"{t:032x}", f"{s:016x}", "" if s == 0 else f"{0:016x}", version) for t in numbers for s in range(2)]


def sealer(place, **more):
    settings = seal.Settings(str(place / "log"), str(place / "cp"), **{"checkpoint_interval": 3} | more)
    return seal.Sealer(settings, T.StructType.fromDDL(SPANS), KEY, lambda: "2026-01-01T00:00:00Z")


def verified(spark, s):
    entries, torn = jsonl.read_entries(spark, s.settings.log_path)
    cps = jsonl.read_checkpoints(spark, s.settings.checkpoint_path)
    return entries, cps, [r.kind for r in verify.findings(entries, cps, PUBLIC, torn, strict_seq=True).collect()]


def test_sealed_batches_verify(spark, tmp_path, capsys):
    """Five batches, one repeated and one empty, with late spans, repeated spans and traces that can't be sealed."""
    s = sealer(tmp_path)
    s(packed(spark, *traces(range(4)), *traces([0])), 0)
    s(packed(spark, *traces(range(4, 6), "v2"), ("xyz", "s", "", None), *traces([70], "v99"), *traces([71], "v1"), *traces([71], "v3")), 3)
    for _ in range(2):
        s(packed(spark, *traces(range(6, 9))).unionByName(packed(spark, *traces([1]), segment="late")), 5)
    s(packed(spark).limit(0), 6)
    s(packed(spark, *traces([72], "v1")), 7)
    entries, cps, found = verified(spark, s)
    assert found == []
    assert entries.select("trace_id").distinct().count() == 10 and entries.count() == 20
    assert [(r.checkpoint_seq, len(r.trace_tips)) for r in cps.orderBy("checkpoint_seq").collect()] == [(1, 3), (2, 3), (3, 3)]
    assert {r.schema_version for r in entries.where("trace_id like '%48'").collect()} == {"v1"}
    left = s.passed(spark, 8)
    assert (left["sealed"], left["late"], left["quarantined"], len(left["pending"])) == (10, 2, 5, 1)
    aside = [json.loads(r.line) for r in jsonl.lines(spark, s.settings.quarantine_path).collect()]
    assert sorted((x["trace_id"][-2:], x["reason"][:8], x["schema_versions"], x["record"]["span_id"][-1:]) for x in aside) == [("46", "mixed or", ["v99"], "0"), ("46", "mixed or", ["v99"], "1"), ("47", "mixed or", ["v1", "v3"], "0"), ("47", "mixed or", ["v1", "v3"], "1"), ("yz", "no chain", ["v3"], "s")]
    assert cli.main(["--key", PUBLIC.hex(), s.settings.log_path, s.settings.checkpoint_path], spark) == 0
    assert "Status: OK" in capsys.readouterr().out
    # delivered again after its memory has ended, a trace becomes a second segment, which the verifier reports
    s(packed(spark, *traces([2])), 9)
    assert "duplicate_trace_segment" in verified(spark, s)[2]


def test_checkpoints_go_on_after_a_lost_state(spark, tmp_path):
    s = sealer(tmp_path)
    s(packed(spark, *traces(range(3))), 0)
    again = seal.Sealer(seal.Settings(s.settings.log_path, s.settings.checkpoint_path, str(tmp_path / "fresh"), checkpoint_interval=3), s.spans, KEY)
    again(packed(spark, *traces(range(3, 6))), 1)
    assert verified(spark, again)[2] == [] and verified(spark, again)[1].count() == 2


def test_checkpoints_that_cannot_be_written(spark, tmp_path, monkeypatch):
    """Entries are logged all the same; tips wait, are tried again later and later, and are dropped beyond the cap."""
    s = sealer(tmp_path, checkpoint_interval=2, max_pending=5, min_retry_ms=0)
    kept = seal.Sealer._commit

    def fails(*_):
        raise OSError("disk full")

    monkeypatch.setattr(seal.Sealer, "_commit", fails)
    for k in range(4):
        s(packed(spark, *traces(range(2 * k, 2 * k + 2))), k)
    left = s.passed(spark, 4)
    assert left["failures"] == 4 and left["cap_dropped"] == 3 and len(left["pending"]) == 5 and left["seq"] == 0
    assert [t["seal_no"] for t in left["pending"]] == [3, 4, 5, 6, 7]
    monkeypatch.setattr(seal.Sealer, "_commit", kept)
    s(packed(spark, *traces([8])), 4)
    entries, cps, found = verified(spark, s)
    assert found == [] and cps.count() == 3 and entries.select("trace_id").distinct().count() == 9
    assert verify.uncovered_traces(entries, cps).count() == 3 and s.passed(spark, 5)["failures"] == 0


def test_from_requests_to_a_verified_log(spark, tmp_path, one_partition):
    (tmp_path / "in").mkdir()
    span = lambda t, s: {"traceId": f"{t:032x}", "spanId": f"{s:016x}", "parentSpanId": "" if s == 0 else f"{0:016x}", "name": f"n<{s}>", "kind": 1, "startTimeUnixNano": str(10 * s), "endTimeUnixNano": str(10 * s + 5), "attributes": [{"key": "gen_ai.usage.input_tokens", "value": {"intValue": "3"}}]}
    request = lambda *spans: json.dumps({"resourceSpans": [{"scopeSpans": [{"spans": list(spans)}]}]})
    requests = otlp.spans(spark.readStream.text(str(tmp_path / "in"))).select("trace_id", "span_id", "parent_span_id", "name", "kind", "start_time_unix_nano", "end_time_unix_nano", "status_code", "attributes")
    settings = seal.Settings(str(tmp_path / "log"), str(tmp_path / "cps"), checkpoint_interval=2, timeout_ms=600_000)
    for k in range(3):
        (tmp_path / "in" / f"{k}.json").write_text("\n".join([request(*[span(t, 1) for t in range(3 * k, 3 * k + 3)]), request(*[span(t, 0) for t in range(3 * k, 3 * k + 3)])]))
        query = seal.start(requests, settings, str(tmp_path / "stream"), KEY)
        end = time.monotonic() + 90
        while sum(1 for _ in (tmp_path / "cps.state").glob("batch=*/_SUCCESS")) <= k and time.monotonic() < end:
            time.sleep(0.3)
        query.stop()
    entries, torn = jsonl.read_entries(spark, settings.log_path)
    cps = jsonl.read_checkpoints(spark, settings.checkpoint_path)
    assert torn is None and entries.count() == 18 and cps.count() == 4
    assert verify.findings(entries, cps, PUBLIC).count() == 0
    assert entries.where(F.size("selected_attributes") == 1).count() == 18


def parquet_file(spark, place, name, rows):
    """Spans (trace, span, parent, version) as a file of a stream's folder."""
    made = [(t, s, p, f"n {s}", 1, Decimal(k), Decimal(k + 5), 1, [("gen_ai.operation.name", "chat")], v) for k, (t, s, p, v) in enumerate(rows)]
    spark.createDataFrame(made, SPANS).coalesce(1).write.parquet(str(place / f"made-{name}"))
    (place / "in").mkdir(exist_ok=True)
    for f in (place / f"made-{name}").glob("part-*"):
        f.rename(place / "in" / f"{name}.parquet")


def run(spark, place, settings, **more):
    """All files of the folder through the stream."""
    stream = spark.readStream.schema(SPANS).parquet(str(place / "in"))
    seal.drain(seal.start(stream, settings, str(place / "stream"), KEY, **more), 120)


def ids(k):
    return f"{k:032x}"


def test_end_of_a_stream(spark, tmp_path, one_partition):
    """Open traces are sealed and short checkpoints written; a second end changes nothing, and a stream that goes on seals
    only what is new."""
    settings = seal.Settings(str(tmp_path / "log"), str(tmp_path / "cp"), checkpoint_interval=3, timeout_ms=600_000)
    end = lambda: seal.finish(spark, settings, T.StructType.fromDDL(SPANS), str(tmp_path / "stream"), KEY)
    s = seal.Sealer(settings, T.StructType.fromDDL(SPANS), KEY)
    parquet_file(spark, tmp_path, "a", [*traces(range(4)), (ids(8), "b", "x", None), (ids(8), "c", "x", None), (ids(9), "d", "x", None)])
    run(spark, tmp_path, settings)
    assert len(s.passed(spark, 99)["pending"]) == 1
    end()
    entries, cps, found = verified(spark, s)
    assert found == [] and s.passed(spark, 99)["pending"] == [] and entries.count() == 11
    assert [len(r.trace_tips) for r in cps.orderBy("checkpoint_seq").collect()] == [3, 3]
    end()
    assert verified(spark, s)[0].count() == 11
    # trace 9 comes out of the state without anything new, trace 8 with a root
    parquet_file(spark, tmp_path, "b", [(ids(8), "x", "", None), (ids(10), "y", "", None)])
    run(spark, tmp_path, settings)
    end()
    entries, cps, found = verified(spark, s)
    # two chains under one id are all that the verifier reports
    assert {r.trace_id for r in verify.findings(entries, cps, PUBLIC, strict_seq=True).collect()} == {ids(8)}
    assert "duplicate_trace_segment" in found
    assert sorted((r.trace_id, r.span_id) for r in entries.collect() if r.trace_id in (ids(8), ids(9), ids(10))) == [(ids(8), "b"), (ids(8), "c"), (ids(8), "x"), (ids(9), "d"), (ids(10), "y")]
    got = {(r.trace_id, r.segment_no): r.entry_count for r in seal.segments(spark, settings).collect()}
    assert (got[ids(8), 0], got[ids(8), 1], got[ids(9), 0], got[ids(10), 0], len(got)) == (2, 1, 1, 1, 8)
    assert cps.count() == 3 and s.passed(spark, 99)["pending"] == []


def test_an_end_that_fails_is_taken_back(spark, tmp_path, one_partition, monkeypatch):
    settings = seal.Settings(str(tmp_path / "log"), str(tmp_path / "cp"), checkpoint_interval=3, timeout_ms=600_000)
    s = seal.Sealer(settings, T.StructType.fromDDL(SPANS), KEY)
    parquet_file(spark, tmp_path, "a", [*traces(range(2)), (ids(8), "b", "x", None)])
    run(spark, tmp_path, settings)

    def fails(*_):
        raise OSError("disk full")

    with monkeypatch.context() as m:
        m.setattr(seal.Sealer, "_commit", fails)
        with pytest.raises(OSError):
            s.finish(spark, str(tmp_path / "stream"))
    parquet_file(spark, tmp_path, "b", [(ids(8), "x", "", None)])
    run(spark, tmp_path, settings)
    s.finish(spark, str(tmp_path / "stream"))
    entries, cps, found = verified(spark, s)
    assert found == [] and entries.count() == 6 and [r.segment_no for r in seal.segments(spark, settings).collect()] == [0, 0, 0]
    assert cps.count() == 1


WAL_LINE = '{{"type":"span","trace_id":"{0}","record":{{"schema_version":"{2}","trace_id":"{0}","span_id":"{1}","parent_span_id":"{3}","seq_in_trace":0,"start_time_unix_nano":{4},"end_time_unix_nano":{4},"span_name":"from the log","otel_kind":"Client","gen_ai_operation":"chat","audit_kind":"task","selected_attributes":[{{"key":"gen_ai.system","value":"s"}}],"status":"Ok"}}}}'


def test_restart_from_a_write_ahead_log(spark, tmp_path, one_partition):
    """A trace that is half in the log and half in the stream is one chain; tips without a checkpoint get one; traces of
    other versions are sealed as they are or set aside."""
    span = lambda t, s, v="v3", parent="r": WAL_LINE.format(ids(t), s, v, parent, "5" if v in ("v1", "v2") else '"5"')
    lines = [
        '{"type":"span","torn', span(1, "a"), span(1, "b", "v2"), span(1, "a", "v2"), span(2, "c", "v1"), span(3, "d", "v1"), span(3, "e", "v3"), span(4, "f", "v9"), span(6, "g"),
        span(5, "h", parent=""), f'{{"type":"sealed","trace_id":"{ids(5)}","tip_hash":"{"7" * 64}","entry_count":1}}', span(7, "i", parent=""),
    ]
    (tmp_path / "wal").write_text("\n".join(lines) + "\n")
    settings = seal.Settings(str(tmp_path / "log"), str(tmp_path / "cp"), checkpoint_interval=3, timeout_ms=600_000)
    s = seal.Sealer(settings, T.StructType.fromDDL(SPANS), KEY)
    parquet_file(spark, tmp_path, "a", [(ids(1), "r", "", None), (ids(2), "late", "c", None), (ids(8), "x", "", None), (ids(7), "i", "", None)])
    run(spark, tmp_path, settings, wal_lines=jsonl.read_wal(spark, str(tmp_path / "wal")))
    left = s.passed(spark, 99)
    assert (left["quarantined"], left["late"], left["sealed"]) == (3, 1, 5)
    s.finish(spark, str(tmp_path / "stream"))
    entries, cps, found = verified(spark, s)
    rows = sorted((int(r.trace_id, 16), r.span_id, r.schema_version, r.span_name) for r in entries.collect())
    log = "from the log"
    assert rows == [(1, "a", "v3", log), (1, "b", "v3", log), (1, "r", "v3", "n r"), (2, "c", "v1", log), (6, "g", "v3", log), (7, "i", "v3", "n i"), (8, "x", "v3", "n x")]
    tips = [t for r in cps.collect() for t in r.trace_tips]
    assert sorted(int(t.trace_id, 16) for t in tips) == [1, 2, 5, 6, 7, 8]
    # the tip of the trace whose entries an older log holds is all that this log can't confirm
    assert sorted(set(found)) == ["entry_count_mismatch", "tip_hash_mismatch"] or set(found) == {"entry_count_mismatch"}
    with pytest.raises(ValueError):
        s.begin(spark, jsonl.read_wal(spark, str(tmp_path / "wal")))


def test_segments_over_batches_and_merges(spark, tmp_path, monkeypatch):
    """A trace that is delivered again gets the next number, a batch that is repeated the same ones, also when tables of
    earlier batches were merged; working folders don't grow with the batches."""
    monkeypatch.setattr("ledgerframe.streaming.segments.FAN", 2)
    s = sealer(tmp_path)
    place = spark.sparkContext.getCheckpointDir() or stage.shared_dir(spark)
    counts = []
    for k, who in enumerate([(0, 1), (1, 2), (1, 3), (4,), (2, 1)]):
        for _ in range(1 + (k == 2)):
            s(packed(spark, *traces(who)), k)
        counts.append((len(stage.listed(spark, place)), len(stage.listed(spark, s.settings.state)), len(stage.listed(spark, s.settings.segments_path))))
    got = sorted((int(r.trace_id, 16), r.segment_no) for r in seal.segments(spark, s.settings).collect())
    assert got == [(0, 0), (1, 0), (1, 1), (1, 2), (1, 3), (2, 0), (2, 1), (3, 0), (4, 0)]
    assert len({c[0] for c in counts}) == 1 and max(c[1] for c in counts) <= 4 and max(c[2] for c in counts) <= 4


def test_scopes_are_emitted_as_the_batch_groups_them(spark, tmp_path, one_partition):
    """Traces of two resources and three scopes, of which one comes in two files; then a late span."""
    (tmp_path / "in").mkdir()
    pair = lambda k, v: {"key": k, "value": {"stringValue": v}}
    span = lambda t, s: {"traceId": f"{t:032x}", "spanId": f"{s:016x}", "parentSpanId": "" if s == 0 else f"{0:016x}", "name": f"n{s}"}
    scope = lambda n, *spans: {"scope": {"name": n, "version": "1", "attributes": [pair("s", n)]}, "spans": list(spans)}
    resource = lambda host, *scopes: {"resource": {"attributes": [pair("z", "1"), pair("host", host)]}, "schemaUrl": "u", "scopeSpans": list(scopes)}
    files = [
        [resource("a", scope("x", span(1, 1), span(2, 3)), scope("y", span(1, 2))), resource("b", scope("x", span(1, 3)))],
        [resource("a", scope("x", span(1, 0), span(2, 0), span(2, 3)))],
        [resource("a", scope("x", span(1, 9)))],
    ]
    out, checkpoint = tmp_path / "out", str(tmp_path / "cp")
    requests = lambda read: otlp.spans(read.text(str(tmp_path / "in")))
    for k, request in enumerate(files):
        (tmp_path / "in" / f"{k}.json").write_text(json.dumps({"resourceSpans": request}))
        seal.drain(emit.start(requests(spark.readStream), str(out), checkpoint, 600_000), 120)
    got = spark.read.option("recursiveFileLookup", "true").parquet(str(out))
    late = F.col("span_id") == f"{9:016x}"
    whole = requests(spark.read).dropDuplicates(["trace_id", "span_id"]).withColumn("segment", F.when(late, "late").otherwise("complete"))
    want = otlp.regrouped(whole, *[c for c in whole.columns if c not in emit.OUTSIDE])
    rows = lambda df: sorted(str(r.asDict(recursive=True)) for r in df.select(*sorted(df.columns)).collect())
    assert rows(got) == rows(want) and got.count() == 5
    assert [len(r.spans) for r in got.where("segment = 'late'").collect()] == [1]


def test_batches_of_a_log_are_merged(spark, tmp_path, monkeypatch):
    """Lines and their numbers stay, folders are few, and a merge that was cut short at any place is no harm."""
    monkeypatch.setattr(jsonl, "FAN", 3)
    log, want = tmp_path / "log", []

    def put(name, n):
        (log / name).mkdir(parents=True)
        for part in range(2):
            some = [f'{{"b":"{name}","n":{k}}}' for k in range(part, n, 2)]
            want.extend(some)
            (log / name / f"part-0000{part}.txt").write_text("".join(f"{x}\n" for x in some))
        (log / name / "_SUCCESS").write_text("")

    def read():
        return [r.line for r in jsonl.numbered(jsonl.lines(spark, str(log))).orderBy("line_no").collect()]

    jsonl.compact(spark, str(log), jsonl.batch_name(0))  # no log yet
    put(jsonl.batch_name("-begin"), 3)
    for k in range(12):
        put(jsonl.batch_name(k), k % 4)
        if k == 4:
            put(jsonl.batch_name("000000000004_end"), 2)
        jsonl.compact(spark, str(log), jsonl.batch_name(k))
        assert jsonl.batch_name(k) in {p.name for p in log.iterdir()}
    assert read() == want and len(list(log.iterdir())) <= 6 and any(".2." in p.name for p in log.iterdir())
    # sources that are still there, and a merged folder that isn't whole
    before = sorted(p.name for p in log.iterdir())
    (log / "batch=000000000001").mkdir()
    (log / "batch=000000000001" / "part-00000.txt").write_text("again\n")
    (log / "batch=000000000011.1.000000000010").mkdir()
    (log / "batch=000000000011.1.000000000010" / "part-00000.txt").write_text("half\n")
    assert read() == want
    monkeypatch.setattr(jsonl, "FAN", 8)
    jsonl.compact(spark, str(log), jsonl.batch_name(12))
    assert sorted(p.name for p in log.iterdir()) == before and read() == want
    # a merge that doesn't give what its sources hold leaves them
    monkeypatch.setattr(jsonl, "FAN", 1)
    monkeypatch.setattr(jsonl, "_digest", lambda rows, n=iter(range(9)): (next(n), 0))
    with pytest.raises(jsonl.MalformedLine):
        jsonl.compact(spark, str(log), jsonl.batch_name(12))
    assert sorted(p.name for p in log.iterdir()) == before and read() == want


def test_settings(tmp_path):
    s = seal.Settings("log", "cp", checkpoint_interval=0, timeout_ms=0)
    assert (s.interval, s.pending_cap, s.timeout, s.key()) == (100, 1000, 30_000, None)
    for bad in (("", "cp"), ("log", "log"), ("log", "log.quarantine"), ("log", "cp", "cp"), ("log", "cp", "", "log")):
        with pytest.raises(ValueError):
            seal.Settings(*bad)
    for more in ({"max_pending": 5}, {"timeout_ms": 0.5}, {"timeout_ms": -1}, {"min_retry_ms": -1}):
        with pytest.raises(ValueError):
            seal.Settings("log", "cp", **more)
    (tmp_path / "key").write_text(ed25519.private_pem(KEY))
    assert seal.Settings("log", "cp", key_path=str(tmp_path / "key")).key() == KEY
    assert stage.kept is not None
