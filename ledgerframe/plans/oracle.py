"""DuckDB SQL for the registered queries, built from shared parts."""

from __future__ import annotations

from ..functions.jsonbytes import ESCAPES
from ..operators.records import ALLOWED, KINDS, STATUSES


def text(value: str) -> str:
    """A SQL string; characters outside printable ASCII as chr()."""
    if all(" " <= c <= "~" for c in value):
        return "'" + value.replace("'", "''") + "'"
    return "(" + " || ".join(f"chr({ord(c)})" for c in value) + ")"


def json_string(x: str) -> str:
    for raw, written in ESCAPES:
        if raw != "\0":
            x = f"replace({x}, {text(raw)}, {text(written)})"
    return f"('\"' || {x} || '\"')"


def _hex(x: str, width: int) -> str:
    return f"lower(lpad(to_hex({x}), {width}, '0'))"


def _name(x: str, names: tuple[str, ...]) -> str:
    return "CASE " + " ".join(f"WHEN {x} = {k} THEN '{n}'" for k, n in enumerate(names)) + " ELSE '' END"


_PAIRS = {"gen_ai.system": "'<own>'", "gen_ai.operation.name": "coalesce(op, 'second')", "gen_ai.guardrail.name": "CASE WHEN event_id % 11 = 0 THEN 'guard-' || (event_id % 3) END"}
_ATTRIBUTES = ", ".join(f"CASE WHEN {_PAIRS[k]} IS NOT NULL THEN '{{\"key\":\"{k}\",\"value\":' || {json_string(_PAIRS[k])} || '}}' END" for k in ALLOWED if k in _PAIRS)

#: Records of the events, in order within their trace, with their canonical bytes.
RECORDS = f"""
e AS (SELECT *, CASE event_type WHEN 'click' THEN 'execute_tool' WHEN 'purchase' THEN 'tool_call' WHEN 'signup' THEN 'handoff' WHEN 'view' THEN 'chat' END AS op,
  epoch_us(ts) * 1000 AS t0, first_value(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS root FROM events),
r AS (SELECT 'v3' AS schema_version, {_hex('user_id', 32)} AS trace_id, {_hex('event_id', 16)} AS span_id, CASE WHEN event_id = root THEN '' ELSE {_hex('root', 16)} END AS parent_span_id,
  t0 AS start_ns, t0 + 1000 * (event_id % 500) AS end_ns, event_type AS span_name, {_name('event_id % 7', KINDS)} AS otel_kind, coalesce(op, 'second') AS gen_ai_operation,
  CASE WHEN event_id % 11 = 0 THEN 'guardrail' WHEN op IN ('execute_tool', 'tool_call') THEN 'tool' WHEN op = 'handoff' THEN 'handoff' WHEN event_type = 'error' THEN 'error' ELSE 'task' END AS audit_kind,
  '[' || concat_ws(',', {_ATTRIBUTES}) || ']' AS attributes_json,
  {_name("(CASE event_type WHEN 'error' THEN 2 WHEN 'purchase' THEN 1 ELSE 0 END)", STATUSES)} AS status, event_id, user_id FROM e),
s AS (SELECT *, row_number() OVER (PARTITION BY trace_id ORDER BY start_ns, span_id) - 1 AS seq_in_trace FROM r),
c AS (SELECT *, '{{"schema_version":"v3","trace_id":"' || trace_id || '","span_id":"' || span_id || '","parent_span_id":"' || parent_span_id || '","seq_in_trace":' || seq_in_trace || ',"start_time_unix_nano":"' || start_ns || '","end_time_unix_nano":"' || end_ns
  || '","span_name":' || {json_string('span_name')} || ',"otel_kind":"' || otel_kind || '","gen_ai_operation":"' || gen_ai_operation || '","audit_kind":"' || audit_kind || '","selected_attributes":' || attributes_json || ',"status":"' || status || '"}}' AS bytes FROM s)
"""
#: All hashes of a chain as one text of 64 digits each, the seed first.
CHAINS = (
    RECORDS
    + """,
h AS (SELECT trace_id, count(*) AS entry_count, list_reduce(list(bytes ORDER BY seq_in_trace), lambda a, x: a || sha256(encode(x) || unhex(right(a, 64))), sha256(unhex(trace_id) || encode('v3'))) AS hashes FROM c GROUP BY trace_id),
tips AS (SELECT trace_id, entry_count, right(hashes, 64) AS tip_hash FROM h)
"""
)
_TIP = """'{"trace_id":"' || trace_id || '","tip_hash":"' || tip_hash || '","entry_count":' || entry_count || '}'"""
CHECKPOINTS = (
    CHAINS
    + f""",
no AS (SELECT *, row_number() OVER (ORDER BY trace_id) - 1 AS seal_no FROM tips),
b AS (SELECT *, seal_no // 20 + 1 AS checkpoint_seq FROM no),
p AS (SELECT checkpoint_seq, '[' || string_agg({_TIP}, ',' ORDER BY trace_id) || ']' AS tips_json FROM b GROUP BY checkpoint_seq),
q AS (SELECT checkpoint_seq, '{{"schema_version":"v3","checkpoint_seq":' || checkpoint_seq || ',"timestamp":"2026-01-01T00:00:00Z","prev_checkpoint_hash":"' AS head, '","trace_tips":' || tips_json || ',"key_id":"k","algorithm":"ed25519"}}' AS tail FROM p),
f AS (SELECT list_reduce(list(head || '@' || tail ORDER BY checkpoint_seq), lambda a, x: a || sha256(encode(replace(x, '@', right(a, 64)))), repeat('0', 64)) AS links FROM q),
k AS (SELECT checkpoint_seq, substr(links, CAST((checkpoint_seq - 1) * 64 + 1 AS BIGINT), 64) AS prev_checkpoint_hash, tips_json FROM p, f)
"""
)
#: A log in which some entries were edited, some repeated and one trace in seven dropped, and checkpoints before that.
TAMPERED = (
    CHECKPOINTS
    + """,
st AS (SELECT user_id, trace_id, count(*) AS n0, bool_or(event_id % 997 = 0) AS edited, bool_or(event_id % 991 = 0) AS repeated, count(*) + count(*) FILTER (event_id % 991 = 0) AS n FROM c WHERE user_id % 7 <> 3 GROUP BY user_id, trace_id),
cs AS (SELECT st.*, tips.tip_hash AS tip, CASE WHEN repeated THEN 'dup' WHEN edited THEN 'bad' ELSE 'ok' END AS state FROM st JOIN tips USING (trace_id)),
made AS (SELECT * REPLACE (CASE WHEN seal_no % 13 = 5 THEN repeat('a', 64) ELSE tip_hash END AS tip_hash) FROM b),
m AS (SELECT made.checkpoint_seq, made.trace_id, made.entry_count, made.tip_hash, coalesce(cs.n, 0) AS n, cs.state, cs.tip FROM made LEFT JOIN cs USING (trace_id))
"""
)


def _links(tips: str) -> str:
    """``lk``: checkpoints over a table of tips, every third with a link to nothing, and what each should link to."""
    return f"""
lp AS (SELECT checkpoint_seq, '[' || string_agg({_TIP}, ',' ORDER BY trace_id) || ']' AS tips_json FROM {tips} GROUP BY checkpoint_seq),
lq AS (SELECT checkpoint_seq, '{{"schema_version":"v3","checkpoint_seq":' || checkpoint_seq || ',"timestamp":"2026-01-01T00:00:00Z","prev_checkpoint_hash":"' AS head, '","trace_tips":' || tips_json || ',"key_id":"k","algorithm":"ed25519"}}' AS tail FROM lp),
lf AS (SELECT list_reduce(list(head || '@' || tail ORDER BY checkpoint_seq), lambda a, x: a || sha256(encode(replace(x, '@', right(a, 64)))), repeat('0', 64)) AS links FROM lq),
ls AS (SELECT checkpoint_seq, head, tail, CASE WHEN checkpoint_seq % 3 = 2 THEN repeat('b', 64) ELSE substr(links, CAST((checkpoint_seq - 1) * 64 + 1 AS BIGINT), 64) END AS prev_checkpoint_hash FROM lq, lf),
lk AS (SELECT checkpoint_seq, prev_checkpoint_hash, coalesce(lag(sha256(encode(head || prev_checkpoint_hash || tail))) OVER (ORDER BY checkpoint_seq), repeat('0', 64)) AS expected_prev FROM ls)
"""


_WAL = f"""
w AS (SELECT event_id AS line_no, CASE WHEN event_id % 100 = 97 THEN 'sealed' ELSE 'span' END AS type, {_hex('user_id', 32)} AS trace_id, CASE WHEN event_id % 100 <> 97 THEN {_hex('event_id % 13', 16)} END AS span_id,
  CASE WHEN event_id % 100 <> 97 THEN CASE WHEN user_id % 10 < 5 THEN 'v3' WHEN user_id % 10 < 7 THEN (CASE WHEN event_id % 2 = 0 THEN 'v2' ELSE 'v3' END) WHEN user_id % 10 < 8 THEN 'v1' WHEN user_id % 10 < 9 THEN (CASE WHEN event_id % 3 = 0 THEN 'v1' ELSE 'v3' END) ELSE 'v99' END END AS schema_version,
  CASE WHEN event_id % 100 = 97 THEN CASE WHEN event_id % 3 = 0 THEN '' ELSE sha256(encode(CAST(event_id AS VARCHAR))) END END AS tip_hash, CASE WHEN event_id % 100 = 97 THEN event_id % 5 END AS entry_count FROM events),
live AS (SELECT * FROM (SELECT *, max(CASE WHEN type = 'sealed' THEN line_no END) OVER (PARTITION BY trace_id) AS last FROM w) WHERE type = 'span' AND line_no > coalesce(last, -1)),
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trace_id, span_id ORDER BY line_no DESC) AS rn FROM live) WHERE rn = 1),
t AS (SELECT trace_id, count(*) AS n_spans, bool_or(span_id = repeat('0', 16)) AS has_root, list_sort(list(DISTINCT schema_version)) AS vs FROM d GROUP BY trace_id),
a AS (SELECT trace_id, n_spans, has_root, array_to_string(vs, ',') AS versions, CASE WHEN len(list_filter(vs, lambda v: v NOT IN ('v2', 'v3'))) = 0 THEN 'restamp' WHEN len(vs) = 1 AND vs[1] IN ('v1', 'v2', 'v3') THEN 'seal' ELSE 'quarantine' END AS action FROM t)
"""
_ORDERS = f"""
o AS (SELECT {_hex('o_orderkey', 32)} AS trace_id, repeat('0', 15) || 'f' AS span_id, '' AS parent_span_id, 'order ' || o_orderstatus AS span_name, epoch_us(o_orderdate) * 1000 AS t, '' AS arrival FROM orders
 UNION ALL SELECT {_hex('l_orderkey', 32)}, {_hex('l_linenumber', 16)}, repeat('0', 15) || 'f', 'line ' || l_returnflag, epoch_us(l_shipdate) * 1000,
 concat_ws('|', l_partkey, l_suppkey, l_returnflag, l_linestatus, CAST(round(l_quantity * 100) AS BIGINT), CAST(round(l_extendedprice * 100) AS BIGINT), CAST(round(l_discount * 100) AS BIGINT), CAST(round(l_tax * 100) AS BIGINT), epoch_us(l_shipdate) * 1000) FROM lineitem),
x AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trace_id, span_id ORDER BY arrival DESC, span_name DESC, t DESC) AS rn FROM o) WHERE rn = 1)
"""
_ONE_ROOT = "SELECT trace_id, bool_or(parent_span_id = '') AS has_root, count(*) AS n_spans FROM {} GROUP BY trace_id"
_TIMES = "CASE WHEN event_id % 6 = 0 THEN '\"' || event_id || '\"' WHEN event_id % 6 = 1 THEN '0' || event_id WHEN event_id % 6 = 2 THEN '18446744073709551615' WHEN event_id % 6 = 3 THEN '\"18446744073709551616\"' WHEN event_id % 6 = 4 THEN 'null' ELSE event_id || '.0' END"
_MERKLE = [f"SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS n, sha256(unhex('00') || unhex(sha256(encode(CAST(event_id AS VARCHAR))))) AS h FROM events"]
for _ in range(12):
    _MERKLE.append(f"SELECT user_id, n // 2 AS n, CASE WHEN max(CASE WHEN n % 2 = 1 THEN h END) IS NULL THEN max(CASE WHEN n % 2 = 0 THEN h END) ELSE sha256(unhex('01') || unhex(max(CASE WHEN n % 2 = 0 THEN h END)) || unhex(max(CASE WHEN n % 2 = 1 THEN h END))) END AS h FROM m{len(_MERKLE) - 1} GROUP BY user_id, n // 2")

_FINDINGS = """
SELECT trace_id, kind, 'fatal' AS severity, n FROM (
 SELECT trace_id, CASE state WHEN 'dup' THEN 'duplicate_trace_segment' ELSE 'chain' END AS kind, CAST(1 AS BIGINT) AS n FROM cs WHERE state <> 'ok'
 UNION ALL SELECT trace_id, 'entry_count_mismatch', CAST(1 AS BIGINT) FROM m WHERE n <> entry_count
 UNION ALL SELECT trace_id, 'tip_hash_unverifiable', CAST(1 AS BIGINT) FROM m WHERE state IN ('dup', 'bad')
 UNION ALL SELECT trace_id, 'tip_hash_mismatch', CAST(1 AS BIGINT) FROM m WHERE state = 'ok' AND tip <> tip_hash
 UNION ALL SELECT '', 'checkpoint', count(*) FROM lk WHERE prev_checkpoint_hash <> expected_prev HAVING count(*) > 0)
"""

_quarter = "CASE WHEN event_id % 4 = 0 THEN CAST(event_id // 4 AS VARCHAR) ELSE CAST(event_id / 4 AS VARCHAR) END"
#: Records whose attributes also came as numbers and booleans; these stand before others in the order of the list.
_MORE = _PAIRS | {"gen_ai.request.model": "CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END", "gen_ai.usage.input_tokens": "CAST(event_id AS VARCHAR)", "gen_ai.usage.output_tokens": _quarter}
_EVERY = ", ".join(f"CASE WHEN {_MORE[k]} IS NOT NULL THEN '{{\"key\":\"{k}\",\"value\":' || {json_string(_MORE[k])} || '}}' END" for k in ALLOWED if k in _MORE)
_TYPED = RECORDS + f", typed AS (SELECT r.* REPLACE ('[' || concat_ws(',', {_EVERY.replace('event_id', 'r.event_id')}) || ']' AS attributes_json) FROM r JOIN (SELECT event_id AS own, op FROM e) ON own = r.event_id)"

SQL = {
    "ag10_chain_tips": f"WITH {CHAINS} SELECT trace_id, entry_count, tip_hash FROM tips",
    "ag9_chain_hashes": f"WITH {CHAINS} SELECT c.trace_id, CAST(c.seq_in_trace AS BIGINT) AS seq, substr(h.hashes, CAST(c.seq_in_trace * 64 + 65 AS BIGINT), 64) AS entry_hash, substr(h.hashes, CAST(c.seq_in_trace * 64 + 1 AS BIGINT), 64) AS prev_hash FROM c JOIN h USING (trace_id)",
    "prj1_span_to_record": f"WITH {RECORDS} SELECT schema_version, trace_id, span_id, parent_span_id, CAST(start_ns AS VARCHAR) AS start_ns, CAST(end_ns AS VARCHAR) AS end_ns, span_name, otel_kind, gen_ai_operation, audit_kind, status FROM r",
    "prj2_selected_attributes": f"WITH {RECORDS} SELECT span_id, attributes_json FROM r",
    "prj4_operation_counts": f"WITH {RECORDS} SELECT gen_ai_operation, count(*) AS n FROM r GROUP BY gen_ai_operation",
    "prj5_audit_kind_counts": f"WITH {RECORDS} SELECT audit_kind, status, count(*) AS n FROM r GROUP BY audit_kind, status",
    "prj6_kind_names": f"WITH {RECORDS} SELECT otel_kind, count(*) AS n FROM r GROUP BY otel_kind",
    "prj9_key_fingerprint": "SELECT user_id, sha256(unhex(sha256(encode('key' || user_id)))) AS key_id FROM (SELECT DISTINCT user_id FROM events)",
    "flt1_nonempty_traces": "SELECT event_type, count(*) AS n FROM events WHERE user_id % 9 <> 0 GROUP BY event_type",
    "flt2_roots": f"WITH {RECORDS} SELECT trace_id, span_id FROM r WHERE parent_span_id = ''",
    "flt4_version_classes": "SELECT v AS schema_version, v IN ('v1', 'v2') AS numeric_times, v IN ('v2', 'v3') AS restampable, v IN ('v1', 'v2', 'v3') AS implemented FROM (SELECT DISTINCT 'v' || (user_id % 6) AS v FROM events)",
    "flt7_fatal_count": "SELECT CAST(count(*) FILTER (s IS DISTINCT FROM 'advisory') AS BIGINT) AS fatal FROM (SELECT CASE WHEN event_id % 3 = 0 THEN 'advisory' WHEN event_id % 3 = 1 THEN 'odd' END AS s FROM events)",
    "jn1_entry_count_mismatch": f"WITH {TAMPERED} SELECT checkpoint_seq, trace_id, entry_count, n AS logged FROM m WHERE n <> entry_count",
    "jn2_tip_unverifiable": f"WITH {TAMPERED} SELECT checkpoint_seq, trace_id, tip_hash FROM m WHERE state IN ('dup', 'bad')",
    "jn3_tip_mismatch": f"WITH {TAMPERED} SELECT checkpoint_seq, trace_id, tip_hash, tip FROM m WHERE state = 'ok' AND tip <> tip_hash",
    "jn4_wal_compact": f"WITH {_WAL} SELECT phase, line_no, trace_id FROM (SELECT 0 AS phase, line_no, trace_id FROM w WHERE type = 'sealed' AND tip_hash <> '' AND line_no % 4 = 1 UNION ALL SELECT 1, line_no, trace_id FROM live)",
    "jn5_open_traces": f"WITH {RECORDS} SELECT trace_id, count(*) AS n FROM r WHERE user_id % 3 <> 0 GROUP BY trace_id",
    "jn6_late_spans": f"WITH {RECORDS} SELECT trace_id, span_id FROM r WHERE user_id % 3 = 0",
    "jn7_own_tip_pending": f"WITH {CHECKPOINTS} SELECT trace_id, tip_hash FROM no WHERE seal_no % 4 = 2",
    "jn8_uncovered_traces": f"WITH {CHECKPOINTS} SELECT DISTINCT trace_id FROM b WHERE checkpoint_seq % 2 = 0",
    "ag1_entries_by_trace": f"WITH {RECORDS} SELECT trace_id, count(*) AS n, min(start_ns) AS first_ns, max(end_ns) AS last_ns FROM r GROUP BY trace_id",
    "ag2_dedupe_last_wins": f"WITH {_ORDERS} SELECT trace_id, span_id, span_name, arrival FROM x",
    "ag3_processed": f"WITH {CHECKPOINTS} SELECT (SELECT count(DISTINCT trace_id) FROM c) AS traces, (SELECT count(*) FROM p) AS checkpoints",
    "ag4_duplicate_segments": f"WITH {TAMPERED} SELECT trace_id FROM cs WHERE state = 'dup'",
    "ag5_other_key_ids": "SELECT DISTINCT k AS key_id FROM (SELECT 'key' || (event_id % 5) AS k FROM events UNION ALL SELECT CASE WHEN user_id % 2 = 0 THEN '' ELSE 'cp' || (user_id % 4) END FROM events) WHERE k <> '' AND k <> 'key0'",
    "ag6_version_sets": f"WITH {_WAL} SELECT trace_id, n_spans, versions FROM a",
    "ag7_restampable": f"WITH {_WAL} SELECT trace_id, action = 'restamp' AS restampable FROM a",
    "ag8_has_root": f"WITH {_ORDERS} " + _ONE_ROOT.format("x"),
    "ag11_merkle_root": "WITH " + ", ".join(f"m{k} AS ({q})" for k, q in enumerate(_MERKLE)) + f" SELECT user_id, CASE WHEN user_id % 5 <> 0 THEN h END AS root, CASE WHEN user_id % 5 = 0 THEN 'EMPTY_BATCH' END AS reject FROM m{len(_MERKLE) - 1}",
    "ag12_status_lines": "SELECT user_id, CASE WHEN f = 0 AND a = 0 THEN 'Status: OK' WHEN f = 0 THEN 'Status: OK (' || a || ' advisory finding(s))' WHEN a = 0 THEN 'Status: FAILED (' || f || ' error(s))' ELSE 'Status: FAILED (' || f || ' fatal, ' || a || ' advisory)' END AS status FROM (SELECT user_id, count(*) FILTER (event_type = 'error' AND event_id % 5 = 0) AS f, count(*) FILTER (event_type = 'view' AND event_id % 7 = 0) AS a FROM events GROUP BY user_id)",
    "ag13_pending_sets": f"WITH {_WAL} SELECT trace_id, array_to_string(list_sort(list(DISTINCT tip_hash)), ',') AS tips FROM w WHERE tip_hash <> '' GROUP BY trace_id",
    "wn1_seq_in_trace": f"WITH {RECORDS} SELECT trace_id, span_id, CAST(seq_in_trace AS BIGINT) AS seq FROM s",
    "wn3_checkpoint_link": f"WITH {CHECKPOINTS} SELECT checkpoint_seq, prev_checkpoint_hash FROM k",
    "wn4_adjacent_duplicates": "SELECT user_id, event_id % 50 AS seq, count(*) - 1 AS repeats FROM events GROUP BY user_id, event_id % 50 HAVING count(*) > 1",
    "wn5_checkpoint_batches": f"WITH {CHECKPOINTS} SELECT trace_id, CAST(checkpoint_seq AS BIGINT) AS checkpoint_seq FROM b",
    "wn6_wal_replay": f"WITH {_WAL} SELECT line_no, trace_id, span_id, schema_version FROM live",
    "vf1_chain_states": f"WITH {TAMPERED} SELECT trace_id, CAST(n AS BIGINT) AS n, state FROM cs",
    "vf3_checkpoint_links": f"WITH {CHECKPOINTS}, {_links('b')} SELECT checkpoint_seq, prev_checkpoint_hash, expected_prev FROM lk WHERE prev_checkpoint_hash <> expected_prev",
    "vf2_signatures": f"""WITH {RECORDS}, x AS (SELECT trace_id, seq_in_trace, CASE WHEN event_id % 89 = 0 THEN 'unsupported algorithm "rsa"' WHEN event_id % 83 = 0 THEN 'decode signature: illegal base64 data' WHEN event_id % 97 = 0 THEN 'signature verification failed' END AS wrong FROM s),
  y AS (SELECT trace_id, count(*) AS n, min(seq_in_trace) FILTER (wrong IS NOT NULL) AS k FROM x GROUP BY trace_id)
  SELECT y.trace_id, y.n, CASE WHEN k IS NOT NULL THEN 'entry ' || k || ': ' || wrong END AS error, k IS NULL AS verified FROM y LEFT JOIN x ON x.trace_id = y.trace_id AND x.seq_in_trace = y.k""",
    "vf4_findings": f"WITH {TAMPERED}, {_links('made')} {_FINDINGS}",
    "vf6_key_id_mismatch": f"WITH {TAMPERED} SELECT c.trace_id, c.span_id, 'other' AS key_id FROM c JOIN cs USING (trace_id) WHERE cs.state = 'ok' AND c.event_id % 5 = 1",
    "so2_checkpoint_tips": f"WITH {CHECKPOINTS} SELECT checkpoint_seq, tips_json FROM p",
    "so4_sorted_spans": f"WITH {RECORDS} SELECT trace_id, string_agg(span_id, ',' ORDER BY span_id) AS spans FROM r GROUP BY trace_id",
    "src4_last_checkpoint": f"WITH {CHECKPOINTS} SELECT checkpoint_seq, prev_checkpoint_hash FROM k WHERE checkpoint_seq = (SELECT max(checkpoint_seq) FROM k WHERE checkpoint_seq % 4 <> 0)",
    "tk1_trim_pending": f"WITH {CHECKPOINTS} SELECT trace_id, CAST(seal_no AS BIGINT) AS seal_no FROM no ORDER BY seal_no DESC LIMIT 25",
    "tk3_fragment_prefix": "SELECT conv_id, turn, hex(encode(text)[1:256]) AS prefix FROM conversations",
    "st1_claimed_keys": "SELECT DISTINCT k AS key_id FROM (SELECT 'key' || (event_id % 5) AS k FROM events UNION ALL SELECT 'cp' || (user_id % 4) FROM events)",
    "st3_uncommitted": f"WITH {CHECKPOINTS} SELECT trace_id, tip_hash FROM b WHERE checkpoint_seq > 2",
    "fn1_canonical_bytes": f"WITH {RECORDS} SELECT span_id, sha256(encode(bytes)) AS digest, strlen(bytes) AS n_bytes FROM c",
    "fn1_json_strings": f"SELECT conv_id, turn, {json_string('text')} AS quoted FROM conversations",
    "fn3_unixnano_parse": f"SELECT event_id, CASE WHEN x = 'null' THEN '0' WHEN regexp_full_match(d, '0|[1-9][0-9]*') AND length(d) <= 20 AND CAST(CASE WHEN regexp_full_match(d, '[0-9]+') THEN d ELSE '0' END AS HUGEINT) <= 18446744073709551615 THEN d END AS nanos FROM (SELECT event_id, x, trim(x, '\"') AS d FROM (SELECT event_id, {_TIMES} AS x FROM events))",
    "fn4_genesis_seed": "SELECT user_id, CASE WHEN user_id % 4 = 3 THEN NULL ELSE sha256(unhex(t) || encode('v' || (user_id % 3 + 1))) END AS seed FROM (SELECT DISTINCT user_id, " + _hex("user_id", 32) + " AS t FROM events)",
    "fn9_finding_labels": "SELECT DISTINCT user_id, CASE WHEN user_id % 3 = 0 THEN CAST(user_id AS VARCHAR) WHEN user_id % 3 = 1 THEN 'audit log' ELSE 'checkpoint' END AS label FROM events",
    "fn10_backoff": "SELECT f, p, CASE WHEN c > 0 THEN least(x, c) ELSE x END AS retry_at FROM (SELECT event_id % 4 AS f, event_id % 3000 AS p, event_id % 5000 AS c, CASE WHEN event_id % 4 > 1 THEN least(event_id % 3000 * 2, event_id % 3000 + 1024) ELSE event_id % 3000 + 1 END AS x FROM events)",
    "fn11_defaults": "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 100 ELSE event_id % 4 END AS interval_of FROM events",
    "fn13_id_checks": "SELECT event_id, CASE WHEN length(t) <> 16 THEN 'ID_BAD_LENGTH' WHEN NOT regexp_full_match(t, '[0-9a-f]*') THEN 'ID_NOT_LOWERCASE_HEX' END AS code FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN lower(lpad(to_hex(event_id), 16, '0')) WHEN 1 THEN upper(lpad(to_hex(event_id), 15, 'F')) || 'A' ELSE to_hex(event_id) END AS t FROM events)",
    "ss6_scope_groups": f"WITH {RECORDS} SELECT trace_id, '\"host\"=\"' || (event_id % 2) || '\"' AS resource_key, 's' || (event_id % 3) AS scope_name, string_agg(span_id, ',' ORDER BY span_id) AS spans FROM r GROUP BY trace_id, event_id % 2, event_id % 3",
    "ss11_disposition": f"WITH {_WAL} SELECT trace_id, n_spans, has_root, versions, action FROM a",
    "ss13_restored_tips": f"WITH {_WAL} SELECT line_no, trace_id, tip_hash, entry_count FROM w WHERE tip_hash <> ''",
    "snk4_quarantine": f"WITH {_WAL} SELECT d.trace_id, d.span_id, d.line_no, a.versions, 'mixed or unknown versions' AS reason FROM d JOIN a USING (trace_id) WHERE a.action = 'quarantine'",
    "src1_span_ingest": f"WITH {_TYPED} SELECT trace_id, span_id, parent_span_id, CAST(start_ns AS VARCHAR) AS start_ns, span_name, otel_kind, status, audit_kind, attributes_json FROM typed",
    "prj3_attribute_text": f"SELECT event_id, CASE event_id % 7 WHEN 0 THEN n WHEN 1 THEN n WHEN 2 THEN {_quarter} WHEN 3 THEN CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END WHEN 4 THEN base64(encode(n)) WHEN 5 THEN '[' || n || ',\"\\u003cx\\u003e\"]' ELSE '' END AS text FROM (SELECT event_id, CAST(event_id AS VARCHAR) AS n FROM events)",
    "fn7_attributes_key": "SELECT '\"a\"=\"' || user_id || '\"' || chr(1) || '\"b\"=\"' || event_type || '\"' AS attributes, count(*) AS n FROM events GROUP BY user_id, event_type",
    "tk4_drop_pending": "SELECT CAST(0 AS BIGINT) AS pending, count(DISTINCT user_id) AS dropped FROM events",
    "ss8_sealed_batches": "SELECT CAST(t // 20 AS BIGINT) AS checkpoints, CAST(t // 20 * 20 AS BIGINT) AS covered, CAST(0 AS BIGINT) AS findings, e AS entries, CAST(t % 20 AS BIGINT) AS pending, t AS sealed FROM (SELECT count(DISTINCT user_id) AS t, count(*) AS e FROM events)",
    "ss10_segments": f"WITH {RECORDS}, n AS (SELECT trace_id, user_id, count(*) AS entry_count FROM s GROUP BY trace_id, user_id) SELECT trace_id, unnest(range(0, CASE WHEN user_id % 6 = 0 THEN 3 ELSE 1 END)) AS segment_no, entry_count FROM n",
    "ss17_finished_stream": f"""WITH {RECORDS}, n AS (SELECT trace_id, user_id % 4 = 1 AS open, count(*) AS k FROM s WHERE user_id % 4 <> 1 OR parent_span_id <> '' GROUP BY trace_id, user_id % 4 = 1),
  done AS (SELECT count(*) FILTER (NOT open) AS done, count(*) AS t, CAST(sum(k) AS BIGINT) AS e FROM n)
  SELECT CAST(done // 20 + ceil((t - done // 20 * 20) / 20.0) AS BIGINT) AS checkpoints, t AS covered, e AS entries, CAST(0 AS BIGINT) AS findings, CAST(0 AS BIGINT) AS pending FROM done""",
    "ss12_restamped": f"WITH {_WAL} SELECT d.line_no, d.trace_id, d.span_id, 'v3' AS schema_version FROM d JOIN a USING (trace_id) WHERE a.action = 'restamp'",
    "src2_conversation_log": f"SELECT row_number() OVER (ORDER BY trace_id, turn) AS line_no, trace_id, span_id, span_name, audit_kind, CAST(NULL AS VARCHAR) AS torn FROM (SELECT {_hex('conv_id', 32)} AS trace_id, {_hex('turn', 16)} AS span_id, turn, coalesce(text, '') AS span_name, CASE WHEN role = 'user' THEN 'handoff' ELSE 'task' END AS audit_kind FROM conversations)",
}
