"""DuckDB SQL for the registered queries of this subpackage that SQL can state."""

from __future__ import annotations

from . import decontaminate, mixing, secret_scan

_SPLIT = r"'[\x20\x09-\x0D]+'"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> str:
    """List of the words of a text; empty for null."""
    return f"list_filter(string_split_regex(coalesce({text}, ''), {_SPLIT}), lambda w: w <> '')"


#: All sets by their words, then all pairs that share a shingle, then what is reachable.
_JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, {words(f"translate(text, '{_UPPER}', '{_LOWER}')")} AS w FROM documents),
g AS (SELECT DISTINCT doc_id, s FROM (
  SELECT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
r AS (SELECT doc_id AS a, doc_id AS low FROM documents UNION SELECT l.b, r.low FROM r JOIN l ON l.a = r.a WHERE r.low < l.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.low AS component_id, coalesce(k.k, 0) AS n_links
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(low) AS low FROM r GROUP BY a) m USING (doc_id) LEFT JOIN (SELECT a AS doc_id, count(*) AS k FROM l GROUP BY a) k USING (doc_id)
"""

#: Every place of a document's word in an item; on a diagonal, equal words of a stretch are counted in a range.
_NEEDED = f"CASE WHEN n < {decontaminate.LEAST} THEN n ELSE CAST(ceil(least({decontaminate.STRETCH}, n) * {decontaminate.SHARE} / 100.0) AS BIGINT) END"
_LEAKS = f"""
WITH b AS (SELECT item_id, {words("lower(text)")} AS w FROM benchmark WHERE text IS NOT NULL),
i AS (SELECT item_id, len(w) AS n, unnest(w) AS w, generate_subscripts(w, 1) AS a FROM b),
d AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS p FROM (SELECT doc_id, {words("lower(text)")} AS w FROM documents)),
m AS (SELECT doc_id, item_id, n, p - a AS shift, a, {_NEEDED} AS needed FROM d JOIN i USING (w)),
q AS (SELECT * FROM m QUALIFY count(*) OVER (PARTITION BY doc_id, item_id, shift) >= needed),
e AS (SELECT doc_id, item_id, needed, count(*) OVER (PARTITION BY doc_id, item_id, shift ORDER BY a RANGE BETWEEN CURRENT ROW AND {decontaminate.STRETCH - 1} FOLLOWING) AS equal FROM q),
f AS (SELECT doc_id, item_id, max(equal) AS equal FROM e WHERE equal >= needed GROUP BY doc_id, item_id),
x AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS items, max(equal) AS equal FROM f GROUP BY doc_id)
SELECT doc_id, n_items IS NOT NULL AS contaminated, coalesce(n_items, 0) AS n_items, coalesce(items, '') AS items, coalesce(equal, 0) AS equal FROM documents LEFT JOIN x USING (doc_id)
"""

#: Every string of 200 bytes, by its digest; the starts of those that occur twice make runs.
_BYTES = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
s AS (SELECT doc_id, unnest(range(1, n - 198)) AS i, b FROM d WHERE n >= 200),
h AS (SELECT doc_id, i, md5(b[i:i + 199]) AS h FROM s),
t AS (SELECT doc_id, i FROM h QUALIFY count(*) OVER (PARTITION BY h) > 1),
u AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS new FROM t),
v AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM u),
r AS (SELECT doc_id, k, min(i) AS a, max(i) + 199 AS z FROM v GROUP BY doc_id, k),
e AS (SELECT doc_id, a, z, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS next, row_number() OVER (PARTITION BY doc_id ORDER BY a) AS k FROM r),
p AS (SELECT doc_id, count(*) AS n_spans, sum(z - a + 1) AS n_removed, string_agg((CASE WHEN k = 1 AND a > 1 THEN hex(b[1:a - 1]) ELSE '' END) || (CASE WHEN z < coalesce(next - 1, n) THEN hex(b[z + 1:coalesce(next - 1, n)]) ELSE '' END), '' ORDER BY a) AS kept FROM e JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, CASE WHEN kept IS NULL THEN sha256(b) ELSE sha256(unhex(kept)) END AS kept_sha256 FROM d LEFT JOIN p USING (doc_id)
"""

#: Every window of 20 words; all but the first of a kind remove their words.
_WINDOWS = f"""
WITH d AS (SELECT doc_id, {words("text")} AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
f AS (SELECT doc_id, i FROM g QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM f),
o AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS p FROM d),
k AS (SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY p) AS kept FROM o ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(encode(coalesce(kept, ''))) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""

_MOST, _WEIGHTS = mixing.MOST, list(map(float, mixing.WEIGHTS))
_SIZE = f"CAST(len({words('text')}) AS BIGINT)"
#: Targets, copies and Pareto ranks as in the operator; the line of ranks is cut where its running total passes the room.
_MIX = f"""
WITH d AS (SELECT doc_id, source, {_SIZE} AS size, md5(text) AS print FROM documents),
i AS (SELECT *, CASE WHEN size < 50 THEN 1 WHEN size < 200 THEN 2 WHEN size < 800 THEN 3 ELSE 4 END AS importance FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, ({_WEIGHTS})[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(_WEIGHTS)} + 1] AS weight FROM s),
o AS (SELECT *, row_number() OVER full_first AS place, (sum(source_size) OVER () - {_MOST} * coalesce(sum(source_size) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS unit FROM w
  WINDOW full_first AS (ORDER BY source_size / weight, source NULLS LAST), before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least({_MOST} * CAST(source_size AS DOUBLE), coalesce((SELECT arg_min(unit, place) FROM o WHERE unit * weight <= {_MOST} * source_size) * weight, 'infinity'::DOUBLE)) AS target FROM o),
l AS (SELECT source, importance, CAST(sum(size) AS BIGINT) AS level_size FROM i GROUP BY source, importance),
c AS (SELECT l.source, importance, source_size, target, row_number() OVER down AS place,
  (target - {_MOST} * coalesce(sum(level_size) OVER (PARTITION BY l.source ORDER BY importance DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / nullif(sum(level_size * importance) OVER (PARTITION BY l.source ORDER BY importance DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS c
  FROM l JOIN t ON l.source IS NOT DISTINCT FROM t.source WINDOW down AS (PARTITION BY l.source ORDER BY importance DESC)),
f AS (SELECT source, arg_min(c, place) AS c FROM c WHERE c * importance <= {_MOST} GROUP BY source),
e AS (SELECT c.source, importance, source_size, target, greatest(0.0, least({_MOST}.0, coalesce(f.c * importance, {_MOST}.0))) AS expected FROM c LEFT JOIN f ON c.source IS NOT DISTINCT FROM f.source),
r AS (SELECT doc_id, i.source, size, source_size, target, floor(expected) AS whole, expected - floor(expected) AS p,
  (CAST(('0x' || substr(md5(concat_ws(':', CAST(doc_id AS VARCHAR), print)), 1, 13)) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM i JOIN e ON i.source IS NOT DISTINCT FROM e.source AND i.importance = e.importance),
k AS (SELECT *, (u / (1 - u)) / (p / nullif(1 - p, 0)) AS rank FROM r),
b AS (SELECT *, CASE WHEN p > 0 AND size > 0 THEN least(CAST(floor(rank / (1 + rank) * {1 << 3 * mixing._STEP}.0::DOUBLE) AS BIGINT), {(1 << 3 * mixing._STEP) - 1}) END AS bits FROM k),
m AS (SELECT source, any_value(target) - sum(whole * size) AS room FROM b GROUP BY source),
y AS (SELECT b.source, bits, room, sum(size) AS words, sum(sum(size)) OVER (PARTITION BY b.source ORDER BY bits) AS upto FROM b JOIN m ON b.source IS NOT DISTINCT FROM m.source WHERE bits IS NOT NULL GROUP BY b.source, bits, room),
z AS (SELECT source, min(bits) AS first, arg_min(words, bits) AS words, arg_min(room - (upto - words), bits) AS rest FROM y WHERE upto > room GROUP BY source)
SELECT doc_id, size, source_size, target, CAST(CASE WHEN size > 0 THEN whole + CASE WHEN bits IS NULL THEN 0 WHEN first IS NULL OR bits < first OR bits = first AND words - rest < rest THEN 1 ELSE 0 END ELSE 0 END * size AS BIGINT) AS taken
FROM b LEFT JOIN z ON b.source IS NOT DISTINCT FROM z.source
"""



def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _matches(name: str, pattern: str) -> str:
    """``name``: (doc_id, k, hit, start, stop) of all matches; positions are sums of what lies before."""
    return f"""{name} AS (SELECT doc_id, k, hit, stop - length(hit) AS start, stop FROM (
  SELECT doc_id, k, hits[k] AS hit, sum(length(pieces[k]) + length(hits[k])) OVER (PARTITION BY doc_id ORDER BY k) AS stop FROM (
    SELECT doc_id, hits, pieces, unnest(range(1, len(hits) + 1)) AS k FROM (
      SELECT doc_id, regexp_extract_all(t, {_quoted(pattern)}) AS hits, string_split_regex(t, {_quoted(pattern)}) AS pieces FROM d))))"""


_DIGIT, _SMALL, _LARGE = (f"regexp_matches(hit, '{c}')" for c in ("[0-9]", "[a-z]", "[A-Z]"))
#: Conditions of the classes without look-ahead, in their order.
_CLASSES = {
    "hex": "regexp_full_match(hit, '[0-9a-fA-F-]+')",
    "alnum": f"{_DIGIT} AND ({_SMALL} OR {_LARGE}) AND regexp_full_match(hit, '[0-9A-Za-z]+')",
    "lower": f"{_DIGIT} AND {_SMALL} AND regexp_full_match(hit, '[0-9a-z+/_=-]+')",
    "upper": f"{_DIGIT} AND {_LARGE} AND regexp_full_match(hit, '[0-9A-Z+/_=-]+')",
    "base64": f"{_DIGIT} AND {_SMALL} AND {_LARGE}",
}
_BITS = "CASE " + " ".join(f"WHEN {_CLASSES[c.name]} THEN {c.bits}" for c in secret_scan.CLASSES) + " END"
#: The allow-list without back references: what is made of copies of its first one to four characters.
_COPIES = " OR ".join(f"length(hit) % {k} = 0 AND length(hit) >= {2 * k} AND hit = repeat(left(hit, {k}), length(hit) // {k})" for k in range(1, 5))
_ALLOWED = " OR ".join(f"regexp_matches(hit, {_quoted(a)})" for a in secret_scan.ALLOWED if "\\1" not in a) + f" OR {_COPIES}"
_W = secret_scan.WINDOW
_LIST = "coalesce(string_agg(['assign', 'access', 'hex', 'entropy'][rank + 1] || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, rank, stop) {}, '')"
#: Matches by their kinds; windows of candidates by counting their characters, high ones joined to runs.
_SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
{_matches("m0", secret_scan.ASSIGN)},
v AS (SELECT doc_id, unnest(vals) AS val, generate_subscripts(vals, 1) AS k FROM (SELECT doc_id, regexp_extract_all(t, {_quoted(secret_scan.ASSIGN)}, 2) AS vals FROM d)),
{_matches("m1", secret_scan.ACCESS)},
{_matches("m2", secret_scan.HEX)},
{_matches("m3", secret_scan.CANDIDATE)},
c AS (SELECT doc_id, start AS begin, hit, {_BITS} AS bits FROM m3 WHERE NOT ({_ALLOWED})),
w AS (SELECT doc_id, begin, bits, hit, unnest(range(0, length(hit) - {_W - 1})) AS i FROM c WHERE bits IS NOT NULL),
x AS (SELECT doc_id, begin, bits, i, ch, count(*) AS n FROM (SELECT doc_id, begin, bits, i, unnest(string_split(substr(hit, i + 1, {_W}), '')) AS ch FROM w) GROUP BY doc_id, begin, bits, i, ch),
y AS (SELECT doc_id, begin, i FROM x GROUP BY doc_id, begin, i, bits HAVING log2({_W}) - sum(n * log2(n)) / {_W} >= bits),
z AS (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id, begin ORDER BY i) + {_W} THEN 0 ELSE 1 END AS new FROM y),
r AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, begin ORDER BY i) AS g FROM z),
s AS (SELECT doc_id, 0 AS rank, start, stop FROM m0 JOIN v USING (doc_id, k) WHERE length(val) >= {secret_scan.ASSIGN_LEAST}
  UNION ALL SELECT doc_id, 1, start, stop FROM m1 UNION ALL SELECT doc_id, 2, start, stop FROM m2
  UNION ALL SELECT doc_id, 3, begin + min(i), begin + max(i) + {_W} FROM r GROUP BY doc_id, begin, g)
SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex, count(*) FILTER (rank = 3) AS n_entropy,
  sha256({_LIST.format("FILTER (rank < 3)")}) AS base_sha256, {_LIST.format("")} AS spans
FROM d LEFT JOIN s USING (doc_id) GROUP BY doc_id
"""

#: All phrases of up to five words within pieces, their cuts, and the longer phrases that hold them.
_COLLOCATIONS = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM p),
c AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM w GROUP BY lang),
o AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 6) r(k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS a FROM o GROUP BY lang, k, phrase HAVING count(*) >= 100),
j AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
s AS (SELECT j.lang, j.k, j.phrase, j.a, cut, l.a AS l, r.a AS r, n, (1000 * j.a * n) // (l.a * r.a) AS score
  FROM j JOIN c ON c.lang = j.lang JOIN f l ON l.lang = j.lang AND l.phrase = array_to_string(w[1:cut], ' ') JOIN f r ON r.lang = j.lang AND r.phrase = array_to_string(w[cut + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
h AS (SELECT lang, array_to_string(x.w[i:i + m - 1], ' ') AS phrase, max(a) AS a FROM (SELECT lang, a, k, w, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT lang, k, a, string_split(phrase, ' ') AS w FROM f) q, range(2, 5) t(m) WHERE m < k) x GROUP BY ALL),
t AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, encode(b.phrase)) AS rank FROM b LEFT JOIN h ON h.lang = b.lang AND h.phrase = b.phrase WHERE h.a IS NULL OR 100 * h.a < 100 * b.a)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM t WHERE rank <= 2000
"""

#: The checksum byte by byte from a table of its 256 steps; words that lose a code point meet, and forms are followed.
_SPELLING = f"""
WITH RECURSIVE t AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(range(0, 8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END, i) AS c FROM range(0, 256) r(i))),
q AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), '{_UPPER}', '{_LOWER}') AS run FROM documents),
r AS (SELECT doc_id, run, count(*) AS k, hex(encode(doc_id || ':' || run)) AS x FROM q WHERE length(run) >= 5 GROUP BY doc_id, run),
h AS (SELECT run, k, xor(4294967295, list_reduce(list_transform(range(1, length(x), 2), lambda i: ('0x' || x[i:i + 1])::BIGINT), lambda c, b: xor(t[xor(c, b) % 256 + 1], c // 256), 4294967295::BIGINT)) AS h FROM r, t),
w AS (SELECT word, sum(k)::BIGINT AS n FROM (SELECT k, CASE WHEN h % 97 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM h) WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
d AS (SELECT word, i, word[1:i - 1] || word[i + 1:] AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
e AS (SELECT a.word, b.word AS near FROM d a JOIN d b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT d.word, w.word FROM d JOIN w ON d.rest = w.word UNION SELECT w.word, d.word FROM d JOIN w ON d.rest = w.word),
m AS (SELECT e.word, count(*) AS n_near, min({{'n': -x.n, 'near': near}}) AS best FROM e JOIN w x ON x.word = e.near GROUP BY e.word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -m.best.n >= 2 * w.n THEN m.best.near END AS form, CASE WHEN -m.best.n >= 2 * w.n THEN -m.best.n END AS form_n FROM w LEFT JOIN m USING (word)),
z AS (SELECT word, word AS at FROM f UNION ALL SELECT z.word, f.form FROM z JOIN f ON f.word = z.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, z.at AS root, f.n, f.n_near, f.form_n FROM f JOIN z ON z.word = f.word JOIN f g ON g.word = z.at AND g.form IS NULL
"""

SQL = {
    "op1_ngram_jaccard_join": _JACCARD,
    "op3_secret_scan": _SECRETS,
    "op6_mixing": _MIX,
    "op7_decontaminate": _LEAKS,
    "op9_suffix_dedup": _BYTES,
    "op10_substring_dedup": _WINDOWS,
    "op11_collocations": _COLLOCATIONS,
    "op13_spelling_variants": _SPELLING,
}
