import itertools
import math
import random
import zlib
from collections import defaultdict
from statistics import NormalDist

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerframe.llm import language_id, mixing, token_file, url_filter
from ledgerframe.llm.queries import URL_RULES
from ledgerframe.llm.store import Scratch

FILE = public_tokenizers.path("byte_bpe_50k.json")
MORE = ["a  b  c  d\n\n e", "it's <|endoftext|> here's\t\tx ", "日本 語　 x", " lead", "x" * 3000, "é è\u0085 z"]


def test_token_file_round_trip(spark, documents, tmp_path):
    rows = documents + [(200_000 + k, t) for k, t in enumerate(MORE)]
    rows += [(None, "no key"), (7_000_000, "again"), (7_000_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    path = str(tmp_path / "file")
    token_file.write_tokens(docs, path, FILE)
    got = sorted(tuple(r)[1:] + (r.doc_id,) for r in token_file.read_documents(spark, path).collect())
    model, start, want, flat = Tokenizer.from_file(FILE), 0, [], []
    # of the two rows with one id, the one whose text has the smaller digest comes first
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is None)):
        ids = [*model.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), d))
        start += len(ids)
        flat += ids
    assert got == want
    ask = list(range(0, len(flat), 997)) + [len(flat) - 1, len(flat) + 5, 3, 3]
    read = sorted(tuple(r) for r in token_file.read_tokens(spark, path, spark.createDataFrame([(x,) for x in ask], "position long")).collect())
    assert read == sorted((x, flat[x]) for x in ask if x < len(flat))


def test_codes():
    rng = np.random.default_rng(3)
    for ids in (np.zeros(0, np.uint32), np.array([5], np.uint32), rng.integers(0, 1 << 20, 5000).astype(np.uint32), rng.integers(0, 300, 1030).astype(np.uint32)):
        packed = token_file.pack(ids)
        assert (token_file.unpack(*packed[:2]) == ids).all()
        if len(ids):
            assert (token_file.access(*packed, np.arange(len(ids))[::-1]) == ids[::-1]).all()


def test_code_lengths_are_those_of_the_tree(spark):
    texts = ["the cat sat on the mat", "then the hat", "la casa de la rosa", "el gato y la casa"]
    train = spark.createDataFrame([(k, t, "en" if k < 2 else "es") for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    model = language_id.learn(train)
    counts = {x: {} for x in model.langs}
    for k, t in enumerate(texts):
        raw = b"\n\n\n" + t.encode()
        for i in range(3, len(raw)):
            counts["en" if k < 2 else "es"].setdefault(raw[i - 3 : i + 1], 0)
            counts["en" if k < 2 else "es"][raw[i - 3 : i + 1]] += 1

    def bits(lang, ctx, s):
        grams = counts[lang]
        after = {}
        for g, n in grams.items():
            if g[3 - len(ctx) : 3] == ctx:
                after[g[3]] = after.get(g[3], 0) + n
        n, q = sum(after.values()), len(after)
        if s in after:
            return np.log2((n + q) / after[s])
        less = bits(lang, ctx[1:], s) if ctx else np.log2(257)
        return less + (np.log2((n + q) / q) if q else 0)

    for text in ("the casa", "la mat Ü"):
        raw = b"\n\n\n" + text.encode().lower().replace(b"\xc3\x9c", b"\xc3\xbc")
        want = [sum(bits(x, raw[i - 3 : i], raw[i]) for i in range(3, len(raw))) for x in model.langs]
        got = model.bits(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
        assert np.allclose(got[0], want, rtol=1e-4)
    # asked again, from the table, and with a table too small for its strings
    model.SLOTS = 1 << 21
    for _ in range(2):
        again = model.bits(np.frombuffer(b"the casathe mat", np.uint8), np.array([0, 8, 15]))
        assert np.allclose(again[0], model.bits(np.frombuffer(b"the casa", np.uint8), np.array([0, 8]))[0], rtol=1e-5)
        model.KEEP = 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null and lang_pred <> 'und'")
    right, n = out.select(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right >= 0.97 * n


def test_language_edges(spark):
    docs = spark.createDataFrame([(1, "some words here", "en"), (2, None, "en"), (3, "123 !!", None), (None, "words", None), (5, "some words here too", "en")], "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language_id.identify(docs).collect()}
    assert got[2] == got[3] == "und" and set(got) == {1, 2, 3, None, 5}
    assert {r.lang_pred for r in language_id.identify(docs.where("doc_id = 3")).collect()} == {"und"}
    assert language_id.identify(docs.limit(0)).count() == 0
    # a language of one short text is learned as well
    two = spark.createDataFrame([(1, "some words here", "en"), (4, "qx", "qq"), (5, "some words", "en"), (8, "qx qx", None)], "doc_id long, text string, lang string")
    assert {r.doc_id: r.lang_pred for r in language_id.identify(two.where("not crc32(cast(doc_id as string)) % 4 = 2 or lang is null")).collect()}.get(8) == "qq"


def _targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, full = {}, set()
    while True:
        room = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        open_ = sum(weight[s] for s in names if s not in full)
        target = {s: 3 * sizes[s] if s in full else room * weight[s] / open_ for s in names}
        over = {s for s in names if s not in full and target[s] > 3 * sizes[s]}
        if not over:
            return target
        full |= over


def test_mixing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("source", F.when(F.col("source") == "src3", None).when(F.col("doc_id") % 3 == 0, "src0").otherwise(F.col("source")))
    rows = [r.asDict() for r in mixing.mix(docs).collect()]
    text = {r.doc_id: (len(brute.words(r.text)), r.source) for r in docs.collect()}
    sizes, taken, largest = {}, {}, {}
    for r in rows:
        assert r["size"] == text[r["doc_id"]][0] and r["source"] == text[r["doc_id"]][1]
        assert r["taken"] in {k * r["size"] for k in range(4)}
        s = r["source"]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
        largest[s] = max(largest.get(s, 0), r["size"])
    want = _targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) <= 1e-6 * want[r["source"]]
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)
    again = {r.doc_id: r.taken for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mixing_of_two_sources_of_uneven_size(spark):
    docs = spark.createDataFrame([(1, "a b c", "x"), (2, None, "x"), (3, "d " * 1000, "y"), (3, "d " * 1000, "y"), (None, "q r", None)], "doc_id long, text string, source string")
    got = {(r.source, r.target) for r in mixing.mix(docs).collect()}
    assert {(s, round(t, 6)) for s, t in got} == {(s, round(t, 6)) for s, t in _targets({"x": 3, "y": 2000, None: 2}).items()}


def test_url_rules(spark):
    cases = {"http://A.Example.NET/en/x?y": ("a.example.net", "/en/x", "example.net/en/", "allow"), "https://b.net/q": ("b.net", "/q", "net/", "block"), "//x.net/": ("", "", None, "allow"), None: ("", "", None, "allow"), "ftp://net#/": ("net", "", None, "allow"), "http://x.example.com/de/1": ("x.example.com", "/de/1", "example.com/de/", "block"), "http://notexample.com/de/1": ("notexample.com", "/de/1", None, "allow"), "http://k.org/fr/": ("k.org", "/fr/", "org/fr/", "allow")}
    pages = spark.createDataFrame([(k, u, "x") for k, u in enumerate(cases)], "page_id long, url string, host string")
    none = spark.createDataFrame([], "url string, bad boolean")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, none, URL_RULES).collect()}
    assert [got[k] for k in range(len(cases))] == list(cases.values())
    assert url_filter.judge(pages.limit(0), none, URL_RULES).count() == 0


def test_url_rules_are_mined(spark):
    pages = spark.range(4000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h"), F.col("id") % 7, F.lit(".org/"), F.when(F.col("id") % 3 == 0, "shop/").otherwise("news/"), F.col("id"), F.when(F.col("id") % 2 == 0, "?ad=1").otherwise("")).alias("url"))
    bad = (F.col("page_id") % 3 == 0) & (F.col("page_id") % 2 == 0)
    out = url_filter.judge(pages, pages.where("page_id < 2000").select("url", bad.alias("bad")), [])
    assert out.where((F.col("verdict") == "block") != bad).count() == 0
    rules = url_filter.mine(pages.select("url", bad.alias("bad"))).collect()
    assert [sorted(r["items"]) for r in rules] == [["p:shop", "q:ad"]]


def _lower(met, z):
    m, p = len(met), sum(met) / len(met)
    return (p + z * z / (2 * m) - z * math.sqrt(p * (1 - p) / m + z * z / (4 * m * m))) / (1 + z * z / m)


def _rules(rows, precision, least=20, error=0.05):
    """All token combinations that plain counts accept, from rows (url, tokens, bad): found on one half of the urls, each
    with all tokens of its urls that always stand together, and proved on the other."""
    mined = [(have, bad) for u, have, bad in rows if zlib.crc32(u.encode()) % 2 == 0]
    held = [(have, bad) for u, have, bad in rows if zlib.crc32(u.encode()) % 2]
    need = max(least, 0.002 * len(mined))
    where = defaultdict(list)
    for k, (have, _) in enumerate(mined):
        for t in have:
            where[t].append(k)
    groups = defaultdict(list)
    for t, at in where.items():
        if sum(mined[k][1] for k in at) >= need:
            groups[tuple(at)].append(t)
    found = {}
    for size in (1, 2, 3, 4, 5):
        for some in itertools.combinations(groups, size):
            met = [mined[k][1] for k in set.intersection(*map(set, some))]
            if sum(met) >= need and sum(met) / len(met) >= precision:
                found[tuple(sorted(t for g in some for t in groups[g]))] = sum(met) / len(met)
    kept = {i: p for i, p in found.items() if not any(set(o) < set(i) and q >= p - 1e-12 for o, q in found.items())}
    if kept:
        z = NormalDist().inv_cdf(1 - error / len(kept))
    met = {i: [bad for have, bad in held if set(i) <= have] for i in kept}
    kept = {i: p for i, p in kept.items() if met[i] and _lower(met[i], z) > precision}
    own = defaultdict(list)
    for have, bad in held:
        if hit := [(p, len(i), i) for i, p in kept.items() if set(i) <= have]:
            own[max(hit)[2]].append(bad)
    return {i: p for i, p in kept.items() if i in own and _lower(own[i], z) > precision}


def _tokens(spark, frame):
    return {r.url: set(r.t) for r in frame.select("url", url_filter.tokens(F.col("url")).alias("t")).collect() if r.url}


@pytest.mark.parametrize("precision", [0.5, 0.25])
def test_mined_rules_against_plain_counts(spark, precision):
    rng = random.Random(2)
    pages = []
    for k in range(3000):
        spam, host = rng.random() < 0.3, rng.choice(("a", "b", "c"))
        url = f"http://{host}.{'xyz' if spam else 'org'}/{rng.choice(('shop', 'news'))}/{k}" + rng.choice(("", "?ad=1"))
        pages.append((k, url, rng.random() < (0.8 if spam and "shop" in url else 0.4 if host == "b" else 0.1)))
    pages += [(9000, None, True), (9001, "http://a.org/x", None), (9002, "no scheme", False), (9003, pages[0][1], True)]
    labelled = spark.createDataFrame(pages, "page_id long, url string, bad boolean")
    own = _tokens(spark, labelled)
    want = _rules([(u, own[u], b) for _, u, b in pages if u and b is not None], precision)
    rules = url_filter.mine(labelled.select("url", "bad"), precision=precision)
    got = {tuple(sorted(r["items"])): r.confidence for r in rules.collect()}
    assert want and set(got) == set(want) and all(abs(got[i] - p) < 1e-9 for i, p in want.items())
    assert len(want) > 1 or precision == 0.5
    hits = {r.url: r.confidence for r in url_filter.match(labelled, rules, Scratch(spark, "t")).collect()}
    best = {u: max(p for i, p in want.items() if set(i) <= have) for u, have in own.items() if any(set(i) <= have for i in want)}
    assert hits == pytest.approx(best)
    if precision == 0.5:
        out = {r.page_id: r.verdict for r in url_filter.judge(labelled.select("page_id", "url"), labelled.select("url", "bad"), []).collect()}
        assert out == {p: "block" if u in best else "allow" for p, u, _ in pages}


def test_nothing_is_mined_from_noise(spark):
    """Labels that don't depend on the url give no rule, though some token of many has a share of bad rows by chance."""
    rng = random.Random(9)
    rows = [(f"http://h{rng.randrange(30)}.org/{rng.choice('abcdefgh')}/{rng.choice('ijklmnop')}?{rng.choice('qrst')}=1", rng.random() < 0.45) for _ in range(3000)]
    assert url_filter.mine(spark.createDataFrame(rows, "url string, bad boolean")).count() == 0


def test_long_families_of_tokens(spark):
    """Thirty path parts that always stand together are one to the miner, apart from those of other families."""
    parts = ["/".join(f"{f}{k}" for k in range(30)) for f in "ab"]
    rows = [(f"http://x.org/{parts[k % 2]}/{k}" + "?ad" * (k % 3 == 0), k % 2 == 0 and k % 10 != 2) for k in range(600)]
    rows += [(f"http://x.org/a7/{k}", False) for k in range(9)]
    labelled = spark.createDataFrame(rows, "url string, bad boolean")
    got = {tuple(r["items"]) for r in url_filter.mine(labelled).collect()}
    own = _tokens(spark, labelled)
    assert got == set(_rules([(u, own[u], b) for u, b in rows], 0.5))
    # p:a7 alone is as good but for urls that are all good
    assert any(len(items) == 29 for items in got) and not any("p:a7" in items for items in got)


def test_mined_rules_decide_on_a_real_table(spark):
    from ledgerframe.llm.queries import op8_url_filter

    out = op8_url_filter(spark, "/root/testdata/sf0.1")
    assert out.where("rule is null and verdict = 'block'").count() == out.where("confidence is not null").count()
    pages, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("pages", "labels"))
    bad = labels.select(F.col("doc_id").alias("page_id"), ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad"))
    blocked = out.where("confidence is not null").join(bad, "page_id").agg(F.count_if("bad"), F.count(F.lit(1))).first()
    assert 2 * blocked[0] >= blocked[1]
    labelled = pages.join(bad, "page_id").select("url", "bad")
    own = _tokens(spark, labelled)
    want = _rules([(r.url, own[r.url], r.bad) for r in labelled.collect() if r.url and r.bad is not None], 0.5)
    assert {tuple(r["items"]) for r in url_filter.mine(labelled).collect()} == set(want)
