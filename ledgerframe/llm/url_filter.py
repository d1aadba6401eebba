"""URL filters: curated host and path rules first, then association rules that Spark's FP-growth mines from labels."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import Scratch

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BAD = "=block"


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL: labels of the host and its last two together, parts of the path (numbers all alike),
    the ending, and the names in the query."""
    h, p = host(url), path(url)
    labels = F.filter(F.split(h, r"\."), lambda x: x != "")
    parts = F.filter(F.split(p, "[/._-]+"), lambda x: x != "")
    names = F.filter(F.transform(F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&"), lambda x: F.split(x, "=")[0]), lambda x: x != "")
    both = [
        F.transform(labels, lambda x: F.concat(F.lit("h:"), x)),
        F.array(F.concat(F.lit("d:"), F.substring_index(h, ".", -2))),
        F.transform(parts, lambda x: F.concat(F.lit("p:"), F.when(x.rlike("^[0-9]+$"), F.lit("#")).otherwise(x))),
        F.transform(names, lambda x: F.concat(F.lit("q:"), x)),
    ]
    return F.array_distinct(F.concat(*[F.coalesce(b, F.array().cast("array<string>")) for b in both]))


def mine(labelled: DataFrame, support: float = 0.002, least: int = 20, precision: float = 0.5, error: float = 0.05) -> DataFrame:
    """(rule, items, confidence, support) from rows (url, bad): token combinations that imply a bad page.

    Rules are mined on one half of the urls and proved on the other. A rule stands for ``support`` of the rows mined,
    and for ``least`` bad rows at the fewest. ``precision`` is the share of bad pages among those blocked that it must
    exceed: c / (1 + c) where blocking a good page costs c times as much as passing a bad one, a half at equal costs.
    Rules that a more general one of at least the same confidence covers are left out. Of the rest those stay whose
    share of bad rows on the half held out is proved to exceed ``precision``, among all rows they match and then among
    those that no more confident rule matches: the lower end of the confidence interval (Wilson), at a chance of
    ``error`` that any of the candidates is wrong (Bonferroni).

    Tokens of the same urls are one to FP-growth (see ``_alike``), so a rule names all that its urls share. FP-growth
    runs distributed; its rules are few, unless a dozen tokens stand together in nearly, but not quite, the same urls.
    A url that repeats counts each time, always in the same half; a null url, or a null label, teaches nothing.
    """
    scratch = Scratch(labelled.sparkSession, "mined")
    known = labelled.where("url is not null and bad is not null").select("url", F.col("bad").cast("boolean").alias("bad"))
    counts = known.groupBy("url").agg(F.count(F.lit(1)).alias("m"), F.count_if("bad").alias("k"))
    counts = scratch.keep(counts.withColumn("held", F.crc32("url") % 2 == 1).withColumn("tokens", tokens(F.col("url"))), "counts")
    n, bad = counts.where("not held").agg(F.coalesce(F.sum("m"), F.lit(0)), F.coalesce(F.sum("k"), F.lit(0))).first()
    need = max(support * n, least)
    if bad < need:
        return labelled.sparkSession.createDataFrame([], "rule long, items array<string>, confidence double, support double")
    named = _alike(counts.where("not held"), need, scratch)
    own = counts.where("not held").select("url", F.explode("tokens").alias("token")).join(named.select("token", "name"), "token")
    own = own.groupBy("url").agg(F.collect_set("name").alias("names"))
    end = F.when(F.col("bad"), F.array(F.lit(_BAD))).otherwise(F.array().cast("array<string>"))
    baskets = known.join(own, "url").select(F.concat("names", end).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=need / n, minConfidence=precision).fit(scratch.keep(baskets, "baskets"))
    # support and lift of the model count baskets with a token that may matter; those here count all rows mined
    size = F.lit(scratch.spark.read.parquet(scratch.path("baskets")).count() / n)
    rules = model.associationRules.where(F.col("consequent") == F.array(F.lit(_BAD))).select(F.explode("antecedent").alias("name"), F.xxhash64(F.array_sort("antecedent")).alias("rule"), "confidence", (F.col("support") * size).alias("support"))
    rules = rules.join(named, "name").groupBy("rule", "confidence", "support").agg(F.array_sort(F.collect_set("token")).alias("items"))
    rules = scratch.keep(rules.select(F.xxhash64("items").alias("rule"), "items", "confidence", "support"), "found")
    # more general rules: every rule of fewer tokens that has its first token in this one and lies within it
    wide = rules.select(F.explode("items").alias("first"), "items", "confidence")
    less = rules.select(F.col("items")[0].alias("first"), F.col("items").alias("general"), F.col("confidence").alias("at_least"))
    covers = (F.size("general") < F.size("items")) & (F.col("at_least") >= F.col("confidence")) & (F.size(F.array_except("general", "items")) == 0)
    within = wide.join(less, "first").where(covers).select("items").distinct()
    kept = scratch.keep(rules.join(within, "items", "left_anti").select("rule", "items", "confidence", "support"), "kept")
    candidates = kept.count()
    if not candidates:
        return kept
    z = NormalDist().inv_cdf(1 - error / candidates)
    proof = counts.where("held").select("url", "m", "k")
    for name, hits in (("all", _met), ("own", match)):
        met = proof.join(hits(proof, kept, Scratch(labelled.sparkSession, "proof")).select("url", "rule"), "url")
        shown = met.groupBy("rule").agg(F.sum("m").alias("m"), F.sum("k").alias("k"))
        shown = shown.where(_lower(F.col("k") / F.col("m"), F.col("m"), z) > precision).select("rule")
        kept = scratch.keep(kept.join(shown, "rule", "left_semi"), name)
    return kept


def _alike(counts: DataFrame, need: float, scratch: Scratch) -> DataFrame:
    """(token, name) of the tokens of ``need`` bad rows, from rows (url, k, tokens): tokens that stand in the same urls
    have one name, the least of them.

    Any combination of such tokens has the rows of all of them, and a dozen would make thousands. Candidates have as many
    urls and equal sums of two hashes; each url then shows whether it holds all tokens of a name or none.
    """
    each = counts.select("url", "k", F.explode("tokens").alias("token"))
    part = lambda seed: F.sum(F.shiftright(F.xxhash64(F.lit(seed), "url"), 24))
    marks = each.groupBy("token").agg(F.sum("k").alias("k"), F.count(F.lit(1)).alias("n"), part(1).alias("x"), part(2).alias("y")).where(F.col("k") >= need)
    same = marks.groupBy("n", "x", "y").agg(F.min("token").alias("name"), F.count(F.lit(1)).alias("size"), F.collect_list("token").alias("members"))
    named = scratch.keep(same.select("name", "size", F.explode("members").alias("token")), "names")
    held = each.join(named.where("size > 1"), "token").groupBy("url", "name", "size").agg(F.count(F.lit(1)).alias("n"))
    wrong = held.where("n < size").select("name").distinct().withColumn("wrong", F.lit(True))
    named = named.join(wrong, "name", "left")
    return scratch.keep(named.select("token", F.when(F.col("wrong"), F.col("token")).otherwise(F.col("name")).alias("name")), "alike")


def _lower(p: Column, m: Column, z: float) -> Column:
    """Lower end of the Wilson interval of a share ``p`` among ``m``."""
    return (p + z * z / (2 * m) - z * F.sqrt(p * (1 - p) / m + z * z / (4 * m * m))) / (1 + z * z / m)


def _met(urls: DataFrame, rules: DataFrame, scratch: Scratch) -> DataFrame:
    """(url, rule, confidence, items) of the distinct urls and all rules that match them, by an inverted index: a rule
    waits at its rarest token, and a url looks at the rules of its own tokens alone."""
    rows = scratch.keep(urls.where("url is not null").select("url").distinct().withColumn("tokens", tokens(F.col("url"))), "tokens")
    wanted = rules.select(F.explode("items").alias("token")).distinct()
    counts = rows.select(F.explode("tokens").alias("token")).join(wanted, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    index = rules.withColumn("token", F.explode("items")).join(counts, "token", "left")
    index = index.groupBy("rule", "items", "confidence").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"].alias("token"))
    met = rows.select("url", "tokens", F.explode("tokens").alias("token")).join(index, "token")
    return met.where(F.size(F.array_except("items", "tokens")) == 0).select("url", "rule", "confidence", "items")


def match(urls: DataFrame, rules: DataFrame, scratch: Scratch) -> DataFrame:
    """(url, rule, confidence, n_rules) of the distinct urls that a rule matches, with the most confident rule, of
    several the one with more tokens."""
    rules = scratch.keep(rules, "rules")
    if rules.isEmpty():
        return urls.select("url", F.lit(0).cast("long").alias("rule"), F.lit(0.0).alias("confidence"), F.lit(0).cast("long").alias("n_rules")).limit(0)
    best = F.max(F.struct("confidence", F.size("items").alias("size"), "items", "rule"))
    met = _met(urls, rules, scratch).groupBy("url").agg(best.alias("best"), F.count(F.lit(1)).alias("n_rules"))
    return met.select("url", "best.rule", "best.confidence", "n_rules")


def judge(pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str, str]], url: str = "url", key: str = "page_id") -> DataFrame:
    """One row (key, host, path, rule, verdict, confidence) per row of ``pages``.

    ``rules`` are curated (verdict, host, path): one fits its host and all subdomains where the path of the url starts
    with its own, and the longest wins. Where none fits the mined rules decide: block if one matches. A url that is
    null or has no ``://`` has an empty host and path, fits no rule and is allowed, unless a mined rule of its query
    names matches. ``labelled`` has (url, bad); without bad pages nothing is mined. Urls that repeat are matched once and
    judged alike; other columns are ignored, and an empty table gives an empty result.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    name = verdict = None
    for what, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((F.col("host") == h) | F.col("host").endswith(f".{h}")) & F.col("path").startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    none = F.lit(None).cast("string")
    rows = rows.withColumns({"rule": none if name is None else name, "_own": none if verdict is None else verdict})
    hits = match(rows.where("rule is null"), mine(labelled), scratch).select(F.col("url").alias("_u"), "confidence")
    out = rows.join(hits, F.col("url") == F.col("_u"), "left")
    return out.select(
        F.col("page_id").alias(key),
        "host",
        "path",
        "rule",
        F.coalesce("_own", F.when(F.col("confidence").isNotNull(), F.lit("block")), F.lit("allow")).alias("verdict"),
        "confidence",
    )
