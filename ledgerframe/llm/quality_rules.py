"""Quality rules: a decision list of threshold conjunctions, learned by sequential covering from labelled statistics.

Statistics and learning are DataFrame aggregations; the driver only ever sees histograms of a fixed size (features
times bins). What is learned becomes one ordered CASE expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .native import let, words
from .store import Scratch

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_punct", "n_digits", "n_lines")


def _repeat_words(w: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text.

    Windows are pairs (hash, position) in order, so equal windows are neighbours. The positions of repeated windows, in
    order, then cover min(3, distance to the next) words each.
    """

    def of(h: Column) -> Column:
        n = F.size(h)

        def marked(s: Column) -> Column:
            same = lambda x, k: F.get(s, k)["h"] == x["h"]
            again = F.filter(s, lambda x, k: ((k > 0) & same(x, k - 1)) | F.coalesce(same(x, k + 1), F.lit(False)))
            at = F.sort_array(F.transform(again, lambda x: x["at"]))
            step = lambda p: F.transform(p, lambda x, k: F.coalesce(F.least(F.get(p, k + 1) - x, F.lit(3)), F.lit(3)))
            return let(at, lambda p: F.aggregate(step(p), F.lit(0).cast("long"), lambda a, b: a + b))

        window = lambda i: F.struct(F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)).alias("h"), i.alias("at"))
        windows = F.transform(F.sequence(F.lit(0), n - 3), window)
        return F.when(n < 4, F.lit(0).cast("long")).otherwise(let(F.sort_array(windows), marked))

    return let(F.transform(w, lambda x: F.xxhash64(x)), of)


def statistics(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and the statistics of each row of ``docs``, all longs; a null or blank text has zeros."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*[F.col(c) for c in keep], whole.alias("_whole"), words(F.col(text)).alias("_words"))
    joined = F.array_join("_words", "")
    lines = F.filter(F.split("_whole", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    count = lambda pattern: F.regexp_count("_whole", F.lit(pattern)).cast("long")
    rows = rows.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(joined).cast("long").alias("word_chars"),
        count("[#*$%&|<>]").alias("n_symbols"),
        let(lines, lambda x: F.array(F.size(x), F.size(x) - F.size(F.array_distinct(x)))).alias("_lines"),
        _repeat_words(F.col("_words")).alias("n_repeat_words"),
        count("[A-Z]").alias("n_upper"),
        count("[!?.,;:]").alias("n_punct"),
        count("[0-9]").alias("n_digits"),
    )
    return rows.select(*keep, *[F.col("_lines")[k].cast("long").alias(c) if k is not None else F.col(c) for c, k in zip(STATISTICS, (None, None, None, 1, None, None, None, None, 0), strict=True)])


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def features() -> dict[str, Column]:
    """Named numbers that the rules may compare with thresholds."""
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": share("word_chars", "n_words"),
        "symbol_share": share("n_symbols", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "upper_share": share("n_upper", "word_chars"),
        "punct_share": share("n_punct", "n_words"),
        "digit_share": share("n_digits", "word_chars"),
        "line_words": share("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        x = features()[self.feature]
        return x > self.threshold if self.above else x <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Ordered rules, each a conjunction that rejects; what none matches is kept."""

    rules: list[tuple[Condition, ...]] = field(default_factory=list)

    def rule(self) -> Column:
        """Text of the first rule that matches, or null."""
        out = None
        for r in self.rules:
            hit, name = reduce(lambda a, b: a & b, (c.column() for c in r)), F.lit(" and ".join(map(str, r)))
            out = F.when(hit, name) if out is None else out.when(hit, name)
        return F.lit(None).cast("string") if out is None else out


def learn(train: DataFrame, scratch: Scratch, bins: int = 32, max_rules: int = 8, max_conditions: int = 3, precision: float = 0.9, support: int = 10) -> DecisionList:
    """Sequential covering over rows of statistics with a column ``bad`` (boolean).

    Two thirds of the rows grow a rule by the condition of highest information gain, the last third prunes its tail
    and accepts it only with at least ``precision`` (a document that is wrongly rejected is the worse error); rows
    that it covers then leave. Every step is one aggregation of at most features * (bins + 1) groups.
    """
    names = list(features())
    cuts = train.select([F.percentile_approx(c, [k / bins for k in range(1, bins)], 2000).alias(n) for n, c in features().items()]).first()
    cut = {n: sorted(set(cuts[n] or [])) for n in names}
    bin_of = lambda n, x: F.size(F.filter(F.lit(cut[n] or [0.0]), lambda t: t < x)).alias(n)
    binned = [bin_of(n, c) for n, c in features().items()]
    rows = scratch.keep(train.select(F.col("bad").cast("int").alias("bad"), (F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(3)) > 0).alias("grow"), *binned), "train")
    found = DecisionList()
    left = rows

    def met(c: tuple[str, bool, int]) -> Column:
        return F.col(c[0]) > c[2] if c[1] else F.col(c[0]) <= c[2]

    def gain(p: float, n: float, p0: float, n0: float) -> float:
        return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else -1.0

    while len(found.rules) < max_rules:
        rule: list[tuple[str, bool, int]] = []
        covered = left.where("grow")
        while len(rule) < max_conditions:
            hist = covered.select(
                "bad",
                F.explode(F.array(*[F.struct(F.lit(n).alias("f"), F.col(n).alias("b")) for n in names])).alias("x"),
            ).groupBy("x.f", "x.b").agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).collect()
            one = {f: sorted((r.b, r.p, r.n) for r in hist if r.f == f) for f in names}
            p0, n0 = (sum(x[k] for x in one[names[0]]) for k in (1, 2))
            if not p0 or not n0:
                break
            best = (0.0, None)
            for f in names:
                p = n = 0
                for b, dp, dn in one[f][:-1]:
                    p, n = p + dp, n + dn
                    for above, pp, nn in ((False, p, n), (True, p0 - p, n0 - n)):
                        if pp >= support and b < len(cut[f]):
                            best = max(best, (gain(pp, nn, p0, n0), (f, above, b)), key=lambda x: (x[0], str(x[1])))
            if best[1] is None:
                break
            rule.append(best[1])
            covered = covered.where(met(best[1]))
        if not rule:
            break
        heads = [reduce(lambda a, b: a & b, map(met, rule[: k + 1])) for k in range(len(rule))]
        got = left.where("not grow").select(*[F.sum(F.when(h, v)).alias(f"{s}{k}") for k, h in enumerate(heads) for s, v in (("p", F.col("bad")), ("n", 1 - F.col("bad")))]).first()
        worth = [((p - n) / (p + n) if p + n else -1.0, -k, p, n) for k in range(len(rule)) for p, n in [(got[f"p{k}"] or 0, got[f"n{k}"] or 0)]]
        _, k, p, n = max(worth)
        if p < max(1, support // 3) or p < precision * (p + n):
            break
        rule = rule[: 1 - k]
        found.rules.append(tuple(Condition(f, above, cut[f][b] if above else cut[f][b]) for f, above, b in rule))
        left = left.where(~reduce(lambda a, b: a & b, map(met, rule)))
    return found


def _known(labels: DataFrame, key: str) -> DataFrame:
    """(doc_id, bad) of the labels that teach."""
    rows = labels.where(F.col("quality").isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("doc_id"))
    sides = rows.agg(F.min("quality").alias("low"), F.max("quality").alias("high")).where("low = high")
    return sides.select("doc_id", (F.col("low") == 0).alias("bad"))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DecisionList:
    """The rules that the labelled rows of ``docs`` teach; only these are read for it."""
    scratch = Scratch(docs.sparkSession, "quality")
    some = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("_text")).join(_known(labels, key), "doc_id")
    return learn(scratch.keep(statistics(some, "_text", ("doc_id", "bad")), "statistics").where(~base_failed()), scratch)


def verdicts(stats: DataFrame, rules: DecisionList) -> DataFrame:
    """``stats`` with ``base_failed``, ``rule`` and ``kept``."""
    rows = stats.withColumn("base_failed", base_failed())
    rows = rows.withColumn("rule", F.when(~F.col("base_failed"), rules.rule()))
    return rows.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: key, the statistics, ``base_failed``, ``rule`` (the text of the rule that rejects
    it, or null) and ``kept``.

    ``labels`` has the key and ``quality`` (1 good, 0 bad); rows without a quality, with a null key or with conflicting
    labels teach nothing; without labels of both kinds there are no rules and only the base counts. Null and blank
    texts have no words and fail the base. Rows that repeat are judged alike, row by row; other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    stats = scratch.keep(statistics(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("_text")), "_text"), "statistics")
    out = verdicts(stats, learn(stats.where(~base_failed()).join(_known(labels, key), "doc_id"), scratch))
    return out.withColumnRenamed("doc_id", key) if key != "doc_id" else out
