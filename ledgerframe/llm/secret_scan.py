"""Secret scans: patterns, and sliding-window Shannon entropy per character class over candidate strings."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .native import let

# The base patterns and the least length of what they must find.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"

#: Order of kinds at one start.
KINDS = ("assign", "access", "hex", "entropy")
_SPAN = "array<struct<start:int,rank:int,end:int>>"


@dataclass(frozen=True)
class CharClass:
    """Candidates of one class: which strings belong, the symbols counted, and the bits a window must reach."""

    name: str
    member: str
    symbols: str
    bits: float


#: First class that fits counts. Symbols outside ``symbols`` share one more slot.
CLASSES = (
    CharClass("hex", r"^[0-9a-fA-F-]+$", "0123456789abcdefABCDEF", 3.1),
    CharClass("alnum", r"^(?=.*[0-9])(?=.*[A-Za-z])[0-9A-Za-z]+$", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", 3.7),
    CharClass("lower", r"^(?=.*[0-9])(?=.*[a-z])[0-9a-z+/_=-]+$", "0123456789abcdefghijklmnopqrstuvwxyz+/_=-", 3.7),
    CharClass("upper", r"^(?=.*[0-9])(?=.*[A-Z])[0-9A-Z+/_=-]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-", 3.7),
    CharClass("base64", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z]).+$", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-", 3.9),
)
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Matches, or windows, that one fold goes over.
BLOCK = 256
#: Strings that are random by design and no secrets, or that say that they are examples.
ALLOWED = (r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", r"(?i)example|sample|placeholder|xxxx|0123456789|abcdefgh", r"^[-=_/]+$", r"^(.{1,4})\1+$")


def _in_blocks(items: Column, body) -> Column:
    """Array of ``body(block)`` over blocks of BLOCK items: what a fold appends to is then never long, so the work
    grows with the items and not with their square."""
    starts = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int"))
    return F.transform(starts, lambda k: let(F.slice(items, k * BLOCK + 1, F.lit(BLOCK)), body))


def _spans(text: Column, pattern: str, rank: int, values: Column | None = None) -> Column:
    """Spans of all matches (of those with a value of ASSIGN_LEAST characters, if ``values`` are given); their
    positions are the sums of the lengths of what lies between, first within blocks of matches and then over blocks."""
    span = lambda begin, end: F.struct(begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"))

    def placed(hits: Column) -> Column:
        pieces = F.split(text, pattern, -1)
        zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

        def step(acc: Column, x: Column) -> Column:
            begin = acc["at"] + F.char_length(x["piece"])
            end = begin + F.char_length(x["hit"])
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span(begin, end))).alias("out"))

        def shifted(blocks: Column) -> Column:
            ends = F.transform(blocks, lambda b: b["at"])
            grown = F.aggregate(ends, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
            by = F.arrays_zip(blocks.alias("block"), F.slice(grown, F.lit(1), F.size(blocks)).alias("before"))
            return F.flatten(F.transform(by, lambda b: F.transform(b["block"]["out"], lambda s: span(s["start"] + b["before"], s["end"] + b["before"]))))

        both = F.arrays_zip(hits.alias("hit"), F.slice(pieces, 1, F.size(hits)).alias("piece"))
        all_ = let(_in_blocks(both, lambda block: F.aggregate(block, zero, step)), shifted)
        if values is not None:
            long_enough = F.filter(F.arrays_zip(all_.alias("span"), values.alias("value")), lambda x: F.char_length(x["value"]) >= ASSIGN_LEAST)
            all_ = F.transform(long_enough, lambda x: x["span"])
        return all_

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda hits: F.when(F.size(hits) == 0, F.array().cast(_SPAN)).otherwise(placed(hits)))


def _plogp(n: int) -> Column:
    """c * log2(c) for counts 0 to n, as an array to look up."""
    return F.lit([0.0] + [c * math.log2(c) for c in range(1, n + 1)])


def entropy_runs(candidate: Column, symbols: str, bits: float, window: int = WINDOW) -> Column:
    """Stretches (lo, hi) of a candidate all of whose windows reach ``bits``, overlapping windows joined.

    A fold over the characters holds the counts of the window, one slot per symbol of the class, and the sum of
    c * log2(c): a character that enters or leaves changes one count and two terms of the sum, nothing is recounted.
    The entropy of a window is log2(window) - sum / window. A long candidate is folded in blocks of BLOCK windows, and
    stretches that touch are joined afterwards.
    """
    slots = len(symbols) + 1
    table = _plogp(window)
    slot = lambda ch: F.instr(F.lit(symbols), ch)  # noqa: E731  0 for any other symbol
    runs_type = "array<struct<lo:int,hi:int>>"

    def folded(codes: Column, begin: Column) -> Column:
        """Stretches of the windows that start at ``begin`` to ``begin`` + BLOCK - 1."""
        zero = F.struct(F.array_repeat(F.lit(0), slots).alias("counts"), F.lit(0.0).alias("sum"), F.array().cast(runs_type).alias("runs"))

        def term(counts: Column, k: Column, by: int) -> Column:
            c = F.get(counts, k)
            return F.get(table, c + by) - F.get(table, c)

        def moved(counts: Column, k: Column, by: int) -> Column:
            return F.concat(F.slice(counts, F.lit(1), k), F.array(F.get(counts, k) + by), F.slice(counts, k + 2, F.lit(slots)))

        def step(acc: Column, i: Column) -> Column:
            new, old = F.get(codes, i), F.get(codes, i - window)
            state = lambda counts, total: F.struct(counts.alias("counts"), total.alias("sum"))
            out = state(moved(acc["counts"], old, -1), acc["sum"] + term(acc["counts"], old, -1))
            left = F.when(i - begin >= window, out).otherwise(state(acc["counts"], acc["sum"]))
            now = let(left, lambda a: state(moved(a["counts"], new, 1), a["sum"] + term(a["counts"], new, 1)))

            def closed(a: Column) -> Column:
                high = (i - begin >= window - 1) & (F.lit(math.log2(window)) - a["sum"] / window >= bits)
                lo, hi, runs = i - (window - 1), i + 1, acc["runs"]
                last = F.get(runs, F.size(runs) - 1)
                run = lambda x: F.array(F.struct(x.alias("lo"), hi.alias("hi")))
                longer = F.concat(F.slice(runs, F.lit(1), F.size(runs) - 1), run(last["lo"]))
                grown = F.when((F.size(runs) > 0) & (last["hi"] >= lo), longer).otherwise(F.concat(runs, run(lo)))
                return F.struct(a["counts"].alias("counts"), a["sum"].alias("sum"), F.when(high, grown).otherwise(runs).alias("runs"))

            return let(now, closed)

        steps = F.sequence(begin, F.least(begin + (BLOCK + window - 2), F.size(codes) - 1))
        return F.aggregate(steps, zero, step, lambda acc: acc["runs"])

    def joined(runs: Column) -> Column:
        """Stretches of neighbouring blocks that touch become one."""
        first = F.filter(runs, lambda x, k: (k == 0) | (F.get(runs, k - 1)["hi"] < x["lo"]))
        last = F.filter(runs, lambda x, k: (k == F.size(runs) - 1) | (F.get(runs, k + 1)["lo"] > x["hi"]))
        return F.transform(F.arrays_zip(first.alias("a"), last.alias("b")), lambda x: F.struct(x["a"]["lo"].alias("lo"), x["b"]["hi"].alias("hi")))

    def run(codes: Column) -> Column:
        begins = F.sequence(F.lit(0), F.greatest(F.size(codes) - window, F.lit(0)), F.lit(BLOCK))
        return let(F.flatten(F.transform(begins, lambda begin: folded(codes, begin))), joined)

    return let(F.transform(F.split(candidate, ""), slot), run)


def _entropy_spans(text: Column) -> Column:
    none = F.array().cast("array<struct<lo:int,hi:int>>")

    def runs(value: Column) -> Column:
        allowed = F.lit(False)
        for a in ALLOWED:
            allowed = allowed | value.rlike(a)
        out = F.when(allowed, none)
        for c in CLASSES:
            out = out.when(value.rlike(c.member), entropy_runs(value, c.symbols, c.bits))
        return out.otherwise(none)

    def moved(hits: Column, spans: Column) -> Column:
        each = F.transform(
            F.arrays_zip(hits.alias("hit"), spans.alias("span")),
            lambda x: F.transform(
                runs(x["hit"]),
                lambda r: F.struct(
                    (x["span"]["start"] + r["lo"]).alias("start"),
                    F.lit(3).alias("rank"),
                    (x["span"]["start"] + r["hi"]).alias("end"),
                ),
            ),
        )
        return F.flatten(each)

    return let(
        F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)),
        lambda hits: F.when(F.size(hits) == 0, F.array().cast(_SPAN)).otherwise(moved(hits, _spans(text, CANDIDATE, 3))),
    )


def _written(spans: Column) -> Column:
    kind = F.lit(list(KINDS))
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.get(kind, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: key, the spans of the base patterns by kind, the entropy spans, counts and digests.

    Spans are code points, the end exclusive. A null text is empty and has no spans. Repeated rows are scanned row by
    row; columns besides key and text are ignored. A candidate on the allow-list yields no entropy span; the base
    spans are never suppressed.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    t = F.col("_t")
    values = F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2))
    rows = rows.select(
        "doc_id",
        _spans(t, ASSIGN, 0, values).alias("assign"),
        _spans(t, ACCESS, 1).alias("access"),
        _spans(t, HEX, 2).alias("hex"),
        _entropy_spans(t).alias("entropy"),
    )
    base = F.concat("assign", "access", "hex")
    return rows.select(
        F.col("doc_id").alias(key), "assign", "access", "hex", "entropy",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_written(base), 256).alias("base_sha256"),
        _written(F.concat(base, "entropy")).alias("spans"),
    )
