"""Benchmark decontamination by spaced seeds: masks that ignore some words, so that a copy with words replaced still
agrees with the benchmark on what the mask takes, and verification of the aligned words around each hit."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .native import let, words
from .store import Scratch

#: 1: the word counts, 0: it may be any. The first mask is for items of STRETCH words or more: however 5 of 20 words are
#: replaced, it hits somewhere. The second is for shorter items, with 25 in 100 words replaced, and the third joins it for
#: items of up to TEN words, where one of the two always hits (tests/llm try all ways).
MASKS = ("10111", "1101", "111")
#: Words of an aligned stretch, and how many of a hundred must be equal.
STRETCH, SHARE = 20, 75
#: Items of up to so many words have two masks; items of fewer than LEAST have none and must be found whole.
TEN, LEAST = 10, 5
#: Seeds of a benchmark that are broadcast, of a hundred bytes each at most; more are joined by a shuffle.
BROADCAST_SEEDS = 1_000_000


def needed(size: int) -> int:
    """Equal words that an item of ``size`` words needs in a stretch."""
    return size if size < LEAST else -(-min(STRETCH, size) * SHARE // 100)


def _word_hashes(text: Column) -> Column:
    """Hashes of the words, letters in lower case."""
    return F.transform(words(F.lower(text)), lambda w: F.xxhash64(w))


def _seeds(h: Column, mask: int) -> Column:
    """Array of the hashes of the words that a mask takes, at each position."""
    span, at = len(MASKS[mask]), [k for k, c in enumerate(MASKS[mask]) if c == "1"]
    some = F.transform(F.sequence(F.lit(0), F.size(h) - span), lambda i: F.xxhash64(F.lit(mask), *[F.get(h, i + k) for k in at]))
    return F.when(F.size(h) >= span, some).otherwise(F.array().cast("array<bigint>"))


def _masks(size: Column) -> Column:
    """Numbers of the masks of an item of ``size`` words."""
    few = F.when(size >= LEAST, F.array(F.lit(1), F.lit(2))).otherwise(F.array().cast("array<int>"))
    return F.when(size >= STRETCH, F.array(F.lit(0))).when(size > TEN, F.array(F.lit(1))).otherwise(few)


def _whole(rows: DataFrame, items: DataFrame) -> DataFrame:
    """(doc, item, at) of items without a mask, from rows (doc, h) and items (item, item_words): the first place where a
    document has all words of the item in a row. The words are the key of the join, and one place for each document and
    item is kept before anything is shuffled."""
    sizes = sorted(r[0] for r in items.select(F.size("item_words")).distinct().collect())
    pieces = lambda n: F.transform(F.sequence(F.lit(0), F.size("h") - n), lambda i: F.struct(i.alias("at"), F.slice("h", i + 1, n).alias("item_words")))
    none = F.array().cast("array<struct<at:int,item_words:array<bigint>>>")
    every = F.concat(*[F.when(F.size("h") >= n, pieces(n)).otherwise(none) for n in sizes])
    index = F.broadcast(items) if items.count() <= BROADCAST_SEEDS else items
    return rows.select("doc", F.inline(every)).join(index, "item_words").groupBy("doc", "item", "item_words").agg(F.min("at").alias("at"))


def _best(row: str, item: str, at: str, item_at: str) -> Column:
    """Most equal words in any stretch of STRETCH aligned words that starts up to STRETCH words before the hit and
    holds it; ``row`` is the array of words of the document from position ``at`` - STRETCH on."""
    inside = lambda d: (F.col(item_at) + d >= 0) & (F.col("_from") + d >= 0)
    same = lambda d: F.get(F.col(row), F.col("_from") + d) == F.get(F.col(item), F.col(item_at) + d)
    one = lambda d: F.when(inside(d), F.coalesce(same(d).cast("int"), F.lit(0))).otherwise(0)
    equal = F.transform(F.sequence(F.lit(-STRETCH), F.lit(2 * STRETCH)), one)
    total = lambda e, k: F.aggregate(F.slice(e, k + 1, STRETCH), F.lit(0), lambda a, b: a + b)
    return let(equal, lambda e: F.array_max(F.transform(F.sequence(F.lit(0), F.lit(STRETCH)), lambda k: total(e, k))))


def overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id") -> DataFrame:
    """(key, item, at, item_at, equal): verified overlaps, one per document, item and hit.

    A hit is verified on the aligned words around it: of some stretch of 20 words that holds the hit (or of the whole
    item, where it is shorter) at least 75 in 100 must be equal, and all of an item of fewer than LEAST words. Every
    such stretch has a hit. An item of one to four words leaves no seed to ignore words in; it meets the documents as a
    whole, once for each document. Items without words match nothing; null texts likewise. Words compare in lower case.
    Seeds carry item and place alone; the words of an item meet the hits by its id. Ids must not be long strings, as up
    to BROADCAST_SEEDS of them are broadcast.
    """
    scratch = Scratch(docs.sparkSession, "leaks")
    items = benchmark.where(F.col(text).isNotNull() & F.col(item).isNotNull()).select(F.col(item).alias("item"), _word_hashes(F.col(text)).alias("item_words"))
    items = scratch.keep(items.where(F.size("item_words") > 0).distinct().withColumn("masks", _masks(F.size("item_words"))), "items")
    used = sorted(r.mask for r in items.select(F.explode("masks").alias("mask")).distinct().collect()) or [0]
    found = [items.where(F.array_contains("masks", m)).select("item", F.posexplode(_seeds(F.col("item_words"), m)).alias("item_at", "seed")) for m in used]
    seeds = scratch.keep(functools.reduce(DataFrame.unionByName, found).distinct(), "seeds")

    rows = docs.where(F.col(text).isNotNull() & F.col(key).isNotNull())
    few = items.where(F.size("masks") == 0).select("item", "item_words")
    short = None if few.isEmpty() else _whole(rows.select(F.col(key).alias("doc"), _word_hashes(F.col(text)).alias("h")), few)
    whole = let(_word_hashes(F.col(text)), lambda h: F.struct(h.alias("h"), *[_seeds(h, m).alias(f"s{m}") for m in used]))
    rows = rows.select(F.col(key).alias("doc"), whole.alias("x"))
    every = F.concat(*[F.col(f"x.s{m}") for m in used])
    sizes = [F.size(f"x.s{m}") for m in used]
    rows = rows.select("doc", F.col("x.h").alias("h"), F.array(*sizes).alias("sizes"), F.posexplode(every).alias("pos", "seed"))
    before = [functools.reduce(Column.__add__, [F.get("sizes", F.lit(j)) for j in range(k + 1)]) for k in range(len(used) - 1)]
    gone = [F.when(F.col("pos") >= b, F.get("sizes", F.lit(k))).otherwise(0) for k, b in enumerate(before)]
    rows = rows.withColumn("at", functools.reduce(Column.__sub__, gone, F.col("pos")))  # each mask's places count from 0
    near = F.slice("h", F.greatest(F.col("at") - STRETCH, F.lit(0)) + 1, 3 * STRETCH + 1).alias("near")
    if seeds.count() <= BROADCAST_SEEDS:
        met = rows.join(F.broadcast(seeds), "seed").select("doc", "at", near, "item", "item_at")
    else:  # texts don't go through the shuffle: what is near a hit is looked up again by its document
        places = rows.select("doc", "at", "seed").join(seeds, "seed").select("doc", "at", "item", "item_at")
        places = places.groupBy("doc").agg(F.collect_list(F.struct("at", "item", "item_at")).alias("places"))
        words_of = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("doc"), _word_hashes(F.col(text)).alias("h"))
        met = words_of.join(places, "doc").select("doc", "h", F.explode("places").alias("p")).select("doc", "h", "p.*").select("doc", "at", near, "item", "item_at")
    hits = scratch.keep(met, "hits").join(items.select("item", "item_words"), "item")
    hits = hits.withColumn("_from", F.least("at", F.lit(STRETCH)))
    size = F.size("item_words")
    least = F.when(size < LEAST, size).otherwise(F.ceil(F.least(F.lit(STRETCH), size) * SHARE / 100))
    hits = hits.withColumn("equal", _best("near", "item_words", "at", "item_at")).where(F.col("equal") >= least)
    out = hits.select(F.col("doc").alias(key), F.col("item").alias(item), "at", "item_at", "equal")
    if short is None:
        return out
    return out.unionByName(short.select(F.col("doc").alias(key), F.col("item").alias(item), "at", F.lit(0).alias("item_at"), F.size("item_words").alias("equal")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id") -> DataFrame:
    """One row (key, contaminated, n_items, items, equal) per row of ``docs``: whether it holds a passage of the
    benchmark, the sorted items, and the most equal words of a stretch (0 if none).

    Rows that repeat a key get the findings of all rows of the key; a null key or text is never contaminated. An empty
    benchmark marks nothing. Columns besides key and text are ignored.
    """
    by = overlaps(docs, benchmark, text, key, item).groupBy(key).agg(F.sort_array(F.collect_set(item)).alias("items"), F.max("equal").cast("long").alias("equal"))
    out = docs.select(key).join(by, key, "left")
    return out.select(
        key,
        F.col("items").isNotNull().alias("contaminated"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast(by.schema["items"].dataType)).alias("items"),
        F.coalesce("equal", F.lit(0)).cast("long").alias("equal"),
    )
