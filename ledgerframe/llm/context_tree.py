"""Language-model scores by context-tree weighting, beside those of smoothed word counts.

Every byte is eight binary decisions, each made at a node of the byte's binary tree (its bits so far). Each such node has
a context tree of its own: its root counts zeros and ones in all contexts, its children tell the byte before apart, theirs
the byte before that, down to ``ORDER`` bytes. A node's estimate is that of Krichevsky and Trofimov; its weighted
probability is half that of its own counts and half the product of its children's. So a prediction mixes the estimates of
all depths, each with the weight that the training texts gave it. Statistics are frozen: nothing is learned from the
texts that are scored.

All training texts are counted, in strings of ``ORDER`` + 1 bytes, and every node that they reach is kept. The nodes of
up to ``TOP`` bytes are at most 255 for each pair of bytes, whatever the size of the corpus; the driver weighs them. The
trees below them are dealt over tasks by their ``TOP`` + 1 newest bytes, which no two tasks share: a first pass tells what
each adds to the node above it, a second one gives the code length of every string that any text has. The most frequent
strings are looked up in the tasks that score, the others meet their lengths by a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .store import Scratch

_U = np.uint64
ORDER = 5
#: Contexts of so many bytes are weighed by the driver, longer ones by tasks.
TOP = 2
#: A node is kept if it has one in so many of all symbols: all nodes are.
NODES = 1 << 62
#: Strings whose code lengths are looked up in the tasks, 16 bytes each.
HOT = 1 << 20
#: A word is common if it is one in so many of all words, and one in 2**24 for each of its bytes: common words are at
#: most so many and have 16 MB at most. They are looked up in the tasks; the others meet their counts by a join.
COMMON = 1 << 20
#: Stands before and after every text; no byte of UTF-8.
_EDGE = 0xFF
#: Symbols, or different strings, that are worked on together.
_STEP = 1 << 20


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function by Stirling's series, ten steps up."""
    z = x + 10.0
    out = (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7)
    for k in range(10):
        out -= np.log(x + k)
    return out


#: Logarithms of the gamma function at small counts and a half, and at one more.
_HALVES, _WHOLE = (log_gamma(np.arange(1 << 12) + x) for x in (0.5, 1.0))


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of so many zeros and ones."""
    out, few = np.empty(len(zeros)), zeros + ones < len(_WHOLE)
    z, o = zeros[few].astype(np.int64), ones[few].astype(np.int64)
    out[few] = _HALVES[z] + _HALVES[o] - _WHOLE[z + o]
    z, o = zeros[~few], ones[~few]
    out[~few] = log_gamma(z + 0.5) + log_gamma(o + 0.5) - log_gamma(z + o + 1.0)
    return out - np.log(np.pi)


def log_weighted(own: np.ndarray, product: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The weight of nodes against their children, and the logarithm of their weighted probability."""
    return 1 / (1 + np.exp(np.clip(product - own, -700, 700))), np.logaddexp(own, product) - np.log(2)


def framed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with A-Z in lower case, ``ORDER`` edges before and one after each; where each begins, and the end."""
    n, length = len(offsets) - 1, np.diff(offsets)
    start = np.concatenate((np.zeros(1, np.int64), np.cumsum(length + ORDER + 1)))
    out = np.full(int(start[-1]), _EDGE, np.uint8)
    inside = np.ones(len(out), bool)
    for k in range(ORDER):
        inside[start[:-1] + k] = False
    inside[start[1:] - 1] = False
    out[inside] = T.LOWER[data[offsets[0] : offsets[n]]]
    return out, start


def symbols(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Strings of a symbol and the ``ORDER`` bytes before it, as numbers, and the text of each; texts of any length in
    steps of a fixed size."""
    out, start = framed(data, offsets)
    for a in range(ORDER, len(out), _STEP):
        b = min(a + _STEP, len(out))
        key = np.zeros(b - a, _U)
        for k in range(ORDER + 1):
            key = key << _U(8) | out[a - ORDER + k : b - ORDER + k]
        text = np.searchsorted(start, np.arange(a, b), "right") - 1
        symbol = np.arange(a, b) - start[text] >= ORDER
        yield key[symbol], text[symbol]


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Strings of texts with how often they came, those of texts to learn from (all, without a column ``held_out``) apart."""
    for batch in batches:
        apart = "held_out" in batch.schema.names
        held = np.asarray(batch.column(batch.schema.get_field_index("held_out"))) if apart else np.zeros(batch.num_rows, bool)
        for key, text in symbols(*T.columns(batch, "text")):
            unlearned = held[text]
            for some, learned in ((key[~unlearned], True), (key[unlearned], False)):
                found, n = np.unique(some, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n), pa.array(n * learned)], names=["gram", "m", "n"])


def nodes(grams: DataFrame, least: int, scratch: Scratch) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Keys (context and bits so far), zeros and ones of the nodes of each depth that have ``least`` symbols."""
    out = []
    for depth in range(ORDER, -1, -1):
        mask = (1 << 8 * (depth + 1)) - 1
        grams = grams.groupBy(F.col("gram").bitwiseAND(F.lit(mask)).alias("gram")).agg(F.sum("n").alias("n"))
        if depth:
            grams = scratch.keep(grams, f"strings-{depth}")
        x, j = F.col("gram").bitwiseAND(F.lit(255)), F.explode(F.sequence(F.lit(0), F.lit(7))).alias("j")
        bits = grams.select("n", x.alias("x"), F.shiftright("gram", 8).alias("context"), j)
        so_far = F.expr("shiftleft(1L, j) | shiftright(x, 8 - j)")
        one = F.expr("shiftright(x, 7 - j) & 1")
        key = F.shiftleft("context", 8).bitwiseOR(so_far).alias("key")
        counts = bits.select(key, (F.col("n") * (1 - one)).alias("zeros"), (F.col("n") * one).alias("ones")).groupBy("key").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))
        found = counts.where(F.col("zeros") + F.col("ones") >= least).toArrow().sort_by("key")
        key, zeros, ones = (found.column(c).to_numpy() for c in ("key", "zeros", "ones"))
        out.append((key.astype(_U), zeros.astype(np.float64), ones.astype(np.float64)))
    return out[::-1]


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key stands, and whether it does."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


class Model:
    """For each depth: keys, the estimate of a one, a node's weight against its children, and the estimate of the child
    that stands for all contexts not kept."""

    def __init__(self, counts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], below: tuple[np.ndarray, ...] | None = None):
        """``below``: keys, zeros, ones and logarithms of the weighted probabilities of nodes under the deepest ones; those
        of one parent may be taken together under its key."""
        self.depths = []
        for depth in range(len(counts) - 1, -1, -1):
            key, zeros, ones = counts[depth]
            own = log_estimate(zeros, ones)
            weight, whole = np.ones(len(key)), own
            other = np.full(len(key), 0.5)
            if below is not None and len(below[0]):
                keys, z, o, weighted = below
                # the context without its oldest byte
                parent, _ = _find(key, keys & _U((1 << 8 * (depth + 1)) - 1))
                children = np.bincount(parent, minlength=len(key)) > 0
                left_z, left_o = zeros - np.bincount(parent, z, len(key)), ones - np.bincount(parent, o, len(key))
                product = np.bincount(parent, weighted, len(key)) + log_estimate(left_z, left_o)
                some, mixed = log_weighted(own, product)
                weight, whole = np.where(children, some, 1.0), np.where(children, mixed, own)
                other = (left_o + 0.5) / (left_z + left_o + 1)
            self.depths.append((key, (ones + 0.5) / (zeros + ones + 1), weight, other))
            below = key, zeros, ones, whole
        self.depths.reverse()

    def bits(self, grams: np.ndarray, deeper: np.ndarray | None = None) -> np.ndarray:
        """Code length in bits of the last byte of each string after those before it. ``deeper``: for each of its bits, the
        chance that longer contexts than those of this model give it."""
        x, out = grams & _U(255), np.zeros(len(grams))
        for j in range(8):
            so_far = _U(1 << j) | x >> _U(8 - j)
            one = (x >> _U(7 - j) & _U(1)).astype(bool)
            chance, left, open_ = np.zeros(len(grams)), np.ones(len(grams)), np.arange(len(grams))
            rest = np.full(len(grams), 0.5) if deeper is None else deeper[j]
            # chances of the bit that came, as a difference from one would lose small ones
            for depth, (keys, estimate, weight, other) in enumerate(self.depths):
                context = grams[open_] >> _U(8) & _U((1 << 8 * depth) - 1)
                at, ok = _find(keys, context << _U(8) | so_far[open_])
                estimate, other = estimate[at], other[at]
                zero = ~one[open_]
                estimate[zero], other[zero] = 1 - estimate[zero], 1 - other[zero]
                gone = open_[~ok]
                chance[gone] += left[gone] * rest[gone]
                left[gone] = 0
                at, open_ = at[ok], open_[ok]
                chance[open_] += left[open_] * weight[at] * estimate[ok]
                left[open_] *= 1 - weight[at]
                if deeper is None:
                    rest[open_] = other[ok]
                open_ = open_[left[open_] > 0]
            chance += left * rest
            out -= np.log2(chance)
        return out


def below(grams: np.ndarray, n: np.ndarray) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """The trees under nodes of ``TOP`` bytes, from all different strings that share their ``TOP`` + 1 newest bytes before the
    last and how often each was learned (some never).

    What they add to the nodes above (keys; zeros, ones and the logarithm of the product of weighted probabilities), and
    for each bit and string the chance that they give to the bit, as by ``Model.bits``.
    """
    order = np.argsort(grams)
    keys, counts, up = [grams[order]], [n[order].astype(np.float64)], []
    for depth in range(ORDER - 1, TOP, -1):
        key, at = np.unique(keys[-1] & _U((1 << 8 * (depth + 1)) - 1), return_inverse=True)
        counts.append(np.bincount(at, counts[-1], len(key)))
        keys.append(key)
        up.append(at)
    chances, above = np.empty((8, len(grams))), []
    for j in range(8):
        chance, to = np.empty(0), np.arange(len(grams))
        for k, key in enumerate(keys):
            # strings of one context and the same bits so far lie side by side
            first = np.concatenate((np.ones(1, bool), np.diff(key >> _U(8 - j)) > 0))
            node, head = np.cumsum(first) - 1, np.flatnonzero(first)
            one = (key >> _U(7 - j) & _U(1)).astype(bool)
            total, ones = np.bincount(node, counts[k]), np.bincount(node, counts[k] * one)
            zeros = total - ones
            own = log_estimate(zeros, ones)
            estimate = (np.where(one, ones[node], zeros[node]) + 0.5) / (total[node] + 1)
            if k:
                product = np.bincount(node[up[k - 1][heads]], whole, len(head))
                weight, whole = log_weighted(own, product)
                to = up[k - 1][to]
                share = weight[node[to]]
                chance = share * estimate[to] + (1 - share) * chance
            else:
                whole, chance = own, estimate
            heads = head
        chances[j, order] = chance
        last = keys[-1][heads]
        parent = last & _U((1 << 8 * (TOP + 1)) - 1 ^ 255) | _U(1 << j) | (last & _U(255)) >> _U(8 - j)
        found, at = np.unique(parent, return_inverse=True)
        above.append((found, *(np.bincount(at, x, len(found)) for x in (zeros, ones, whole))))
    return tuple(np.concatenate(x) for x in zip(*above, strict=True)), chances


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Strings, how often they were learned and came at all, in parts that split no group of ``_dealt``."""
    held, size, due = [], 0, _STEP
    for batch in batches:
        held.append([batch.column(k).to_numpy() for k in range(3)])
        size += batch.num_rows
        if size >= due:
            gram, n, m = (np.concatenate(x) for x in zip(*held, strict=True))
            group = gram >> 8 & ((1 << 8 * (TOP + 1)) - 1)
            cut = int(np.searchsorted(group, group[-1]))
            if cut:
                yield gram[:cut].view(_U), n[:cut], m[:cut]
            held, size = [[gram[cut:], n[cut:], m[cut:]]], size - cut
            due = max(_STEP, 2 * size)
    if size:
        gram, n, m = (np.concatenate(x) for x in zip(*held, strict=True))
        yield gram.view(_U), n, m


def _dealt(grams: DataFrame, different: int) -> DataFrame:
    """Strings by the ``TOP`` + 1 bytes before the last: a group is a few megabytes of strings at most, and together."""
    group = F.shiftright("gram", 8).bitwiseAND(F.lit((1 << 8 * (TOP + 1)) - 1))
    many = max(int(grams.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-different // _STEP))
    return grams.select("gram", "n", "m").repartition(many, group).sortWithinPartitions(group)


def lengths(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """(gram, bits, m): each string of the column ``text``, its code length by all contexts of those texts that aren't
    ``held_out``, and how often it came."""
    counted = texts.select("text", "held_out").mapInArrow(_grams, "gram long, m long, n long")
    grams = scratch.keep(counted.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("m").alias("m")), "grams")
    dealt = _dealt(grams, grams.count())

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gram, n, _ in _whole_groups(batches):
            key, *sums = below(gram, n)[0]
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *map(pa.array, sums)], names=["key", "zeros", "ones", "product"])

    above = dealt.mapInArrow(first, "key long, zeros double, ones double, product double").groupBy("key")
    found = above.agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "product")]).toArrow().sort_by("key")
    key, zeros, ones, product = (found.column(c).to_numpy() for c in ("key", "zeros", "ones", "product"))
    key = key.astype(_U)
    counts = [(key, zeros, ones)]
    for depth in range(TOP - 1, -1, -1):
        inner, at = np.unique(counts[0][0] & _U((1 << 8 * (depth + 1)) - 1), return_inverse=True)
        counts.insert(0, (inner, *(np.bincount(at, x, len(inner)) for x in counts[0][1:])))
    top = texts.sparkSession.sparkContext.broadcast(Model(counts, (key, zeros, ones, product)))

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gram, n, m in _whole_groups(batches):
            bits = top.value.bits(gram, below(gram, n)[1])
            yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(bits), pa.array(m)], names=["gram", "bits", "m"])

    out = scratch.keep(dealt.mapInArrow(second, "gram long, bits double, m long"), "lengths")
    scratch.drop("grams")
    return out


def hottest(found: DataFrame, hot: int) -> int:
    """How often a string must have come to be one of at most ``hot``: a power of two."""
    power = F.floor(F.log2("m")).cast("int")
    many, least = 0, 64
    for r in sorted(found.groupBy(power.alias("power")).count().collect(), reverse=True):
        many += r["count"]
        if many > hot:
            break
        least = r["power"]
    return 1 << least if least < 63 else (1 << 63) - 1


def learn(train: DataFrame, most: int = NODES) -> Model:
    """A model of the column ``text`` in one piece, for corpora that are small (``score`` doesn't need it); of nothing, one
    by which all bytes are alike."""
    scratch = Scratch(train.sparkSession, "context-trees")
    grams = scratch.keep(train.select("text").mapInArrow(_grams, "gram long, m long, n long").groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    total = grams.agg(F.sum("n")).first()[0] or 0
    found = nodes(grams, max(1, -(-total // most)), scratch)
    scratch.drop("")
    return Model(found)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 7 == 2, F.lit(False))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = T.columns(batch, "text")
        for _, _, some, off in T.blocks(data, offsets, T.SLICE_BYTES, T.SPACES):
            n = pc.value_counts(T.split(some, off, T.SPACES)[0])
            yield pa.RecordBatch.from_arrays([n.field(0).cast(pa.string()), n.field(1)], names=["word", "n"])


def _lists(sizes: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes))).astype(np.int32)), values)


def score(docs: DataFrame, text: str = "text", key: str = "doc_id", common: int = COMMON, hot: int = HOT) -> DataFrame:
    """One row (key, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) for each row.

    Rows whose key has a checksum that leaves 2 modulo 7 are held out; the model and the counts come from all others
    that have a key. A null text is an empty one; an empty text has one token and one symbol, its end. With nothing to
    learn from, every byte takes eight bits and the base score is zero. Rows that repeat are scored alike, each learned
    from; other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "scores")
    rows = docs.select(F.col(key).alias("id"), held_out(F.col(key)).alias("held_out"), F.coalesce(text, F.lit("")).alias("text"))
    train = rows.where("not held_out and id is not null").select("text")
    counts = scratch.keep(train.mapInArrow(_word_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    size = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).first()
    ends = train.count()
    total, whole = (size.n or 0) + ends, (size.n or 0) + ends + size.words + (ends > 0) + 1
    is_common = F.col("n") >= F.lit(total) * F.greatest(F.lit(1 / common), F.octet_length("word") / (16.0 * common))
    known = counts.where(is_common).toArrow()
    shared = spark.sparkContext.broadcast((known.column("word").combine_chunks().cast(pa.large_utf8()), np.log10((known.column("n").to_numpy() + 1) / whole)))
    # rows without a key are scored, not learned from
    costs = lengths(rows.select("text", (F.col("held_out") | F.col("id").isNull()).alias("held_out")), scratch)
    least = hottest(costs, hot)
    top = costs.where(F.col("m") >= least).select("gram", "bits").toArrow().sort_by("gram")
    frequent = spark.sparkContext.broadcast((top.column("gram").to_numpy().astype(_U), top.column("bits").to_numpy()))
    end = float(np.log10((ends + 1) / whole))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, logs = shared.value
        strings, costs = frequent.value
        for batch in batches:
            n = batch.num_rows
            data, offsets = T.columns(batch, "text")
            tokens, seen, base, bits = np.ones(n, np.int64), np.full(n, int(ends > 0)), np.full(n, end), np.zeros(n)
            rare, rare_at = [], np.zeros(n, np.int64)
            for a, b, some, off in T.blocks(data, offsets, 4 * T.SLICE_BYTES, T.SPACES):
                found, starts = T.split(some, off, T.SPACES)
                text = np.searchsorted(off, starts, "right") - 1
                at = pc.index_in(found, value_set=words)
                ok = np.asarray(at.is_valid())
                tokens[a:b] += np.bincount(text, minlength=b - a)
                seen[a:b] += np.bincount(text[ok], minlength=b - a)
                base[a:b] += np.bincount(text[ok], logs[at.drop_null().to_numpy()], b - a)
                rare_at[a:b] += np.bincount(text[~ok], minlength=b - a)
                rare.append(found.filter(pa.array(~ok)).cast(pa.string()))
            left, left_at = [np.zeros(0, _U)], np.zeros(n, np.int64)
            for grams, text in symbols(data, offsets):
                found, own = np.unique(grams, return_inverse=True)
                at, ok = _find(strings, found)
                cost = np.zeros(len(found))
                cost[ok] = costs[at[ok]]
                bits += np.bincount(text, cost[own], n)
                away = ~ok[own]
                left_at += np.bincount(text[away], minlength=n)
                left.append(grams[away])
            others = _lists(rare_at, pa.concat_arrays(rare) if rare else pa.array([], pa.string()))
            strange = _lists(left_at, pa.array(np.concatenate(left).view(np.int64)))
            size = pa.array(np.diff(offsets) + 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(x) for x in (tokens, seen, base, bits)], size, others, strange],
                names=["id", "held_out", "n_tokens", "seen", "base", "bits", "size", "others", "strange"],
            )

    kind = dict(rows.dtypes)["id"]
    made = rows.mapInArrow(run, f"id {kind}, held_out boolean, n_tokens long, seen long, base double, bits double, size long, others array<string>, strange array<long>")
    made = scratch.keep(made.withColumn("row", F.monotonically_increasing_id()), "rows")
    met = made.select("row", F.explode("others").alias("word")).join(counts.where(~is_common), "word", "left")
    more = met.groupBy("row").agg(F.sum(F.log10((F.coalesce("n", F.lit(0)) + 1) / float(whole))).alias("more"), F.count("n").alias("more_seen"))
    met = made.select("row", F.explode("strange").alias("gram")).join(costs.where(F.col("m") < least), "gram")
    rest = met.groupBy("row").agg(F.sum("bits").alias("rest"))
    bits = F.col("bits") + F.coalesce("rest", F.lit(0.0))
    return made.drop("others", "strange").join(more, "row", "left").join(rest, "row", "left").select(
        F.col("id").alias(key),
        "held_out",
        "n_tokens",
        (F.col("seen") + F.coalesce("more_seen", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (bits * -float(np.log10(2))).alias("score"),
        (bits / F.col("size")).alias("bits_per_byte"),
    )
