"""N-gram Jaccard self-join by pivots, Voronoi regions and triangle-inequality windows.

A document is its set of distinct word shingles; d(x, y) = 1 - |x & y| / |x | y| is a metric. Equal sets are collapsed
first, so a group of copies costs one member. Documents of different subject are all at distance one from each other,
where no pivot can tell them apart, so regions are seeded with slices of the shingle space: shingles are dealt to K
slices by hash, K so large that two documents within the threshold must agree wholly on some slices that aren't empty.
Documents leave out their most frequent slices, as far as one slice in common is still sure; those that agree on one of
the others may be partners, and what such agreement connects makes a region. Then, in every region:

* pivots are elected and the exact distance of every member to them is computed, which decides all their links;
* the other members go to the Voronoi cell of their nearest pivot, and a triangle-inequality window of 2 * eps
  replicates those near a border to the earlier of the two cells (``regions.cells``), so that each pair meets once;
* the cells are joined in the same way, until no two members are left whose pair isn't decided.

A task does this for whole regions (``regions.Members``). A region with more than MEMBERS members or SHINGLES shingles
is first cut by the same round of pivots, cells and windows through Spark, its members dealt over tasks. Where that
doesn't make it smaller (near copies that all lie within a window), it is cut into tiles of two blocks of its members.
A region that chains of chance agreements have joined is taken apart into its slices, if these have fewer pairs.
Whatever the cut, each pair is decided exactly, counted once, and no partner or candidate is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textops as T
from .components import connected_components
from .regions import PIVOTS, SLACK, Members, cells
from .store import Scratch

_U = np.uint64
_LEVELS = 64
#: Members and shingles of a region that a task may hold; what is larger is cut into cells first.
MEMBERS, SHINGLES = 1024, 1 << 21
#: Slices go through their counts in so many complete ranges of their hash, one after the other.
PASSES = 4


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles; texts with fewer words have one shingle, or none."""
    for _, _, part, off in T.slices(data, offsets):
        part = T.LOWER[part]
        starts, ends, first = T.words(part, off)
        word = T.bytes_hashes(part, starts, ends)
        at, grams = T.gram_hashes(word, first, size)
        cut = np.searchsorted(at, first)
        sums = T.prefix_sums(word)
        for k in range(len(off) - 1):
            n = first[k + 1] - first[k]
            if n >= size:
                yield np.unique(grams[cut[k] : cut[k + 1]])
            elif n:
                yield T.range_hash(sums, first[k : k + 1], first[k + 1 : k + 2])
            else:
                yield np.zeros(0, _U)


class Slicer:
    """Slice signatures for a threshold num / den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        step = max(1.6, den / num)
        self.high, low = [], 1
        while low < 1 << 31:
            self.high.append(max(low, int(low * step)))
            low = self.high[-1] + 1

    def classes(self, n: int) -> list[int]:
        """Size classes of the larger partner of a document with n shingles."""
        own = int(np.searchsorted(self.high, n))
        return [own, own + 1] if n * self.den // self.num > self.high[own] else [own]

    def shape(self, c: int) -> tuple[int, int]:
        """Number of slices, and on how many of them partners may differ."""
        most = 2 * self.high[c] * (self.den - self.num) // (self.den + self.num)
        spare = most // 3 + 3 if most else 0
        return most + 1 + spare, most

    def signatures(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Signatures of the slices that aren't empty, and their tags (dealing, number that may be left out).

        Of the N slices that a document fills, partners agree on N - most at least. Both may thus leave out their
        N - most - 1 most frequent ones, in one order for all documents: what the two leave out of their common slices
        is the head of the longer of the two lists, so one common slice stays. A document that fills no more than
        ``most`` slices leaves out nothing and deals its shingles anew, with another hash.
        """
        out, tags = [], []
        dealt = h
        for c in self.classes(len(h)):
            slices, most = self.shape(c)
            for level in range(_LEVELS):
                if level:
                    dealt = np.sort(T.mix(h + _U(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1)))
                else:
                    dealt = h
                which = ((dealt >> _U(32)) * _U(slices)) >> _U(32)
                edge = np.flatnonzero(which[1:] != which[:-1]) + 1
                starts = np.concatenate(([0], edge))
                total = np.add.reduceat(T.mix(dealt.copy()), starts)
                out.append(T.mix(total + which[starts] * _U(0xC2B2AE3D27D4EB4F) + _U(((c * _LEVELS + level + 1) * 0x165667B19E3779F9) & (1 << 64) - 1)))
                spare = max(0, len(starts) - most - 1)
                tags.append(np.full(len(starts), (c * _LEVELS + level) << 19 | min(spare, (1 << 19) - 1), np.int32))
                if len(starts) > most:
                    break
        return np.concatenate(out), np.concatenate(tags)


def _fingerprint(h: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    return int(T.mix(h.copy()).sum(dtype=_U)), int(T.mix(h ^ _U(0x94D049BB133111EB)).sum(dtype=_U))


_ROW = "doc_id long, n_shingles long, fp1 long, fp2 long"


def _rows(text: str, size: int):
    """Size and fingerprint of every set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, fp = [], []
            for h in shingle_sets(*T.columns(batch, text), size):
                count.append(len(h))
                fp.append(_fingerprint(h))
            pair = np.array(fp, _U).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count, pa.int64()), pa.array(pair[:, 0]), pa.array(pair[:, 1])],
                names=["doc_id", "n_shingles", "fp1", "fp2"],
            )

    return run


def _wanted(batch: pa.RecordBatch, text: str, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(cid, set) of the rows whose set is the one that their cid stands for; a doc_id may have several texts."""
    cid, fp1, fp2 = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("cid", "fp1", "fp2"))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    for k, h in enumerate(shingle_sets(*T.columns(batch, text), size)):
        a, b = _fingerprint(h)
        if (signed(a), signed(b)) == (fp1[k], fp2[k]):
            yield cid[k], h


def _signed(text: str, size: int, num: int, den: int):
    """(cid, sigs, tags) of the sets that stand for their class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slicer = Slicer(num, den)
        for batch in batches:
            cids, sigs, tags = [], [np.zeros(0, _U)], [np.zeros(0, np.int32)]
            for cid, h in _wanted(batch, text, size):
                cids.append(cid)
                for to, x in zip((sigs, tags), slicer.signatures(h), strict=True):
                    to.append(x)
            at = pa.array(np.cumsum(list(map(len, sigs))), pa.int32())
            both = [pa.ListArray.from_arrays(at, pa.array(x)) for x in (np.concatenate(sigs).view(np.int64), np.concatenate(tags))]
            yield pa.RecordBatch.from_arrays([pa.array(cids, pa.int64()), *both], names=["cid", "sigs", "tags"])

    return run


def _sets(text: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_wanted(batch, text, size))
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in found], pa.int64()), pa.array([h.tobytes() for _, h in found], pa.binary())], names=["cid", "shingles"])

    return run


def _texts_of(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """One text or more for each class, with what its set must be."""
    wanted = classes.select("cid", F.col("rep").alias("doc_id"), "fp1", "fp2")
    return texts.join(wanted, "doc_id").select("cid", "fp1", "fp2", "_text")


def jaccard_components(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 5, threshold: tuple[int, int] = (4, 5)) -> DataFrame:
    """One row (doc_id, n_shingles, component_id, n_links) for each row of ``docs``.

    ``threshold`` is the least similarity as a fraction; documents link when den * |x & y| >= num * |x | y|, counted
    exactly. ``component_id`` is the smallest doc_id reachable by links, ``n_links`` the number of other documents
    (rows) that the document links to, those with an equal set included. Documents with null or blank text
    have no shingles, link with nothing and are their own component. Rows that repeat a doc_id give a row each, with
    the component of their own text. Rows with a null doc_id can't be named by a component: they come back with a null
    component and no links. Other columns of ``docs`` are ignored, and an empty table gives an empty result.
    """
    num, den = threshold
    scratch = Scratch(docs.sparkSession, "jaccard")
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    rows = scratch.keep(texts.mapInArrow(_rows("_text", shingle), _ROW), "rows")
    same = ["fp1", "fp2", "n_shingles"]
    classes = rows.where("n_shingles > 0 and doc_id is not null").groupBy(*same).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    # a class is known by its row in the table that is written here
    classes = scratch.keep(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")

    slices = _seed(texts, classes, scratch, shingle, num, den)
    busy = classes.join(slices.select("cid").distinct(), "cid", "left_semi")
    sets = scratch.keep(_texts_of(texts.where("doc_id is not null"), busy).mapInArrow(_sets("_text", shingle), "cid long, shingles binary").dropDuplicates(["cid"]), "sets")
    roots, degree = _join(slices, classes, sets, scratch, num, den)
    scratch.drop("sets", "slices")
    named = roots.join(classes.select("cid", "rep"), "cid")
    smallest = named.groupBy("root").agg(F.min("rep").alias("component"))
    named = named.join(smallest, "root").select("cid", "component")
    facts = classes.join(degree, "cid", "left").join(named, "cid", "left")
    facts = facts.select(*same, F.coalesce("component", "rep").alias("component"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    facts = scratch.keep(facts, "facts")
    out = rows.join(facts, same, "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    linked = F.when(F.col("doc_id").isNotNull(), F.col("links"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(linked, F.lit(0)).cast("long").alias("n_links"))


def _seed(texts: DataFrame, classes: DataFrame, scratch: Scratch, shingle: int, num: int, den: int) -> DataFrame:
    """(slice, cid): the classes that agree on a slice, for slices on which two or more agree.

    Slices are as many as a good part of the shingles. They are counted in PASSES ranges of their hash, each complete,
    so that a range's share of them is in a shuffle at a time; only slices that are shared at all go on.
    """
    signed = _texts_of(texts.where("doc_id is not null"), classes).mapInArrow(_signed("_text", shingle, num, den), "cid long, sigs array<long>, tags array<int>")
    signed = scratch.keep(signed, "signed")
    flat = signed.select("cid", F.explode(F.arrays_zip("sigs", "tags")).alias("x")).select(F.col("x.sigs").alias("slice"), "cid", F.col("x.tags").alias("tag"))
    met = None
    for k in range(PASSES):
        part = flat.where(F.pmod("slice", F.lit(PASSES)) == k)
        shared = scratch.keep(part.groupBy("slice").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), f"shared-{k}")
        found = scratch.keep(part.join(shared, "slice"), f"met-{k}")
        scratch.drop(f"shared-{k}")
        met = found if met is None else met.unionByName(found)
    # the slices that a document may leave out: its most frequent ones
    place = F.row_number().over(Window.partitionBy("cid", "tag").orderBy(F.col("n").desc(), "slice"))
    members = met.withColumn("place", place).where(F.col("place") > F.col("tag").bitwiseAND((1 << 19) - 1))
    members = scratch.keep(members.select("slice", "cid").distinct(), "members")
    scratch.drop("signed", *[f"met-{k}" for k in range(PASSES)])
    # slices on which the same documents agree say the same: one of them is enough
    digest = [F.bit_xor(F.xxhash64("cid", F.lit(k))).alias(f"all{k}") for k in (1, 2)]
    alike = members.groupBy("slice").agg(F.count(F.lit(1)).alias("n"), F.min("cid").alias("low"), F.max("cid").alias("high"), *digest).where("n > 1")
    one = alike.groupBy("n", "low", "high", "all1", "all2").agg(F.min("slice").alias("slice")).select("slice")
    slices = scratch.keep(members.join(one, "slice"), "slices")
    scratch.drop("members")
    return slices


_REGION = "region struct<kind:int,id:long>"
_MEMBER = f"{_REGION}, cid long, blockers array<long>"


def _regions(slices: DataFrame, scratch: Scratch) -> DataFrame:
    """(region, cid, blockers): what agreement on slices connects; or its slices, where these have fewer pairs.

    A pair of slices' members may agree on several: the first of them decides it, so the earlier slices of a document
    block its pairs in the later ones.
    """
    ends = scratch.keep(slices.groupBy("slice").agg(F.min("cid").alias("low"), F.count(F.lit(1)).alias("n")), "ends")
    chained = connected_components(slices.join(ends, "slice").select(F.col("low").alias("a"), F.col("cid").alias("b")), scratch, "chains")
    whole = chained.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    apart = ends.join(chained, F.col("low") == F.col("node")).groupBy("root").agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("pairs"))
    large = whole.where(F.col("members") > MEMBERS).join(apart, "root").where("pairs < cast(members as double) * members").select("root")
    large = scratch.keep(large, "chained")
    if large.isEmpty():
        return chained.select(
            F.struct(F.lit(0).alias("kind"), F.col("root").alias("id")).alias("region"),
            F.col("node").alias("cid"),
            F.array().cast("array<long>").alias("blockers"),
        )
    loose = chained.join(large, "root", "left_semi").select(F.col("node").alias("cid"))
    mine = slices.join(loose, "cid").withColumn("all", F.collect_list("slice").over(Window.partitionBy("cid")))
    mine = mine.select(F.struct(F.lit(1).alias("kind"), F.col("slice").alias("id")).alias("region"), "cid", F.filter("all", lambda s: s < F.col("slice")).alias("blockers"))
    tight = chained.join(large, "root", "left_anti")
    tight = tight.select(F.struct(F.lit(0).alias("kind"), F.col("root").alias("id")).alias("region"), F.col("node").alias("cid"), F.array().cast("array<long>").alias("blockers"))
    return tight.unionByName(mine)


_FOUND = "cid long, links long, root long"


def _members(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, list[np.ndarray]]:
    """cid, sets, copies and blockers of a region's rows, in the order of cid."""
    table = table.sort_by("cid")
    sets = [np.frombuffer(x.as_buffer(), _U) for x in table.column("shingles")]
    blockers = table.column("blockers").combine_chunks()
    flat, at = blockers.flatten().to_numpy(zero_copy_only=False), np.concatenate(
        ([0], np.cumsum(blockers.value_lengths().to_numpy(zero_copy_only=False)))
    ) if len(blockers) else np.zeros(1, np.int64)
    return table.column("cid").to_numpy(), sets, table.column("copies").to_numpy(), [flat[at[k] : at[k + 1]] for k in range(len(sets))]


def _decide(num: int, den: int):
    """All pairs of a region: for each member its links, and the smallest member it is connected with."""

    def run(table: pa.Table) -> pa.Table:
        cid, sets, copies, blockers = _members(table)
        region = Members(sets, copies, blockers, num, den)
        region.decide_all()
        return pa.table({"cid": pa.array(cid), "links": pa.array(region.degree), "root": pa.array(cid[region.top])})

    return run


_ROUND = f"{_FOUND}, cell int, home boolean"


def _measure(num: int, den: int):
    """A round for a part of a large region: its members and the region's pivots. The links of the pivots are decided
    here; the other members come back with the cells they go to."""

    def run(table: pa.Table) -> pa.Table:
        cid, sets, copies, blockers = _members(table)
        order = table.sort_by("cid")
        pivot, own = (order.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("pivot", "own"))
        region = Members(sets, copies, blockers, num, den)
        at, index = np.flatnonzero(pivot), np.flatnonzero(own)
        d, linked = region.measure(at, index)
        # two pivots meet in the part that owns the later one
        owned = ~pivot[index][None, :] | (index[None, :] > at[:, None])
        region.count(at, index, linked, owned)
        cell, home, member = cells(d, region.eps)
        stay = ~pivot[index][member]
        cell, home, member = cell[stay], home[stay], index[member[stay]]
        n, m = len(cid), len(cell)
        return pa.table(
            {
                "cid": pa.array(np.concatenate((cid, cid[member]))),
                "links": pa.array(np.concatenate((region.degree, np.zeros(m, np.int64)))),
                "root": pa.array(np.concatenate((cid[region.top], np.zeros(m, np.int64)))),
                "cell": pa.array(np.concatenate((np.zeros(n, np.int32), cell.astype(np.int32))), mask=np.arange(n + m) < n),
                "home": pa.array(np.concatenate((np.zeros(n, bool), home))),
            }
        )

    return run


def _sizes(members: DataFrame, by: str) -> DataFrame:
    """(by, n, parts): members of a region, and of how many times a task's share it is."""
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / MEMBERS), F.ceil(F.sum("n_shingles") / SHINGLES)).cast("int")
    return members.groupBy(by).agg(F.count(F.lit(1)).alias("n"), parts.alias("parts"))


def _dealt(parts: Column) -> Column:
    return F.pmod(F.xxhash64("cid", F.lit(11)), parts).cast("int")


def _join(slices: DataFrame, classes: DataFrame, sets: DataFrame, scratch: Scratch, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(cid, root) of what is linked with anything, and (cid, links)."""
    about = classes.select("cid", "copies", "n_shingles")
    facts = sets.join(about.drop("n_shingles"), "cid")
    members = scratch.keep(_regions(slices, scratch).join(about.drop("copies"), "cid"), "regions-0")
    found, step = [], 0
    while True:
        sizes = scratch.keep(_sizes(members, "region").where("parts > 1"), f"large-{step}")
        final = sizes.isEmpty()
        small = members if final else members.join(sizes, "region", "left_anti")
        decided = small.select("region", "cid", "blockers").join(facts, "cid").groupBy("region").applyInArrow(_decide(num, den), _FOUND)
        found.append(scratch.keep(decided, f"found-{step}"))
        if final:
            break
        cut, links = _round(members.join(sizes, "region"), facts, scratch, num, den, step)
        found.append(links)
        step += 1
        members = scratch.keep(cut, f"regions-{step}")
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    degree = scratch.keep(every.groupBy("cid").agg(F.sum("links").alias("links")), "degree")
    ends = every.where("root <> cid").select(F.col("root").alias("a"), F.col("cid").alias("b"))
    if step or not every.groupBy("cid").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        roots = connected_components(ends, scratch, "linked").select(F.col("node").alias("cid"), "root")
    else:  # every document lies in one region, which knows its component
        roots = every.select("cid", "root")
    return roots, degree


def _round(large: DataFrame, facts: DataFrame, scratch: Scratch, num: int, den: int, step: int) -> tuple[DataFrame, DataFrame]:
    """One round for regions that no task should hold: the cells they are cut into, and the links of their pivots.

    ``large`` has region, cid, blockers, n_shingles, n and parts. Members are dealt over parts, each of which gets the
    pivots as well. A region whose cells would hold more than three quarters of it, or would double it, is cut into
    tiles instead: its members are dealt to blocks and every two blocks make a tile, in which members of one block
    block each other. Tiles hold two thirds of a task's share, so most are decided at once.
    """
    rank = F.row_number().over(Window.partitionBy("region").orderBy("rank"))
    # pivots by hash: the lowest few of each part first, so that no window holds a region
    spread = Window.partitionBy("region", "part").orderBy("rank")
    dealt = large.withColumn("part", _dealt(F.col("parts"))).withColumn("rank", F.xxhash64("cid", F.lit(step)))
    dealt = scratch.keep(dealt, f"dealt-{step}")
    some = dealt.withColumn("_n", F.row_number().over(spread)).where(F.col("_n") <= PIVOTS).drop("_n")
    pivots = some.withColumn("_n", rank).where(F.col("_n") <= PIVOTS).drop("_n")
    pivots = scratch.keep(pivots, f"pivots-{step}")
    mine = dealt.join(pivots.select("region", "cid", F.lit(True).alias("pivot")), ["region", "cid"], "left")
    mine = mine.select("region", "part", "cid", "blockers", F.coalesce("pivot", F.lit(False)).alias("pivot"), F.lit(True).alias("own"))
    other = pivots.withColumn("home", F.col("part")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where("part <> home")
    other = other.select("region", "part", "cid", "blockers", F.lit(True).alias("pivot"), F.lit(False).alias("own"))
    measured = mine.unionByName(other).join(facts, "cid").groupBy("region", "part").applyInArrow(_keyed(_measure(num, den)), f"{_REGION}, {_ROUND}")
    measured = scratch.keep(measured, f"round-{step}")
    links = measured.where("cell is null").select("cid", "links", "root")

    rows = measured.where("cell is not null").select("region", "cid", "cell", "home")
    shape = rows.groupBy("region", "cell").agg(F.count(F.lit(1)).alias("k")).groupBy("region").agg(F.max("k").alias("largest"), F.sum("k").alias("total"))
    size = large.select("region", "n", "parts").distinct()
    fate = scratch.keep(
        shape.join(size, "region").select("region", "parts", (F.greatest(F.col("largest") / 0.75, F.col("total") / 2) <= F.col("n")).alias("gains")),
        f"fate-{step}",
    )
    was = dealt.join(pivots.select("region", "cid"), ["region", "cid"], "left_anti").select("region", "cid", "blockers", "n_shingles")
    token = lambda *c: F.xxhash64("region.kind", "region.id", F.lit(step), *c)
    region = lambda *c: F.struct(F.lit(2 + step).alias("kind"), token(*c).alias("id")).alias("region")

    cut = rows.join(fate.where("gains"), "region", "left_semi").join(was, ["region", "cid"])
    guest = F.when(F.col("home"), F.col("blockers")).otherwise(F.concat("blockers", F.array(token("cell", F.lit(1)))))
    cut = cut.select(region("cell"), "cid", guest.alias("blockers"), "n_shingles")
    blocks = was.join(fate.where("not gains"), "region").withColumn("parts", 3 * F.col("parts")).withColumn("block", _dealt(F.col("parts")))
    tile = F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least("block", o).alias("a"), F.greatest("block", o).alias("b"))))
    blocks = blocks.withColumn("tile", tile)
    mate = F.when(F.col("tile.a") == F.col("tile.b"), F.col("blockers")).otherwise(F.concat("blockers", F.array(token("block", F.lit(2)))))
    return cut.unionByName(blocks.select(region("tile.a", "tile.b"), "cid", mate.alias("blockers"), "n_shingles")), links


def _keyed(run):
    """``run`` with the region of the group before its columns."""

    def keyed(table: pa.Table) -> pa.Table:
        out = run(table)
        return out.add_column(0, "region", pa.array([table.column("region")[0].as_py()] * out.num_rows, table.schema.field("region").type))

    return keyed
