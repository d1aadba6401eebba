"""Connected components of an undirected graph given as a DataFrame of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Scratch


def connected_components(links: DataFrame, scratch: Scratch, tag: str = "cc") -> DataFrame:
    """(node, root) for every node of ``links`` (columns ``a`` and ``b``, longs); root is the smallest node reachable.

    Every round each node hooks onto its smallest neighbour, the resulting trees are flattened by pointer jumping, and
    the links are contracted to links between roots. Rounds are few (the graph at least halves), each is written to
    the shared folder, and all steps are minima or equi-joins, so a node with a third of all links is no special case.
    Links from a node to itself are allowed. An empty table gives an empty table.
    """
    edges = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    edges = scratch.keep(edges, f"{tag}-edges-0")
    found = None
    step = 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("root"))
        up = scratch.keep(up, f"{tag}-up-{step}-0")
        jump = 0
        while True:
            far = up.alias("u").join(up.select(F.col("node").alias("mid"), F.col("root").alias("top")).alias("t"), F.col("u.root") == F.col("t.mid"))
            jump += 1
            far = scratch.keep(far.select("node", F.col("top").alias("root"), (F.col("top") < F.col("root")).alias("moved")), f"{tag}-up-{step}-{jump}")
            moved = not far.where("moved").isEmpty()
            up = far.select("node", "root")
            if not moved:
                break
        if found is None:
            found = up
        else:
            over = up.select(F.col("node").alias("mid"), F.col("root").alias("top"))
            found = scratch.keep(found.join(over, found["root"] == over["mid"], "left").select("node", F.coalesce("top", "root").alias("root")), f"{tag}-found-{step}")
        side = lambda c: up.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))  # noqa: E731, B023
        step += 1
        edges = scratch.keep(
            edges.join(side("a"), "a").join(side("b"), "b").where("a_root <> b_root").select(
                F.least("a_root", "b_root").alias("a"),
                F.greatest("a_root", "b_root").alias("b"),
            ).distinct(),
            f"{tag}-edges-{step}",
        )
    return found if found is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
