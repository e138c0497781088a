"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.scratch import stored

#: Nodes with more than their share of the edges, one in HUBS, are hubs; there are HUBS at most.
HUBS = 4_096
#: Nodes with fewer edges are never hubs.
LEAST_HUB = 128


def meet(rows: DataFrame, per_key: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """``rows`` joined with ``per_key`` (one row for each ``key``, ``count`` being its number of rows) on ``key``.

    Keys that hold more than one in HUBS of the ``total`` rows are too few to
    matter (HUBS at most): they are broadcast and their rows never move. No task
    of the other join gets more rows of one key than that share.
    """
    hot = F.col(count) > max(LEAST_HUB, total // HUBS)
    hubs, others = per_key.where(hot), per_key.where(~hot)
    of_hubs = rows.join(F.broadcast(hubs), key)
    rest = rows.join(F.broadcast(hubs.select(key)), key, "left_anti")
    return of_hubs.unionByName(rest.join(others, key))


def _star(edges: DataFrame, with_self: bool, total: int) -> DataFrame:
    """``edges(a, b)`` with the least of each ``a``'s neighbours, and of itself if asked for, as ``m``."""
    m = F.least("a", F.min("b")) if with_self else F.min("b")
    least = edges.groupBy("a").agg(m.alias("m"), F.count("*").alias("n"))
    return meet(edges, least, "a", "n", total).drop("n")


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node of its neighbourhood."""
    both = edges.union(edges.select("b", "a").toDF("a", "b"))
    return _star(both, True, 2 * total).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    linked = _star(down, False, total).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.union(down.groupBy("a").agg(F.min("b").alias("b"))).where("a <> b")


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """``(node, label)`` for every node of ``edges(a, b)`` but the smallest of its component.

    ``label`` is the smallest node reachable; nodes are of any type that has an order. Each round is written to the
    shared folder; hubs are only ever aggregated and met by broadcast, never
    gathered into one row or task. Self-loops and repeated edges are allowed; an
    empty edge table gives an empty result.
    """
    now = stored(edges.where("a <> b").select("a", "b").distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if seen == before or not seen[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label"))
        before = seen
        large = stored(_large_star(now, seen[0]), "edges")
        now = stored(_small_star(large, seen[0]).distinct(), "edges")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
