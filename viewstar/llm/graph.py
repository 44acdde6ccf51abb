"""Connected components by joins: large-star and small-star, in turn, until nothing changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from viewstar.staging import Staging

MAX_ROUNDS = 60
#: A node is a hub if it is on more than one in this many rows: at most as many nodes can be.
HUB_SHARE = 10_000


def _on_least(edges: DataFrame, least: DataFrame, total: int) -> DataFrame:
    """``edges`` (a, b) with the column ``least`` of their node a.

    The rows of hubs stay where they are, as hubs are few and come by broadcast; any other node is
    on too few rows to make a task long.
    """
    # Both parts come of one written table, so a node is a hub in both or in neither.
    hub = F.col("n") * HUB_SHARE > total
    hubs = F.broadcast(least.where(hub).select(F.col("a").alias("hub"), F.col("least").alias("top")))
    found = edges.join(hubs, F.col("a") == F.col("hub"), "left")
    return found.where("hub IS NOT NULL").select("a", "b", F.col("top").alias("least")).union(
        found.where("hub IS NULL").select("a", "b").join(
            least.where(~hub).select("a", "least"), "a").select("a", "b", "least"))


def _large_star(edges: DataFrame, total: int, staging: Staging) -> DataFrame:
    """Each node hangs its larger neighbours on the least node it knows, itself included."""
    both = edges.union(edges.select("b", "a"))
    least = staging.table(both.groupBy("a").agg(
        F.least("a", F.min("b")).alias("least"), F.count("*").alias("n")), "least")
    return _on_least(both.where("b > a"), least, 2 * total).select(
        F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame, total: int, staging: Staging) -> DataFrame:
    """Each node hangs itself and its smaller neighbours on the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = staging.table(down.groupBy("a").agg(
        F.min("b").alias("least"), F.count("*").alias("n")), "least")
    hung = _on_least(down, least, total).where("b > least").select("b", "least")
    return hung.union(least.select("a", "least")).toDF("a", "b").distinct()


def components(edges: DataFrame, staging: Staging) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b); root is the least node reached.

    Both steps keep what is connected and never add edges; a group of any density is a star
    around its least node after a few rounds, and paths shrink by a constant share per round.
    Every step is written to the shared folder. Neighbours are reduced to a minimum on the map
    side, and the least node reaches the rows of a hub by broadcast, so a hub of any degree
    spreads over all tasks. Links of a node with itself and repeated links count once; a node
    without links to others is in no row; a null end links nothing; without edges there are no
    rows.
    """
    edges = staging.table(edges.select("a", "b").where("a <> b").distinct(), "edges")
    mark, total = None, edges.count()
    for _ in range(MAX_ROUNDS):
        edges = staging.table(_large_star(edges, total, staging), "large")
        # Neither step adds edges, so that many are still enough to tell hubs by.
        edges = staging.table(_small_star(edges, total, staging), "small")
        # Equal counts and checksums: the same set of edges as a round before.
        found = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        total = found[0]
        if found == mark:
            roots = edges.select(F.col("b").alias("node")).distinct()
            return edges.toDF("node", "root").union(roots.select("node", "node"))
        mark = found
    raise RuntimeError(f"edges still change after {MAX_ROUNDS} rounds")
