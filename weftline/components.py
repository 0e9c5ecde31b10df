"""Connected components of an edge table, distributed (nodes move to the least neighbour of their least neighbour).

Labels are the least node of each component.  A round takes each node's least neighbour, twice over, puts those nodes in
the place of both ends of all edges, and keeps an edge from each node to the one that it moved to.  A star around any
node takes one round; a node that is less than all its neighbours takes one of them in or has a lesser neighbour in the next round, and
the steps of a chain at least double with each.

Every step is a map-side combined minimum or a join; tables are written to the shared folder between steps, and
nothing but a few counts per round reaches the driver.  The minima that begin a round also tell whether the
edges are stars already, so no round is spent on seeing that nothing changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.scratch import Scratch


#: Nodes with more neighbours than a 2^-17 share of all edge ends, and this many, are hot: there are 2^17 of them at most.
HOT = 1_000
#: Nodes up to which the least neighbours of all are broadcast; rows of 24 bytes.
BROADCAST_NODES = 300_000


def _least(edges: DataFrame) -> DataFrame:
    """(u, m, n, below, above): the least of each node and its neighbours, how many there are, and how many are less and greater."""
    below, above = F.count(F.when(F.col("v") < F.col("u"), 1)), F.count(F.when(F.col("v") > F.col("u"), 1))
    rows = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"), below.alias("below"), above.alias("above"))
    return rows.withColumn("m", F.least("u", "m"))


def _moved(edges: DataFrame, to: DataFrame, nodes: int, hot: Column) -> DataFrame:
    """(u, v) of ``edges`` with v, and the node that ``to`` has for u as u.

    Edges stay where they are and meet a broadcast table of bounded size: of all nodes if these are few, of the hot ones otherwise.
    """
    if nodes <= BROADCAST_NODES:
        return edges.join(F.broadcast(to.select("u", "m")), "u").select(F.col("m").alias("u"), "v")
    marked = edges.join(F.broadcast(to.filter(hot).select("u", F.col("m").alias("hot"))), "u", "left")
    others = marked.filter("hot is null").drop("hot").join(to.filter(~hot).select("u", "m"), "u")
    return marked.filter("hot is not null").select(F.col("hot").alias("u"), "v").unionByName(others.select(F.col("m").alias("u"), "v"))


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, comp) for every node that an edge (u, v) touches; comp is the least node reachable.

    Self-loops keep a node in the result; repeated edges and either direction are allowed.
    """
    turned = [F.col("v").alias("u"), F.col("u").alias("v")]
    ordered = [F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")]
    now = scratch.write(edges.select(ordered).distinct(), "edges")
    # In a star around its least node, every other node has one neighbour.
    astray = F.count(F.when((F.col("below") > 1) | ((F.col("below") > 0) & (F.col("above") > 0)), 1))
    while True:
        least = scratch.write(_least(now.union(now.select(turned))), "least")
        nodes, ends, left = least.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)), astray).first()
        if not left:
            scratch.drop(now)
            return least.select(F.col("u").alias("node"), F.col("m").alias("comp"))
        hot = F.col("n") > max(HOT, ends >> 17)
        # Each node and the least neighbour of its least neighbour.
        goal = _moved(least.select(F.col("m").alias("u"), F.col("u").alias("v")), least, nodes, hot).select(F.col("v").alias("u"), F.col("u").alias("m"))
        goal = goal if nodes <= BROADCAST_NODES else goal.join(least.select("u", "n"), "u")
        goal = scratch.write(goal, "goal")
        both = _moved(_moved(now, goal, nodes, hot).select(turned), goal, nodes, hot)
        after = scratch.write(both.filter("u <> v").union(goal.select("u", F.col("m").alias("v"))).select(ordered).distinct(), "edges")
        scratch.drop(now, least, goal)
        now = after
