"""Transitive closure of a parent table by path doubling.

Every node starts with its parent at distance 1. A round joins the paths of
length 2^k with themselves, which gives those of twice the length, and adds to
the closure what lies beyond: a tree of depth d takes log2(d) rounds. A node
on a cycle (or below one) has ancestors at every distance; after more rounds
than any path without repetition can need, the ends of the paths that still go
on are exactly the nodes on cycles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.session import ensure_checkpoint_dir


def closure(edges: DataFrame, node: str = "node", parent: str = "parent") -> tuple[DataFrame, DataFrame]:
    """((node, ancestor, steps), (node)): all ancestors of every node with their distance, and the nodes on cycles.

    A node has one parent at most; rows without a node or parent are left out
    (roots) and repeated ones count once. Nodes on a cycle or below one have no
    rows in the closure: their ancestors have no distance. Rounds are
    checkpoints in the shared folder, since each is read twice."""
    ensure_checkpoint_dir(edges.sparkSession)
    jump = (edges.where(F.col(node).isNotNull() & F.col(parent).isNotNull())
            .select(F.col(node).alias("node"), F.col(parent).alias("ancestor")).distinct().checkpoint())
    several = jump.groupBy("node").count().where("count > 1").head(1)
    if several:
        raise ValueError(f"more than one parent: {several[0].node!r}")
    nodes = jump.count()
    found, reach = jump.withColumn("steps", F.lit(1).cast("bigint")), 1
    # paths without repetition have fewer steps than there are nodes
    while reach <= nodes and jump.head(1):
        up = jump.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("beyond"))
        # ancestors at 1 .. reach steps of the node at distance reach are at reach + 1 .. 2 reach
        more = (jump.select("node", F.col("ancestor").alias("via")).join(
            found.select(F.col("node").alias("via"), "ancestor", "steps"), "via").select("node", "ancestor", (F.col("steps") + reach).alias("steps")))
        found = found.unionByName(more).checkpoint()
        jump = jump.join(up, "ancestor").select("node", F.col("beyond").alias("ancestor")).checkpoint()
        reach *= 2
    endless = jump.select("node").distinct()
    cycles = jump.select(F.col("ancestor").alias("node")).distinct()
    return found.join(endless, "node", "left_anti"), cycles
