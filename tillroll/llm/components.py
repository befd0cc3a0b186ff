"""Connected components of an edge table by alternating large and small stars.

Every round hangs the neighbours of a node below the smallest node in reach
(Kiveris et al., "Connected Components in MapReduce and Beyond"); the edges
end as stars around each component's smallest node after a number of rounds
logarithmic in the longest chain. Each round is a written table, so a lost
executor costs one round at most, and nothing passes through the driver but
whether a round is the last one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.storage import written

#: Rows of a round's file, about: small rounds are few files, however many partitions a shuffle has.
FILE_ROWS = 250_000


def _least(edges: DataFrame, name: str, files: int) -> DataFrame:
    """(u, v, m): each directed edge with the smallest of u and its neighbours.

    The minima are a written table: the join then shuffles both of its sides
    itself, and adaptive execution can split the edges of one hot node."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(written(least.coalesce(files), f"{name}-least"), "u")


def _round(edges: DataFrame, name: str, files: int) -> DataFrame:
    """One large star, then one small star, over distinct edges (u > v)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _least(both, name, files).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    small = _least(written(large.coalesce(files), f"{name}-large"), name, files)
    hung = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct().coalesce(files)


def _stars(edges: DataFrame) -> bool:
    """Whether every upper node has one edge and no lower node is an upper one: the components are found."""
    twice = edges.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1")
    if twice.head(1):
        return False
    return not edges.select(F.col("v").alias("u")).distinct().join(edges, "u", "left_semi").head(1)


def components(edges: DataFrame, a: str = "a", b: str = "b", name: str = "components") -> DataFrame:
    """(node, root) of every node that has an edge to another one; root is the smallest node of its component.

    ``a`` and ``b`` are long columns; null ends, loops and repeated edges count
    for nothing. Without edges the result is empty.
    """
    now = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).alias("a"), F.col(b).alias("b"))
                  .filter("a IS NOT NULL AND b IS NOT NULL AND u <> v").select("u", "v").distinct(), f"{name}-edges")
    while not _stars(now):
        now = written(_round(now, name, 1 + now.count() // FILE_ROWS), f"{name}-round")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
