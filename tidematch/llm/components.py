"""Connected components of an undirected graph by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidematch.llm.common import stored


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest
    node that can be reached.

    Two steps alternate until nothing changes. The large one hangs a node's
    larger neighbours on its smallest neighbour, the small one its smaller
    neighbours and itself. Each keeps the components and the number of edges
    does not grow; the depth shrinks fast, so few rounds are needed. Minima are
    pre-aggregated; every round is written to the shared folder.
    """
    now = stored(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        f"{name}-edges",
    )
    before = _mark(now)
    while True:
        now = stored(_small(_large(now)), f"{name}-round")
        after = _mark(now)
        if after == before:
            break
        before = after
    # Now every edge leads from a node to its component's smallest one.
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def _large(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours, tied to the smallest of it and all its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    tied = both.filter("b > a").join(least, "a")
    return tied.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours, tied to the smallest of those. Edges
    lead from the larger to the smaller node."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.union(least.select("a", F.col("m").alias("b"))).distinct()
