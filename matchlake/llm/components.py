"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.session import ensure_checkpoint_dir


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("root"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang every smaller neighbour of a node, and the node, on the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("root"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return moved.filter("a <> b").unionByName(least.select("a", F.col("root").alias("b")))


def nearer(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with a > b that connect what the given ones do, after one large and one small star.

    Often the smallest b of a is then the smallest node of its component, not always. For edges that are cheap to
    read again; the result is kept in the checkpoint folder.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    return _small_star(_large_star(edges)).distinct().checkpoint()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the edges (a, b); the root is the smallest node of its component.

    Edges are pairs of longs without nulls; repeated and reversed ones do no harm, and an edge
    from a node to itself is ignored. A hub costs no more than its edges: minima are combined
    before the shuffle, and the join back is one that adaptive execution splits. The number of
    rounds grows with the logarithm of the size. Each round is kept in the checkpoint folder.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    edges = edges.select("a", "b").filter("a <> b").distinct().checkpoint()
    before = _checksum(edges)
    while True:
        edges = nearer(edges)
        after = _checksum(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
