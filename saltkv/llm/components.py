"""Connected components of an edge table, as joins and grouped minima.

Alternates two steps that keep components and shrink paths: *large star* links
the greater neighbours of a node to its least neighbour, *small star* the smaller
ones.  The table turns into stars around each component's least node after
about ``log(n)`` rounds.  Rounds are written to the shared folder, so lineage stays
short; minima combine before the shuffle, and nothing is collected but a row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges``: columns ``a, b`` of one orderable type.  Returns ``node, label``
    (the least node of its component) for every node of an edge between two nodes.  Nulls,
    loops and repeated edges change nothing."""
    e = edges.where("a is not null and b is not null and a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    e = written(e.distinct(), "edges")
    state = None
    while True:
        e = written(_small_star(_large_star(e)), "edges")
        new = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == state:
            break
        state = new
    return e.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()
