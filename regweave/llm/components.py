"""Connected components of an edge table by alternating stars; each round is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regweave.session import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node it is linked to, itself included) for every node of ``a``-``b`` edges.

    Large stars hang a node's larger neighbours on its smallest one, small stars the smaller ones, until
    nothing moves; rounds grow with the logarithm of the longest chain.  Minima are combined before each shuffle
    and joins are plain equi-joins, so a hub of any degree is split.  Self links and repeated edges do no harm.
    """
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = stored(small.select("e.a", "e.b").filter("a <> b").distinct())
        if (new := _mark(now)) == mark:
            break
        mark = new
    found = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())


def _mark(edges: DataFrame) -> tuple:
    """Count and two sums that tell two edge tables apart."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())
