"""Connected components of a distributed graph by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import materialize


def components(edges: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 100) -> DataFrame:
    """(node, label) of every node of ``edges``; label is the smallest node of its component.

    A round hangs each node's larger neighbours on its smallest neighbour, then
    its smaller ones; the graph becomes a star per component after a number of
    rounds that grows with the logarithm of its size. Smallest neighbours are
    summed up before the shuffle, and no neighbourhood is held in one place.
    """
    lo, hi = F.least(u, v).alias("a"), F.greatest(u, v).alias("b")
    now = materialize(edges.where(F.col(u) != F.col(v)).select(lo, hi).distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        both = now.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(
            now.select(F.col("b").alias("x"), F.col("a").alias("y")))
        least = both.groupBy(F.col("x").alias("m_x")).agg(F.least(F.min("y"), F.col("m_x")).alias("m"))
        large = both.where(F.col("y") > F.col("x")).join(least, F.col("x") == F.col("m_x")).select(
            F.col("m").alias("a"), F.col("y").alias("b")).distinct()
        least = large.groupBy(F.col("b").alias("m_x")).agg(F.min("a").alias("m"))
        small = large.join(least, F.col("b") == F.col("m_x"))
        now = materialize(small.where(F.col("a") != F.col("m")).select(F.col("m").alias("a"), F.col("a").alias("b"))
                          .unionByName(least.select(F.col("m").alias("a"), F.col("m_x").alias("b"))).distinct(), "edges")
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(
        now.select(F.col("a").alias("node"), F.col("a").alias("label"))).distinct()
