"""Distinct counts that add up: bitmaps over dense numbers, and sketches.

COUNT(DISTINCT) of a month cannot be summed to that of a year. Here ids get dense
numbers once (`dense_ids`), and a group keeps a bitmap for each bucket of 32,768
numbers in which it has any. Bitmaps of finer groups are OR-ed to those of coarser
ones, so one pass over the rows serves all levels, exactly, and a row that is
repeated sets a bit that is set. They are aggregated before the shuffle; an id or a group
holding a third of all rows is one bitmap per task and bucket.

A bitmap has 4 KiB whether it holds one id or all of its bucket, so numbers should follow
the groups: `dense_ids` numbers by the columns of ``cluster`` first (orders by month,
customers by state), and a group then fills few buckets.

`sketches` / `sketch_counts` are the approximate form (HyperLogLog, some KB a group,
no numbers needed); nothing uses it unless asked to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.operators.ranking import with_global_row_number


def dense_ids(df: DataFrame, key: str, number: str, cluster: Sequence[str] = ()) -> DataFrame:
    """(key, number): the distinct non-null keys numbered from 0, those of equal
    ``cluster`` values (the least of a key's) next to each other."""
    known = df.where(F.col(key).isNotNull())
    keys = known.groupBy(key).agg(*[F.min(c).alias(c) for c in cluster]) if cluster else known.select(key).distinct()
    numbered = with_global_row_number(keys, [(c, True) for c in (*cluster, key)], number)
    return numbered.select(key, (F.col(number) - 1).alias(number))


def bitmaps(df: DataFrame, by: Sequence[str], number: str) -> DataFrame:
    """(by, bucket, bits): the numbers that occur in each group; null numbers do not."""
    n = F.col(number)
    return (df.where(n.isNotNull()).groupBy(*by, F.bitmap_bucket_number(n).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias("bits")))


def merged(bits: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser groups."""
    return bits.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(bits: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """One row per group of ``by`` with its number of distinct ids."""
    return merged(bits, by).groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))


def sketches(df: DataFrame, by: Sequence[str], key: str, lg_k: int = 14) -> DataFrame:
    """(by, sketch): the keys of each group as a HyperLogLog sketch."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(F.col(key).cast("string"), lg_k).alias("sketch"))


def sketch_counts(parts: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """About how many distinct keys the groups of ``by`` have, from sketches of finer groups."""
    return parts.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
