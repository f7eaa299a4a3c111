"""Exact quantiles (linear interpolation, as numpy/pandas and SQL
``percentile_cont``) by selection.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer, so one big group means one task holding millions of values.
Here the values at the neighbouring ranks floor / ceil of p * (n - 1) are selected
(`operators.selection`): a sketch gives each group a bracket of values, a second scan
counts the rows below and those inside. Rows are neither sorted nor written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.operators.ranking import join_on_keys
from marketlens.operators.selection import select_ranks


def quantiles(df: DataFrame, value: str, probs: Sequence[float], names: Sequence[str],
              by: Sequence[str] = (), digits: int | None = None, also: Sequence[Column] = ()) -> DataFrame:
    """One row per group with one column per probability; null values do not count.

    ``also`` are aggregates (over the doubles of ``value``) that the first scan takes
    along. A group without values has null quantiles.
    """
    by = list(by)
    values = df.select(*by, F.col(value).cast("double").alias(value))
    pos = [F.lit(float(p)) * (F.col("_n") - 1) for p in probs]
    picked, groups = select_ranks(values, by, [(F.floor(p), F.ceil(p)) for p in pos], value, also=also)
    of = lambda i, c: F.max(F.when(F.col("_t") == i, F.col(c)))
    wide = picked.groupBy(*by).agg(*[of(i, v).alias(f"_{n}_{v}") for i, n in enumerate(names) for v in ("v0", "v1")])
    if by:
        joined = join_on_keys(groups, F.broadcast(wide), by, "left")
    else:  # one row each
        both = groups.unionByName(wide, allowMissingColumns=True)
        joined = both.agg(*[F.max(c).alias(c) for c in both.columns])
    out = []
    for p, n in zip(pos, names):
        q = F.col(f"_{n}_v0") + (F.col(f"_{n}_v1") - F.col(f"_{n}_v0")) * (p - F.floor(p))
        out.append((F.round(q, digits) if digits is not None else q).alias(n))
    extra = [c for c in groups.columns if c not in by and c != "_n"]
    return joined.select(*by, *out, *extra)
