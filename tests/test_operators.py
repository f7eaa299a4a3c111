"""Distributed ranking and quantile operators against plain windows / numpy."""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlens.operators import quantiles as Q
from marketlens.operators import ranking as R


def _frame(spark, n=3000, seed=7):
    rng = np.random.default_rng(seed)
    hot = rng.random(n) < 0.34  # a third of the rows share one value
    value = np.where(hot, 42, rng.integers(0, 200, n))
    grp = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 50, n))  # one hot group
    pdf = pd.DataFrame({"id": np.arange(n), "value": value.astype("int64"), "grp": grp.astype("int64"),
                        "ts": rng.integers(0, 10_000, n).astype("int64")})
    return spark.createDataFrame(pdf)


def test_global_row_number_matches_window(spark):
    df = _frame(spark)
    got = R.with_global_row_number(df, [("value", False), ("id", True)], "rn", num_partitions=5)
    ref = df.withColumn("rn_ref", F.row_number().over(Window.orderBy(F.col("value").desc(), "id")))
    j = got.join(ref.select("id", "rn_ref"), "id")
    assert j.filter(F.col("rn") != F.col("rn_ref")).count() == 0
    assert got.count() == df.count()


def test_global_ntile_matches_window(spark):
    df = _frame(spark)
    for k in (3, 7):
        got = R.with_global_ntile(df, [("value", False), ("id", True)], k, "b", num_partitions=6)
        ref = df.withColumn("b_ref", F.ntile(k).over(Window.orderBy(F.col("value").desc(), "id")))
        j = got.join(ref.select("id", "b_ref"), "id")
        assert j.filter(F.col("b") != F.col("b_ref")).count() == 0


def test_ntile_more_buckets_than_rows(spark):
    df = _frame(spark, n=5)
    got = R.with_global_ntile(df, [("id", True)], 8, "b", num_partitions=3)
    assert sorted(r.b for r in got.collect()) == [1, 2, 3, 4, 5]


def test_global_rank_with_heavy_ties(spark):
    df = _frame(spark)
    got = R.with_global_rank(df, [("value", False)], [("id", True)], "rk", num_partitions=4)
    ref = df.withColumn("rk_ref", F.rank().over(Window.orderBy(F.col("value").desc())))
    j = got.join(ref.select("id", "rk_ref"), "id")
    assert j.filter(F.col("rk") != F.col("rk_ref")).count() == 0


def test_group_sequence_matches_partitioned_window(spark):
    df = _frame(spark)
    got = R.with_group_sequence(df, ["grp"], [("ts", True), ("id", True)], "seq",
                                lags={"ts": "prev_ts"}, num_partitions=6)
    w = Window.partitionBy("grp").orderBy("ts", "id")
    ref = df.select("id", F.row_number().over(w).alias("seq_ref"), F.lag("ts").over(w).alias("prev_ref"))
    j = got.join(ref, "id")
    assert j.count() == df.count()
    assert j.filter(F.col("seq") != F.col("seq_ref")).count() == 0
    assert j.filter(~F.col("prev_ts").eqNullSafe(F.col("prev_ref"))).count() == 0


def test_exact_quantiles_by_group(spark):
    df = _frame(spark)
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    names = [f"p{i}" for i in range(len(probs))]
    got = Q.quantiles(df, "value", probs, names, by=["grp"]).toPandas().set_index("grp").sort_index()
    pdf = df.toPandas()
    for g, part in pdf.groupby("grp"):
        exp = np.percentile(part["value"].to_numpy(dtype=float), [p * 100 for p in probs])
        assert np.allclose(got.loc[g, names].to_numpy(dtype=float), exp), g


def test_exact_quantiles_global_single_row(spark):
    df = spark.createDataFrame(pd.DataFrame({"v": [5.0]}))
    got = Q.quantiles(df, "v", [0.25, 0.5], ["a", "b"]).collect()[0]
    assert got.a == 5.0 and got.b == 5.0


def test_ranking_plan_has_no_single_partition_over_rows(spark):
    """The rows are range-partitioned; only the per-range table is windowed."""
    df = _frame(spark)
    out = R.with_global_ntile(df, [("value", False), ("id", True)], 3, "b", num_partitions=4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ntile" not in plan.lower()
