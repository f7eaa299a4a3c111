"""Property tests: distributed ranking and quantiles equal the plain answers
on random inputs (few values -> heavy ties; many ranges -> empty ranges)."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlens.operators import quantiles as Q
from marketlens.operators import ranking as R

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def _df(spark, values, groups):
    pdf = pd.DataFrame({"id": np.arange(len(values)), "v": values, "g": groups})
    return spark.createDataFrame(pdf, "id long, v long, g long")


rows = st.integers(min_value=1, max_value=120)


@SETTINGS
@given(n=rows, distinct=st.integers(1, 6), parts=st.integers(1, 12), k=st.integers(1, 5), seed=st.integers(0, 99))
def test_ntile_and_rank_equal_windows(spark, n, distinct, parts, k, seed):
    rng = np.random.default_rng(seed)
    df = _df(spark, rng.integers(0, distinct, n), rng.integers(0, 3, n))
    order = Window.orderBy(F.col("v").desc(), "id")
    ref = df.select("id", F.ntile(k).over(order).alias("b_ref"),
                    F.rank().over(Window.orderBy(F.col("v").desc())).alias("r_ref"))
    got = R.with_global_ntile(df, [("v", False), ("id", True)], k, "b", num_partitions=parts)
    got = R.with_global_rank(got, [("v", False)], [("id", True)], "r", num_partitions=parts)
    j = got.join(ref, "id")
    assert j.count() == n
    assert j.filter((F.col("b") != F.col("b_ref")) | (F.col("r") != F.col("r_ref"))).count() == 0


@SETTINGS
@given(n=rows, parts=st.integers(1, 12), seed=st.integers(0, 99))
def test_group_sequence_with_null_group(spark, n, parts, seed):
    rng = np.random.default_rng(seed)
    groups = [None if r < 0.2 else int(g) for r, g in zip(rng.random(n), rng.integers(0, 4, n))]
    values = [int(v) for v in rng.integers(0, 5, n)]
    df = spark.createDataFrame(list(zip(range(n), values, groups)), "id long, v long, g long")  # null group too
    w = Window.partitionBy("g").orderBy("v", "id")
    ref = df.select("id", F.row_number().over(w).alias("s_ref"), F.lag("v").over(w).alias("l_ref"))
    got = R.with_group_sequence(df, ["g"], [("v", True), ("id", True)], "s", lags={"v": "l"},
                                num_partitions=parts)
    j = got.join(ref, "id")
    assert j.count() == n
    assert j.filter((F.col("s") != F.col("s_ref")) | ~F.col("l").eqNullSafe(F.col("l_ref"))).count() == 0


@SETTINGS
@given(n=rows, distinct=st.integers(1, 30), parts=st.integers(1, 12), seed=st.integers(0, 99))
def test_quantiles_equal_numpy(spark, n, distinct, parts, seed):
    rng = np.random.default_rng(seed)
    df = _df(spark, rng.integers(0, distinct, n), rng.integers(0, 3, n))
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")  # running counts cross batches
    try:
        probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
        names = [f"p{i}" for i in range(len(probs))]
        got = Q.quantiles(df, "v", probs, names, by=["g"]).toPandas().set_index("g")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    pdf = df.toPandas()
    for g, part in pdf.groupby("g"):
        exp = np.percentile(part["v"].to_numpy(dtype=float), [p * 100 for p in probs])
        assert np.allclose(got.loc[g, names].to_numpy(dtype=float), exp)


@SETTINGS
@given(n=rows, parts=st.integers(1, 6), batch=st.integers(1, 7), seed=st.integers(0, 99))
def test_sequence_with_large_keys_and_tiny_batches(spark, n, parts, batch, seed):
    """Keys above 2**53 must not merge (no float round trip); groups and lags
    must carry across Arrow batch boundaries inside a range."""
    rng = np.random.default_rng(seed)
    base = 2 ** 60
    groups = [base + int(g) for g in rng.integers(0, 3, n)]  # neighbours differ only in low bits
    values = [int(v) for v in rng.integers(0, 4, n)]
    df = spark.createDataFrame(list(zip(range(n), values, groups)), "id long, v long, g long")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = R.with_group_sequence(df, ["g"], [("v", True), ("id", True)], "s", lags={"id": "prev_id"},
                                    num_partitions=parts)
        w = Window.partitionBy("g").orderBy("v", "id")
        ref = df.select("id", F.row_number().over(w).alias("s_ref"), F.lag("id").over(w).alias("p_ref"))
        j = got.join(ref, "id")
        assert j.count() == n
        assert j.filter((F.col("s") != F.col("s_ref")) | ~F.col("prev_id").eqNullSafe(F.col("p_ref"))).count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
