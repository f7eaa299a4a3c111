"""Distinct counts that add up, against plain counts."""

import random

import pytest
from pyspark.sql import functions as F
from test_layout import written
from test_warehouse import FILES

from marketlens.operators import distinct as D
from marketlens.plans import eda, measures, shop
from marketlens.sources.tables import Tables


def rows_of(spark):
    rnd = random.Random(2)
    data = [(rnd.choice(["a", "b", None]), rnd.randrange(4), rnd.choice([None, *(f"id{i}" for i in range(300))])) for _ in range(3000)]
    data += [("hot", 1, "id7")] * 1000
    return data, spark.createDataFrame(data, "g string, m int, key string").repartition(6)


def test_ids_are_dense_and_clustered(spark):
    data, df = rows_of(spark)
    got = {r.key: r.no for r in D.dense_ids(df, "key", "no", ["m"]).collect()}
    least = {k: min(m for _, m, x in data if x == k) for k in {x for _, _, x in data} - {None}}
    assert sorted(got.values()) == list(range(len(least)))
    assert sorted(got, key=got.get) == sorted(least, key=lambda k: (least[k], k))
    assert sorted(r.no for r in D.dense_ids(df, "key", "no").collect()) == list(range(len(least)))


def test_bitmaps_add_up(spark):
    data, df = rows_of(spark)
    spread = D.dense_ids(df, "key", "no").withColumn("no", F.col("no") * 1000)  # several buckets
    bits = D.bitmaps(df.join(spread, "key"), ["g", "m"], "no")
    assert bits.select("bucket").distinct().count() > 5
    for by in (["g", "m"], ["g"], ["m"], []):
        at = {"g": 0, "m": 1}
        want = {}
        for row in data:
            if row[2] is not None:
                want.setdefault(tuple(row[at[c]] for c in by), set()).add(row[2])
        got = {tuple(r[c] for c in by): r.n for r in D.distinct_counts(bits, by, "n").collect()}
        assert got == {k: len(v) for k, v in want.items()}
        about = {tuple(r[c] for c in by): r.n for r in D.sketch_counts(
            D.sketches(df.where("key IS NOT NULL"), ["g", "m"], "key"), by, "n").collect()}
        assert about.keys() == got.keys() and all(abs(about[k] - got[k]) <= 0.05 * got[k] + 1 for k in got)


@pytest.fixture()
def repeated(spark, tmp_path):
    """The marketplace with one order twice."""
    lines = FILES["raw_orders"].rstrip().split("\n")
    return Tables.from_marketplace_csv(spark, written(tmp_path / "raw", FILES | {"raw_orders": "\n".join([*lines, lines[2], lines[2]]) + "\n"}))


def test_repeated_orders_count_once(spark, repeated, tmp_path):
    t = Tables.from_marketplace_csv(spark, written(tmp_path / "clean"))
    assert repeated.fact_orders.count() == t.fact_orders.count() + 2
    key = lambda df: sorted(map(str, df.collect()))
    assert key(measures.distinct_rollup(repeated)) == key(measures.distinct_rollup(t))
    assert {(r.level, r.month_label): r.orders for r in measures.distinct_rollup(repeated).collect()}["all", None] == 4
    frame = measures.order_frame
    assert key(measures.measures(frame(repeated), ["month_label"], repeated=True)) == key(
        measures.measures(frame(t), ["month_label"]))
    about = {(r.level, r.month_label): r.orders for r in measures.distinct_rollup(repeated, approximate=True).collect()}
    assert about["all", None] == 4


def test_new_values_make_new_columns(spark):
    rows = [("2002-03-01 00:00:00", "Phone", "NEW", "x", 5.0), ("1999-03-01 00:00:00", "Online", "PROMO", "x", 7.0),
            ("1999-04-01 00:00:00", None, None, "y", 1.0)]
    t = Tables(spark, {"sales": lambda: spark.createDataFrame(rows, "d string, channel string, category string, region string, r double")
                       .selectExpr("CAST(d AS TIMESTAMP_NTZ) AS date", "channel", "category", "region", "CAST(r AS DECIMAL(12,2)) AS revenue")})
    m = eda.seasonality_matrix(t, expected=[1998, 1999])
    assert m.columns == ["month", "1998", "1999", "2002", "month_name"]
    assert [(r["1998"], r["1999"], r["2002"]) for r in m.collect()] == [(None, 7.0, 5.0), (None, 1.0, None)]
    assert eda.channel_by_month(t, expected=["Online"]).columns == ["month_label", "Online", "Phone"]
    assert eda.region_by_category(t, expected=["PROMO", "SMALL"]).columns == ["region", "PROMO", "SMALL", "NEW"]
    with pytest.raises(Exception, match="not declared: 2002"):
        eda.seasonality_matrix(t, years=[1999]).collect()


def test_pivot_of_nothing(spark):
    t = Tables(spark, {"orders": lambda: spark.createDataFrame([], "customer_id long, order_date date, status string, order_id long"),
                       "customers": lambda: spark.createDataFrame([], "customer_id long, signup_date date")})
    assert shop.cohort_retention_matrix(t).collect() == []
    assert shop.cohort_retention_matrix(t, expected=[0, 1]).columns == ["cohort_month", "0", "1"]
