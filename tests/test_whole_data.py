"""Nothing is lost without a word: unlisted columns, gaps, nulls, odd texts, big keys."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketlens.functions import expr as X
from marketlens.operators import ranking as R
from marketlens.plans import eda, measures, warehouse
from marketlens.sources import schemas
from marketlens.sources.tables import Tables

DAY = dt.datetime(2022, 1, 3)


def sales(spark, rows):
    data = [(DAY, c, r, ch, 1.0, 1, Decimal(v)) for c, r, ch, v in rows]
    nullable = schemas.StructType([schemas.StructField(f.name, f.dataType, True) for f in schemas.SALES.fields])
    return Tables(spark, {"sales": lambda: spark.createDataFrame(data, nullable)})


def test_every_channel_has_a_column(spark):
    t = sales(spark, [("a", "n", "Online", "15"), ("a", "n", "Phone", "90"), ("a", "n", None, "1")])
    row = eda.channel_by_month(t).collect()[0]
    assert row.Online == 15.0 and row.Phone == 90.0 and len(row) == 3
    with pytest.raises(Exception, match="not declared: Phone"):
        eda.channel_by_month(t, channels=["Online"]).collect()


def test_null_categories_take_no_part(spark):
    t = sales(spark, [("a", "n", "x", "30"), (None, "n", "x", "70"), ("b", None, "x", "10")])
    assert {r.category: r.share_pct for r in eda.category_summary(t).collect()} == {"a": 75.0, "b": 25.0}
    assert eda.region_by_category(t).columns == ["region", "a"]
    assert [r.category for r in eda.revenue_distribution(t).collect()] == ["a", "b"]


def test_mean_is_rounded_once(spark):
    exact = X.money_mean(F.lit(Decimal("1004999995.00")), F.lit(1_000_000_000))  # 1.004999995
    assert spark.range(1).select(exact).first()[0] == 1.0


def test_big_keys_beside_nulls(spark):
    a, b = 2**60 + 1, 2**60 + 2
    rows = [(a, 1, a), (b, 1, b), (None, 1, None), (a, 2, None), (b, 2, b + 5), (a, 3, a + 7)]
    df = spark.createDataFrame(rows, "g long, o long, v long")
    got = {(r.g, r.o): (r.s, r.p) for r in R.with_group_sequence(
        df, ["g"], [("o", True)], "s", lags={"v": "p"}, num_partitions=3).collect()}
    assert got == {(a, 1): (1, None), (a, 2): (2, a), (a, 3): (3, None), (b, 1): (1, None), (b, 2): (2, b),
                   (None, 1): (1, None)}


def marketplace(spark, folder, review, price="10.00"):
    text = {
        "raw_orders": "o1,c1,delivered,2017-01-05 10:00:00,,,2017-01-09 10:00:00,2017-01-08 00:00:00",
        "raw_order_items": f"o1,1,p1,s1,2017-01-06 00:00:00,{price},1.00",
        "raw_order_reviews": review,
    }
    for name, fields in schemas.RAW.items():
        head = ",".join(f.name for f in fields.fields)
        (folder / f"{name}.csv").write_text(f"{head}\n{text.get(name, '')}\n" if name in text else head + "\n")
    return Tables.from_marketplace_csv(spark, str(folder), {n: f"{n}.csv" for n in schemas.RAW})


def test_reviews_with_line_breaks_and_bad_prices(spark, tmp_path):
    cols = [f.name for f in schemas.RAW["raw_order_reviews"].fields]
    values = {"review_id": "r1", "order_id": "o1", "review_score": "4", "review_creation_date": "2017-01-10 00:00:00"}
    quoted = ",".join('"said ""fine""\nand left"' if "message" in c else values.get(c, "") for c in cols)
    t = marketplace(spark, tmp_path, quoted)
    assert [r.review_id for r in t.raw_order_reviews.collect()] == ["r1"]
    assert t.fact_orders.first().review_score == 4
    bad = marketplace(spark, tmp_path, quoted, price="ten")
    with pytest.raises(Exception):
        bad.raw_order_items.collect()


def cohorts(spark):
    ts = lambda y, m: dt.datetime(y, m, 5)
    orders = [("c1", ts(2017, 1)), ("c1", ts(2017, 4)), ("c2", ts(2017, 1)), ("c2", ts(2017, 6)), ("c3", ts(2017, 2))]
    fo = spark.createDataFrame([(f"o{i}", c, "delivered", t) for i, (c, t) in enumerate(orders)],
                               "order_id string, customer_id string, order_status string, order_purchase_ts timestamp_ntz")
    dim = spark.createDataFrame([("c1", "2017-01"), ("c2", "2017-01"), ("c3", "2017-02")],
                                "customer_id string, cohort_month string")
    return Tables(spark).register("fact_orders", fo).register("dim_customer", dim)


def test_cohort_matrix_cuts_by_position(spark):
    t = cohorts(spark)
    assert warehouse.warehouse_cohort_retention(t, matrix=True).columns == ["cohort_month", "0", "3", "5"]
    first = warehouse.warehouse_cohort_retention(t, matrix=True, max_months=2)
    assert first.columns == ["cohort_month", "0", "3"]
    assert {r.cohort_month: r["3"] for r in first.collect()} == {"2017-01": 50.0, "2017-02": None}


def test_year_slicer_prunes_folders(spark, tmp_path):
    t = cohorts(spark)
    df = t.fact_orders.withColumn("order_month", F.date_format("order_purchase_ts", "yyyy-MM"))
    df.write.partitionBy("order_month").parquet(str(tmp_path / "fact_orders.parquet"))
    star = Tables.from_parquet(spark, str(tmp_path))
    plan = measures.order_frame(star, year=2017)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan and ">= 2017-01" in plan
    assert measures.order_frame(star, year=2017).count() == 5
