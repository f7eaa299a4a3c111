"""Written stars: months, buckets, single months anew, observed counts; reading raw files."""

import glob
import os

import pytest
from test_warehouse import FILES, by

from marketlens.plans import report, shop, warehouse
from marketlens.sources import schemas
from marketlens.sources.tables import Tables


def written(folder, files=FILES, name=lambda t: schemas.RAW_FILES[t]):
    os.makedirs(folder, exist_ok=True)
    for t, text in files.items():
        with open(os.path.join(folder, name(t)), "w") as f:
            f.write(text)
    return str(folder)


@pytest.fixture()
def t(spark, tmp_path):
    return Tables.from_marketplace_csv(spark, written(tmp_path / "raw"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_are_observed_while_writing(t, tmp_path):
    counts = warehouse.write_star(t, str(tmp_path / "star"))
    expected = {n: r["row_count"] for n, r in by(warehouse.warehouse_row_counts(t), "table_name").items()}
    assert counts == {n: expected[n] for n in schemas.STAR}


def test_a_year_prunes_items_and_payments(spark, t, tmp_path):
    warehouse.write_star(t, str(tmp_path / "star"))
    star = Tables.from_parquet(spark, str(tmp_path / "star"))
    for df, column in ((report.top_categories(star, year=2017), "price"),
                       (report.payment_method_share(star, year=2017), "payment_type")):
        scan = [x for x in plan(df).split("\n") if "FileScan" in x and f"{column}#" in x]
        assert scan and all("PartitionFilters: [isnotnull(order_month" in x and "2017-12" in x for x in scan)
    assert by(report.top_categories(star, year=2017), "category_en") == by(report.top_categories(t, year=2017), "category_en")
    assert report.top_categories(star, year=2016).count() == 0
    assert by(report.payment_method_share(star, year=2017), "payment_type") == by(
        report.payment_method_share(t, year=2017), "payment_type")


def test_rows_of_no_order_stay(spark, tmp_path):
    files = FILES | {"raw_order_items": FILES["raw_order_items"].rstrip() + "\nghost,1,p1,s1,2017-01-10 00:00:00,1.00,1.00\n"}
    t = Tables.from_marketplace_csv(spark, written(tmp_path / "raw", files))
    warehouse.write_star(t, str(tmp_path / "star"))
    star = Tables.from_parquet(spark, str(tmp_path / "star"))
    assert star.fact_order_items.where("order_month IS NULL").count() == 1
    assert star.fact_order_items.count() == t.fact_order_items.count()


def stamps(folder):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/fact_*.parquet/order_month=*/*.parquet")}


def test_only_changed_months_are_written(spark, t, tmp_path):
    folder = str(tmp_path / "star")
    warehouse.write_star(t, folder)
    before = stamps(folder)
    # o4 (March) moves to February, so March is empty
    later = FILES | {"raw_orders": FILES["raw_orders"].replace("2017-03-01 08:30:00", "2017-02-27 08:30:00")}
    t2 = Tables.from_marketplace_csv(spark, written(tmp_path / "raw2", later))
    counts = warehouse.write_star(t2, folder, months=["2017-02", "2017-03"])
    after = stamps(folder)
    kept = {f: s for f, s in before.items() if "order_month=2017-01" in f}
    assert kept and all(after[f] == s for f, s in kept.items())
    assert not any("order_month=2017-03" in f for f in after)
    assert not {f for f in before if "order_month=2017-02" in f} & set(after)
    star = Tables.from_parquet(spark, folder)
    assert counts["fact_orders"] == 3 and star.fact_orders.count() == 4
    key = lambda x: sorted(map(str, x.collect()))
    for name in ("fact_orders", "fact_order_items", "fact_payments"):
        assert key(star[name].select(t2[name].columns)) == key(t2[name])


def test_bucketed_facts_join_without_a_shuffle(spark, t, tmp_path):
    warehouse.save_star(t, str(tmp_path / "tables"), prefix="layout_test_", buckets=4)
    try:
        star = Tables.from_catalog(spark, "layout_test_")
        old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        try:
            items = star.fact_order_items.groupBy("order_id").sum("price")
            paid = star.fact_payments.groupBy("order_id").sum("payment_value")
            df = star.fact_orders.join(items, "order_id").join(paid, "order_id", "left")
            assert "Exchange" not in plan(df) and "SortMergeJoin" in plan(df)
            assert df.count() == 3
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        assert by(report.top_categories(star), "category_en") == by(report.top_categories(t), "category_en")
    finally:
        for name in schemas.STAR:
            spark.sql(f"DROP TABLE IF EXISTS layout_test_{name}")


# --- raw files ---------------------------------------------------------------

def test_export_files_are_found_by_name(spark, tmp_path):
    export = lambda n: "some_" + schemas.RAW_FILES[n][:-4] + "_dataset.csv" if "translation" not in n else schemas.RAW_FILES[n]
    t = Tables.from_marketplace_csv(spark, written(tmp_path / "raw", name=export))
    assert t.raw_orders.count() == 4 and t.raw_order_items.columns[1] == "order_item_id"
    assert t.raw_category_translation.count() > 0 and t.raw_products.columns[0] == "product_id"
    with pytest.raises(ValueError):
        schemas.raw_file_names(["a_orders.csv", "b_orders.csv"])


def test_only_the_reviews_are_read_whole(spark, tmp_path):
    lines = ["order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value"]
    lines += [f"o{i},1,p1,s1,2017-01-10 00:00:00,1.00,0.50" for i in range(3000)]
    texts = FILES["raw_order_reviews"].rstrip() + '\nr9,o1,5,,"two\nlines ""and"" quotes",2017-01-25 00:00:00,\n'
    t = Tables.from_marketplace_csv(spark, written(tmp_path / "raw", FILES | {
        "raw_order_items": "\n".join(lines) + "\n", "raw_order_reviews": texts}))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
    try:
        assert t.raw_order_items.rdd.getNumPartitions() > 3 and t.raw_order_items.count() == 3000
        assert t.raw_order_reviews.where("review_id = 'r9'").first().review_comment_message == 'two\nlines "and" quotes'
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_rejected_records(spark, tmp_path):
    bad = FILES["raw_order_items"].rstrip() + "\no1,9,p1,s1,2017-01-10 00:00:00,cheap,1.00\no2,8,p1,s1,never,5.00,1.00\n"
    folder = written(tmp_path / "raw", FILES | {"raw_order_items": bad})
    with pytest.raises(Exception, match="(?i)malformed|failfast|parse"):
        Tables.from_marketplace_csv(spark, folder).raw_order_items.collect()
    t = Tables.from_marketplace_csv(spark, folder, rejects=True)
    clean = Tables.from_marketplace_csv(spark, written(tmp_path / "clean"))
    assert t.raw_order_items.count() == clean.raw_order_items.count()
    # whichever columns are read
    assert t.raw_order_items.select("order_id").count() == clean.raw_order_items.count()
    got = sorted((r.table_name, r.record) for r in t.rejects.collect())
    assert got == [("raw_order_items", "o1,9,p1,s1,2017-01-10 00:00:00,cheap,1.00"),
                   ("raw_order_items", "o2,8,p1,s1,never,5.00,1.00")]
    r = {(x.table_name, x.rule): x.violations for x in warehouse.integrity_report(t).collect()}
    assert r["raw_order_items", "readable"] == 2 and r["raw_orders", "readable"] == 0
    assert sum(r.values()) == 2


# --- SQL and grains ----------------------------------------------------------

def test_sql_surface(spark, t):
    text = """SELECT category_en, CAST(SUM(price + freight_value) AS DOUBLE) AS revenue
              FROM {fact_order_items} i JOIN {dim_product} p USING (product_id)
              JOIN {fact_orders} o USING (order_id) WHERE year(order_purchase_ts) = :year
              GROUP BY category_en"""
    sql = {r.category_en: r.revenue for r in t.sql(text, year=2017).collect()}
    assert sql == {r.category_en: r.revenue for r in report.top_categories(t, n=None, year=2017).collect()}
    t.create_views(["raw_orders"])
    assert spark.sql("SELECT count(*) FROM raw_orders").first()[0] == 4
    spark.catalog.dropTempView("raw_orders")


def test_several_payments_do_not_multiply_orders(spark):
    made = {
        "orders": ([(1, "completed"), (2, "completed"), (3, "pending")], "order_id long, status string"),
        "order_items": ([(1, 10), (1, 20), (2, None), (2, 5), (3, 9)], "order_id long, line_revenue decimal(10,2)"),
        "payments": ([(1, "2020-01-03"), (1, "2020-01-09"), (1, "2020-02-01"), (2, "2020-01-01"), (3, "2020-01-01")],
                     "order_id long, d string")}
    t = Tables(spark, {k: lambda v=v: spark.createDataFrame([(a, None if b is None else b) for a, b in v[0]],
                                                            v[1].replace("decimal(10,2)", "int")) for k, v in made.items()})
    t.register("payments", t.payments.selectExpr("order_id", "CAST(d AS DATE) AS payment_date"))
    t.register("order_items", t.order_items.selectExpr("order_id", "CAST(line_revenue AS DECIMAL(10,2)) AS line_revenue"))
    rows = [(str(r.month), r.total_orders, r.gross_revenue, r.avg_order_value) for r in shop.monthly_revenue(t).collect()]
    # lines count once for each payment, orders once in a month
    assert rows == [("2020-01-01", 2, 65.0, 13.0), ("2020-02-01", 1, 30.0, 15.0)]


def test_a_state_slicer_filters_the_orders_scan(spark, t, tmp_path):
    """Where the orders are too large to broadcast against, Spark's runtime Bloom filter of the
    sliced customers reaches the orders' scan."""
    warehouse.write_star(t, str(tmp_path / "star"))
    star = Tables.from_parquet(spark, str(tmp_path / "star"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = report.order_status_mix(star, states=["RJ"])
        assert "might_contain" in df._jdf.queryExecution().optimizedPlan().toString()
        assert by(df, "order_status")["shipped"]["orders"] == 1
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
