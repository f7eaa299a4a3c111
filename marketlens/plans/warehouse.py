"""Warehouse ETL: raw marketplace tables -> star schema, plus the checks and
KPIs computed on it.

Dimensions: dim_date, dim_customer, dim_product, dim_seller.
Facts: fact_orders (order grain), fact_order_items, fact_payments.

fact_orders is built from three order-grain pre-aggregations (items,
payments, latest review), each already hash-partitioned on ``order_id``
by its own aggregation, so the three left joins to the orders add one
shuffle of the orders and no fan-out. ``write_star`` lays the facts out by
purchase month, so date-bounded reads prune whole folders, and writes single
months anew; ``save_star`` also buckets them by order.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from marketlens.functions import expr as X
from marketlens.operators.constraints import check_constraints
from marketlens.operators.pivot import pivot
from marketlens.operators.ranking import materialize_small
from marketlens.sources import schemas

DELIVERED_OR_SHIPPED = ("delivered", "shipped")
FAR_FUTURE = "9999-12-31 00:00:00"  # undated reviews sort after every dated one


def conform(df: DataFrame, schema) -> DataFrame:
    """Select the declared columns, cast to the declared types (only where
    the type differs: every cast is a round trip to the JVM at build time)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[F.col(f.name) if have.get(f.name) == f.dataType
                       else F.col(f.name).cast(f.dataType.simpleString()).alias(f.name)
                       for f in schema.fields])


# ------------------------------------------------------------------ dimensions
def dim_date(t) -> DataFrame:
    """One row per day between the first and the last purchase day.

    The bounds are a global min/max (one row); the day list it expands to
    is bounded by the calendar span, not by the data volume.
    """
    bounds = t.raw_orders.agg(F.to_date(F.min("order_purchase_timestamp")).alias("lo"),
                              F.to_date(F.max("order_purchase_timestamp")).alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date"))
    wd = F.weekday("date")  # Monday = 0
    return conform(days.select(
        "date", F.year("date").alias("year"), F.quarter("date").alias("quarter"),
        F.month("date").alias("month"), X.month_label("date").alias("month_label"),
        wd.alias("weekday"), F.date_format("date", "EEEE").alias("weekday_name"),
        (wd >= 5).cast("int").alias("is_weekend")), schemas.STAR["dim_date"])


def customer_cohort(t) -> DataFrame:
    """First purchase month ('yyyy-MM') per customer, over orders of any status."""
    orders = t.raw_orders.join(t.raw_customers.select("customer_id"), "customer_id", "left_semi")
    return (orders.groupBy("customer_id")
            .agg(X.month_label(F.min("order_purchase_timestamp")).alias("cohort_month")))


def dim_customer(t) -> DataFrame:
    c = t.raw_customers.select("customer_id", "customer_state", "customer_city")
    return conform(c.join(customer_cohort(t), "customer_id", "left"), schemas.STAR["dim_customer"])


def dim_product(t) -> DataFrame:
    # one row per category name, whatever the file repeats: products never fan out
    cat = t.raw_category_translation.groupBy("product_category_name").agg(
        F.min("product_category_name_english").alias("product_category_name_english"))
    p = t.raw_products.join(cat, "product_category_name", "left")
    volume = (F.col("product_length_cm").cast("long") * F.col("product_height_cm")
              * F.col("product_width_cm"))
    return conform(p.select(
        "product_id", F.col("product_category_name").alias("category"),
        F.col("product_category_name_english").alias("category_en"),
        F.col("product_weight_g").alias("weight_g"), volume.alias("volume_cm3"),
        F.col("product_photos_qty").alias("photos_qty")), schemas.STAR["dim_product"])


def dim_seller(t) -> DataFrame:
    return conform(t.raw_sellers, schemas.STAR["dim_seller"])


# ------------------------------------------------------------------ facts
def _item_agg(t) -> DataFrame:
    i = t.raw_order_items
    freight = F.coalesce(F.sum("freight_value"), F.lit(0))
    return i.groupBy("order_id").agg(
        F.count("order_item_id").alias("total_items"),
        (F.coalesce(F.sum("price"), F.lit(0)) + freight).alias("revenue"),
        freight.alias("freight"))


def _payment_agg(t) -> DataFrame:
    return t.raw_order_payments.groupBy("order_id").agg(
        F.count_distinct("payment_type").alias("payment_methods"),
        F.max("payment_installments").alias("payment_installments"))


def _latest_review(t) -> DataFrame:
    """Score of the latest review with a score, per order; undated reviews
    count as latest, review id breaks ties."""
    r = t.raw_order_reviews.filter(F.col("review_score").isNotNull())
    far = F.lit(FAR_FUTURE).cast("timestamp_ntz")  # same type as the column: no time-zone shift
    key = F.struct(F.coalesce("review_creation_date", far), F.col("review_id"))
    return r.groupBy("order_id").agg(F.max_by("review_score", key).alias("review_score"))


def fact_orders(t) -> DataFrame:
    o = t.raw_orders
    f = (o.join(_item_agg(t), "order_id", "left")
          .join(_payment_agg(t), "order_id", "left")
          .join(_latest_review(t), "order_id", "left"))
    delay = X.floor_days("order_delivered_customer_date", "order_estimated_delivery_date")
    return conform(f.select(
        "order_id", "customer_id", "order_status",
        F.col("order_purchase_timestamp").alias("order_purchase_ts"),
        F.col("order_delivered_customer_date").alias("delivered_ts"),
        F.col("order_estimated_delivery_date").alias("estimated_ts"),
        delay.alias("delivery_delay_days"),
        X.to_flag(delay > 0).alias("is_late"),
        "review_score", "total_items", "revenue", "freight",
        "payment_methods", "payment_installments"), schemas.STAR["fact_orders"])


def fact_order_items(t) -> DataFrame:
    return conform(t.raw_order_items, schemas.STAR["fact_order_items"])


def fact_payments(t) -> DataFrame:
    return conform(t.raw_order_payments, schemas.STAR["fact_payments"])


STAR_BUILDERS = {
    "dim_date": dim_date, "dim_customer": dim_customer, "dim_product": dim_product,
    "dim_seller": dim_seller, "fact_orders": fact_orders,
    "fact_order_items": fact_order_items, "fact_payments": fact_payments,
}


#: Facts are laid out by the order's purchase month: sort keys within a month.
LAYOUT = {"fact_orders": ("order_purchase_ts", "order_id"), "fact_order_items": ("order_id", "order_item_id"),
          "fact_payments": ("order_id", "payment_sequential")}
MONTH = "order_month"


def with_order_month(t, name: str) -> DataFrame:
    """A fact with the purchase month of its order ('yyyy-MM'; null for rows of no order)."""
    df = t[name]
    if MONTH in df.columns:
        return df
    if name == "fact_orders":
        return df.withColumn(MONTH, X.month_label("order_purchase_ts"))
    months = t.fact_orders.groupBy("order_id").agg(X.month_label(F.min("order_purchase_ts")).alias(MONTH))
    return df.join(months, "order_id", "left")


def write_star(t, folder: str, fmt: str = "parquet", mode: str = "overwrite",
               months: Sequence[str] | None = None) -> dict[str, int]:
    """Write the seven star tables, the three facts laid out by purchase month.

    Each fact is range-partitioned on (month, keys), so writers stay balanced even when
    one month holds most orders, and each month's rows arrive sorted (tight row-group
    bounds). With ``months`` only those months of the facts are written anew and the
    files of all others stay; a named month that has no rows any more is emptied.

    Returns the rows written per table, observed while writing (no scan of their own).
    """
    spark = t.spark
    counts: dict[str, int] = {}
    for name in STAR_BUILDERS:
        path = os.path.join(folder, name if fmt == "csv" else f"{name}.parquet")
        df = t[name]
        by_month = name in LAYOUT and (fmt != "csv" or name == "fact_orders")
        if by_month:
            df = with_order_month(t, name)
            if months is not None:
                df = df.where(F.col(MONTH).isin(*months))
            keys = [MONTH, *LAYOUT[name]]
            df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        seen = Observation(name)
        wanted = list(months or ()) if by_month else []
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"),
                        *[F.count_if(F.col(MONTH) == m).alias(f"m{i}") for i, m in enumerate(wanted)])
        w = df.write.mode(mode)
        if by_month:
            w = w.partitionBy(MONTH)
            if months is not None:
                w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        if fmt == "csv":
            w.option("header", True).csv(path)
        else:
            w.parquet(path)
        counts[name] = seen.get["rows"]
        for i, m in enumerate(wanted):
            if not seen.get[f"m{i}"]:
                _remove(spark, os.path.join(path, f"{MONTH}={m}"))
    return counts


def _remove(spark, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def save_star(t, folder: str, prefix: str = "star_", buckets: int = 64) -> None:
    """The star as catalog tables below ``folder``: facts by purchase month, and within it in
    ``buckets`` by order, sorted. Joins and groupings of the facts on ``order_id`` then
    read bucket by bucket, without a shuffle. Take some 200 MB a bucket of the whole fact.

    Read them back with ``Tables.from_catalog``.
    """
    for name in STAR_BUILDERS:
        df = with_order_month(t, name) if name in LAYOUT else t[name]
        if name in LAYOUT:  # one writer a bucket: no more files than buckets in a month
            w = df.repartition(buckets, "order_id").write.bucketBy(buckets, "order_id").sortBy("order_id")
            w = w.partitionBy(MONTH)
        else:
            w = df.write
        w.mode("overwrite").format("parquet").option("path", os.path.join(folder, name)).saveAsTable(prefix + name)


# ------------------------------------------------------------------ checks
RAW_TABLES = ("raw_customers", "raw_sellers", "raw_products", "raw_orders", "raw_order_items",
              "raw_order_payments", "raw_order_reviews", "raw_category_translation")


#: Star tables that hold the rows of a raw table under the same names: derived, they need no scan of their own.
SAME_ROWS = {"fact_order_items": "raw_order_items", "fact_payments": "raw_order_payments", "dim_seller": "raw_sellers"}


def warehouse_row_counts(t) -> DataFrame:
    """Rows per raw table read and per star table; a table is scanned once, also for those
    that hold its rows. (`write_star` returns its counts without a scan.)"""
    same = {star: raw for star, raw in SAME_ROWS.items() if star not in t._builders}
    shown: dict[str, list[str]] = {}
    for n in (*RAW_TABLES, *STAR_BUILDERS):
        shown.setdefault(same.get(n, n), []).append(n)
    parts = [t[n].agg(F.count(F.lit(1)).alias("row_count")).select(
        F.explode(F.array(*map(F.lit, under))).alias("table_name"), "row_count") for n, under in shown.items()]
    return reduce(DataFrame.unionByName, parts)


# Declared constraints of the raw and star layers, checked as
# data rules. (table, rule label, kind, arguments)
INTEGRITY_RULES = [
    ("raw_customers", "pk", "unique", ("customer_id",)),
    ("raw_sellers", "pk", "unique", ("seller_id",)),
    ("raw_products", "pk", "unique", ("product_id",)),
    ("raw_orders", "pk", "unique", ("order_id",)),
    ("raw_order_items", "pk", "unique", ("order_id", "order_item_id")),
    ("raw_order_payments", "pk", "unique", ("order_id", "payment_sequential")),
    ("raw_category_translation", "pk", "unique", ("product_category_name",)),
    ("raw_orders", "not_null", "not_null", ("order_purchase_timestamp",)),
    ("raw_orders", "fk_customer", "fk", ("customer_id", "raw_customers", "customer_id")),
    ("raw_order_items", "fk_order", "fk", ("order_id", "raw_orders", "order_id")),
    ("raw_order_items", "fk_product", "fk", ("product_id", "raw_products", "product_id")),
    ("raw_order_items", "fk_seller", "fk", ("seller_id", "raw_sellers", "seller_id")),
    ("raw_order_payments", "fk_order", "fk", ("order_id", "raw_orders", "order_id")),
    ("raw_order_reviews", "fk_order", "fk", ("order_id", "raw_orders", "order_id")),
    ("raw_order_items", "price_non_negative", "check", "price >= 0"),
    ("raw_order_items", "freight_non_negative", "check", "freight_value >= 0"),
    ("raw_order_payments", "value_non_negative", "check", "payment_value >= 0"),
    ("raw_order_reviews", "score_1_to_5", "check", "review_score BETWEEN 1 AND 5"),
    ("dim_date", "pk", "unique", ("date",)),
    ("dim_customer", "pk", "unique", ("customer_id",)),
    ("dim_product", "pk", "unique", ("product_id",)),
    ("dim_seller", "pk", "unique", ("seller_id",)),
    ("fact_orders", "pk", "unique", ("order_id",)),
    ("fact_orders", "fk_customer", "fk", ("customer_id", "dim_customer", "customer_id")),
    ("fact_order_items", "fk_order", "fk", ("order_id", "fact_orders", "order_id")),
    ("fact_order_items", "pk", "unique", ("order_id", "order_item_id")),
    ("fact_order_items", "fk_product", "fk", ("product_id", "dim_product", "product_id")),
    ("fact_order_items", "fk_seller", "fk", ("seller_id", "dim_seller", "seller_id")),
    ("fact_payments", "pk", "unique", ("order_id", "payment_sequential")),
    ("fact_payments", "fk_order", "fk", ("order_id", "fact_orders", "order_id")),
]


# Declared constraints of the shop schema (customers, products, orders,
# order_items, payments), for ``integrity_report(t, SHOP_INTEGRITY_RULES)``.
SHOP_INTEGRITY_RULES = [
    ("customers", "pk", "unique", ("customer_id",)),
    ("customers", "not_null", "not_null", ("name", "signup_date")),
    ("products", "pk", "unique", ("product_id",)),
    ("products", "not_null", "not_null", ("name", "cost_price")),
    ("products", "cost_non_negative", "check", "cost_price >= 0"),
    ("orders", "pk", "unique", ("order_id",)),
    ("orders", "not_null", "not_null", ("customer_id", "order_date", "status")),
    ("orders", "fk_customer", "fk", ("customer_id", "customers", "customer_id")),
    ("orders", "status_known", "check", "status IN ('completed', 'cancelled', 'refunded', 'pending')"),
    ("order_items", "pk", "unique", ("item_id",)),
    ("order_items", "not_null", "not_null", ("order_id", "product_id", "quantity", "unit_price")),
    ("order_items", "fk_order", "fk", ("order_id", "orders", "order_id")),
    ("order_items", "fk_product", "fk", ("product_id", "products", "product_id")),
    ("order_items", "quantity_positive", "check", "quantity > 0"),
    ("order_items", "price_non_negative", "check", "unit_price >= 0"),
    ("payments", "pk", "unique", ("payment_id",)),
    ("payments", "not_null", "not_null", ("order_id", "amount", "payment_date")),
    ("payments", "fk_order", "fk", ("order_id", "orders", "order_id")),
    ("payments", "amount_non_negative", "check", "amount >= 0"),
    ("payments", "method_known", "check", "method IN ('card', 'paypal', 'transfer')"),
]


def integrity_report(t, rules=INTEGRITY_RULES) -> DataFrame:
    """One row per declared rule with the number of rows breaking it.

    One scan per table and one aggregate for all rules (`operators.constraints`); of a star
    table that is still derived from the raw layer only the columns of its rules are built.
    Tables read with rejects add a rule ``readable`` for each raw table: its rejected records.
    """
    same = {star: raw for star, raw in SAME_ROWS.items() if star not in t._builders}
    report = check_constraints(lambda name: t[name], rules, same)
    if "rejects" not in t._builders:
        return report
    names = sorted({r[0] for r in rules if r[0].startswith("raw_")})
    counts = t.rejects.groupBy("table_name").agg(F.count(F.lit(1)).alias("n"))
    listed = t.spark.range(1).select(F.explode(F.array(*map(F.lit, names))).alias("table_name"))
    return report.unionByName(listed.join(F.broadcast(counts), "table_name", "left").select(  # a row per table
        "table_name", F.lit("readable").alias("rule"), F.coalesce("n", F.lit(0)).alias("violations")))


# ------------------------------------------------------------------ KPIs
def warehouse_kpis(t, customer_key: str = "customer_id") -> DataFrame:
    """Headline numbers over delivered and shipped orders (one row).

    One pass: orders are first rolled up per customer (which the repeat
    rate needs anyway), then a single global aggregate combines the partial
    sums and counts. ``customer_key="customer_unique_id"`` counts people
    rather than per-order customer ids (the raw customer table maps one to
    the other).
    """
    fo = t.fact_orders.filter(F.col("order_status").isin(*DELIVERED_OR_SHIPPED))
    if customer_key != "customer_id":
        people = t.raw_customers.select("customer_id", F.col(customer_key).alias("_person"))
        fo = fo.join(people, "customer_id", "left").drop("customer_id").withColumnRenamed("_person", "customer_id")
    per_customer = fo.groupBy("customer_id").agg(
        F.count("order_id").alias("n"),
        F.sum("revenue").alias("rev"), F.count("revenue").alias("rev_n"),
        F.sum("review_score").alias("score"), F.count("review_score").alias("score_n"),
        F.sum("is_late").alias("late"))
    ratio = lambda a, b: F.try_divide(F.sum(a).cast("double"), F.sum(b))
    return per_customer.agg(
        F.sum("rev").cast("double").alias("total_revenue"),
        F.sum("n").alias("orders"),
        ratio("rev", "rev_n").alias("avg_order_value"),
        F.count(F.lit(1)).alias("customers"),
        (F.lit(100.0) * F.count_if(F.col("n") >= 2) / F.count(F.lit(1))).alias("repeat_rate_pct"),
        ratio("score", "score_n").alias("avg_review_score"),
        (F.lit(100.0) * F.sum("late") / F.sum("n")).alias("late_share_pct"))


def warehouse_cohort_retention(t, statuses=("delivered",), matrix: bool = False,
                               max_cohorts: int | None = None, max_months: int | None = None) -> DataFrame:
    """Retention of first-purchase cohorts over delivered orders.

    Long form: cohort_month, months_since, active, pct. ``matrix=True`` gives
    one row per cohort and one column per offset that occurs; ``max_cohorts``
    and ``max_months`` keep the first so many cohorts and, by position, the
    first so many of those offsets. A cohort is sized by its customers' first
    active months, in the same aggregate as the cells.
    """
    fo = (t.fact_orders.filter(F.col("order_status").isin(*statuses))
          .select("customer_id", X.month_label("order_purchase_ts").alias("order_month"))
          .distinct())
    c = fo.join(t.dim_customer.select("customer_id", "cohort_month"), "customer_id")
    earliest = F.min("order_month").over(Window.partitionBy("customer_id"))  # a customer's months: few
    cells = (c.withColumn("first", F.col("order_month") == earliest)
              .withColumn("months_since", X.month_label_diff("order_month", "cohort_month"))
              .groupBy("cohort_month", "months_since")
              .agg(F.count(F.lit(1)).alias("active"), F.count_if("first").alias("starters")))
    # the cells are bounded by the calendar
    size = F.sum("starters").over(Window.partitionBy("cohort_month"))
    long = cells.select("cohort_month", "months_since", "active", X.pct("active", size).alias("pct"))
    if not matrix:
        return long.orderBy("cohort_month", "months_since")
    place = lambda c: F.dense_rank().over(Window.orderBy(c))
    kept = materialize_small(long.withColumn("_row", place("cohort_month")).where(
        F.lit(True) if max_cohorts is None else F.col("_row") <= max_cohorts).drop("_row"))
    kept = kept.withColumn("_col", place("months_since")).where(
        F.lit(True) if max_months is None else F.col("_col") <= max_months).drop("_col")
    return pivot(kept, "cohort_month", "months_since", F.first("pct")).orderBy("cohort_month")
