"""Datasets behind the five report pages (and the top-sellers table).

Each function returns the rows one visual plots; none draws anything.
Slicers are keyword arguments: ``year`` (purchase year), ``states``
(customer states), ``categories`` (English category names, item-level
datasets only).

Grain rules: revenue split by category, product or seller is item revenue
(price + freight); split by payment method it is paid value; an
order-level number under such a split (review, delay, order count) is
taken once per distinct (order, split value) pair. Item rows are always
rolled up to (order, split value) or (product) before they meet a
dimension or fact_orders, so every join carries aggregated rows. Top-n
lists sort by value then key, so ties are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions import expr as X
from marketlens.plans import measures as M
from marketlens.operators.ranking import materialize_small
from marketlens.plans.warehouse import warehouse_cohort_retention

LATE_TARGET_PCT = 7.0  # fixed value: target line of the late-share chart


def _div(a, b):
    return F.try_divide(X.col(a).cast("double"), X.col(b).cast("double"))


def _top(df: DataFrame, n: int | None, value: str, key: Sequence[str]) -> DataFrame:
    ordered = df.orderBy(F.col(value).desc_nulls_last(), *key)
    return ordered.limit(n) if n else ordered


def _orders(t, year=None, states=None) -> DataFrame:
    return M.order_frame(t, year=year, states=states)


def _items(t, year=None, states=None, categories=None) -> DataFrame:
    """fact_order_items in scope, with item revenue. A year prunes the folders of a written
    star on its own; the orders then decide row by row."""
    it = M.in_year(t.fact_order_items, year)
    if year is not None or states:
        it = it.join(_orders(t, year, states).select("order_id"), "order_id", "left_semi")
    if categories:
        prods = t.dim_product.filter(F.col("category_en").isin(*categories)).select("product_id")
        it = it.join(prods, "product_id", "left_semi")
    return it.withColumn("item_revenue", F.col("price") + F.col("freight_value"))


# ------------------------------------------------------------- page 1
def kpi_cards(t, year: int | None = None, states=None) -> DataFrame:
    """Six cards: revenue (+ YoY %), orders, AOV, customers, repeat rate, review.

    Revenue PY shifts the whole date selection back one year: with a year
    slicer it is the year before; without one it is the revenue of orders
    placed up to one year before the last purchase date. That date is a
    scalar subquery over the purchase timestamps alone; PY is then a
    conditional sum in the same rollup as the other cards.
    """
    fo = _orders(t, year, states)
    cols = ["total_revenue", "orders", "avg_order_value", "customers", "repeat_rate_pct", "avg_review_score"]
    if year is None:
        cutoff = F.add_months(fo.agg(F.max(F.to_date("order_purchase_ts"))).scalar(), -12)
        prior = F.when(F.to_date("order_purchase_ts") <= cutoff, F.col("revenue"))
        both = M.measures(fo.withColumn("_prior", prior), names=cols, extra_sums={"rev_prior": F.col("_prior")})
    else:
        prior = _orders(t, year - 1, states).agg(F.sum("revenue").alias("rev_prior"))
        # two one-row results side by side: union, then one max per column (no join)
        both = (M.measures(fo, names=cols).unionByName(prior, allowMissingColumns=True)
                .agg(*[F.max(c).alias(c) for c in cols + ["rev_prior"]]))
    rev = F.col("total_revenue")
    py = F.col("rev_prior").cast("double")
    return both.select(
        "total_revenue",
        (F.try_divide(rev - py, py) * 100).alias("revenue_yoy_pct"),
        "orders", "avg_order_value", "customers", "repeat_rate_pct", "avg_review_score")


def monthly_revenue_rolling(t, year=None, states=None) -> DataFrame:
    """Order revenue per month and its 3-month rolling mean."""
    per = (_orders(t, year, states).groupBy("month_label").agg(F.sum("revenue").alias("rev")))
    w = Window.orderBy("month_label").rowsBetween(-2, 0)  # monthly series: small
    return per.select("month_label", F.col("rev").cast("double").alias("revenue"),
                      (F.sum("rev").over(w).cast("double") / F.count("rev").over(w)).alias("rolling_3m_avg")
                      ).orderBy("month_label")


def _category_revenue(t, **scope) -> DataFrame:
    per_product = _items(t, **scope).groupBy("product_id").agg(F.sum("item_revenue").alias("rev"))
    return (per_product.join(t.dim_product.select("product_id", "category_en"), "product_id", "left")
            .groupBy("category_en").agg(F.sum("rev").alias("rev")))


def top_categories(t, n: int | None = 8, **scope) -> DataFrame:
    per = _category_revenue(t, **scope).select("category_en", F.col("rev").cast("double").alias("revenue"))
    return _top(per, n, "revenue", ["category_en"])


def revenue_by_state(t, year=None, states=None) -> DataFrame:
    per_customer = (_orders(t, year, states).groupBy("customer_id")
                    .agg(F.sum("revenue").alias("rev"), F.count("order_id").alias("n")))
    per = (per_customer.join(t.dim_customer.select("customer_id", "customer_state"), "customer_id", "left")
           .groupBy("customer_state").agg(F.sum("rev").alias("rev"), F.sum("n").alias("orders")))
    return per.select("customer_state", F.col("rev").cast("double").alias("revenue"), "orders",
                      _div("rev", "orders").alias("avg_order_value")).orderBy(F.col("revenue").desc(),
                                                                            "customer_state")


def order_status_mix(t, year=None, states=None) -> DataFrame:
    return (_orders(t, year, states).groupBy("order_status")
            .agg(F.count("order_id").alias("orders")).orderBy(F.col("orders").desc(), "order_status"))


# ------------------------------------------------------------- page 2
def cohort_matrix_18(t, wide: bool = True, max_months: int = 18) -> DataFrame:
    """Cohort x months since first purchase (0..18), retention %."""
    long = (warehouse_cohort_retention(t).filter(F.col("months_since") <= max_months)
            .select("cohort_month", "months_since", F.col("pct").alias("retention_pct")))
    if not wide:
        return long
    return (long.groupBy("cohort_month").pivot("months_since", list(range(max_months + 1)))
            .agg(F.first("retention_pct")).orderBy("cohort_month"))


def new_vs_returning(t, year=None, states=None) -> DataFrame:
    """Customers per month split by whether the order is in their cohort month."""
    # a customer's months first: orders do not meet the customers
    seen = _orders(t, year, states).select("month_label", "customer_id").distinct()
    cohorts = t.dim_customer.select("customer_id", "cohort_month")
    is_new = X.to_flag(F.col("month_label") == F.col("cohort_month"))
    per = (seen.join(cohorts, "customer_id", "left")
           .groupBy("month_label", is_new.alias("is_new")).agg(F.count(F.lit(1)).alias("customers")))
    return per.orderBy("month_label", "is_new")


def orders_per_customer(t, year=None, states=None) -> DataFrame:
    m = M.measures(_orders(t, year, states), ["month_label"], names=["orders", "customers"])
    return m.withColumn("orders_per_customer", _div("orders", "customers")).orderBy("month_label")


def top_customers(t, n: int | None = 20, year=None, states=None) -> DataFrame:
    per = (_orders(t, year, states).groupBy("customer_id")
           .agg(F.count("order_id").alias("orders"), F.sum("revenue").alias("rev"),
                F.to_date(F.min("order_purchase_ts")).alias("first_order"),
                F.to_date(F.max("order_purchase_ts")).alias("last_order")))
    out = (per.join(t.dim_customer.select("customer_id", "customer_state"), "customer_id", "left")
           .select("customer_id", "customer_state", "orders", F.col("rev").cast("double").alias("revenue"),
                   "first_order", "last_order", F.datediff("last_order", "first_order").alias("days_active")))
    return _top(out, n, "revenue", ["customer_id"])


# ------------------------------------------------------------- page 3
def category_pareto(t, n: int | None = 20, **scope) -> DataFrame:
    """Categories by item revenue with the cumulative share of all revenue."""
    per = _category_revenue(t, **scope)
    order = Window.orderBy(F.col("rev").desc(), F.col("category_en")).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy()  # one row per category
    out = per.select("category_en", F.col("rev").cast("double").alias("revenue"),
                     (_div(F.sum("rev").over(order), F.sum("rev").over(everything)) * 100).alias("cumulative_pct"))
    return _top(out, n, "revenue", ["category_en"])


def _order_category(t, **scope) -> DataFrame:
    """(order, category) pairs with their item revenue and item count.

    Items meet their products row by row, in shuffled parts: an order holds a product about once, so
    counting such pairs first, or those of an unshuffled split, keeps nearly all its items in memory.
    A part's products, one row each, are held instead."""
    items = _items(t, **scope).select("order_id", "product_id", "item_revenue")
    products = t.dim_product.select("product_id", "category_en").hint("shuffle_hash")
    return (items.join(products, "product_id", "left")
            .groupBy("order_id", "category_en").agg(F.sum("item_revenue").alias("rev"), F.count(F.lit(1)).alias("units")))


def avg_ticket_by_category(t, **scope) -> DataFrame:
    per = (_order_category(t, **scope).groupBy("category_en")
           .agg(F.sum("rev").alias("rev"), F.count(F.lit(1)).alias("orders")))
    return per.select("category_en", F.col("rev").cast("double").alias("revenue"), "orders",
                      _div("rev", "orders").alias("avg_order_value")).orderBy(F.col("avg_order_value").desc(),
                                                                            "category_en")


def category_quality(t, **scope) -> DataFrame:
    oc = _order_category(t, **scope).join(t.fact_orders.select("order_id", "review_score"), "order_id", "left")
    per = oc.groupBy("category_en").agg(
        F.sum("review_score").alias("s"), F.count("review_score").alias("k"),
        F.sum("rev").alias("rev"), F.count(F.lit(1)).alias("orders"))
    return per.select("category_en", _div("s", "k").alias("avg_review_score"),
                      F.col("rev").cast("double").alias("revenue"), "orders").orderBy("category_en")


def top_products(t, n: int | None = 10, **scope) -> DataFrame:
    per_op = (_items(t, **scope).groupBy("order_id", "product_id")
              .agg(F.sum("item_revenue").alias("rev"), F.count(F.lit(1)).alias("units")))
    scored = per_op.join(t.fact_orders.select("order_id", "review_score"), "order_id", "left")
    per = scored.groupBy("product_id").agg(
        F.sum("units").alias("units"), F.sum("rev").alias("rev"),
        F.sum("review_score").alias("s"), F.count("review_score").alias("k"))
    out = (per.join(t.dim_product.select("product_id", "category_en"), "product_id", "left")
           .select("product_id", "category_en", "units", F.col("rev").cast("double").alias("revenue"),
                   _div("s", "k").alias("avg_review_score")))
    return _top(out, n, "revenue", ["product_id"])


# ------------------------------------------------------------- page 4
def _with_state(t, fo: DataFrame) -> DataFrame:
    return fo.join(t.dim_customer.select("customer_id", "customer_state"), "customer_id", "left")


def delay_by_state(t, year=None, states=None) -> DataFrame:
    per_customer = _orders(t, year, states).groupBy("customer_id").agg(
        F.sum("delivery_delay_days").alias("s"), F.count("delivery_delay_days").alias("k"))
    per = _with_state(t, per_customer).groupBy("customer_state").agg(F.sum("s").alias("s"), F.sum("k").alias("k"))
    return per.select("customer_state", _div("s", "k").alias("avg_delivery_delay"),
                      F.col("k").alias("delivered_orders")).orderBy("customer_state")


def late_share_by_state(t, n: int | None = 15, target_pct: float = LATE_TARGET_PCT,
                        year=None, states=None) -> DataFrame:
    m = M.measures(_orders(t, year, states), ["customer_state"], names=["orders", "late_orders", "late_share_pct"],
                   customers=t.dim_customer.select("customer_id", "customer_state"))
    out = m.withColumn("above_target", X.to_flag(F.col("late_share_pct") > F.lit(target_pct)))
    return _top(out, n, "orders", ["customer_state"])


def review_distribution(t) -> DataFrame:
    """Every review (not only the latest per order) by score."""
    return (t.raw_order_reviews.filter(F.col("review_score").isNotNull())
            .groupBy("review_score").agg(F.count(F.lit(1)).alias("reviews")).orderBy("review_score"))


def late_vs_ontime_review(t, year=None, states=None) -> DataFrame:
    fo = _orders(t, year, states).filter(F.col("order_status") == "delivered")
    per = fo.groupBy("is_late").agg(F.sum("review_score").alias("s"), F.count("review_score").alias("k"),
                                    F.count("order_id").alias("orders"))
    return per.select("is_late", _div("s", "k").alias("avg_review_score"), "orders").orderBy("is_late")


def top_routes(t, n: int | None = 10, year=None, states=None) -> DataFrame:
    """seller state -> customer state: orders and mean delay over distinct (order, route)."""
    legs = (_items(t, year, states).select("order_id", "seller_id").distinct()
            .join(t.dim_seller.select("seller_id", "seller_state"), "seller_id", "left")
            .select("order_id", "seller_state").distinct())
    fo = _with_state(t, t.fact_orders.select("order_id", "customer_id", "delivery_delay_days"))
    per = (legs.join(fo, "order_id")
           .groupBy("seller_state", "customer_state")
           .agg(F.count(F.lit(1)).alias("orders"),
                F.sum("delivery_delay_days").alias("s"), F.count("delivery_delay_days").alias("k")))
    out = per.select("seller_state", "customer_state", "orders", _div("s", "k").alias("avg_delivery_delay"))
    return _top(out, n, "orders", ["seller_state", "customer_state"])


# ------------------------------------------------------------- page 5
def _payments(t, year=None, states=None) -> DataFrame:
    p = M.in_year(t.fact_payments, year)
    if year is not None or states:
        p = p.join(_orders(t, year, states).select("order_id"), "order_id", "left_semi")
    return p


def payment_method_share(t, year=None, states=None) -> DataFrame:
    per = (_payments(t, year, states).select("payment_type", "order_id").distinct()
           .groupBy("payment_type").agg(F.count(F.lit(1)).alias("orders")))
    everything = Window.partitionBy()  # one row per payment method
    return per.select("payment_type", "orders",
                      (_div("orders", F.sum("orders").over(everything)) * 100).alias("share_pct")
                      ).orderBy(F.col("orders").desc(), "payment_type")


def installments_distribution(t, year=None, states=None) -> DataFrame:
    return (_payments(t, year, states).select("payment_type", "payment_installments", "order_id").distinct()
            .groupBy("payment_type", "payment_installments").agg(F.count(F.lit(1)).alias("orders"))
            .orderBy("payment_type", "payment_installments"))


def aov_by_payment_method(t, year=None, states=None) -> DataFrame:
    pairs = _payments(t, year, states).select("order_id", "payment_type").distinct()
    per = (pairs.join(t.fact_orders.select("order_id", "revenue"), "order_id")
           .groupBy("payment_type").agg(F.sum("revenue").alias("rev"), F.count(F.lit(1)).alias("orders")))
    return per.select("payment_type", "orders", _div("rev", "orders").alias("avg_order_value")
                      ).orderBy("payment_type")


def payment_method_by_month(t, year=None, states=None, wide: bool = False) -> DataFrame:
    p = _payments(t, year, states).join(
        t.fact_orders.select("order_id", X.month_label("order_purchase_ts").alias("month_label")), "order_id")
    long = (p.groupBy("payment_type", "month_label")
            .agg(F.sum("payment_value").cast("double").alias("revenue")))
    if not wide:
        return long.orderBy("payment_type", "month_label")
    # methods x months: small; materialized so the pivot's month scan reads it, not the facts
    return (materialize_small(long).groupBy("payment_type").pivot("month_label")
            .agg(F.first("revenue")).orderBy("payment_type"))


# ------------------------------------------------------------- top sellers
def top_sellers(t, n: int | None = 10, **scope) -> DataFrame:
    """Sellers by item revenue: orders, units, revenue, mean review over distinct (order, seller)."""
    per_os = (_items(t, **scope).groupBy("order_id", "seller_id")
              .agg(F.sum("item_revenue").alias("rev"), F.count(F.lit(1)).alias("units")))
    scored = per_os.join(t.fact_orders.select("order_id", "review_score"), "order_id", "left")
    per = scored.groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("units").alias("units"), F.sum("rev").alias("rev"),
        F.sum("review_score").alias("s"), F.count("review_score").alias("k"))
    out = (per.join(t.dim_seller.select("seller_id", "seller_state"), "seller_id", "left")
           .select("seller_id", "seller_state", "orders", "units", F.col("rev").cast("double").alias("revenue"),
                   _div("s", "k").alias("avg_review_score")))
    return _top(out, n, "revenue", ["seller_id"])
