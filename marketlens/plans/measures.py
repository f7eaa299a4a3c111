"""Report measures and the twelve headline KPIs.

Measures are evaluated at any grain with ``measures(df, by=[...])`` over an
order-grain frame (fact_orders plus whatever grouping columns the caller
added). Every measure is a sum or a count, so the frame is rolled up once
to (grain, customer) — which the repeat-customer measure needs anyway — and
then once to the grain: two map-side combined aggregations, no join and no
distinct-count expansion. Ratios are computed in double precision as
``DIVIDE(a, b) * 100``; a zero or missing denominator gives null.

Revenue PY is the same grain one period earlier, read through a RANGE
window frame on a period index (12 months back, or 1 year back), so a gap
stays null instead of borrowing a neighbour, and no second copy of the
order pipeline is joined in.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions import expr as X
from marketlens.operators.distinct import bitmaps, dense_ids, distinct_counts, sketch_counts, sketches
from marketlens.operators.selection import checkpointed

MEASURES = (
    "total_revenue", "orders", "avg_order_value", "total_items", "avg_items_per_order",
    "customers", "repeat_customers", "repeat_rate_pct", "avg_delivery_delay", "late_orders",
    "late_share_pct", "avg_review_score", "low_review_orders", "low_review_share_pct",
    "revenue_py", "revenue_yoy_pct",
)


def _div(a, b):
    return F.try_divide(X.col(a).cast("double"), X.col(b).cast("double"))


def measures(df: DataFrame, by: Sequence[str] = (), period: str | None = None,
             names: Sequence[str] | None = None, extra_sums: dict | None = None,
             customers: DataFrame | None = None, repeated: bool = False) -> DataFrame:
    """All report measures per ``by`` group.

    ``df`` is at order grain (one row per order). ``period`` names the
    column among ``by`` that Revenue PY shifts: ``"month_label"``
    ('yyyy-MM') or ``"year"``; without it PY is not computed. ``extra_sums``
    maps an output name to a per-order Column that is summed in the same
    two aggregations. ``customers`` has those of the ``by`` columns that go
    with the customer (customer_id first); it meets the rollup, not the orders.
    Order ids are counted by their rows, which is their distinct count as long as
    ``df`` holds an order once (`warehouse.integrity_report` checks it); with
    ``repeated`` a repeated order counts once in all measures, at the price of a
    shuffle of the orders.
    """
    if repeated:
        df = df.dropDuplicates(["order_id"])
    by = list(by)
    extra_sums = dict(extra_sums or {})
    own = [c for c in by if customers is None or c not in customers.columns]
    per_customer = df.groupBy(*own, "customer_id").agg(
        F.count("order_id").alias("n"),
        F.sum("revenue").alias("rev"),
        F.sum("total_items").alias("items"),
        F.sum("delivery_delay_days").alias("delay_sum"), F.count("delivery_delay_days").alias("delay_n"),
        F.count(F.when(F.col("is_late") == 1, F.col("order_id"))).alias("late"),
        F.sum("review_score").alias("score_sum"), F.count("review_score").alias("score_n"),
        F.count(F.when(F.col("review_score") <= 2, F.col("order_id"))).alias("low"),
        *[F.sum(e).alias(k) for k, e in extra_sums.items()])
    if customers is not None:
        per_customer = per_customer.join(customers, "customer_id", "left")
    agg = per_customer.groupBy(*by).agg(
        F.sum("rev").alias("rev"), F.sum("n").alias("orders"), F.sum("items").alias("total_items"),
        F.count("customer_id").alias("customers"),
        F.count_if(F.col("customer_id").isNotNull() & (F.col("n") >= 2)).alias("repeat_customers"),
        F.sum("delay_sum").alias("delay_sum"), F.sum("delay_n").alias("delay_n"),
        F.sum("late").alias("late_orders"),
        F.sum("score_sum").alias("score_sum"), F.sum("score_n").alias("score_n"),
        F.sum("low").alias("low_review_orders"),
        *[F.sum(k).alias(k) for k in extra_sums])
    if period:
        # value of the same grain exactly one period earlier: a RANGE frame
        # on a period index over the (small) aggregate, null on a gap
        idx = (F.year(F.to_date(F.col(period), "yyyy-MM")) * 12 + F.month(F.to_date(F.col(period), "yyyy-MM"))
               if period == "month_label" else F.col(period))
        step = 12 if period == "month_label" else 1
        others = [c for c in by if c != period]
        w = Window.partitionBy(*others).orderBy(idx).rangeBetween(-step, -step)
        agg = agg.withColumn("rev_py", F.sum("rev").over(w))
    else:
        agg = agg.withColumn("rev_py", F.lit(None).cast("decimal(38,4)"))
    out = agg.select(
        *by,
        F.col("rev").cast("double").alias("total_revenue"),
        "orders",
        _div("rev", "orders").alias("avg_order_value"),
        "total_items",
        _div("total_items", "orders").alias("avg_items_per_order"),
        "customers", "repeat_customers",
        (_div("repeat_customers", "customers") * 100).alias("repeat_rate_pct"),
        _div("delay_sum", "delay_n").alias("avg_delivery_delay"),
        "late_orders",
        (_div("late_orders", "orders") * 100).alias("late_share_pct"),
        _div("score_sum", "score_n").alias("avg_review_score"),
        "low_review_orders",
        (_div("low_review_orders", "orders") * 100).alias("low_review_share_pct"),
        F.col("rev_py").cast("double").alias("revenue_py"),
        (_div(F.col("rev") - F.col("rev_py"), "rev_py") * 100).alias("revenue_yoy_pct"),
        *list(extra_sums),
    )
    if names:
        out = out.select(*by, *names, *list(extra_sums))
    return out


def in_year(df: DataFrame, year: int | None) -> DataFrame:
    """A fact cut to the folders of a purchase year, if it is laid out by month; all of it otherwise."""
    if year is None or "order_month" not in df.columns:
        return df
    return df.filter(F.col("order_month").between(f"{year:04d}-01", f"{year:04d}-12"))


def order_frame(t, year: int | None = None, states: Sequence[str] | None = None) -> DataFrame:
    """fact_orders in the slicer scope, with month_label and year added."""
    fo = t.fact_orders
    if year is not None:
        # a range of the timestamp reaches the scan; the month bounds prune
        # whole folders of a star written by `warehouse.write_star`
        start = lambda y: F.lit(f"{y:04d}-01-01 00:00:00").cast("timestamp_ntz")
        fo = fo.filter((F.col("order_purchase_ts") >= start(year)) & (F.col("order_purchase_ts") < start(year + 1)))
        fo = in_year(fo, year)
    if states:
        in_states = t.dim_customer.filter(F.col("customer_state").isin(*states)).select("customer_id")
        fo = fo.join(in_states, "customer_id", "left_semi")
    return fo.withColumns({"month_label": X.month_label("order_purchase_ts"),
                           "year": F.year("order_purchase_ts")})


def measures_by_month(t, **scope) -> DataFrame:
    return measures(order_frame(t, **scope), ["month_label"], period="month_label").orderBy("month_label")


def measures_by_state(t, **scope) -> DataFrame:
    """Per customer state and purchase year (PY = same state, year before)."""
    states = t.dim_customer.select("customer_id", "customer_state")
    return measures(order_frame(t, **scope), ["customer_state", "year"], period="year",
                    customers=states).orderBy("customer_state", "year")


LEVELS = {"month_state": ("month_label", "customer_state"), "month": ("month_label",), "state": ("customer_state",),
          "all": ()}


def distinct_rollup(t, approximate: bool = False, **scope) -> DataFrame:
    """Distinct orders and customers per month and state, per month, per state and over all.

    Bitmaps of the finest groups are made once and OR-ed to those of the coarser ones
    (`operators.distinct`). Repeated orders count once. ``approximate`` takes sketches
    instead, which need no numbering of the ids.
    """
    states = t.dim_customer.select("customer_id", "customer_state")
    fo = order_frame(t, **scope).select("order_id", "customer_id", "month_label").join(states, "customer_id", "left")
    finest = LEVELS["month_state"]
    parts = {}
    for key, name, cluster in (("order_id", "orders", "month_label"), ("customer_id", "customers", "customer_state")):
        if approximate:
            part = sketches(fo, finest, key)
        else:
            part = bitmaps(fo.join(dense_ids(fo, key, "_no", [cluster]), key), finest, "_no")
        parts[name] = checkpointed(part)  # all levels are made from the finest groups
    count = sketch_counts if approximate else distinct_counts
    out = []
    for level, by in LEVELS.items():
        orders, customers = (count(parts[n], by, n) for n in ("orders", "customers"))
        both = orders.unionByName(customers, allowMissingColumns=True).groupBy(*by).agg(
            F.max("orders").alias("orders"), F.max("customers").alias("customers"))
        out.append(both.select(F.lit(level).alias("level"), *[
            (F.col(c) if c in by else F.lit(None).cast("string")).alias(c) for c in finest], "orders", "customers"))
    return reduce(DataFrame.unionByName, out)


# ------------------------------------------------------------------ 12 KPIs
def _kpi(name: str, value) -> list:
    return [F.lit(name).alias("kpi"), value.cast("double").alias("value")]


def dashboard_kpis(t, statuses: Sequence[str] = ("delivered",)) -> DataFrame:
    """The twelve headline KPIs over delivered orders, one row each (kpi, value).

    Revenue is paid value (payments of delivered orders, pre-aggregated per
    order and joined 1:1); category share uses item revenue (price +
    freight); state share uses order revenue; the payment-mix entropy is
    base 2 over each method's share of (order, method) pairs.
    """
    fo = t.fact_orders.filter(F.col("order_status").isin(*statuses))
    paid = t.fact_payments.groupBy("order_id").agg(F.sum("payment_value").alias("paid"))
    per_customer = (fo.join(paid, "order_id", "left").groupBy("customer_id").agg(
        F.count("order_id").alias("n"), F.sum("paid").alias("paid"),
        F.sum("revenue").alias("rev"), F.sum("total_items").alias("items"),
        F.sum("delivery_delay_days").alias("delay_sum"), F.count("delivery_delay_days").alias("delay_n"),
        F.sum("is_late").alias("late"),
        F.sum("review_score").alias("score_sum"), F.count("review_score").alias("score_n"),
        F.count_if(F.col("review_score") <= 2).alias("low")))
    # customers -> their state (one row per state: bounded), then one global
    # aggregate gives every order-grain KPI and the top-state share together
    states = t.dim_customer.select("customer_id", "customer_state")
    per_state = (per_customer.join(states, "customer_id", "left").groupBy("customer_state").agg(
        F.sum("paid").alias("paid"), F.sum("n").alias("orders"), F.sum("items").alias("items"),
        F.count("customer_id").alias("customers"),
        F.count_if(F.col("customer_id").isNotNull() & (F.col("n") >= 2)).alias("repeat"),
        F.sum("delay_sum").alias("delay_sum"), F.sum("delay_n").alias("delay_n"),
        F.sum("late").alias("late"), F.sum("score_sum").alias("score_sum"),
        F.sum("score_n").alias("score_n"), F.sum("low").alias("low"), F.sum("rev").alias("rev")))
    tot = per_state.agg(*[F.sum(c).alias(c) for c in (
        "paid", "orders", "items", "customers", "repeat", "delay_sum", "delay_n", "late",
        "score_sum", "score_n", "low", "rev")], F.max("rev").alias("top_rev"))
    order_kpis = tot.select(F.explode(F.array(
        F.struct(*_kpi("total_revenue", F.col("paid"))),
        F.struct(*_kpi("orders", F.col("orders"))),
        F.struct(*_kpi("avg_order_value", _div("paid", "orders"))),
        F.struct(*_kpi("avg_items_per_order", _div("items", "orders"))),
        F.struct(*_kpi("repeat_customer_rate_pct", _div("repeat", "customers") * 100)),
        F.struct(*_kpi("avg_delivery_delay_days", _div("delay_sum", "delay_n"))),
        F.struct(*_kpi("late_delivery_share_pct", _div("late", "orders") * 100)),
        F.struct(*_kpi("avg_review_score", _div("score_sum", "score_n"))),
        F.struct(*_kpi("low_review_share_pct", _div("low", "score_n") * 100)),
        F.struct(*_kpi("top_state_share_pct", _div("top_rev", "rev") * 100)),
    )).alias("k")).select("k.*")
    keys = fo.select("order_id")
    # 10: largest category's share of item revenue (items pre-aggregated per product)
    items = (t.fact_order_items.join(keys, "order_id", "left_semi")
             .groupBy("product_id").agg(F.sum(F.col("price") + F.col("freight_value")).alias("rev")))
    per_cat = (items.join(t.dim_product.select("product_id", "category_en"), "product_id", "left")
               .groupBy("category_en").agg(F.sum("rev").alias("rev")))
    top_cat = per_cat.agg(*_kpi("top_category_share_pct", _div(F.max("rev"), F.sum("rev")) * 100))
    # 12: Shannon entropy (bits) of the orders-per-method mix
    per_method = (t.fact_payments.join(keys, "order_id", "left_semi")
                  .filter(F.col("payment_type").isNotNull())
                  .select("payment_type", "order_id").distinct()
                  .groupBy("payment_type").agg(F.count(F.lit(1)).alias("n")))
    share = F.col("n") / F.sum("n").over(Window.partitionBy())  # one row per payment method
    entropy = (per_method.select(share.alias("p"))
               .agg(*_kpi("payment_mix_entropy", -F.sum(F.col("p") * F.log2("p")))))
    return order_kpis.unionByName(top_cat).unionByName(entropy)
