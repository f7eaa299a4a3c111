"""Shop SQL pack: ten business analyses over customers, products, orders,
order items and payments.

Every function takes a `Tables` and returns a DataFrame. Money is summed
as exact decimals and leaves as double after rounding. Line revenue is the
``line_revenue`` column (quantity x unit price; readers add it).

Plan notes that hold for all of them:
  * order items are aggregated to order or product grain *before* they meet
    a dimension, so joins carry one row per key instead of one per line;
  * the completed-order filter is a semi join on ``order_id`` (status is
    not needed downstream), and a "left join ... is null" is written as an
    anti join;
  * rankings without PARTITION BY use `operators.ranking` (no single
    partition), windows over per-day/per-month aggregates stay plain.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions import expr as X
from marketlens.operators import ranking
from marketlens.operators.pivot import pivot
from marketlens.operators.selection import checkpointed, with_ntiles

COMPLETED = "completed"


def _completed_orders(t) -> DataFrame:
    return t.orders.filter(F.col("status") == COMPLETED)


def _order_totals(t) -> DataFrame:
    """Order grain: one row per order that has items (partial aggregation)."""
    return (t.order_items.groupBy("order_id")
            .agg(F.sum("line_revenue").alias("order_revenue"),
                 F.count(F.lit(1)).alias("order_lines")))


def monthly_revenue(t) -> DataFrame:
    """Completed orders by payment month: orders, revenue, mean *line* value.

    The average is over order lines, not orders, as in the original query. Lines are
    rolled up per order before they meet the payments; an order with several
    payments counts in each payment's month, its lines once for each payment.
    """
    completed = _completed_orders(t).select("order_id")
    totals = t.order_items.groupBy("order_id").agg(
        F.sum("line_revenue").alias("total"), F.count("line_revenue").alias("lines"))
    paid = (t.payments.join(completed, "order_id", "left_semi")
            .groupBy("order_id", X.month_start("payment_date").alias("month"))
            .agg(F.count(F.lit(1)).alias("times")))
    each = lambda c: F.sum(F.col(c) * F.col("times"))
    return (paid.join(totals, "order_id").groupBy("month")  # one row per order and month
            .agg(F.count(F.lit(1)).alias("total_orders"),
                 X.money(each("total")).alias("gross_revenue"),
                 X.money_mean(each("total"), each("lines")).alias("avg_order_value"))
            .orderBy("month"))


def top_products_margin(t, n: int | None = 10) -> DataFrame:
    """Top-n products by gross margin (revenue minus quantity x cost)."""
    completed = _completed_orders(t).select("order_id")
    per_product = (t.order_items.join(completed, "order_id", "left_semi")
                   .groupBy("product_id")
                   .agg(F.sum("quantity").alias("units_sold"),
                        F.sum("line_revenue").alias("revenue")))
    p = t.products.select("product_id", F.col("name").alias("product_name"), "category", "cost_price")
    j = per_product.join(p, "product_id")
    cost = F.col("units_sold") * F.col("cost_price")
    margin = F.col("revenue") - cost
    out = j.select(
        "product_id", "product_name", "category",
        F.col("units_sold").cast("long").alias("units_sold"),
        X.money("revenue").alias("total_revenue"),
        X.money(cost).alias("total_cost"),
        X.money(margin).alias("gross_margin"),
        F.round(X.safe_div(F.lit(100) * margin, F.col("revenue")), 1).cast("double").alias("margin_pct"),
    ).orderBy(F.col("gross_margin").desc(), "product_id")
    return out.limit(n) if n else out


def _customer_spend(t) -> DataFrame:
    """Completed orders with items, rolled up per customer."""
    orders = _completed_orders(t).select("order_id", "customer_id", "order_date")
    per_order = orders.join(_order_totals(t), "order_id")
    return (per_order.groupBy("customer_id")
            .agg(F.count(F.lit(1)).alias("total_orders"),
                 F.sum("order_revenue").alias("spend"),
                 F.min("order_date").alias("first_order"),
                 F.max("order_date").alias("last_order")))


def customer_ltv(t) -> DataFrame:
    """Spend per customer, ranked by the rounded lifetime value (RANK, ties share)."""
    spend = _customer_spend(t).withColumn("lifetime_value", F.round("spend", 2)).drop("spend")
    known = spend.join(t.customers.select("customer_id"), "customer_id", "left_semi")
    ranked = ranking.with_global_rank(known, value=[("lifetime_value", False)],
                                      tiebreak=[("customer_id", True)], name="ltv_rank")
    named = ranked.join(t.customers.select("customer_id", "name", "city", "signup_date"), "customer_id")
    return (named.select(
        "customer_id", "name", "city", "signup_date", "total_orders",
        F.col("lifetime_value").cast("double").alias("lifetime_value"),
        "first_order", "last_order", "ltv_rank",
        X.money_mean("lifetime_value", "total_orders").alias("avg_order_value"),
    ).orderBy("ltv_rank", "customer_id"))


def _cohort_activity(t) -> DataFrame:
    """(customer, cohort month, active month) for completed orders, deduplicated;
    ``first`` marks each customer's first active month."""
    active = (_completed_orders(t)
              .select("customer_id", X.month_start("order_date").alias("order_month"))
              .distinct())
    c = t.customers.select("customer_id", X.month_start("signup_date").alias("cohort_month"))
    earliest = F.min("order_month").over(Window.partitionBy("customer_id"))  # a customer's months: few
    return active.join(c, "customer_id").withColumn("first", F.col("order_month") == earliest)


def cohort_retention(t, denominator: str = "active") -> DataFrame:
    """Signup-month cohorts x months since signup -> active customers and %.

    ``denominator="active"`` (default) sizes a cohort by its customers with
    at least one completed order, counted by their first active month in the
    same aggregate as the cells; ``"all_signups"`` by every signup.
    """
    cells = _cohort_activity(t).groupBy("cohort_month", "order_month").agg(
        F.count(F.lit(1)).alias("active_customers"), F.count_if("first").alias("starters"))
    if denominator == "all_signups":
        sizes = (t.customers.groupBy(X.month_start("signup_date").alias("cohort_month"))
                 .agg(F.count_distinct("customer_id").alias("cohort_size")))
        sized = cells.join(F.broadcast(sizes), "cohort_month")  # one row per cohort month: bounded by the calendar
    else:
        sized = cells.withColumn("cohort_size", F.sum("starters").over(Window.partitionBy("cohort_month")))
    return (sized.select("cohort_month",
                         X.month_diff("order_month", "cohort_month").alias("months_since_signup"),
                         "active_customers", "cohort_size",
                         X.pct("active_customers", "cohort_size", 1).alias("retention_pct"))
            .orderBy("cohort_month", "months_since_signup"))


def cohort_retention_matrix(t, max_months: int | None = None, offsets=None, expected=()) -> DataFrame:
    """Cohorts as rows, months since signup as columns, retention % as cells.

    ``max_months`` keeps the offsets up to it; ``offsets`` declares the columns and
    ``expected`` are there in any case (`pivot`).
    """
    long = cohort_retention(t)
    if max_months is not None:
        long = long.filter(F.col("months_since_signup") <= max_months)
    return pivot(long, "cohort_month", "months_since_signup", F.first("retention_pct"), offsets, expected).orderBy("cohort_month")


def rfm_segments(t, high_is_best: bool = False) -> DataFrame:
    """Recency / frequency / monetary tertiles and five segments.

    With ``high_is_best=False`` the tertiles number from the most recent /
    most frequent / biggest spender down (1 = best), exactly as the original
    query executes; ``True`` flips them so 3 is best, as its comments intend.
    Ties: recency by customer id; frequency by monetary then customer id;
    monetary by customer id.
    """
    orders = _completed_orders(t).select("order_id", "customer_id", "order_date")
    per_order = orders.join(_order_totals(t), "order_id")
    raw = (per_order.groupBy("customer_id")
           .agg(F.max("order_date").alias("last_order_date"),
                F.count(F.lit(1)).alias("frequency"),
                F.sum("order_revenue").alias("monetary")))
    # one narrow row per customer, read again for each key of the cuts
    raw = checkpointed(raw.join(t.customers.select("customer_id"), "customer_id", "left_semi"))
    asc = high_is_best
    scored = with_ntiles(raw, {
        "r_score": [("last_order_date", asc), ("customer_id", True)],
        "f_score": [("frequency", asc), ("monetary", asc), ("customer_id", True)],
        "m_score": [("monetary", asc), ("customer_id", True)]}, 3)
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    fm = F.col("f_score") + F.col("m_score")
    # fixed values: thresholds and labels
    segment = (F.when(total >= 8, "Champions")
                .when(total >= 6, "Loyal Customers")
                .when((F.col("r_score") == 3) & (fm <= 3), "New Customers")
                .when((F.col("r_score") <= 2) & (F.col("f_score") >= 2), "At Risk")
                .otherwise("Need Attention"))
    named = scored.join(t.customers.select("customer_id", "name"), "customer_id")
    return (named.select(
        "customer_id", "name", "last_order_date", "frequency",
        X.money("monetary").alias("monetary"),
        "r_score", "f_score", "m_score",
        total.cast("int").alias("rfm_total"),
        segment.alias("segment"),
    ).orderBy(F.col("rfm_total").desc(), "customer_id"))


def rfm_segment_counts(t, **kw) -> DataFrame:
    return (rfm_segments(t, **kw).groupBy("segment")
            .agg(F.count(F.lit(1)).alias("customers"))
            .orderBy(F.col("customers").desc(), "segment"))


def first_vs_repeat(t) -> DataFrame:
    """Every completed order numbered per customer, with the previous order date.

    Two orders of one customer on one day are ordered by order id.
    """
    orders = (_completed_orders(t).select("order_id", "customer_id", "order_date")
              .join(t.customers.select("customer_id", "name"), "customer_id"))
    seq = ranking.with_group_sequence(
        orders, group=["customer_id"], order=[("order_date", True), ("order_id", True)],
        number_name="order_rank", lags={"order_date": "previous_order_date"})
    return seq.select(
        "order_id", "customer_id", "name", "order_date", "order_rank",
        F.when(F.col("order_rank") == 1, "First Purchase").otherwise("Repeat Purchase").alias("purchase_type"),
        "previous_order_date",
        F.datediff("order_date", "previous_order_date").alias("days_since_last_order"),
    ).orderBy("customer_id", "order_rank")


def yoy_by_category(t, year0: int = 1997, year1: int = 1998, missing_as_zero: bool = False) -> DataFrame:
    """Revenue of two years per category, one pass with conditional sums.

    A category with no sale in a year shows null (``missing_as_zero=True``
    gives 0 and a -100 % growth instead).
    """
    orders = (_completed_orders(t)
              .select("order_id", F.year("order_date").alias("yr")))
    zero = F.lit(0) if missing_as_zero else F.lit(None)
    per_product = (t.order_items.select("order_id", "product_id", "line_revenue")
                   .join(orders, "order_id")
                   .groupBy("product_id")
                   .agg(F.sum(F.when(F.col("yr") == year0, F.col("line_revenue")).otherwise(zero)).alias("r0"),
                        F.sum(F.when(F.col("yr") == year1, F.col("line_revenue")).otherwise(zero)).alias("r1")))
    per_cat = (per_product.join(t.products.select("product_id", "category"), "product_id")
               .groupBy("category").agg(F.sum("r0").alias("r0"), F.sum("r1").alias("r1")))
    growth = F.round(X.safe_div(F.lit(100) * (F.col("r1") - F.col("r0")), F.col("r0")), 1)
    return (per_cat.select(
        "category",
        X.money("r0").alias(f"revenue_{year0}"),
        X.money("r1").alias(f"revenue_{year1}"),
        growth.cast("double").alias("yoy_growth_pct"),
    ).orderBy(F.col(f"revenue_{year1}").desc_nulls_last(), "category"))


def orders_without_payment(t, excluded=("cancelled", "refunded")) -> DataFrame:
    """Active orders with no payment row, with their item total.

    ``NOT IN`` drops a null status as SQL does; orders without items drop
    out through the inner join to the item totals.
    """
    active = t.orders.filter(~F.col("status").isin(*excluded))
    unpaid = active.join(t.payments.select("order_id"), "order_id", "left_anti")
    return (unpaid.join(_order_totals(t), "order_id")
            .join(t.customers.select("customer_id", F.col("name").alias("customer_name")), "customer_id")
            .select("order_id", "customer_id", "customer_name", "order_date", "status",
                    F.col("order_revenue").cast("double").alias("order_total"))
            .orderBy("order_date", "order_id"))


def daily_running_revenue(t, calendar: bool = False) -> DataFrame:
    """Payment-day revenue, running total and a 7-step moving mean.

    The series is one row per payment day (bounded by the calendar), so the
    ordered windows run on that small aggregate. ``calendar=True`` makes the
    moving mean span 7 calendar days instead of 7 rows.
    """
    completed = _completed_orders(t).select("order_id")
    daily = (t.payments.join(completed, "order_id", "left_semi")
             .groupBy(F.col("payment_date").alias("day"))
             .agg(F.sum("amount").alias("daily_revenue")))
    running = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if calendar:
        moving = (Window.orderBy(F.unix_date("day")).rangeBetween(-6, Window.currentRow))
    else:
        moving = Window.orderBy("day").rowsBetween(-6, Window.currentRow)
    return (daily.select(
        "day",
        X.money("daily_revenue").alias("daily_revenue"),
        X.money(F.sum("daily_revenue").over(running)).alias("running_total"),
        X.money_mean(F.sum("daily_revenue").over(moving), F.count("daily_revenue").over(moving)).alias("rolling_7day_avg"),
    ).orderBy("day"))


def order_totals_in_range(t, start: str | dt.date = "1998-01-01", end: str | dt.date = "1998-06-30") -> DataFrame:
    """Completed orders placed between two dates (inclusive), largest first.

    On an orders table written partitioned by ``order_month`` the month
    bounds are added too, so the scan prunes partitions as well as row
    groups (a date predicate alone does not prune a derived partition).
    """
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    orders = t.orders
    cond = (F.col("status") == COMPLETED) & F.col("order_date").between(lo, hi)
    if "order_month" in orders.columns:
        cond = cond & F.col("order_month").between(F.date_format(lo, "yyyy-MM"), F.date_format(hi, "yyyy-MM"))
    picked = orders.filter(cond).select("order_id", "customer_id", "order_date")
    return (picked.join(_order_totals(t), "order_id")
            .join(t.customers.select("customer_id", "name"), "customer_id")
            .select("order_id", "order_date", "name", F.col("order_revenue").cast("double").alias("order_total"))
            .orderBy(F.col("order_total").desc(), "order_id"))
