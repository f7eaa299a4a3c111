"""Exploratory analysis of flat sales transactions.

Input: ``t.sales`` (date, category, region, channel, unit_price, quantity,
revenue). Rows whose group key is null take no part in a grouped result, as in
pandas. Rounding follows pandas (half to even, ``bround``); money sums
are exact decimals. Every grouped result is aggregated first and only the
small aggregate meets a window, a pivot or a grand total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions import expr as X
from marketlens.operators import quantiles as Q
from marketlens.operators.pivot import pivot
from marketlens.operators.selection import small

# fixed values: Q4 months, as the analysis names them
Q4_MONTHS = (10, 11, 12)
DESCRIBE_COLUMNS = ("unit_price", "quantity", "revenue")


def sales_calendar(t) -> DataFrame:
    """Sales rows with year, month, quarter and 'yyyy-MM' label."""
    s = t.sales
    return s.select(
        "date", "category", "region", "channel", "unit_price", "quantity",
        F.col("revenue").cast("double").alias("revenue"),
        F.year("date").alias("year"), F.month("date").alias("month"),
        F.quarter("date").alias("quarter"), X.month_label("date").alias("month_label"),
    )


def sales_quality(t) -> DataFrame:
    """Per column: declared type and null count; with row count, column
    count and date range of the table. One scan, one aggregate row, then
    unpivoted to one row per column."""
    s = t.sales
    cols = s.columns
    row = s.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.to_date(F.min("date")).alias("min_date"), F.to_date(F.max("date")).alias("max_date"),
        *[F.sum(F.col(c).isNull().cast("long")).alias(f"nulls_{i}") for i, c in enumerate(cols)],
    )
    per_col = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 F.lit(s.schema[c].dataType.simpleString()).alias("data_type"),
                 F.coalesce(F.col(f"nulls_{i}"), F.lit(0)).alias("null_count"))
        for i, c in enumerate(cols)]))
    return (row.select(per_col.alias("c"), "row_count", "min_date", "max_date")
               .select("c.column_name", "c.data_type", "c.null_count", "row_count",
                       F.lit(len(cols)).alias("column_count"), "min_date", "max_date"))


def sales_describe(t) -> DataFrame:
    """count, mean, std, min, quartiles, max of the numeric columns, rounded
    to 2 decimals (half to even). Quartiles are exact and distributed.

    Moments and extremes ride along with the first scan of the quartiles (the
    standard deviation from Spark's merging of centred moments).
    """
    s = t.sales
    long = s.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in DESCRIBE_COLUMNS])))
    found = Q.quantiles(long, "value", [0.25, 0.5, 0.75], ["q25", "q50", "q75"], by=["column_name"], also=[
        f("value").alias(n) for n, f in (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp),
                                         ("min", F.min), ("max", F.max))])
    r = lambda c: F.bround(c, 2).alias(c)
    # a table without rows still has its columns
    names = s.sparkSession.createDataFrame([(c,) for c in DESCRIBE_COLUMNS], "column_name string")
    return (names.join(found, "column_name", "left")
            .select("column_name", F.coalesce("count", F.lit(0)).alias("count"),
                    *map(r, ("mean", "std", "min", "q25", "q50", "q75", "max")))
            .orderBy("column_name"))


def _by_category(t) -> DataFrame:
    return (t.sales.where(F.col("category").isNotNull()).groupBy("category")
            .agg(F.sum("revenue").alias("rev"), F.count("revenue").alias("n")))


def category_summary(t) -> DataFrame:
    """Revenue (whole units), transactions, average ticket and share per category."""
    per = _by_category(t)
    total = F.sum("rev").over(Window.partitionBy())  # over the per-category aggregate only
    return (per.select(
        "category",
        F.bround("rev", 0).cast("double").alias("revenue"),
        F.col("n").alias("transactions"),
        F.bround(F.col("rev") / F.col("n"), 2).cast("double").alias("avg_ticket"),
        F.bround(F.lit(100) * F.col("rev") / total, 1).cast("double").alias("share_pct"),
    ).orderBy(F.col("revenue").desc(), "category"))


def sales_kpis(t, focus_category: str = "Electronics") -> DataFrame:
    """Headline numbers in one pass of conditional aggregates."""
    s = t.sales
    rev = F.col("revenue")
    total = F.sum(rev)
    share = lambda part: F.lit(100.0) * part.cast("double") / total.cast("double")
    zero = F.lit(0).cast("decimal(12,2)")
    return s.agg(
        total.cast("double").alias("total_revenue"),
        F.count(F.lit(1)).alias("transactions"),
        X.mean(rev).alias("avg_ticket"),
        share(F.sum(F.when(F.month("date").isin(*Q4_MONTHS), rev).otherwise(zero))).alias("q4_share_pct"),
        share(F.sum(F.when(F.col("channel") == "Online", rev).otherwise(zero))).alias("online_share_pct"),
        F.lit(focus_category).alias("focus_category"),
        share(F.sum(F.when(F.col("category") == focus_category, rev).otherwise(zero))).alias("focus_share_pct"),
    )


def monthly_trend(t) -> DataFrame:
    """Revenue per month and its 3-month rolling mean (partial at the start)."""
    per = (t.sales.where(F.col("date").isNotNull()).groupBy(X.month_label("date").alias("month_label"))
           .agg(F.sum("revenue").alias("rev")))
    w = Window.orderBy("month_label").rowsBetween(-2, 0)  # per-month series: small
    return (per.select(
        "month_label",
        F.col("rev").cast("double").alias("revenue"),
        (F.sum("rev").over(w).cast("double") / F.count("rev").over(w)).alias("rolling_avg"),
    ).orderBy("month_label"))


def revenue_by_category(t) -> DataFrame:
    per = _by_category(t)
    total = F.sum("rev").over(Window.partitionBy())
    return (per.select(
        "category", F.col("rev").cast("double").alias("revenue"),
        (F.lit(100.0) * F.col("rev").cast("double") / total.cast("double")).alias("share_pct"),
    ).orderBy(F.col("revenue").desc(), "category"))


def seasonality_matrix(t, years=None, expected=()) -> DataFrame:
    """Calendar month (Jan..Dec) x one column per year, revenue summed.

    ``years`` declares the columns, ``expected`` are there in any case (`pivot`)."""
    per = (t.sales.where(F.col("date").isNotNull())
           .groupBy(F.month("date").alias("month"), F.year("date").alias("year"))
           .agg(F.sum("revenue").cast("double").alias("revenue")))
    wide = pivot(per, "month", "year", F.first("revenue"), years, expected)
    return (wide.withColumn("month_name", F.date_format(F.make_date(F.lit(2000), F.col("month"), F.lit(1)), "MMM"))
                .orderBy("month"))


def channel_by_month(t, channels=None, expected=()) -> DataFrame:
    """Month x channel revenue; ``channels`` and ``expected`` as in `pivot`."""
    per = (t.sales.where(F.col("date").isNotNull())
           .groupBy(X.month_label("date").alias("month_label"), "channel")
           .agg(F.sum("revenue").cast("double").alias("revenue")))
    return pivot(per, "month_label", "channel", F.first("revenue"), channels, expected).orderBy("month_label")


def revenue_distribution(t) -> DataFrame:
    """Box-plot statistics per category (whiskers at 1.5 IQR), by median desc.

    Quartiles are exact; whiskers are the most extreme values inside the
    fences and outliers count the rows beyond them, in one more scan.
    """
    s = t.sales.where(F.col("category").isNotNull()).select("category", F.col("revenue").cast("double").alias("value"))
    quarts = Q.quantiles(s, "value", [0.25, 0.5, 0.75], ["q1", "median", "q3"], by=["category"], digits=4, also=[
        F.count("value").alias("count"), F.min("value").alias("min"), F.max("value").alias("max")])
    iqr = F.col("q3") - F.col("q1")
    box, _ = small(quarts.where(F.col("count") > 0).select(
        "*", (F.col("q1") - F.lit(1.5) * iqr).alias("lo_fence"), (F.col("q3") + F.lit(1.5) * iqr).alias("hi_fence")))
    inside = F.col("value").between(F.col("lo_fence"), F.col("hi_fence"))
    stats = (s.join(box.select("category", "lo_fence", "hi_fence"), "category").groupBy("category")
             .agg(F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
                  F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
                  F.count_if(~inside).alias("outliers")))
    return (stats.join(box, "category")
            .select("category", "count", "min", "q1", "median", "q3", "max", "whisker_low", "whisker_high", "outliers")
            .orderBy(F.col("median").desc(), "category"))


def region_by_category(t, categories=None, expected=()) -> DataFrame:
    """Region x category revenue, missing cells 0, regions by total desc.

    ``categories`` declares the columns, ``expected`` are there in any case (`pivot`)."""
    per = (t.sales.where(F.col("region").isNotNull()).groupBy("region", "category")
           .agg(F.sum("revenue").cast("double").alias("revenue")))
    wide = pivot(per, "region", "category", F.first("revenue"), categories, expected).fillna(0.0)
    cats = [c for c in wide.columns if c != "region"]
    total = sum((F.col(f"`{c}`") for c in cats), F.lit(0.0))
    return wide.withColumn("_total", total).orderBy(F.col("_total").desc(), "region").drop("_total")
