"""Shop SQL pack on a small hand-written fixture with planted cases.

Cases: completed orders without payment; cancelled and refunded orders
without payment (excluded); a customer with four orders over two years;
a category with no sale in the second year; two orders of one customer on
one day; a two-line order whose line average ends in 5 at the third
decimal; payment days weeks apart; a payment that differs from its items.
"""

import datetime as dt
import os

import pytest

from marketlens.plans import shop
from marketlens.sources.tables import Tables

CSV = {
    "customers": """customer_id,name,city,signup_date
1,Vera,Girona,2022-01-10
2,Ole,Lleida,2022-03-01
3,Ines,Tarragona,2022-02-15
4,Tomas,Reus,2023-01-01
""",
    "products": """product_id,name,category,cost_price
10,Laptop,Electronics,500.00
11,Desk,Furniture,100.00
12,Pen,Stationery,1.00
""",
    "orders": """order_id,customer_id,order_date,status
100,1,2022-01-15,completed
101,1,2022-06-10,completed
102,1,2023-01-20,completed
103,1,2023-02-25,completed
104,2,2022-03-05,completed
105,2,2022-03-05,completed
106,3,2022-04-01,cancelled
107,3,2022-04-02,refunded
108,3,2022-04-03,pending
""",
    "order_items": """item_id,order_id,product_id,quantity,unit_price
1,100,10,1,640.00
2,100,12,2,0.50
3,101,11,1,31.45
4,101,12,1,31.44
5,102,10,1,700.00
6,103,11,2,150.00
7,104,12,10,1.00
8,105,11,1,120.00
9,106,12,1,2.00
10,107,12,1,3.00
11,108,11,1,130.00
""",
    "payments": """payment_id,order_id,amount,payment_date,method
1,100,641.00,2022-01-15,card
2,101,62.89,2022-06-20,paypal
3,102,351.00,2023-01-20,card
4,103,300.00,2023-03-01,transfer
5,105,120.00,2022-03-05,card
""",
}


@pytest.fixture(scope="module")
def t(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("shop")
    for name, text in CSV.items():
        (folder / f"{name}.csv").write_text(text)
    return Tables.from_shop_csv(spark, str(folder))


def rows(df, key=None):
    out = [r.asDict() for r in df.collect()]
    return {r[key]: r for r in out} if key else out


def test_monthly_revenue_line_average_rounds_half_up(t):
    r = rows(shop.monthly_revenue(t), "month")
    assert set(r) == {dt.date(2022, 1, 1), dt.date(2022, 3, 1), dt.date(2022, 6, 1),
                      dt.date(2023, 1, 1), dt.date(2023, 3, 1)}
    june = r[dt.date(2022, 6, 1)]
    assert (june["total_orders"], june["gross_revenue"], june["avg_order_value"]) == (1, 62.89, 31.45)
    assert r[dt.date(2022, 1, 1)]["avg_order_value"] == 320.5  # two lines, one order


def test_orders_without_payment_uses_anti_join_and_not_in(t):
    r = rows(shop.orders_without_payment(t), "order_id")
    assert set(r) == {104, 108}
    assert r[104]["order_total"] == 10.0 and r[108]["status"] == "pending"


def test_yoy_missing_year_is_null_or_zero(t):
    r = rows(shop.yoy_by_category(t, 2022, 2023), "category")
    assert r["Electronics"]["yoy_growth_pct"] == 9.4
    assert r["Furniture"]["revenue_2022"] == 151.45 and r["Furniture"]["yoy_growth_pct"] == 98.1
    assert r["Stationery"]["revenue_2023"] is None and r["Stationery"]["yoy_growth_pct"] is None
    z = rows(shop.yoy_by_category(t, 2022, 2023, missing_as_zero=True), "category")
    assert z["Stationery"]["revenue_2023"] == 0.0 and z["Stationery"]["yoy_growth_pct"] == -100.0


def test_first_vs_repeat_same_day_tie_and_gaps(t):
    r = rows(shop.first_vs_repeat(t), "order_id")
    assert [r[o]["order_rank"] for o in (100, 101, 102, 103)] == [1, 2, 3, 4]
    assert [r[o]["days_since_last_order"] for o in (100, 101, 102, 103)] == [None, 146, 224, 36]
    assert r[104]["purchase_type"] == "First Purchase" and r[105]["order_rank"] == 2
    assert r[105]["days_since_last_order"] == 0
    assert 106 not in r


def test_daily_running_rows_vs_calendar(t):
    r = rows(shop.daily_running_revenue(t), "day")
    assert r[dt.date(2023, 3, 1)]["running_total"] == 1474.89
    assert r[dt.date(2022, 6, 20)]["rolling_7day_avg"] == 274.63
    cal = rows(shop.daily_running_revenue(t, calendar=True), "day")
    assert cal[dt.date(2022, 6, 20)]["rolling_7day_avg"] == 62.89  # nothing else within 7 days


def test_customer_ltv_rank_and_average(t):
    r = rows(shop.customer_ltv(t), "customer_id")
    assert r[1]["lifetime_value"] == 1703.89 and r[1]["ltv_rank"] == 1
    assert r[1]["avg_order_value"] == 425.97 and r[1]["total_orders"] == 4
    assert r[2]["ltv_rank"] == 2 and r[2]["avg_order_value"] == 65.0
    assert set(r) == {1, 2}


def test_cohort_retention_counts_years_in_months(t):
    r = rows(shop.cohort_retention(t))
    ana = sorted(x["months_since_signup"] for x in r if x["cohort_month"] == dt.date(2022, 1, 1))
    assert ana == [0, 5, 12, 13]
    assert all(x["retention_pct"] == 100.0 for x in r)


def test_rfm_reproduces_executed_direction(t):
    r = rows(shop.rfm_segments(t), "customer_id")
    assert (r[1]["r_score"], r[1]["f_score"], r[1]["m_score"], r[1]["segment"]) == (1, 1, 1, "Need Attention")
    assert (r[2]["rfm_total"], r[2]["segment"]) == (6, "Loyal Customers")
    flipped = rows(shop.rfm_segments(t, high_is_best=True), "customer_id")
    assert flipped[1]["rfm_total"] == 6


def test_top_products_margin(t):
    r = rows(shop.top_products_margin(t))
    assert [x["product_id"] for x in r] == [10, 11, 12]
    assert (r[0]["gross_margin"], r[0]["margin_pct"]) == (340.0, 25.4)
    assert (r[2]["units_sold"], r[2]["margin_pct"]) == (13, 69.4)  # 29.44 / 42.44


def test_order_totals_in_range_prunes_month_partitions(spark, t, tmp_dir):
    from pyspark.sql import functions as F
    path = os.path.join(tmp_dir, "orders_by_month")
    (t.orders.withColumn("order_month", F.date_format("order_date", "yyyy-MM"))
     .write.partitionBy("order_month").parquet(path))
    t2 = Tables(spark, {"orders": lambda: spark.read.parquet(path),
                        "order_items": lambda: t.order_items, "customers": lambda: t.customers})
    df = shop.order_totals_in_range(t2, "2022-03-01", "2022-06-30")
    assert [r.order_id for r in df.collect()] == [105, 101, 104]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan
    assert "PushedFilters" in plan and "order_date" in plan


def test_shop_integrity_rules(t):
    from marketlens.plans.warehouse import SHOP_INTEGRITY_RULES, integrity_report
    r = {(x.table_name, x.rule): x.violations for x in integrity_report(t, SHOP_INTEGRITY_RULES).collect()}
    assert len(r) == len(SHOP_INTEGRITY_RULES) and all(v == 0 for v in r.values())


def test_save_results_writes_csv(spark, t, tmp_dir):
    from marketlens.sources.sinks import save_results
    save_results(t, {"monthly_revenue": shop.monthly_revenue}, tmp_dir)
    back = spark.read.option("header", True).csv(os.path.join(tmp_dir, "monthly_revenue"))
    assert back.count() == 5
