"""Invariants of the star layer and the reports on the driver's sf0.01 tables."""

import os

import pytest
from pyspark.sql import functions as F

from marketlens.plans import report, shop, warehouse
from marketlens.sources.tables import Tables

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def t(spark):
    return Tables.from_testdata(spark, SF)


def test_fact_orders_has_one_row_per_order(t):
    fo = warehouse.fact_orders(t)
    assert fo.count() == t.raw_orders.count() == fo.select("order_id").distinct().count()


def test_category_revenue_adds_up_to_item_revenue(t):
    cats = report.top_categories(t, n=None).agg(F.sum("revenue")).first()[0]
    items = t.fact_order_items.agg(F.sum(F.col("price") + F.col("freight_value"))).first()[0]
    assert abs(cats - float(items)) < 1e-6 * float(items)


def test_retention_is_a_percentage(t):
    r = shop.cohort_retention(t).agg(F.min("retention_pct"), F.max("retention_pct")).first()
    assert 0 < r[0] and r[1] <= 100
    w = warehouse.warehouse_cohort_retention(t).agg(F.max("pct")).first()[0]
    assert w <= 100


def test_every_completed_order_with_items_is_numbered_once(t):
    seq = shop.first_vs_repeat(t)
    completed = t.orders.filter(F.col("status") == "completed").count()
    assert seq.count() == completed
    firsts = seq.filter(F.col("order_rank") == 1).count()
    assert firsts == seq.select("customer_id").distinct().count()


def test_integrity_report_flags_the_repeated_item_keys(t):
    r = {(x.table_name, x.rule): x.violations for x in warehouse.integrity_report(t).collect()}
    assert r[("raw_order_items", "pk")] == 60000 - 45832
    assert r[("raw_orders", "pk")] == 0 and r[("fact_orders", "pk")] == 0
