"""Registry: query key -> analysis function taking a `Tables`.

Each entry is a plain function call with the parameters that suit the
driver's data (for example the two years compared by ``yoy_by_category``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from marketlens.plans import eda, measures, report, shop, warehouse



def decimals_as_double(fn):
    """Star tables keep exact decimals; their registered query shows doubles."""
    def run(t):
        df = fn(t)
        return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
                           else F.col(f.name) for f in df.schema.fields])
    return run


# columns that the pivoted results over the driver's data have in any case; further values add columns
COHORT_OFFSETS = list(range(84))
SALES_YEARS = list(range(1995, 2002))
SALES_CHANNELS = ["Online", "In-store"]
SALES_CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]

# slicer of the registered sliced datasets
SLICE = {"year": 1997, "states": ("NATION_3", "NATION_7", "NATION_12")}

QUERIES: dict[str, Callable[..., DataFrame]] = {
    # --- shop SQL pack
    "monthly_revenue": shop.monthly_revenue,
    "top_products_margin": shop.top_products_margin,
    "customer_ltv": shop.customer_ltv,
    "cohort_retention": shop.cohort_retention,
    "cohort_retention_matrix": lambda t: shop.cohort_retention_matrix(t, expected=COHORT_OFFSETS),
    "rfm_segments": shop.rfm_segments,
    "rfm_segments_high_is_best": lambda t: shop.rfm_segments(t, high_is_best=True),
    "rfm_segment_counts": shop.rfm_segment_counts,
    "first_vs_repeat": shop.first_vs_repeat,
    "yoy_by_category": lambda t: shop.yoy_by_category(t, 1997, 1998),
    "yoy_by_category_zero_filled": lambda t: shop.yoy_by_category(t, 1992, 2002, missing_as_zero=True),
    "orders_without_payment": shop.orders_without_payment,
    "daily_running_revenue": shop.daily_running_revenue,
    "daily_running_revenue_calendar": lambda t: shop.daily_running_revenue(t, calendar=True),
    "order_totals_in_range": lambda t: shop.order_totals_in_range(t, "1998-01-01", "1998-06-30"),
    # --- sales EDA
    "sales_calendar": eda.sales_calendar,
    "sales_quality": eda.sales_quality,
    "sales_describe": eda.sales_describe,
    "category_summary": eda.category_summary,
    "sales_kpis": lambda t: eda.sales_kpis(t, focus_category="PROMO"),
    "monthly_trend": eda.monthly_trend,
    "revenue_by_category": eda.revenue_by_category,
    "seasonality_matrix": lambda t: eda.seasonality_matrix(t, expected=SALES_YEARS),
    "channel_by_month": lambda t: eda.channel_by_month(t, expected=SALES_CHANNELS),
    "revenue_distribution": eda.revenue_distribution,
    "region_by_category": lambda t: eda.region_by_category(t, expected=SALES_CATEGORIES),
    # --- warehouse ETL
    "dim_date": warehouse.dim_date,
    "customer_cohort": warehouse.customer_cohort,
    "dim_customer": warehouse.dim_customer,
    "dim_product": warehouse.dim_product,
    "dim_seller": warehouse.dim_seller,
    "fact_orders": decimals_as_double(warehouse.fact_orders),
    "fact_order_items": decimals_as_double(warehouse.fact_order_items),
    "fact_payments": decimals_as_double(warehouse.fact_payments),
    "warehouse_row_counts": warehouse.warehouse_row_counts,
    "integrity_report": warehouse.integrity_report,
    "shop_integrity_report": lambda t: warehouse.integrity_report(t, warehouse.SHOP_INTEGRITY_RULES),
    "warehouse_kpis": warehouse.warehouse_kpis,
    "warehouse_kpis_by_person": lambda t: warehouse.warehouse_kpis(t, customer_key="customer_unique_id"),
    "warehouse_cohort_retention": warehouse.warehouse_cohort_retention,
    # --- KPIs and measures
    "dashboard_kpis": measures.dashboard_kpis,
    "measures_by_month": measures.measures_by_month,
    "measures_by_state": measures.measures_by_state,
    "distinct_rollup": measures.distinct_rollup,
    # --- report datasets
    "kpi_cards": report.kpi_cards,
    "monthly_revenue_rolling": report.monthly_revenue_rolling,
    "top_categories": report.top_categories,
    "top_categories_sliced": lambda t: report.top_categories(t, n=None, categories=("promo", "economy", "small"), **SLICE),
    "revenue_by_state": report.revenue_by_state,
    "order_status_mix": report.order_status_mix,
    "cohort_matrix_18": report.cohort_matrix_18,
    "new_vs_returning": report.new_vs_returning,
    "orders_per_customer": report.orders_per_customer,
    "top_customers": report.top_customers,
    "category_pareto": report.category_pareto,
    "avg_ticket_by_category": report.avg_ticket_by_category,
    "category_quality": report.category_quality,
    "top_products": report.top_products,
    "delay_by_state": report.delay_by_state,
    "late_share_by_state": report.late_share_by_state,
    "review_distribution": report.review_distribution,
    "late_vs_ontime_review": report.late_vs_ontime_review,
    "top_routes": report.top_routes,
    "payment_method_share": report.payment_method_share,
    "payment_method_share_sliced": lambda t: report.payment_method_share(t, **SLICE),
    "installments_distribution": report.installments_distribution,
    "aov_by_payment_method": report.aov_by_payment_method,
    "payment_method_by_month": report.payment_method_by_month,
    "top_sellers": report.top_sellers,
}
