"""Fixed schemas of every table the analyses read or write.

Three source families (shop, sales, marketplace raw) and the star layer the
warehouse ETL produces. Readers always pass these; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType, DecimalType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampNTZType,
)

MONEY = DecimalType(12, 2)


def _s(*fields: tuple) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


# --- shop schema (a relational shop: customers, products, orders, items, payments)
SHOP = {
    "customers": _s(("customer_id", LongType(), False), ("name", StringType(), False),
                    ("city", StringType(), True), ("signup_date", DateType(), False)),
    "products": _s(("product_id", LongType(), False), ("name", StringType(), False),
                   ("category", StringType(), True), ("cost_price", MONEY, False)),
    "orders": _s(("order_id", LongType(), False), ("customer_id", LongType(), False),
                 ("order_date", DateType(), False), ("status", StringType(), False)),
    "order_items": _s(("item_id", LongType(), False), ("order_id", LongType(), False),
                      ("product_id", LongType(), False), ("quantity", IntegerType(), False),
                      ("unit_price", MONEY, False)),
    "payments": _s(("payment_id", LongType(), False), ("order_id", LongType(), False),
                   ("amount", MONEY, False), ("payment_date", DateType(), False),
                   ("method", StringType(), True)),
}

# --- flat sales transactions
SALES = _s(("date", TimestampNTZType(), False), ("category", StringType(), False),
           ("region", StringType(), False), ("channel", StringType(), False),
           ("unit_price", DoubleType(), False), ("quantity", IntegerType(), False),
           ("revenue", MONEY, False))

# --- marketplace raw layer; ids are text, five timestamps parsed at read
_TS = TimestampNTZType()
RAW = {
    "raw_customers": _s(("customer_id", StringType(), False), ("customer_unique_id", StringType(), True),
                        ("customer_zip_code_prefix", StringType(), True), ("customer_city", StringType(), True),
                        ("customer_state", StringType(), True)),
    "raw_geolocation": _s(("geolocation_zip_code_prefix", StringType(), True), ("geolocation_lat", DoubleType(), True),
                          ("geolocation_lng", DoubleType(), True), ("geolocation_city", StringType(), True),
                          ("geolocation_state", StringType(), True)),
    "raw_orders": _s(("order_id", StringType(), False), ("customer_id", StringType(), True),
                     ("order_status", StringType(), True), ("order_purchase_timestamp", _TS, True),
                     ("order_approved_at", _TS, True), ("order_delivered_carrier_date", _TS, True),
                     ("order_delivered_customer_date", _TS, True), ("order_estimated_delivery_date", _TS, True)),
    "raw_order_items": _s(("order_id", StringType(), False), ("order_item_id", IntegerType(), True),
                          ("product_id", StringType(), True), ("seller_id", StringType(), True),
                          ("shipping_limit_date", _TS, True), ("price", MONEY, True),
                          ("freight_value", DecimalType(16, 4), True)),
    "raw_order_payments": _s(("order_id", StringType(), False), ("payment_sequential", IntegerType(), True),
                             ("payment_type", StringType(), True), ("payment_installments", IntegerType(), True),
                             ("payment_value", MONEY, True)),
    "raw_order_reviews": _s(("review_id", StringType(), True), ("order_id", StringType(), True),
                            ("review_score", IntegerType(), True), ("review_comment_title", StringType(), True),
                            ("review_comment_message", StringType(), True), ("review_creation_date", _TS, True),
                            ("review_answer_timestamp", _TS, True)),
    "raw_products": _s(("product_id", StringType(), False), ("product_category_name", StringType(), True),
                       ("product_name_lenght", IntegerType(), True), ("product_description_lenght", IntegerType(), True),
                       ("product_photos_qty", IntegerType(), True), ("product_weight_g", IntegerType(), True),
                       ("product_length_cm", IntegerType(), True), ("product_height_cm", IntegerType(), True),
                       ("product_width_cm", IntegerType(), True)),
    "raw_sellers": _s(("seller_id", StringType(), False), ("seller_zip_code_prefix", StringType(), True),
                      ("seller_city", StringType(), True), ("seller_state", StringType(), True)),
    "raw_category_translation": _s(("product_category_name", StringType(), False),
                                   ("product_category_name_english", StringType(), True)),
}

# File names of the marketplace CSV export, per raw table.
RAW_FILES = {
    "raw_customers": "customers.csv",
    "raw_geolocation": "geolocation.csv",
    "raw_orders": "orders.csv",
    "raw_order_items": "order_items.csv",
    "raw_order_payments": "order_payments.csv",
    "raw_order_reviews": "order_reviews.csv",
    "raw_products": "products.csv",
    "raw_sellers": "sellers.csv",
    "raw_category_translation": "product_category_name_translation.csv",
}
# the one raw table whose texts hold line breaks: its file cannot be split
MULTILINE = ("raw_order_reviews",)


def raw_file_names(found: list[str]) -> dict[str, str]:
    """Raw tables and their files among the names of a folder: the name itself, or else
    the one that holds it (an export may put something before and after)."""
    csv = [n for n in found if n.endswith(".csv")]
    stem = {t: f[:-len(".csv")] for t, f in RAW_FILES.items()}
    out = {t: f for t, f in RAW_FILES.items() if f in csv}
    for table in sorted(stem, key=lambda t: -len(stem[t])):  # order_items before orders
        if table in out:
            continue
        fits = [n for n in csv if stem[table] in n and n not in out.values()]
        if len(fits) > 1:
            raise ValueError(f"{table}: which of {sorted(fits)}?")
        out |= {table: n for n in fits}
    return out


# --- star layer written by the warehouse ETL
STAR = {
    "dim_date": _s(("date", DateType(), False), ("year", IntegerType(), False), ("quarter", IntegerType(), False),
                   ("month", IntegerType(), False), ("month_label", StringType(), False),
                   ("weekday", IntegerType(), False), ("weekday_name", StringType(), False),
                   ("is_weekend", IntegerType(), False)),
    "dim_customer": _s(("customer_id", StringType(), False), ("customer_state", StringType(), True),
                       ("customer_city", StringType(), True), ("cohort_month", StringType(), True)),
    "dim_product": _s(("product_id", StringType(), False), ("category", StringType(), True),
                      ("category_en", StringType(), True), ("weight_g", IntegerType(), True),
                      ("volume_cm3", LongType(), True), ("photos_qty", IntegerType(), True)),
    "dim_seller": _s(("seller_id", StringType(), False), ("seller_state", StringType(), True),
                     ("seller_city", StringType(), True)),
    "fact_orders": _s(("order_id", StringType(), False), ("customer_id", StringType(), True),
                      ("order_status", StringType(), True), ("order_purchase_ts", _TS, True),
                      ("delivered_ts", _TS, True), ("estimated_ts", _TS, True),
                      ("delivery_delay_days", IntegerType(), True), ("is_late", IntegerType(), False),
                      ("review_score", IntegerType(), True), ("total_items", LongType(), True),
                      ("revenue", DecimalType(18, 4), True), ("freight", DecimalType(18, 4), True),
                      ("payment_methods", LongType(), True), ("payment_installments", IntegerType(), True)),
    "fact_order_items": _s(("order_id", StringType(), False), ("order_item_id", IntegerType(), True),
                           ("product_id", StringType(), True), ("seller_id", StringType(), True),
                           ("price", MONEY, True), ("freight_value", DecimalType(16, 4), True)),
    "fact_payments": _s(("order_id", StringType(), False), ("payment_sequential", IntegerType(), True),
                        ("payment_type", StringType(), True), ("payment_installments", IntegerType(), True),
                        ("payment_value", MONEY, True)),
}

ALL = {**SHOP, "sales": SALES, **RAW, **STAR}
