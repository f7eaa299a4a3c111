"""Adapter from the driver's TPC-H-like tables onto this engine's tables.

Each view is one SQL text with ``{table}`` placeholders. Spark runs it with
``spark.sql(text, lineitem=df, ...)`` (DataFrames bound as parameters, so
no global temp views are left behind); the DuckDB oracle inlines the same
text as a ``WITH`` clause. Field-by-field mapping:

  shop      customers <- customer, nation, first order date as signup
            products <- part; shop_orders <- orders (F/O/P -> completed/
            pending/refunded); order_items <- lineitem (line_revenue =
            extended price); payments <- settled ('F') lines per order
  sales     lineitem x orders x part x customer x nation x region
  raw_*     marketplace raw layer over the same tables
"""

from __future__ import annotations

import string

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Declared schemas of the driver's tables (read with them: no footer-inference job per table).
BASE_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
}

# money cast used throughout the adapter
_D = "CAST({x} AS DECIMAL(12,2))"


def _d(x: str) -> str:
    return _D.format(x=x)


VIEWS: dict[str, str] = {
    # ---------------- shop schema ----------------
    "customers": f"""
SELECT c.c_custkey AS customer_id, c.c_name AS name, n.n_name AS city,
       CAST(MIN(o.o_orderdate) AS DATE) AS signup_date
FROM {{customer}} c
JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey
JOIN {{orders}} o ON o.o_custkey = c.c_custkey
GROUP BY c.c_custkey, c.c_name, n.n_name""",
    "products": f"""
SELECT p_partkey AS product_id, p_name AS name, p_type AS category,
       {_d('p_retailprice')} AS cost_price
FROM {{part}}""",
    "shop_orders": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
       CAST(o_orderdate AS DATE) AS order_date,
       CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending'
                          WHEN 'P' THEN 'refunded' END AS status
FROM {orders}""",
    "order_items": f"""
SELECT l_orderkey * 8 + l_linenumber AS item_id, l_orderkey AS order_id, l_partkey AS product_id,
       CAST(l_quantity AS INT) AS quantity,
       CAST(l_extendedprice / l_quantity AS DECIMAL(12,2)) AS unit_price,
       {_d('l_extendedprice')} AS line_revenue
FROM {{lineitem}}""",
    "payments": f"""
SELECT l_orderkey AS payment_id, l_orderkey AS order_id,
       MIN(CAST(l_shipdate AS DATE)) AS payment_date,
       CAST(SUM({_d('l_extendedprice')}) AS DECIMAL(18,2)) AS amount,
       CASE MIN(l_returnflag) WHEN 'A' THEN 'card' WHEN 'N' THEN 'paypal' WHEN 'R' THEN 'transfer' END AS method
FROM {{lineitem}}
WHERE l_linestatus = 'F'
GROUP BY l_orderkey""",
    # ---------------- flat sales ----------------
    "sales": f"""
SELECT o.o_orderdate AS date, p.p_type AS category, r.r_name AS region,
       CASE l.l_linestatus WHEN 'O' THEN 'Online' ELSE 'In-store' END AS channel,
       CAST(l.l_extendedprice AS DOUBLE) / l.l_quantity AS unit_price,
       CAST(l.l_quantity AS INT) AS quantity,
       {_d('l.l_extendedprice')} AS revenue
FROM {{lineitem}} l
JOIN {{orders}} o ON l.l_orderkey = o.o_orderkey
JOIN {{part}} p ON l.l_partkey = p.p_partkey
JOIN {{customer}} c ON o.o_custkey = c.c_custkey
JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey
JOIN {{region}} r ON n.n_regionkey = r.r_regionkey""",
    # ---------------- marketplace raw layer ----------------
    "raw_customers": """
SELECT CAST(c.c_custkey AS STRING) AS customer_id,
       CAST(c.c_custkey AS STRING) AS customer_unique_id,
       CAST(c.c_nationkey AS STRING) AS customer_zip_code_prefix,
       c.c_mktsegment AS customer_city, n.n_name AS customer_state
FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey""",
    "raw_sellers": """
SELECT CAST(s.s_suppkey AS STRING) AS seller_id,
       CAST(s.s_nationkey AS STRING) AS seller_zip_code_prefix,
       r.r_name AS seller_city, n.n_name AS seller_state
FROM {supplier} s
JOIN {nation} n ON s.s_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey""",
    "raw_orders": """
SELECT CAST(o.o_orderkey AS STRING) AS order_id, CAST(o.o_custkey AS STRING) AS customer_id,
       CASE o.o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                            WHEN 'P' THEN 'canceled' END AS order_status,
       o.o_orderdate AS order_purchase_timestamp,
       o.o_orderdate AS order_approved_at,
       CASE WHEN o.o_orderstatus = 'F' THEN s.first_ship END AS order_delivered_carrier_date,
       CASE WHEN o.o_orderstatus = 'F' THEN s.last_ship END AS order_delivered_customer_date,
       o.o_orderdate + INTERVAL '30' DAY AS order_estimated_delivery_date
FROM {orders} o
LEFT JOIN (SELECT l_orderkey, MIN(l_shipdate) AS first_ship, MAX(l_shipdate) AS last_ship
           FROM {lineitem} GROUP BY l_orderkey) s
  ON s.l_orderkey = o.o_orderkey""",
    "raw_order_items": f"""
SELECT CAST(l_orderkey AS STRING) AS order_id, l_linenumber AS order_item_id,
       CAST(l_partkey AS STRING) AS product_id, CAST(l_suppkey AS STRING) AS seller_id,
       l_shipdate AS shipping_limit_date,
       {_d('l_extendedprice')} AS price,
       CAST({_d('l_extendedprice')} * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(16,4)) AS freight_value
FROM {{lineitem}}""",
    "raw_order_payments": f"""
SELECT CAST(l_orderkey AS STRING) AS order_id, l_linenumber AS payment_sequential,
       CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto'
                         WHEN 'R' THEN 'voucher' END AS payment_type,
       l_linenumber AS payment_installments,
       {_d('l_extendedprice')} AS payment_value
FROM {{lineitem}}""",
    "raw_order_reviews": """
SELECT CAST(o_orderkey AS STRING) AS review_id, CAST(o_orderkey AS STRING) AS order_id,
       CAST(substr(o_orderpriority, 1, 1) AS INT) AS review_score,
       CAST(NULL AS STRING) AS review_comment_title,
       CAST(NULL AS STRING) AS review_comment_message,
       o_orderdate + INTERVAL '40' DAY AS review_creation_date,
       o_orderdate + INTERVAL '41' DAY AS review_answer_timestamp
FROM {orders}
WHERE o_orderstatus IN ('F', 'O')""",
    "raw_products": """
SELECT CAST(p_partkey AS STRING) AS product_id, p_type AS product_category_name,
       CAST(length(p_name) AS INT) AS product_name_lenght,
       CAST(NULL AS INT) AS product_description_lenght,
       p_size % 8 AS product_photos_qty, p_size * 100 AS product_weight_g,
       p_size + 10 AS product_length_cm, p_size + 5 AS product_height_cm,
       p_size + 5 AS product_width_cm
FROM {part}""",
    "raw_category_translation": """
SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS product_category_name_english
FROM {part}""",
}


def view_for_duckdb(name: str) -> str:
    """The view text with placeholders bound to the pre-registered tables."""
    return VIEWS[name].format(**{t: t for t in BASE_TABLES})


def with_clause(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` for the oracle SQL."""
    return "WITH " + ",\n".join(f"{n} AS ({view_for_duckdb(n)})" for n in names)


def build_view(spark, base: dict, name: str):
    """Run one adapter view on Spark, binding only the base tables it names."""
    used = {f for _, f, _, _ in string.Formatter().parse(VIEWS[name]) if f}
    return spark.sql(VIEWS[name], **{t: base[t] for t in used})
