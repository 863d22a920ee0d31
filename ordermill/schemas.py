"""Declared schemas of every layer, as DDL text so that any reader can take them as they are.

Money is DECIMAL, never a binary float: sums are then exact and do not depend on the order in which
tasks finish. Only the KPI tables hand out DOUBLE, because their readers expect it.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Wide enough for any amount; a value with more digits is rejected on reading, not rounded.
MONEY = "DECIMAL(18,4)"

# Raw table and column names as the input files spell them ("lenght" included).
RAW_SCHEMAS = {
    "orders": """
        order_id STRING, customer_id STRING, order_status STRING,
        order_purchase_timestamp TIMESTAMP, order_approved_at TIMESTAMP,
        order_delivered_carrier_date TIMESTAMP, order_delivered_customer_date TIMESTAMP,
        order_estimated_delivery_date TIMESTAMP""",
    "order_items": f"""
        order_id STRING, order_item_id INT, product_id STRING, seller_id STRING,
        shipping_limit_date TIMESTAMP, price {MONEY}, freight_value {MONEY}""",
    "order_payments": f"""
        order_id STRING, payment_sequential INT, payment_type STRING,
        payment_installments INT, payment_value {MONEY}""",
    "order_reviews": """
        review_id STRING, order_id STRING, review_score INT, review_comment_title STRING,
        review_comment_message STRING, review_creation_date TIMESTAMP,
        review_answer_timestamp TIMESTAMP""",
    "customers": """
        customer_id STRING, customer_unique_id STRING, customer_zip_code_prefix STRING,
        customer_city STRING, customer_state STRING""",
    "sellers": """
        seller_id STRING, seller_zip_code_prefix STRING, seller_city STRING, seller_state STRING""",
    "products": """
        product_id STRING, product_category_name STRING, product_name_lenght DOUBLE,
        product_description_lenght DOUBLE, product_photos_qty DOUBLE, product_weight_g DOUBLE,
        product_length_cm DOUBLE, product_height_cm DOUBLE, product_width_cm DOUBLE""",
    "geolocation": """
        geolocation_zip_code_prefix STRING, geolocation_lat DOUBLE, geolocation_lng DOUBLE,
        geolocation_city STRING, geolocation_state STRING""",
    "category_translation": """
        product_category_name STRING, product_category_name_english STRING""",
}

# Names of the order columns in Silver, by their names in the raw table.
ORDER_COLUMNS = {
    "order_id": "order_id",
    "customer_id": "customer_id",
    "order_status": "order_status",
    "order_purchase_timestamp": "order_purchase_ts",
    "order_approved_at": "order_approved_ts",
    "order_delivered_customer_date": "order_delivered_ts",
    "order_estimated_delivery_date": "order_estimated_ts",
    "_bronze_ingested_at": "bronze_ingested_at",
    "_source": "source",
}

# The files carry a publisher prefix, so tables are found by the end of the file name.
RAW_FILES = {name: f"*{name}_dataset.csv" for name in RAW_SCHEMAS}
RAW_FILES["category_translation"] = "product_category_name_translation.csv"

EVENT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Fields of the message. One JSON message per order; money is read as exact decimals instead of 32-bit floats.
EVENT_SCHEMA = """
    event_id STRING, order_id STRING, customer_id STRING, order_status STRING,
    order_purchase_ts STRING, order_approved_ts STRING, order_delivered_ts STRING,
    order_estimated_ts STRING, item_count INT, categories ARRAY<STRING>,
    seller_states ARRAY<STRING>, total_items_value DECIMAL(28,4), total_freight DECIMAL(28,4),
    payment_type STRING, payment_installments INT, payment_value DECIMAL(28,4),
    review_score FLOAT, ingested_at STRING, source STRING"""

# What a message broker hands over; files with these columns stand in for it in tests.
ENVELOPE_SCHEMA = """
    key STRING, value STRING, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"""

# Names, order and types of the exported tables. Change only with a new version.
SERVING_CONTRACT = {
    "kpi_global": """
        total_orders BIGINT, total_delivered BIGINT, total_canceled BIGINT, otif_rate_pct DOUBLE,
        avg_delivery_days_actual DOUBLE, avg_delivery_days_estimated DOUBLE, avg_delay_days DOUBLE,
        total_revenue_brl DOUBLE, avg_order_value_brl DOUBLE, avg_review_score DOUBLE,
        avg_freight_ratio_pct DOUBLE, gold_computed_at TIMESTAMP""",
    "kpi_monthly": """
        order_month STRING, orders BIGINT, delivered BIGINT, canceled BIGINT, otif_rate_pct DOUBLE,
        avg_delivery_days DOUBLE, avg_delay_days DOUBLE, revenue_brl DOUBLE,
        avg_review_score DOUBLE, cancellation_rate_pct DOUBLE""",
    "kpi_nps": """
        review_score_int INT, orders BIGINT, avg_payment_value DOUBLE, avg_delivery_days DOUBLE,
        pct_of_total DOUBLE""",
    "kpi_category": """
        category STRING, orders BIGINT, revenue_brl DOUBLE, avg_order_value DOUBLE,
        avg_review_score DOUBLE, otif_rate_pct DOUBLE""",
    "kpi_seller_state": """
        seller_state STRING, orders BIGINT, avg_delivery_days DOUBLE, avg_delay_days DOUBLE,
        otif_rate_pct DOUBLE, revenue_brl DOUBLE, avg_review_score DOUBLE""",
}

# Row order of the exported tables: column and direction, with a column that breaks ties.
SERVING_ORDER = {
    "kpi_global": [],
    "kpi_monthly": [("order_month", "asc")],
    "kpi_nps": [("review_score_int", "asc")],
    "kpi_category": [("revenue_brl", "desc"), ("category", "asc")],
    "kpi_seller_state": [("orders", "desc"), ("seller_state", "asc")],
}


def column_names(ddl: str) -> list[str]:
    return T.StructType.fromDDL(ddl).names
