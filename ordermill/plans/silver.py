"""The enriched order table (Silver): one row per order with metrics and quality flags."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.delivery import parse_timestamps, with_delivery_metrics
from ordermill.operators.dedup import latest_per_key
from ordermill.operators.enrich import (
    items_per_order,
    join_order_parts,
    latest_review_per_order,
    payments_per_order,
    rename_orders,
    translate_products,
)
from ordermill.operators.lookup import BROADCAST_BYTES
from ordermill.operators.quality import ORDER_RULES, Rule, apply_rules
from ordermill.schemas import EVENT_TS_FORMAT

PARTITION_COLUMN = "order_status"


def enrich_orders(raw: Mapping[str, DataFrame], *, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Latest version of every order with its items, payments and review.

    Orders are reduced to one row per key before the joins rather than after: the result is the same,
    since all other sides are unique on the key, and a repeated order is never joined twice.
    """
    orders = latest_per_key(rename_orders(raw["orders"]), ["order_id"], ["bronze_ingested_at"])
    products = translate_products(raw["products"], raw["category_translation"], limit=limit)
    return join_order_parts(
        orders,
        items_per_order(raw["order_items"], products, raw["sellers"], limit=limit),
        payments_per_order(raw["order_payments"]),
        latest_review_per_order(raw["order_reviews"]),
    )


def flagged_versions(raw: Mapping[str, DataFrame], *, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Every row of the orders table, repeats and rows without an id included, with its quality flags."""
    products = translate_products(raw["products"], raw["category_translation"], limit=limit)
    versions = join_order_parts(
        rename_orders(raw["orders"]),
        items_per_order(raw["order_items"], products, raw["sellers"], limit=limit),
        payments_per_order(raw["order_payments"]),
        latest_review_per_order(raw["order_reviews"]),
    )
    return refine_orders(versions)


def refine_orders(enriched: DataFrame, rules: list[Rule] = ORDER_RULES) -> DataFrame:
    """Types, delivery metrics and quality flags; works on batch rows and on parsed events alike."""
    typed = parse_timestamps(enriched, EVENT_TS_FORMAT)
    return apply_rules(with_delivery_metrics(typed), rules).withColumn(
        "silver_processed_at", F.current_timestamp()
    )


def build_silver(raw: Mapping[str, DataFrame], *, limit: int = BROADCAST_BYTES) -> DataFrame:
    return refine_orders(enrich_orders(raw, limit=limit))
