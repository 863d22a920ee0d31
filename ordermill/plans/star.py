"""Raw marketplace tables derived from a TPC-H-like star schema with an event table.

The star has no deliveries, payments or reviews. They are computed from columns it has, the same way on
every run, so that each query can be compared with SQL over the star tables.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.sources.raw import stamp

TABLES = ("nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def read_star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in TABLES}


def _plus_days(ts: Column, days: Column) -> Column:
    return (ts + F.make_dt_interval(days)).cast("timestamp")


def _price() -> Column:
    return F.col("l_extendedprice").cast("decimal(12,2)")


def _rate(column: str) -> Column:
    return F.col(column).cast("decimal(4,2)")


def orders(star: Mapping[str, DataFrame]) -> DataFrame:
    shipped = star["lineitem"].groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    placed, priority = F.col("o_orderdate"), F.col("o_orderpriority")
    status = (
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .when(priority == "5-LOW", "canceled")
        .otherwise("processing")
    )
    transit = F.pmod(F.datediff("last_ship", "o_orderdate"), F.lit(150)) - 10
    arrived = F.when(F.col("o_orderstatus") == "F", _plus_days(placed, transit))
    promised = _plus_days(placed, 20 + 10 * priority.substr(1, 1).cast("int"))
    return (
        star["orders"]
        .join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            status.alias("order_status"),
            placed.cast("timestamp").alias("order_purchase_timestamp"),
            F.lit(None).cast("timestamp").alias("order_approved_at"),
            F.lit(None).cast("timestamp").alias("order_delivered_carrier_date"),
            arrived.alias("order_delivered_customer_date"),
            promised.alias("order_estimated_delivery_date"),
        )
    )


def order_items(star: Mapping[str, DataFrame]) -> DataFrame:
    return star["lineitem"].select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").cast("timestamp").alias("shipping_limit_date"),
        _price().alias("price"),
        (_price() * _rate("l_tax")).alias("freight_value"),
    )


def order_payments(star: Mapping[str, DataFrame]) -> DataFrame:
    flag = F.col("l_returnflag")
    return star["lineitem"].select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.when(flag == "A", "credit_card")
        .when(flag == "N", "boleto")
        .when(flag == "R", "voucher")
        .alias("payment_type"),
        F.col("l_linenumber").alias("payment_installments"),
        (_price() * (1 - _rate("l_discount"))).alias("payment_value"),
    )


def order_reviews(star: Mapping[str, DataFrame]) -> DataFrame:
    return star["events"].select(
        F.col("event_id").alias("review_id"),
        (F.col("user_id") * 100 + F.col("event_id") % 100).alias("order_id"),
        (F.get_json_object("props", "$.k").cast("int") % 7).alias("review_score"),
        F.lit(None).cast("string").alias("review_comment_title"),
        F.lit(None).cast("string").alias("review_comment_message"),
        F.col("ts").cast("timestamp").alias("review_creation_date"),
        F.lit(None).cast("timestamp").alias("review_answer_timestamp"),
    )


def customers(star: Mapping[str, DataFrame]) -> DataFrame:
    nations = star["nation"].select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("customer_state")
    )
    return (
        star["customer"]
        .join(nations, "c_nationkey", "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_unique_id"),
            "customer_state",
        )
    )


def sellers(star: Mapping[str, DataFrame]) -> DataFrame:
    nations = star["nation"].select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("seller_state")
    )
    return (
        star["supplier"]
        .join(nations, "s_nationkey", "left")
        .select(F.col("s_suppkey").alias("seller_id"), "seller_state")
    )


def products(star: Mapping[str, DataFrame]) -> DataFrame:
    return star["part"].select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("product_category_name")
    )


def category_translation(star: Mapping[str, DataFrame]) -> DataFrame:
    """Lower-case names of all part types but one, which stays without a translation."""
    named = F.col("p_type").alias("product_category_name")
    english = F.lower("p_type").alias("product_category_name_english")
    return star["part"].filter("p_type <> 'STANDARD'").select(named, english).distinct()


RAW_BUILDERS = {
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "customers": customers,
    "sellers": sellers,
    "products": products,
    "category_translation": category_translation,
}


def raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    star = read_star(spark, folder)
    return {name: stamp(build(star), name) for name, build in RAW_BUILDERS.items()}


def order_updates(star: Mapping[str, DataFrame]) -> DataFrame:
    """Changes to the order table: shipped orders arrive, urgent orders are followed by a new one.

    Has a column the order table lacks (`priority`) and lacks one it has (`customer_id`).
    """
    placed = F.col("o_orderdate").cast("timestamp")
    arrived = star["orders"].filter("o_orderstatus = 'O'").select(
        F.col("o_orderkey").alias("order_id"),
        F.lit("delivered").alias("order_status"),
        placed.alias("order_purchase_timestamp"),
        F.col("o_orderpriority").alias("priority"),
    )
    followed = star["orders"].filter("o_orderpriority = '1-URGENT'").select(
        (-F.col("o_orderkey") - 1).alias("order_id"),
        F.lit("created").alias("order_status"),
        _plus_days(F.col("o_orderdate"), F.lit(1)).alias("order_purchase_timestamp"),
        F.col("o_orderpriority").alias("priority"),
    )
    return arrived.unionByName(followed)


def event_versions(star: Mapping[str, DataFrame]) -> DataFrame:
    """Several recorded states per user, tied on the day."""
    return star["events"].select(
        "user_id",
        F.date_trunc("day", F.col("ts").cast("timestamp")).alias("day"),
        "event_id",
        "event_type",
        "value",
    )
