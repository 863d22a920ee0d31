"""Batch run: raw files to Bronze, Silver, Gold and the serving files.

Each layer is written before the next one reads it, so nothing is computed twice and a lost executor
costs at most the running stage.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.jobs import run_all
from ordermill.operators.enrich import rename_orders
from ordermill.plans import incremental
from ordermill.plans.gold import group_totals, kpi_tables, passed_only
from ordermill.plans.silver import PARTITION_COLUMN, build_silver
from ordermill.schemas import RAW_SCHEMAS, SERVING_CONTRACT
from ordermill.session import sized_shuffles
from ordermill.sources.buckets import bucket_number
from ordermill.sources.raw import ingest_all
from ordermill.sources.serving import export_all
from ordermill.sources.tables import read_table, table_exists, upsert_table, write_table


# Raw tables without which Silver cannot be brought up to date.
SILVER_TABLES = (
    "orders",
    "order_items",
    "order_payments",
    "order_reviews",
    "products",
    "sellers",
    "category_translation",
)


# Those with rows per order.
ORDER_TABLES = ("orders", "order_items", "order_payments", "order_reviews")


def bronze_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: read_table(spark, f"{root}/bronze/{name}") for name in RAW_SCHEMAS}


def silver_path(root: str) -> str:
    return f"{root}/silver/orders"


def gold_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: read_table(spark, f"{root}/gold/{name}") for name in SERVING_CONTRACT}


def _identified(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    # Unique by construction: one row per order, and all joined sides are unique on the order. Orders
    # without an id match nothing, so each run would add them again; they are kept aside instead.
    return {**raw, "orders": raw["orders"].filter("order_id IS NOT NULL")}


def _keep_nameless(spark: SparkSession, raw: Mapping[str, DataFrame], root: str) -> None:
    aside, nameless = f"{root}/silver/orders_without_id", rename_orders(raw["orders"]).filter("order_id IS NULL")
    if table_exists(spark, aside) or not nameless.isEmpty():
        write_table(nameless, aside)


def refresh_silver(spark: SparkSession, raw: Mapping[str, DataFrame], root: str) -> DataFrame:
    """Bring Silver up to date with the raw tables and return it as stored."""
    path = silver_path(root)
    with sized_shuffles(spark, raw.values()):
        upsert_table(build_silver(_identified(raw)), path, "order_id", (PARTITION_COLUMN,), known_unique=True)
        _keep_nameless(spark, raw, root)
    return read_table(spark, path)


def write_gold(spark: SparkSession, kpis: Mapping[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """The KPI tables are small and independent, so they are written at the same time."""
    run_all(spark, {name: lambda table=table, name=name: write_table(table, f"{root}/gold/{name}") for name, table in kpis.items()})
    return gold_tables(spark, root)


def refresh_gold(
    spark: SparkSession, silver: DataFrame, root: str, only_passed: bool = False
) -> dict[str, DataFrame]:
    """All KPI tables. Silver is scanned once, into a small stored table of totals per group."""
    write_table(group_totals(passed_only(silver, only_passed)), f"{root}/gold/group_totals")
    return write_gold(spark, kpi_tables(read_table(spark, f"{root}/gold/group_totals")), root)


def apply_updates(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    root: str,
    deleted: DataFrame | None = None,
    only_passed: bool = False,
) -> dict[str, DataFrame]:
    """Bring Silver and Gold up to date with raw tables that hold the new and changed orders only.

    The orders of `raw["orders"]` are built anew and replace what Silver holds of them; those in `deleted` (order_id) go. The
    KPI tables follow by the difference, without reading Silver (see `incremental`).
    """
    with sized_shuffles(spark, raw.values()):
        incremental.upsert_orders(build_silver(_identified(raw)), root, deleted, known_unique=True)
        _keep_nameless(spark, raw, root)
    return write_gold(spark, incremental.refresh_gold(spark, root, only_passed), root)


def store_by_order(spark: SparkSession, raw: Mapping[str, DataFrame], bronze: str) -> dict[str, DataFrame]:
    """The raw tables that are joined by order, stored in buckets of the order id.

    The shuffle of the joins is then paid once, when the tables are written, and Silver is built from them without one.
    """
    own = {name: raw[name] for name in ORDER_TABLES}
    number = bucket_number(list(own.values()), int(spark.conf.get("spark.sql.shuffle.partitions")))
    tasks = {name: lambda df=df, name=name: write_table(df, f"{bronze}/{name}", buckets=("order_id", number)) for name, df in own.items()}
    run_all(spark, tasks)
    return {name: read_table(spark, f"{bronze}/{name}") for name in own}


def run(spark: SparkSession, folder: str, root: str) -> dict[str, DataFrame]:
    """All layers from a folder of CSV files; returns the ingestion report and the Gold tables."""
    report = ingest_all(spark, folder, f"{root}/bronze")
    failed = report.filter(F.col("error").isNotNull() & F.col("table_name").isin(*SILVER_TABLES)).collect()
    if failed:
        told = "; ".join(f"{r['table_name']}: {r['error']}" for r in failed)
        raise RuntimeError(f"Silver would be built from older raw tables: {told}")
    silver = refresh_silver(spark, bronze_tables(spark, root), root)
    gold = refresh_gold(spark, silver, root)
    export_all(gold, f"{root}/serving")
    return {"ingested": report, **gold}
