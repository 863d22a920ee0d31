"""The five KPI tables (Gold) and the Silver preview.

Each table is one aggregation over Silver. Spark combines rows per task before the shuffle, so only one
row per group and task moves, however uneven the groups are. `kpi_tables` computes all five from a single
scan. Results are unordered; the order of the exported files is applied when they are written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from ordermill.functions import measures as m

MONTH = "yyyy-MM"


def passed_only(silver: DataFrame, only_passed: bool) -> DataFrame:
    """Quality flags do not drop rows unless asked to."""
    return silver.filter("dq_passed") if only_passed else silver


def _delivered(silver: DataFrame) -> DataFrame:
    # On the status, not on the flag: Silver is partitioned by status, so other partitions are not read.
    return silver.filter(F.col("order_status") == "delivered")


def _measured(groups: GroupedData | DataFrame) -> DataFrame:
    return groups.agg(*m.totals())


# --- from totals per group to the columns of a KPI table


def _global_columns(totals: DataFrame) -> DataFrame:
    return totals.select(
        F.col("orders").alias("total_orders"),
        F.col("delivered").alias("total_delivered"),
        F.col("canceled").alias("total_canceled"),
        m.otif_pct().alias("otif_rate_pct"),
        m.average_delivered("delivery_days_actual").alias("avg_delivery_days_actual"),
        m.average_delivered("delivery_days_estimated").alias("avg_delivery_days_estimated"),
        m.average_delivered("delivery_delay_days").alias("avg_delay_days"),
        m.money_total().alias("total_revenue_brl"),
        m.average("payment_value", 2).alias("avg_order_value_brl"),
        m.average("review_score", 2).alias("avg_review_score"),
        m.percent("freight_ratio_sum", "freight_ratio_n", 1).alias("avg_freight_ratio_pct"),
        F.current_timestamp().alias("gold_computed_at"),
    )


def _monthly_columns(totals: DataFrame) -> DataFrame:
    return totals.select(
        "order_month",
        "orders",
        "delivered",
        "canceled",
        m.otif_pct().alias("otif_rate_pct"),
        m.average_delivered("delivery_days_actual").alias("avg_delivery_days"),
        m.average_delivered("delivery_delay_days").alias("avg_delay_days"),
        m.money_total().alias("revenue_brl"),
        m.average("review_score", 2).alias("avg_review_score"),
        m.percent("canceled", "orders").alias("cancellation_rate_pct"),
    )


def _category_columns(totals: DataFrame) -> DataFrame:
    return totals.select(
        "category",
        "orders",
        m.money_total().alias("revenue_brl"),
        m.average("payment_value", 2).alias("avg_order_value"),
        m.average("review_score", 2).alias("avg_review_score"),
        m.otif_pct().alias("otif_rate_pct"),
    )


def _nps_columns(totals: DataFrame) -> DataFrame:
    # The grand total is summed over the finished groups, one row per score.
    reviewed = F.sum("rows").over(Window.partitionBy())
    return totals.select(
        "review_score_int",
        "orders",
        m.average("payment_value", 2).alias("avg_payment_value"),
        m.average("delivery_days_actual", 1).alias("avg_delivery_days"),
        m.percent(F.col("orders"), reviewed).alias("pct_of_total"),
    )


def _state_columns(totals: DataFrame) -> DataFrame:
    return totals.select(
        "seller_state",
        "orders",
        m.average("delivery_days_actual", 1).alias("avg_delivery_days"),
        m.average("delivery_delay_days", 1).alias("avg_delay_days"),
        m.percent("on_time", "orders").alias("otif_rate_pct"),
        m.money_total().alias("revenue_brl"),
        m.average("review_score", 2).alias("avg_review_score"),
    )


# --- one table at a time


def kpi_global(silver: DataFrame) -> DataFrame:
    return _global_columns(_measured(silver))


def kpi_monthly(silver: DataFrame) -> DataFrame:
    month = F.date_format("order_purchase_ts", MONTH).alias("order_month")
    return _monthly_columns(_measured(silver.groupBy(month)))


def kpi_category(silver: DataFrame) -> DataFrame:
    """Orders touching a category: an order counts in full once per category it has items of."""
    touching = silver.withColumn("category", F.explode("categories")).filter("category IS NOT NULL")
    return _category_columns(_measured(touching.groupBy("category")))


def kpi_nps(silver: DataFrame) -> DataFrame:
    """Per review score, with its share of all reviewed orders."""
    score = F.col("review_score").cast("int").alias("review_score_int")
    return _nps_columns(_measured(silver.filter("review_score IS NOT NULL").groupBy(score)))


def kpi_seller_state(silver: DataFrame) -> DataFrame:
    """Delivered orders touching a seller state."""
    touching = (
        _delivered(silver)
        .withColumn("seller_state", F.explode("seller_states"))
        .filter("seller_state IS NOT NULL")
    )
    return _state_columns(_measured(touching.groupBy("seller_state")))


KPI_TABLES = {
    "kpi_global": kpi_global,
    "kpi_monthly": kpi_monthly,
    "kpi_category": kpi_category,
    "kpi_nps": kpi_nps,
    "kpi_seller_state": kpi_seller_state,
}


# --- all tables from one scan


def memberships() -> Column:
    """The groups an order belongs to, as (kpi table, group) pairs."""

    def pair(table: str, item: Column) -> Column:
        return F.struct(F.lit(table).alias("table"), item.cast("string").alias("item"))

    def pairs(table: str, names: Column) -> Column:
        return F.transform(F.array_compact(names), lambda name: pair(table, name))

    nothing = F.array().cast("array<struct<table:string,item:string>>")
    score, month = F.col("review_score").cast("int"), F.date_format("order_purchase_ts", MONTH)
    delivered = F.col("order_status") == "delivered"
    return F.concat(
        F.array(pair("kpi_global", F.lit(None)), pair("kpi_monthly", month)),
        F.when(score.isNotNull(), F.array(pair("kpi_nps", score))).otherwise(nothing),
        F.coalesce(pairs("kpi_category", F.col("categories")), nothing),
        F.when(delivered, F.coalesce(pairs("kpi_seller_state", F.col("seller_states")), nothing))
        .otherwise(nothing),
    )


def group_totals(rows: DataFrame, sign: str | None = None) -> DataFrame:
    """Exact totals of every group of every KPI table, from one scan and one shuffle of partial sums. `sign` names a
    column of 1 and -1, for rows of Silver to add and to take out."""
    members = rows.withColumn("member", F.explode(memberships()))
    # Only the one table shows this measure.
    ratio = F.when(F.col("member.table") == "kpi_global", F.col("freight_ratio"))
    return members.withColumn("freight_ratio", ratio).groupBy("member.table", "member.item").agg(*m.totals(True, sign))


def kpi_tables(totals: DataFrame) -> dict[str, DataFrame]:
    """The five KPI tables from `group_totals`. Write those first: they are read once per table."""

    def of(table: str, key: str = "item", kind: str = "string") -> DataFrame:
        rows = totals.filter(F.col("table") == table)
        return rows.withColumn(key, F.col("item").cast(kind))

    return {
        "kpi_global": _global_columns(of("kpi_global")),
        "kpi_monthly": _monthly_columns(of("kpi_monthly", "order_month")),
        "kpi_category": _category_columns(of("kpi_category", "category")),
        "kpi_nps": _nps_columns(of("kpi_nps", "review_score_int", "int")),
        "kpi_seller_state": _state_columns(of("kpi_seller_state", "seller_state")),
    }


def silver_preview(silver: DataFrame) -> DataFrame:
    return _measured(_delivered(silver)).select(
        m.average("delivery_days_actual", 1).alias("avg_delivery_days"),
        m.average("delivery_days_estimated", 1).alias("avg_estimated_days"),
        m.average("delivery_delay_days", 1).alias("avg_delay_days"),
        m.percent("late", "rows", 1).alias("pct_late"),
        m.average("payment_value", 2).alias("avg_payment_value"),
        m.average("review_score", 2).alias("avg_review_score"),
    )
