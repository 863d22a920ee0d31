"""Reports over the KPI tables. Their inputs hold one row per month, category or region."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.functions import labels
from ordermill.functions.measures import weighted_mean

MIN_ORDERS = 100

# Metric shown on the map -> column of the region table.
MAP_METRICS = {
    "otif": "otif_rate_pct",
    "delivery": "avg_delivery_days",
    "score": "avg_review_score",
}


def active_months(monthly: DataFrame, year: str | None = None, min_orders: int = MIN_ORDERS) -> DataFrame:
    """Months with more than `min_orders` orders, optionally of one year; drops the thin edges of the data."""
    busy = monthly.filter(F.col("orders") > min_orders)
    return busy if year is None else busy.filter(F.col("order_month").startswith(year))


def year_kpis(monthly: DataFrame) -> DataFrame:
    return (
        active_months(monthly)
        .groupBy(F.left(F.col("order_month"), F.lit(4)).alias("year"))
        .agg(
            F.sum("orders").alias("orders"),
            F.sum("revenue_brl").alias("revenue_brl"),
            weighted_mean("otif_rate_pct", "orders").alias("otif_rate_pct"),
            weighted_mean("avg_review_score", "orders").alias("avg_review_score"),
        )
    )


def category_card(category_kpis: DataFrame, category: str | Column) -> DataFrame:
    """The KPI row of one category with its display name."""
    return category_kpis.filter(F.col("category") == category).select(
        "category",
        labels.category_label(F.col("category")).alias("label"),
        "orders",
        "revenue_brl",
        "otif_rate_pct",
        "avg_review_score",
    )


def top_categories(category_kpis: DataFrame, n: int = 10) -> DataFrame:
    ranked = category_kpis.orderBy(F.desc("revenue_brl"), "category")
    return ranked.limit(n).select("category", "revenue_brl")


def region_list(spark: SparkSession, codes: list[str] = labels.REGION_CODES) -> DataFrame:
    return spark.createDataFrame([(code,) for code in codes], "seller_state STRING")


def state_coverage(regions: DataFrame, state_kpis: DataFrame) -> DataFrame:
    """Every region of the list, with its KPIs where there are any."""
    return regions.join(state_kpis, "seller_state", "left")


def metric_range(df: DataFrame, value: str) -> DataFrame:
    return df.agg(F.min(value).alias("min_value"), F.max(value).alias("max_value"))


def state_metric_bins(
    regions: DataFrame, state_kpis: DataFrame, metric: str = "otif", bins: int = 5
) -> DataFrame:
    """Equal-width bins 0..bins-1 of a metric over all regions with data; no data, no bin.

    The range spans all rows of `state_kpis`, also of states that are not on the list.
    """
    everything = Window.partitionBy()
    value = F.col(MAP_METRICS[metric])
    low = F.min(value).over(everything)
    width = F.max(value).over(everything) - low
    step = F.when(width == 0, 1.0).otherwise(width)
    number = F.least(F.lit(bins - 1), F.floor((value - low) / step * bins)).cast("int")
    scaled = state_kpis.select(
        "seller_state",
        value.alias("value"),
        # `least` skips nulls, so a missing value would land in the last bin without the test.
        F.when(value.isNotNull(), number).alias("bin"),
    )
    return regions.select("seller_state").join(scaled, "seller_state", "left")


def month_labels(monthly: DataFrame) -> DataFrame:
    return monthly.select(
        "order_month", labels.month_label(F.col("order_month")).alias("label"), "orders"
    )


def revenue_labels(table: DataFrame, name: str, amount: str = "revenue_brl") -> DataFrame:
    return table.select(name, labels.compact_money(F.col(amount)).alias("revenue_label"))


def category_labels(category_kpis: DataFrame) -> DataFrame:
    return category_kpis.select(
        "category", labels.category_label(F.col("category")).alias("label")
    )
