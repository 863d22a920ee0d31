"""Per-order delivery metrics: day differences, status flags, order value and freight ratio."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER_TIMESTAMPS = (
    "order_purchase_ts",
    "order_approved_ts",
    "order_delivered_ts",
    "order_estimated_ts",
)


def days_between(later: str, earlier: str) -> Column:
    """Calendar days, so 23:59 to 00:01 on the next day is one. Null when either side is."""
    return F.datediff(F.col(later), F.col(earlier))


def parse_timestamps(df: DataFrame, fmt: str, columns: tuple[str, ...] = ORDER_TIMESTAMPS) -> DataFrame:
    """Text columns to timestamps; unreadable text ('', 'nan') becomes null instead of an error.

    Columns that already are timestamps are left alone.
    """
    kinds = dict(df.dtypes)
    return df.withColumns(
        {c: F.try_to_timestamp(F.col(c), F.lit(fmt)) for c in columns if kinds[c] == "string"}
    )


def with_delivery_metrics(df: DataFrame) -> DataFrame:
    items = F.col("total_items_value").cast("double")
    freight = F.col("total_freight").cast("double")
    return df.withColumns(
        {
            "delivery_days_actual": days_between("order_delivered_ts", "order_purchase_ts"),
            "delivery_days_estimated": days_between("order_estimated_ts", "order_purchase_ts"),
            "delivery_delay_days": days_between("order_delivered_ts", "order_estimated_ts"),
            "is_delivered": F.col("order_status") == "delivered",
            "is_canceled": F.col("order_status") == "canceled",
            "order_value_total": F.col("total_items_value") + F.col("total_freight"),
            "freight_ratio": F.when(items > 0, freight / items),
        }
    ).withColumn(
        # An unknown delay, an unknown status and an undelivered order are all "not late".
        "is_late_delivery",
        F.coalesce(F.col("is_delivered") & (F.col("delivery_delay_days") > 0), F.lit(False)),
    )
