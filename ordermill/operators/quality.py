"""Data-quality rules. A rule set is data: a list of names and SQL conditions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Rule(NamedTuple):
    name: str
    fails_when: str


# Rule names and limits of the order table, in reporting order.
ORDER_RULES = [
    Rule("NULL_ORDER_ID", "order_id IS NULL"),
    Rule("INVALID_PAYMENT_VALUE", "payment_value IS NULL OR payment_value <= 0"),
    Rule("INVALID_ITEM_COUNT", "item_count IS NULL OR item_count < 1"),
    Rule("DELIVERY_BEFORE_PURCHASE", "delivery_days_actual < 0"),
    Rule("INVALID_REVIEW_SCORE", "review_score NOT BETWEEN 1 AND 5"),
    Rule("ANOMALOUS_DELIVERY_DAYS", "delivery_days_actual > 120"),
]

# The shorter set; a missing payment passes and delivery is compared by the second.
BASIC_RULES = [
    Rule("NULL_ORDER_ID", "order_id IS NULL"),
    Rule("ZERO_PAYMENT", "payment_value <= 0"),
    Rule("INVALID_ITEM_COUNT", "item_count IS NULL OR item_count < 1"),
    Rule("DELIVERY_BEFORE_PURCHASE", "order_delivered_ts < order_purchase_ts"),
    Rule("INVALID_REVIEW_SCORE", "review_score > 5"),
]


def apply_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add `dq_flags` (names of the failed rules joined by a pipe, '' when none) and `dq_passed`.

    A condition that is null does not fail. No row is dropped. `concat_ws` skips the nulls of the rules
    that hold, so no array is built per row.
    """
    failed = [F.when(F.expr(rule.fails_when), F.lit(rule.name)) for rule in rules]
    return df.withColumn("dq_flags", F.concat_ws("|", *failed)).withColumn(
        "dq_passed", F.col("dq_flags") == ""
    )


def with_failed_rules(df: DataFrame, rules: list[Rule], column: str = "dq_failed") -> DataFrame:
    """The failed rule names as an array, for counting single rules; [] when none failed."""
    failed = [F.when(F.expr(rule.fails_when), F.lit(rule.name)) for rule in rules]
    return df.withColumn(column, F.array_compact(F.array(*failed)))


def quality_summary(df: DataFrame) -> DataFrame:
    """Rows in total, passed and failed, with percentages, in one pass."""
    total, passed = F.count(F.lit(1)), F.count_if("dq_passed")

    def pct(part):
        return F.round(F.try_divide(part.cast("double"), total) * 100, 1)

    return df.agg(
        total.alias("total"),
        passed.alias("passed"),
        (total - passed).alias("failed"),
        pct(passed).alias("passed_pct"),
        pct(total - passed).alias("failed_pct"),
    )


def deduplication_summary(versions: DataFrame, key: str) -> DataFrame:
    """Quality of all rows before deduplication, and how many rows are left after it (null is one key)."""
    total, passed = F.count(F.lit(1)), F.count_if("dq_passed")
    without = F.coalesce(F.max(F.col(key).isNull().cast("int")), F.lit(0))
    return versions.agg(
        total.alias("rows_before"),
        passed.alias("passed"),
        (total - passed).alias("failed"),
        (F.count_distinct(key) + without).alias("rows_after"),
        F.count_if(F.col(key).isNull()).alias("without_key"),
    )


def flag_distribution(df: DataFrame) -> DataFrame:
    """How often each combination of flags occurs among the rows that failed."""
    return (
        df.filter(~F.col("dq_passed"))
        .groupBy("dq_flags")
        .agg(F.count(F.lit(1)).alias("orders"))
        .orderBy(F.desc("orders"), "dq_flags")
    )


def count_by(df: DataFrame, column: str, alias: str = "orders") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(alias)).orderBy(F.desc(alias), column)
