"""Example questions over the five KPI tables, as SQL on temporary views of the same names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Ties are broken by name, so an answer is the same on every run.
QUESTIONS = {
    "ask_top_category": """
        SELECT category, revenue_brl FROM {kpi_category}
        ORDER BY revenue_brl DESC, category LIMIT 1""",
    "ask_otif_by_year": """
        SELECT CAST(LEFT(order_month, 4) AS INT) AS year, ROUND(AVG(otif_rate_pct), 2) AS avg_otif_pct
        FROM {kpi_monthly} GROUP BY CAST(LEFT(order_month, 4) AS INT) ORDER BY year""",
    "ask_best_state": """
        SELECT seller_state, avg_review_score FROM {kpi_seller_state}
        ORDER BY avg_review_score DESC, seller_state LIMIT 1""",
    "ask_top_months": """
        SELECT order_month, orders FROM {kpi_monthly}
        ORDER BY orders DESC, order_month LIMIT 5""",
    "ask_worst_month": """
        SELECT order_month, canceled FROM {kpi_monthly}
        ORDER BY canceled DESC, order_month LIMIT 1""",
    "ask_late_orders": """
        SELECT CAST(ROUND(total_delivered * (1 - otif_rate_pct / 100)) AS BIGINT) AS late_orders
        FROM {kpi_global}""",
}


def ask(spark: SparkSession, name: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Answer one of QUESTIONS; `tables` holds the KPI tables by name."""
    used = {t: df for t, df in tables.items() if "{" + t + "}" in QUESTIONS[name]}
    return spark.sql(QUESTIONS[name], **used)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make the KPI tables available to any SQL text under their own names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def ask_sql(spark: SparkSession, text: str, limit: int | None = None) -> DataFrame:
    """Run the user's own SQL over the registered views; all its rows, unless a limit is given."""
    answer = spark.sql(text)
    return answer if limit is None else answer.limit(limit)
