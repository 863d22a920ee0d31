"""One row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], newest_by: list[str]) -> DataFrame:
    """The row with the greatest `newest_by` per key; rows with a null key form one group.

    All other columns break ties, so the result is the same on every run. Row number = 1 lets Spark cut
    every key to one row per task before the shuffle, so a key with very many rows is harmless.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest_by]
    newest_first = [F.col(c).desc() for c in [*newest_by, *rest]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
