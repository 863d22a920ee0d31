"""Parquet folders bucketed by a key, which joins and groupings on that key read without a shuffle.

Bucketing is known to Spark through its catalog only, so a folder is declared as an external table for the moment in which it
is written or opened; plans made from it keep the buckets, and no entry is left behind.

A bucket is read by one task, so a key that holds many rows cannot be spread. Such keys are looked for before
writing (`has_even_buckets`), and a table with one is better left unbucketed: its key is then combined before the
shuffle, as everywhere else.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.operators.lookup import input_bytes

BUCKET_BYTES = 128 * 1024 * 1024
# A key may fill this part of an average bucket.
KEY_SHARE = 0.5


def bucket_number(inputs: list[DataFrame], least: int) -> int:
    """Buckets for tables that are joined with each other: a common number, by the size of the largest."""
    size = max((input_bytes(df) for df in inputs), default=0)
    return max(least, math.ceil(size / BUCKET_BYTES))


def has_even_buckets(df: DataFrame, key: str, number: int) -> bool:
    """Whether no value of the key (null included) holds more than half an average bucket's rows."""
    if number <= 1:
        return False
    # One scan; tasks combine first, so a frequent key moves one row per task.
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    most, rows = counts.agg(F.max("n"), F.sum("n")).first()
    return rows is None or most <= rows * KEY_SHARE / number


def _table_name() -> str:
    return f"ordermill_buckets_{uuid.uuid4().hex}"


def write_bucketed(df: DataFrame, path: str, key: str, number: int) -> None:
    """One file a bucket, sorted by the key."""
    spark, name = df.sparkSession, _table_name()
    # Rows are dealt by the hash that buckets have, so that a task writes one bucket.
    dealt = df.repartition(number, key)
    try:
        dealt.write.bucketBy(number, key).sortBy(key).format("parquet").option("path", path).saveAsTable(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def read_bucketed(spark: SparkSession, path: str, key: str, number: int, schema: str) -> DataFrame:
    name, place = _table_name(), path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
        f"INTO {int(number)} BUCKETS LOCATION '{place}'"
    )
    try:
        return spark.table(name).select(F.expr("*"))
    finally:
        spark.sql(f"DROP TABLE {name}")
