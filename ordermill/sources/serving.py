"""Serving layer: the KPI tables as CSV files under a fixed column contract."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.jobs import run_all
from ordermill.schemas import SERVING_CONTRACT, SERVING_ORDER
from ordermill.sources.files import create_text, file_inventory, list_names, move_single_part, read_text
from ordermill.sources.raw import row_counts


def to_contract(df: DataFrame, name: str) -> DataFrame:
    """Columns in contract order and type; a missing column is an error, extra ones are left out."""
    fields = T.StructType.fromDDL(SERVING_CONTRACT[name]).fields
    missing = [f.name for f in fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks contract columns: {', '.join(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType) for f in fields])


def _as_text(field: T.StructField) -> Column:
    """Timestamps as text. Doubles with all their digits and without an exponent: 10017536.0, 12.5."""
    column = F.col(field.name)
    if isinstance(field.dataType, T.DoubleType):
        fixed = column.cast("string").cast("decimal(38,18)").cast("string")
        return F.regexp_replace(fixed, r"(\.\d+?)0+$", "$1").alias(field.name)
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return column.cast("string").alias(field.name)
    return column


def export_table(df: DataFrame, name: str, folder: str) -> str:
    """Write one KPI table as `<folder>/<name>.csv`. It has one row per month, score, category or
    state, so a single sorted file is right; the aggregation before it stays parallel."""
    table = to_contract(df, name)
    order = [F.col(c).desc() if way == "desc" else F.col(c).asc() for c, way in SERVING_ORDER[name]]
    single = table.repartition(1)
    if order:
        single = single.sortWithinPartitions(*order)
    staged = f"{folder}/staged_{name}"
    text = single.select(*[_as_text(f) for f in table.schema.fields])
    text.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(staged)
    move_single_part(df.sparkSession, staged, f"{folder}/{name}.csv")
    return f"{folder}/{name}.csv"


def current_set(spark: SparkSession, folder: str) -> str:
    """The folder of the files that were made visible last."""
    names = list_names(spark, f"{folder}/published")
    if not names:
        raise FileNotFoundError(f"nothing was exported to {folder}")
    return f"{folder}/sets/{json.loads(read_text(spark, f'{folder}/published/{names[-1]}'))['set']}"


def export_all(tables: Mapping[str, DataFrame], folder: str) -> list[str]:
    """Export all tables as one set of files that becomes visible in one step.

        <folder>/sets/<id>/<name>.csv     the files of one export
        <folder>/published/<n>.json       names the set to read; the last one counts

    The files are written side by side into a set of their own; a table that fails stops the others, and readers
    keep the set they had. Older sets stay until someone removes them.
    """
    spark = next(iter(tables.values())).sparkSession
    number = uuid.uuid4().hex
    staged = f"{folder}/sets/{number}"
    tasks = {name: lambda df=df, name=name: export_table(df, name, staged) for name, df in tables.items()}
    files = run_all(spark, tasks)
    names = list_names(spark, f"{folder}/published")
    last = int(names[-1].partition(".")[0]) + 1 if names else 0
    create_text(spark, f"{folder}/published/{last:012d}.json", json.dumps({"set": number, "files": sorted(tables)}))
    return list(files.values())


def read_serving(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The exported tables by name, with the contract types (months stay text), all of one export."""
    files = current_set(spark, folder)
    return {
        name: spark.read.schema(ddl).option("header", True).csv(f"{files}/{name}.csv")
        for name, ddl in SERVING_CONTRACT.items()
    }


def export_report(spark: SparkSession, folder: str) -> DataFrame:
    """File name, size and rows of every exported table."""
    counts = row_counts(read_serving(spark, folder)).select(
        F.concat("table_name", F.lit(".csv")).alias("file_name"), "rows"
    )
    return file_inventory(spark, f"{current_set(spark, folder)}/*.csv").join(F.broadcast(counts), "file_name")
