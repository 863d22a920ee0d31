"""Tables as parquet snapshots.

    <path>/snapshots/<folder>/...   one complete state of the table
    <path>/runs/<n>.json            one small file per finished write: folder, time, operation, rows

A write fills a fresh folder of its own and then adds its file to `runs`, which makes it visible. Readers of
an older snapshot are not disturbed, and a write that dies leaves the table as it was. Of two writers that
saw the same last state, the second to finish fails and changes nothing.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ordermill.operators.upsert import require_unique, upsert
from ordermill.session import COMPRESSED, freed_shuffles, slices
from ordermill.sources.buckets import has_even_buckets, read_bucketed, write_bucketed
from ordermill.sources.files import create_text, list_names, read_text

RUNS_SCHEMA = """
    version BIGINT, committed_at TIMESTAMP, operation STRING, parameters STRING, rows BIGINT,
    applied_through BIGINT"""


def _run(spark: SparkSession, path: str, name: str) -> dict:
    run = json.loads(read_text(spark, f"{path}/runs/{name}"))
    return {**run, "parameters": json.loads(run["parameters"])}


def latest_run(spark: SparkSession, path: str) -> dict | None:
    """The newest finished write, or None when there is none."""
    names = list_names(spark, f"{path}/runs")
    return _run(spark, path, names[-1]) if names else None


def runs_after(spark: SparkSession, path: str, number: int) -> list[dict]:
    """The finished writes after one, oldest first."""
    names = list_names(spark, f"{path}/runs")
    return [_run(spark, path, name) for name in names if int(name.partition(".")[0]) > number]


def table_exists(spark: SparkSession, path: str) -> bool:
    return latest_run(spark, path) is not None


def read_run(spark: SparkSession, path: str, run: dict) -> DataFrame:
    """The state that a write left, for callers that must go on reading what they saw."""
    folder, buckets = f"{path}/snapshots/{run['folder']}", run["parameters"].get("buckets")
    return read_bucketed(spark, folder, **buckets) if buckets else spark.read.parquet(folder)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current state of a table."""
    run = latest_run(spark, path)
    if run is None:
        raise FileNotFoundError(f"no table at {path}")
    return read_run(spark, path, run)


def row_count(spark: SparkSession, path: str) -> int:
    """Counted from the parquet footers; no column is read."""
    return read_table(spark, path).count()


def history(spark: SparkSession, path: str, n: int = 3) -> DataFrame:
    """The last n writes: version, time, operation, parameters, rows."""
    runs = spark.read.schema(RUNS_SCHEMA).json(f"{path}/runs")
    return runs.orderBy(F.desc("version")).limit(n)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = (),
    operation: str = "overwrite",
    parameters: dict | None = None,
    applied_through: int | None = None,
    folder: str | None = None,
    buckets: tuple[str, int] | None = None,
    slice_by: str | None = None,
    slice_share: float = 1,
) -> int:
    """Replace the table, schema included, and return the number of rows written.

    `folder` names the new snapshot for callers that leave something of the same name beside it; it must be unique.
    `buckets` (column, number) writes the rows bucketed and sorted by a column (see `buckets`); a column with a value too
    frequent for that is refused by writing the table without buckets.
    `slice_by` names the key that a large `df` is joined or grouped by: it is then written in slices of that key, so that its
    shuffles take the disk of a slice (see `session.slices`).
    `applied_through` is the last stream batch the new state holds; by default that of the state before.

    Partitioned writes are rebalanced first: small partitions get few files, and a partition that holds
    most of the rows is split over many tasks. Only adaptive execution does the splitting, so without it
    rows are written where they are.
    """
    spark = df.sparkSession
    last = latest_run(spark, path)
    version = 0 if last is None else last["version"] + 1
    if buckets and not has_even_buckets(df, *buckets):
        buckets = None
    folder = folder or f"{version:012d}-{uuid.uuid4().hex}"
    rows = 0
    for part in slices(df, slice_by, slice_share) if slice_by and not buckets else [df]:
        counted = Observation()
        out = part.observe(counted, F.count(F.lit(1)).alias("rows"))
        if partition_by and spark.conf.get("spark.sql.adaptive.enabled") == "true":
            out = out.hint("rebalance", *partition_by)
        if buckets:
            write_bucketed(out, f"{path}/snapshots/{folder}", *buckets)
        else:
            out.write.options(**COMPRESSED).mode("append").partitionBy(*partition_by).parquet(f"{path}/snapshots/{folder}")
        rows += counted.get["rows"]
    in_buckets = {"buckets": {"key": buckets[0], "number": buckets[1], "schema": df.schema.toDDL()}} if buckets else {}
    run = {
        "version": version,
        "folder": folder,
        "committed_at": dt.datetime.now(dt.timezone.utc).isoformat(),
        "operation": operation,
        "parameters": json.dumps({"partition_by": list(partition_by), **in_buckets, **(parameters or {})}),
        "rows": rows,
        "applied_through": -1 if last is None else last["applied_through"],
    }
    if applied_through is not None:
        run["applied_through"] = applied_through
    create_text(spark, f"{path}/runs/{version:012d}.json", json.dumps(run))
    return rows


def upsert_table(
    source: DataFrame,
    path: str,
    key: str,
    partition_by: tuple[str, ...] = (),
    known_unique: bool = False,
) -> int:
    """Update matched rows, insert the others; create the table when it is missing.

    The whole table is read and written, however few rows the source has: an upsert of one order takes nearly as
    long as building the table (6.9 s against 8.8 s at 150,000 orders on eight cores). Small frequent changes
    belong in the event path (`streaming.apply`), whose cost is that of the batch.

    `known_unique` skips the check that `source` holds each key once (it is deduplicated already).
    A row whose partition value changes moves, since the new snapshot is written as a whole.
    """
    spark = source.sparkSession
    with freed_shuffles(spark):
        if not table_exists(spark, path):
            return write_table(source, path, partition_by, "create", slice_by=key)
        if not known_unique:
            require_unique(source, key)
        merged = upsert(read_table(spark, path), source, key)
        return write_table(merged, path, partition_by, "merge", {"key": key}, slice_by=key)
