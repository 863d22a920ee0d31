"""Gold by difference: KPI tables kept current from the changed orders alone.

All KPI figures are made of sums and counts per group (`gold.group_totals`), which are exact whole numbers and decimals.
So a group that loses an order subtracts what that order had added, and one that gains it adds the new values:

    Silver write n leaves a change set beside the table: rows taken away (-1) and rows put in their place (+1)
    totals after write n  =  totals before it  +  signed totals of the change set, per group

A refresh reads the change sets since its totals were written, not Silver. Groups without rows go. Totals remember the
Silver write they stand for; where they are missing, were made of other rows (`only_passed`), or Silver was written
without a change set since, they are computed from all of Silver once.

    <root>/silver/orders            the table, see ordermill.sources.tables
    <root>/silver/order_changes/<folder of the snapshot>   its change set
    <root>/gold/group_totals        totals per KPI table and group
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions import measures as m
from ordermill.operators.upsert import require_unique, with_own_columns
from ordermill.plans.gold import group_totals, kpi_tables, passed_only
from ordermill.plans.silver import PARTITION_COLUMN
from ordermill.session import COMPRESSED, freed_shuffles, scratch_dir, slices
from ordermill.sources.files import delete_folder
from ordermill.sources.tables import (
    latest_run,
    read_run,
    read_table,
    runs_after,
    write_table,
)

SIGN = "_sign"
# What group totals and their groups are made of; change sets hold nothing else.
CHANGE_COLUMNS = (
    "order_id", "order_status", "order_purchase_ts", "categories", "seller_states", "is_delivered", "is_canceled",
    "is_late_delivery", "dq_passed", *m.PLAIN_SUMS,
)
GROUP = ("table", "item")


def change_set(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows taken away and rows put in their place; a row that stays the same is in neither."""
    gone = before.select(*CHANGE_COLUMNS, F.lit(-1).alias(SIGN))
    return gone.unionByName(after.select(*CHANGE_COLUMNS, F.lit(1).alias(SIGN)))


def _with_columns(df: DataFrame, like: DataFrame) -> DataFrame:
    """With the columns it lacks, as nulls of the other's type."""
    kinds = dict(like.dtypes)
    lacking = [c for c in CHANGE_COLUMNS if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast(kinds[c]) for c in lacking}) if lacking else df


def upsert_orders(
    source: DataFrame, root: str, deleted: DataFrame | None = None, known_unique: bool = False
) -> int:
    """Update or insert the orders of `source` in Silver, remove those whose ids are in `deleted`, and leave a change set.

    The ids of a batch are looked up in the old state, which is read for the new snapshot anyway; the change set is as
    large as the batch. An id in both is removed. Returns the number of rows of the new state.
    """
    spark, path, key = source.sparkSession, f"{root}/silver/orders", "order_id"
    run = latest_run(spark, path)
    with freed_shuffles(spark):
        if run is None and known_unique:
            return _upsert(source, path, root, run, deleted, known_unique)
        # Read more than once below, so it is computed once.
        batch = scratch_dir(spark, "order-updates")
        for part in slices(source, key):
            part.write.options(**COMPRESSED).mode("append").parquet(batch)
        rows = _upsert(spark.read.schema(source.schema).parquet(batch), path, root, run, deleted, known_unique)
        delete_folder(spark, batch)
        return rows


def _upsert(source: DataFrame, path: str, root: str, run: dict | None, deleted: DataFrame | None, known_unique: bool) -> int:
    spark, key = source.sparkSession, "order_id"
    if not known_unique:
        require_unique(source, key)
    gone = None if deleted is None else deleted.select(key).filter(f"{key} IS NOT NULL").distinct()
    if gone is not None:
        source = source.join(gone, key, "left_anti")
    if run is None:
        return write_table(source, path, (PARTITION_COLUMN,), "create", slice_by=key)
    old = read_run(spark, path, run)
    touched = source.select(key).filter(f"{key} IS NOT NULL")
    touched = touched if gone is None else touched.unionByName(gone).distinct()
    before = old.join(touched, key, "left_semi")
    # Columns that only Silver has are taken over from the row before, as in the new state.
    after = with_own_columns(before, source, key)
    folder = f"{run['version'] + 1:012d}-{uuid.uuid4().hex}"
    changes = change_set(_with_columns(before, after), _with_columns(after, before))
    for part in slices(changes, key):
        part.write.options(**COMPRESSED).mode("append").parquet(f"{root}/silver/order_changes/{folder}")
    # One join for rows that were replaced and rows that go.
    merged = after.unionByName(old.join(touched, key, "left_anti"), allowMissingColumns=True)
    return write_table(merged, path, (PARTITION_COLUMN,), "merge", {"key": key, "changes": folder}, folder=folder, slice_by=key)


def pending_changes(spark: SparkSession, root: str, since: int) -> tuple[DataFrame | None, int] | None:
    """The change sets of the Silver writes after number `since` and the last number; None where a write left none."""
    runs = runs_after(spark, f"{root}/silver/orders", since)
    folders = [run["parameters"].get("changes") for run in runs]
    if not all(folders):
        return None
    paths = [f"{root}/silver/order_changes/{folder}" for folder in folders]
    changes = [spark.read.parquet(path) for path in paths]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), changes) if changes else None
    return merged, since + len(runs)


def signed_totals(changes: DataFrame) -> DataFrame:
    """What the rows of a change set add to the totals of their groups, or take from them."""
    return group_totals(changes, SIGN)


def add_totals(totals: DataFrame, more: DataFrame) -> DataFrame:
    """Totals of both, per group; groups without rows are left out."""
    measures = [c for c in totals.columns if c not in GROUP]
    kinds = dict(totals.dtypes)
    added = totals.unionByName(more).groupBy(*GROUP)
    sums = added.agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in measures])
    # The sum of no values is null, also where values were taken out again.
    known = [F.when(F.col(m.COUNTED[c]) != 0, F.col(c)).alias(c) if c in m.COUNTED else F.col(c) for c in measures]
    return sums.filter("rows <> 0").select(*GROUP, *known)


def refresh_totals(spark: SparkSession, root: str, only_passed: bool = False) -> str:
    """Bring `gold/group_totals` up to Silver; returns "unchanged", "difference" or "full"."""
    path, silver = f"{root}/gold/group_totals", latest_run(spark, f"{root}/silver/orders")
    if silver is None:
        raise FileNotFoundError(f"no table at {root}/silver/orders")
    last = latest_run(spark, path)
    known = {} if last is None else last["parameters"]
    pending = None
    if known.get("silver_version") is not None and known.get("only_passed") == only_passed:
        pending = pending_changes(spark, root, known["silver_version"])
    if pending is None:
        totals, version, how = group_totals(passed_only(read_run(spark, f"{root}/silver/orders", silver), only_passed)), silver["version"], "full"
    else:
        changes, version = pending
        if changes is None:
            return "unchanged"
        totals, how = add_totals(read_table(spark, path), signed_totals(passed_only(changes, only_passed))), "difference"
    write_table(totals, path, (), how, {"silver_version": version, "only_passed": only_passed})
    return how


def refresh_gold(spark: SparkSession, root: str, only_passed: bool = False) -> dict[str, DataFrame]:
    """The KPI tables, written from totals that only the changed orders were read for."""
    refresh_totals(spark, root, only_passed)
    return kpi_tables(read_table(spark, f"{root}/gold/group_totals"))
