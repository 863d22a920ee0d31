"""Key-based upsert as a DataFrame operator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """`target` after updating the rows matched by `source` and inserting the others.

    `source` holds each non-null key once (see `repeated_keys`). Null keys never match, so such rows are
    kept on the target side and inserted from the source side. Columns only the target has keep their
    old value on matched rows; columns only the source has are null on rows it does not touch.

    The target is read by an anti join (and, only when it has columns of its own, a semi join) against
    the keys of the source. While Spark finds those small enough to broadcast, the target is not shuffled.
    """
    keys = source.select(key).filter(F.col(key).isNotNull())
    untouched = target.join(keys, key, "left_anti")
    return with_own_columns(target, source, key).unionByName(untouched, allowMissingColumns=True)


def with_own_columns(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """`source` with the columns that only the target has, from the row of the same key."""
    own = [c for c in target.columns if c not in source.columns]
    if not own:
        return source
    keys = source.select(key).filter(F.col(key).isNotNull())
    kept = target.join(keys, key, "left_semi").select(key, *own)
    return source.join(kept, key, "left")


def repeated_keys(source: DataFrame, key: str) -> DataFrame:
    """Keys that would match a target row more than once."""
    return (
        source.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > 1)
    )


def require_unique(source: DataFrame, key: str) -> None:
    """Fail, as a merge would, when the source is not unique on its key."""
    worst = repeated_keys(source, key).take(1)
    if worst:
        raise ValueError(f"source is not unique on {key}: {worst[0][0]!r} occurs {worst[0][1]} times")
