"""Left join of a large fact side to a lookup side, safe for hot keys."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 10 * 1024 * 1024

# A key is hot when it holds more than this share of the facts, so at most 1/HOT_SHARE keys can be hot.
HOT_SHARE = 1 / 2000

# Sketches that the last task merges; each is merged from those of its share of the tasks.
SKETCH_GROUPS = 64


def input_bytes(df: DataFrame) -> int:
    """Size of everything `df` reads, by Catalyst's statistics. No job runs.

    Summed over the leaves of the plan: the estimate at the root multiplies the two sides of a join and
    calls a lookup table joined with another one huge.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves().iterator()
    total = 0
    while leaves.hasNext():
        total += int(str(leaves.next().stats().sizeInBytes()))
    return total


def stored_bytes(df: DataFrame) -> int:
    """Size of the files that `df` reads; files that it reads several times count once, other inputs not at all."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves().iterator()
    sizes = {}
    while leaves.hasNext():
        leaf = leaves.next()
        if leaf.getClass().getSimpleName() == "LogicalRelation" and hasattr(leaf.relation(), "location"):
            location = leaf.relation().location()
            sizes[location.rootPaths().toString()] = int(location.sizeInBytes())
    return sum(sizes.values())


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return input_bytes(df) <= limit


def lookup(
    facts: DataFrame,
    side: DataFrame,
    key: str,
    *,
    census: DataFrame | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """`facts` left join `side` on `key`.

    A side that reads at most `limit` bytes is broadcast. A larger one is joined by shuffle with the hot
    keys spread out. `census` may name a cheaper table with the same keys to count (an input of `facts`
    instead of `facts`).
    """
    if fits_broadcast(side, limit):
        return facts.join(F.broadcast(side), key, "left")
    return spread_join(facts, side, key, census=census)


def _tracked(share: float) -> int:
    """Keys that a sketch has to follow to name every key above `share` of all rows.

    A sketch of m slots (a power of two, three quarters of them used) misjudges a count by at most 3.5/m of the rows, and
    names a key whose count stands above that error for certain: any key above 7/m.
    """
    slots = 2 ** math.ceil(math.log2(7 / share))
    return slots * 3 // 4


def candidate_keys(census: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """At most some 10/share keys, among them every key above `share` of all rows, and null.

    Every task keeps a sketch of its frequent keys; the sketches are merged in two steps. What moves is a sketch
    per task, whatever the number of keys.
    """
    n = _tracked(share)
    task = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS))
    sketches = census.select(F.col(key).alias("k")).groupBy(task.alias("task"))
    parts = sketches.agg(F.expr(f"approx_top_k_accumulate(k, {n})").alias("sketch"))
    # Grouped by a constant, as a task without any sketch cannot merge.
    merged = parts.groupBy((F.col("task") * 0).alias("all")).agg(F.expr(f"approx_top_k_combine(sketch, {n})").alias("sketch"))
    found = merged.select(F.expr(f"approx_top_k_estimate(sketch, {n})").alias("found"))
    items = F.coalesce(F.transform("found", lambda f: f["item"]), F.array())
    nothing = F.array(F.lit(None).cast(census.schema[key].dataType))
    return found.select(F.explode(F.concat(items, nothing)).alias("_candidate"))


def hot_keys(census: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """Keys (null included) above `share` of all rows, with the number of buckets that evens them out.

    Exact, and part of the plan: candidates come from sketches, then just their rows are counted, tasks combining first.
    Keys are not shuffled otherwise. At most 1/share keys remain.
    """
    rows = census.agg(F.count(F.lit(1)).alias("rows")).scalar()
    # A number of candidates that depends on `share` alone.
    candidates = F.broadcast(candidate_keys(census, key, share))
    keys = census.select(F.col(key).alias("_hot_key"))
    named = keys.join(candidates, F.col("_hot_key").eqNullSafe(F.col("_candidate")), "left_semi")
    counts = named.groupBy("_hot_key").agg(F.count(F.lit(1)).alias("_n"))
    fair = rows * F.lit(share)
    hot = counts.filter(F.col("_n") > fair)
    return hot.select("_hot_key", F.ceil(F.col("_n") / fair).cast("int").alias("_buckets"))


def spread_join(
    facts: DataFrame,
    side: DataFrame,
    key: str,
    *,
    census: DataFrame | None = None,
    share: float = HOT_SHARE,
) -> DataFrame:
    """Shuffled left join whose hot keys are cut into buckets. No job runs before the result is used.

    A hot key gets as many buckets as it has fair shares of the rows. Its fact rows go to a bucket by a
    hash of the row and of the partition it was read in, so exact copies of one row spread as well. Both
    are the same when a lost task runs again. Its lookup rows are repeated once per bucket: at most
    2/share extra rows for a unique lookup key, whatever the data.
    """
    census = facts if census is None else census
    # At most 1/share rows, whatever the data.
    hot = F.broadcast(hot_keys(census, key, share))
    place = F.xxhash64(*facts.columns, F.spark_partition_id())
    # Only rows of hot keys are hashed.
    salt = F.when(F.col("_buckets").isNotNull(), F.pmod(place, F.col("_buckets"))).otherwise(F.lit(0).cast("bigint"))
    spread_facts = (
        facts.join(hot, F.col(key).eqNullSafe(F.col("_hot_key")), "left")
        .withColumn("_salt", salt)
        .drop("_hot_key", "_buckets")
    )
    last = F.coalesce(F.col("_buckets"), F.lit(1)).cast("bigint") - 1
    spread_side = (
        side.join(hot, F.col(key) == F.col("_hot_key"), "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
        .drop("_hot_key", "_buckets")
    )
    return spread_facts.join(spread_side, [key, "_salt"], "left").drop("_salt")
