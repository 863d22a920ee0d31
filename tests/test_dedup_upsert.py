from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ordermill.operators.dedup import latest_per_key
from ordermill.operators.upsert import repeated_keys, require_unique, upsert


def test_latest_per_key(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "x"), ("b", 1, "z"), ("c", None, "q"), ("c", 0, "p"),
         (None, 1, "m"), (None, 2, "n")],
        "k STRING, at INT, v STRING",
    )
    want = [("a", 2, "y"), ("b", 1, "z"), ("c", 0, "p"), (None, 2, "n")]
    assert rows(latest_per_key(df, ["k"], ["at"])) == want
    assert rows(latest_per_key(df.repartition(7), ["k"], ["at"])) == want


def test_latest_per_key_cuts_hot_keys_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = latest_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


TARGET = [("a", "old", 1), ("b", "old", 2), (None, "old", 3)]


def target(spark):
    return spark.createDataFrame(TARGET, "k STRING, v STRING, kept INT")


def test_upsert_updates_and_inserts(spark, rows):
    source = spark.createDataFrame([("b", "new", 9), ("c", "new", 8), (None, "new", 7)], "k STRING, v STRING, kept INT")
    assert rows(upsert(target(spark), source, "k")) == sorted(
        [("a", "old", 1), ("b", "new", 9), ("c", "new", 8), (None, "new", 7), (None, "old", 3)], key=repr
    )


def test_upsert_evolves_columns(spark, rows):
    source = spark.createDataFrame([("b", "new", "x"), ("c", "new", "y")], "k STRING, v STRING, extra STRING")
    got = upsert(target(spark), source, "k")
    assert rows(got, "k", "v", "kept", "extra") == sorted(
        [("a", "old", 1, None), ("b", "new", 2, "x"), ("c", "new", None, "y"), (None, "old", 3, None)],
        key=repr,
    )


def test_upsert_twice_is_upsert_once(spark, rows):
    source = spark.createDataFrame([("b", "new", 9), ("c", "new", 8)], "k STRING, v STRING, kept INT")
    once = upsert(target(spark), source, "k")
    assert rows(upsert(once, source, "k")) == rows(once)


def test_repeated_source_key_is_refused(spark, rows):
    source = spark.createDataFrame([("b", 1), ("b", 2), ("c", 1), (None, 1), (None, 2)], "k STRING, v INT")
    assert rows(repeated_keys(source, "k")) == [("b", 2)]
    with pytest.raises(ValueError, match="'b' occurs 2 times"):
        require_unique(source, "k")


def test_small_source_does_not_shuffle_the_target(spark, tmp_path):
    spark.range(1000).withColumn("v", F.lit("x")).write.parquet(f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    spark.range(5).withColumn("v", F.lit("y")).write.parquet(f"{tmp_path}/s")
    merged = upsert(stored, spark.read.parquet(f"{tmp_path}/s"), "id")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
