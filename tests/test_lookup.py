from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ordermill.operators import lookup as lk


@pytest.fixture
def skewed(spark):
    """A third of the rows on one key, some without a key, some without a partner."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit(7)).when(n % 50 == 1, None).otherwise(n % 997)
    facts = spark.range(30_000).select(n.alias("row"), key.cast("bigint").alias("k"))
    side = spark.range(900).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    return facts, side


def test_size_decides(spark, skewed):
    _, side = skewed
    assert lk.fits_broadcast(side)
    assert not lk.fits_broadcast(side, limit=0)


def test_size_counts_every_input(spark, tmp_path):
    spark.range(50_000).write.parquet(f"{tmp_path}/big")
    spark.range(10).write.parquet(f"{tmp_path}/small")
    big, small = spark.read.parquet(f"{tmp_path}/big"), spark.read.parquet(f"{tmp_path}/small")
    both = lk.input_bytes(big.join(small, "id", "left"))
    assert both == lk.input_bytes(big) + lk.input_bytes(small)


def test_spread_join_equals_left_join(skewed, rows):
    facts, side = skewed
    want = rows(facts.join(side, "k", "left").select("row", "k", "v"))
    assert rows(lk.spread_join(facts, side, "k").select("row", "k", "v")) == want
    assert rows(lk.lookup(facts, side, "k", limit=-1).select("row", "k", "v")) == want
    assert rows(lk.lookup(facts, side, "k").select("row", "k", "v")) == want


def test_spread_join_keeps_repeated_partners(spark, skewed, rows):
    facts, side = skewed
    twice = side.unionByName(side.withColumn("v", F.concat("v", F.lit("b"))))
    want = rows(facts.join(twice, "k", "left").select("row", "k", "v"))
    assert rows(lk.spread_join(facts, twice, "k").select("row", "k", "v")) == want


def test_hot_keys_are_few_and_get_their_share(skewed):
    facts, _ = skewed
    hot = dict(lk.hot_keys(facts, "k", share=0.01).collect())
    assert set(hot) == {7, None}
    assert hot[7] >= 33
    assert lk.hot_keys(facts, "k", share=1 / 2000).count() <= 2000
    text = facts.select(F.col("k").cast("string"))
    assert set(dict(lk.hot_keys(text, "k", share=0.01).collect())) == {"7", None}


def test_even_keys_are_joined_plainly(spark):
    facts = spark.range(40_000).select((F.col("id") % 20_000).alias("k"))
    assert lk.hot_keys(facts, "k").collect() == []
    assert lk.spread_join(facts, facts.distinct(), "k").count() == 40_000
    empty = facts.limit(0)
    assert lk.hot_keys(empty, "k").collect() == [] and lk.spread_join(empty, facts, "k").count() == 0


def test_only_counts_meet_in_one_task(skewed):
    facts, side = skewed
    plan = lk.spread_join(facts, side, "k")._jdf.queryExecution().toString()
    assert "collect_" not in plan


def test_hot_key_does_not_fill_one_partition(spark, skewed):
    facts, side = skewed
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
           "spark.sql.shuffle.partitions": "16"}
    saved = {key: spark.conf.get(key) for key in off}
    try:
        for key, value in off.items():
            spark.conf.set(key, value)

        def largest(joined):
            parts = joined.groupBy(F.spark_partition_id().alias("p")).count()
            return parts.agg(F.max("count")).first()[0]

        assert largest(facts.join(side, "k", "left")) > 10_000
        assert largest(lk.spread_join(facts, side, "k")) < 2 * 30_000 / 16
        # The same when the hot rows are copies of one row.
        copies = facts.select("k", F.when(F.col("k") == 7, 0).otherwise(F.col("row")).alias("row"))
        copies = copies.repartition(64, F.col("row") % 8, F.rand(1))
        assert copies.groupBy("k", "row").count().agg(F.max("count")).first()[0] > 10_000
        assert largest(lk.spread_join(copies, side, "k")) < 4 * 30_000 / 16
    finally:
        for key, value in saved.items():
            spark.conf.set(key, value)


def test_no_hot_key_is_missed_among_many(spark):
    """Keys just above the share, in tasks that see millions of others or nothing else."""
    n, share = F.col("id"), 1 / 200
    rare = spark.range(200_000).select((n + 1000).alias("k"))
    hot = spark.range(30 * 1200).select((n % 30).alias("k"))
    facts = rare.unionByName(hot.coalesce(1)).unionByName(spark.range(1500).select(F.lit(None).cast("long").alias("k")))
    want = {r["k"] for r in facts.groupBy("k").count().filter(F.col("count") > facts.count() * share).collect()}
    assert want == {*range(30), None}
    assert set(dict(lk.hot_keys(facts, "k", share).collect())) == want


def test_keys_are_not_shuffled_to_find_hot_ones(spark, skewed):
    """What moves is sketches, and rows per candidate and task."""
    facts, _ = skewed
    plan = lk.hot_keys(facts, "k")._jdf.queryExecution().executedPlan().toString()
    assert "approx_top_k_accumulate" in plan
    text = facts.select(F.col("k").cast("string"))
    assert lk.candidate_keys(text, "k", 0.01).count() <= 1500


def test_keys_that_are_all_missing_or_all_one(spark, rows):
    for key in (None, 5):
        facts = spark.range(100).select(F.lit(key).cast("long").alias("k"), F.col("id").alias("row"))
        assert [r["_hot_key"] for r in lk.hot_keys(facts, "k").collect()] == [key]
        side = spark.createDataFrame([(5, "v")], "k long, v string")
        assert rows(lk.spread_join(facts, side, "k").select("row", "k", "v")) == rows(facts.join(side, "k", "left").select("row", "k", "v"))
