"""Tables stored by order, and the plans that read them."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from ordermill.plans import pipeline, star
from ordermill.plans.silver import enrich_orders
from ordermill.sources import buckets, tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark):
    return star.raw_tables(spark, SF)


def content(df):
    return sorted(map(repr, df.drop("bronze_ingested_at").collect()))


def test_orders_are_enriched_without_a_shuffle(spark, raw, tmp_path):
    stored = pipeline.store_by_order(spark, raw, str(tmp_path))
    small = {n: df for n, df in raw.items() if n not in stored}
    enriched = enrich_orders({**small, **stored})
    plan = enriched._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Bucketed: true") == 4
    over_orders = plan[: plan.index("BroadcastExchange")]
    assert "Exchange hashpartitioning(order_id" not in plan and "hashpartitioning" not in over_orders
    assert content(enriched) == content(enrich_orders(raw))


def test_the_unbucketed_plan_has_shuffles_by_order(raw):
    plan = enrich_orders(raw)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\((?:order_id|o_orderkey|l_orderkey)", plan)) >= 3


def test_a_bucketed_table_is_replaced_and_leaves_no_entry_in_the_catalog(spark, tmp_path, rows):
    path, before = f"{tmp_path}/it's/t", {t.name for t in spark.catalog.listTables()}
    frame = spark.range(1000).select("id", (F.col("id") % 7).alias("n"))
    assert tables.write_table(frame, path, buckets=("id", 4)) == 1000
    first = tables.read_table(spark, path)
    assert tables.write_table(frame.limit(10), path, buckets=("id", 4)) == 10
    assert tables.read_table(spark, path).count() == 10 and first.count() == 1000
    assert first.agg(F.sum("n"), F.sum("id")).first() == frame.agg(F.sum("n"), F.sum("id")).first()
    assert {t.name for t in spark.catalog.listTables()} == before
    assert tables.latest_run(spark, path)["parameters"]["buckets"]["number"] == 4


def test_tables_with_a_hot_key_are_not_bucketed(spark, tmp_path):
    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"))
    assert not buckets.has_even_buckets(hot, "k", 8)
    assert not buckets.has_even_buckets(hot.select(F.when(F.col("k") != 1, F.col("k")).alias("k")), "k", 8)
    assert buckets.has_even_buckets(spark.range(3000), "id", 8)
    tables.write_table(hot, f"{tmp_path}/t", buckets=("k", 8))
    assert "buckets" not in tables.latest_run(spark, f"{tmp_path}/t")["parameters"]
    assert tables.read_table(spark, f"{tmp_path}/t").count() == 3000


def test_empty_and_null_keys(spark, tmp_path, rows):
    frame = spark.createDataFrame([(None, 1), (2, 2), (None, 3)], "k INT, v INT")
    buckets.write_bucketed(frame, f"{tmp_path}/n", "k", 3)
    assert rows(buckets.read_bucketed(spark, f"{tmp_path}/n", "k", 3, "k INT, v INT")) == rows(frame)
    tables.write_table(frame.limit(0), f"{tmp_path}/e", buckets=("k", 3))
    assert tables.read_table(spark, f"{tmp_path}/e").count() == 0


def test_the_search_for_hot_keys_reads_its_input_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(k):
        read.add(1)
        return k

    assert buckets.has_even_buckets(spark.range(3000).select(counted("id").alias("k")), "k", 8)
    assert read.value == 3000
