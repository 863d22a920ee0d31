"""The shape of the plans: what is read, what moves, what is never used."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as registry
from ordermill.plans import gold, pipeline, star
from ordermill.plans.silver import build_silver

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    return pipeline.refresh_silver(spark, star.raw_tables(spark, SF), root)


def test_silver_reads_only_what_it_needs(spark):
    text = plan(build_silver(star.raw_tables(spark, SF)))
    for column in ("l_quantity", "l_linestatus", "o_totalprice", "s_acctbal", "p_retailprice", "value"):
        assert not re.search(rf"ReadSchema: [^\n]*\b{column}:", text)


def test_silver_uses_one_partitioning(spark):
    """Without broadcasts every large input is shuffled once on the order, and no join shuffles again."""
    raw = star.raw_tables(spark, SF)
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(build_silver(raw))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
    assert text.count("Exchange hashpartitioning(order_id") <= 4
    assert text.count("SortMergeJoin [order_id") == 3


def test_kpis_read_few_columns_of_silver(silver):
    text = plan(gold.kpi_monthly(silver))
    assert "seller_states" not in text and "customer_id" not in text and "dq_flags" not in text
    assert text.count("FileScan") == 1
    assert plan(gold.kpi_nps(silver)).count("FileScan") == 1
    assert plan(gold.group_totals(silver)).count("FileScan") == 1


def test_state_kpis_read_delivered_orders_only(silver):
    text = plan(gold.kpi_seller_state(silver))
    assert re.search(r"PartitionFilters: \[[^\]]*order_status#\d+ = delivered", text)
    assert re.search(r"PushedFilters: \[[^\]]*IsNotNull\(seller_states\)", text)


def test_groups_are_combined_before_the_shuffle(silver):
    for build in gold.KPI_TABLES.values():
        text = plan(build(silver))
        assert "partial_sum" in text
        assert text.index("Exchange") < text.rindex("HashAggregate")


# Corpus operators have rules of their own; what else is left out returns what it has written.
@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry._QUERIES) - {
    "ingest_report", "csv_payments", "serving_export", "layer_report", "table_history", "stream_ingest",
    "stream_upsert", "stream_batch_mixed", "ingest_rejects"}))
def test_no_cross_joins_and_no_python_rows(spark, name):
    text = plan(registry.queries()[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython",
                     "ArrowEvalPython", "MapInPandas"):
        assert operator not in text
