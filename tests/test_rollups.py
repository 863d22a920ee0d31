from __future__ import annotations

import pytest
from published import (
    CATEGORIES, CATEGORY_COLUMNS, MONTH_COLUMNS, MONTHS, OTIF, STATE_COLUMNS, STATES, TOTAL_DELIVERED,
)
from pyspark.sql import functions as F

from ordermill.functions import labels
from ordermill.plans import questions, rollups


@pytest.fixture
def monthly(spark):
    return spark.createDataFrame(MONTHS, MONTH_COLUMNS)


@pytest.fixture
def states(spark):
    return spark.createDataFrame(STATES, STATE_COLUMNS)


@pytest.fixture
def categories(spark):
    return spark.createDataFrame(CATEGORIES, CATEGORY_COLUMNS)


def test_thin_months_are_left_out(monthly):
    assert rollups.active_months(monthly).count() == 21
    assert rollups.active_months(monthly, "2018").count() == 8
    assert rollups.active_months(monthly, "2016").first()["order_month"] == "2016-10"


def test_year_kpis(monthly, rows):
    got = {
        r["year"]: (r["orders"], round(r["revenue_brl"], 2), round(r["otif_rate_pct"], 4),
                    round(r["avg_review_score"], 4))
        for r in rollups.year_kpis(monthly).collect()
    }
    assert got == {
        "2016": (324, 59090.48, 99.25, 3.56),
        "2017": (45101, 7249746.73, 94.3598, 4.0870),
        "2018": (53991, 8694733.84, 92.2531, 4.0892),
    }


def test_weighted_mean_of_nothing_is_zero(spark):
    from ordermill.functions.measures import weighted_mean

    df = spark.createDataFrame([(1.0, 0), (None, 0)], "v DOUBLE, w BIGINT")
    assert df.agg(weighted_mean("v", "w")).first()[0] == 0.0
    df = spark.createDataFrame([(4.0, 1), (None, 3)], "v DOUBLE, w BIGINT")
    assert df.agg(weighted_mean("v", "w")).first()[0] == 1.0


def test_top_categories(categories):
    got = rollups.top_categories(categories).collect()
    assert [r["category"] for r in got] == [c for c, _ in CATEGORIES[:10]]


def test_category_card(spark):
    df = spark.createDataFrame(
        [("toys", 3, 1.0, 90.0, 4.0), ("la_cuisine", 1, 2.0, 80.0, 5.0)],
        "category STRING, orders BIGINT, revenue_brl DOUBLE, otif_rate_pct DOUBLE, avg_review_score DOUBLE",
    )
    assert tuple(rollups.category_card(df, "toys").first()) == ("toys", "Toys", 3, 1.0, 90.0, 4.0)
    assert rollups.category_card(df, "la_cuisine").first()["label"] == "la_cuisine"
    assert rollups.category_card(df, "none").count() == 0


def bins(regions, states, metric="otif"):
    return {r["seller_state"]: r["bin"] for r in rollups.state_metric_bins(regions, states, metric).collect()}


def test_bins_of_the_map(spark, states):
    regions = rollups.region_list(spark)
    got = bins(regions, states)
    assert len(got) == 26
    assert {s: got[s] for s in ("SP", "MG", "PR", "RJ", "SC", "RS")} == {
        "SP": 3, "MG": 4, "PR": 4, "RJ": 3, "SC": 4, "RS": 4}
    assert got["AM"] == 0 and got["PA"] == 4
    assert got["AP"] is None
    assert rollups.state_coverage(regions, states).filter("orders IS NULL").count() == 26 - 21
    assert tuple(rollups.metric_range(states, "otif_rate_pct").first()) == (66.67, 100.0)
    assert bins(regions, states, "delivery")["AM"] == 4
    assert bins(regions, states, "score")["AM"] == 0


def test_bins_of_equal_or_missing_values(spark):
    regions = spark.createDataFrame([("SP",), ("RJ",), ("MG",)], "seller_state STRING")
    same = spark.createDataFrame([("SP", 90.0), ("RJ", 90.0), ("MG", None)], "seller_state STRING, otif_rate_pct DOUBLE")
    assert bins(regions, same) == {"SP": 0, "RJ": 0, "MG": None}


def test_questions(spark, monthly, states, categories):
    total = spark.createDataFrame([(TOTAL_DELIVERED, OTIF)], "total_delivered BIGINT, otif_rate_pct DOUBLE")
    tables = {"kpi_monthly": monthly, "kpi_seller_state": states, "kpi_category": categories, "kpi_global": total}

    def answer(name):
        return [tuple(r) for r in questions.ask(spark, name, tables).collect()]

    assert answer("ask_top_category") == [("health_beauty", 1448729.73)]
    assert answer("ask_otif_by_year") == [(2016, 66.42), (2017, 95.24), (2018, 92.43)]
    assert answer("ask_best_state") == [("PA", 4.5)]
    assert [m for m, _ in answer("ask_top_months")] == ["2017-11", "2018-01", "2018-03", "2018-04", "2018-05"]
    assert answer("ask_worst_month") == [("2018-08", 84)]
    assert answer("ask_late_orders") == [(6532,)]


def test_free_sql_over_views(spark, monthly):
    questions.register_views({"kpi_monthly": monthly})
    got = questions.ask_sql(spark, "SELECT order_month FROM kpi_monthly ORDER BY order_month")
    assert got.count() == 25 and got.first()[0] == "2016-09"
    assert questions.ask_sql(spark, "SELECT * FROM kpi_monthly", limit=3).count() == 3


def test_labels(spark):
    def one(column):
        return spark.range(1).select(column).first()[0]

    def month(text):
        return one(labels.month_label(F.lit(text)))

    assert [month(m) for m in ("2017-01", "2018-12", "2017-08")] == ["Ene-17", "Dic-18", "Ago-17"]
    assert month("2017-13") is None and month("2017-00") is None and month("none") is None
    amounts = {590.0: "R$590", 198.5: "R$199", 999.99: "R$1000", 1000.0: "R$1K", 291908.01: "R$292K",
               1448729.73: "R$1.4M", 16008872.12: "R$16.0M", 0.0: "R$0"}
    assert {a: one(labels.compact_money(F.lit(a))) for a in amounts} == amounts
    assert one(labels.compact_money(F.lit(None).cast("double"))) is None
    assert one(labels.category_label(F.lit("computers_accessories"))) == "Computers & Acc"
    assert one(labels.category_label(F.lit("la_cuisine"))) == "la_cuisine"
