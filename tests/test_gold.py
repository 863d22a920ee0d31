from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest

from ordermill.plans import gold

SILVER = """order_id STRING, order_status STRING, order_purchase_ts TIMESTAMP, categories ARRAY<STRING>,
    seller_states ARRAY<STRING>, payment_value DECIMAL(28,4), review_score FLOAT,
    delivery_days_actual INT, delivery_days_estimated INT, delivery_delay_days INT, is_delivered BOOLEAN,
    is_canceled BOOLEAN, is_late_delivery BOOLEAN, freight_ratio DOUBLE, dq_passed BOOLEAN"""


def row(order_id, status, month, cats, states, paid=None, score=None, days=None, est=None, delay=None,
        ratio=None, passed=True):
    at = None if month is None else dt.datetime(2020, month, 15)
    delivered, canceled = (None, None) if status is None else (status == "delivered", status == "canceled")
    late = bool(delivered and delay is not None and delay > 0)
    paid = None if paid is None else D(paid)
    return (order_id, status, at, cats, states, paid, score, days, est, delay, delivered, canceled, late,
            ratio, passed)


ROWS = [
    row("a", "delivered", 1, ["toys", "auto"], ["SP"], "100.00", 5.0, 10, 12, -2, 0.1),
    row("b", "delivered", 1, ["toys"], ["SP", "RJ"], "50.50", 1.0, 20, 15, 5, 0.3, passed=False),
    row("c", "delivered", 1, ["auto"], ["RJ"], None, None, None, 9, None),
    row("d", "canceled", 2, ["toys"], ["SP"], "10.00", 3.0),
    row("e", "shipped", 2, [], [], "7.00", None),
    row("f", None, 2, None, None, "1.00", 6.0),
    row("g", "delivered", None, [None, "toys"], [None], "2.00", 5.0, 1, 1, 0),
]


@pytest.fixture
def silver(spark):
    return spark.createDataFrame(ROWS, SILVER)


@pytest.fixture(params=["one by one", "one scan"])
def kpis(request, silver):
    if request.param == "one scan":
        return gold.kpi_tables(gold.group_totals(silver))
    return {name: build(silver) for name, build in gold.KPI_TABLES.items()}


def test_global(kpis):
    got = kpis["kpi_global"].drop("gold_computed_at").first()
    # c has no delivery date and counts as on time: 3 of 4.
    assert tuple(got) == (7, 4, 1, 75.0, 10.3, 9.3, 1.0, 170.5, 28.42, 4.0, 20.0)


def test_monthly(kpis, rows):
    got = {r["order_month"]: tuple(r)[1:] for r in kpis["kpi_monthly"].collect()}
    assert got == {
        "2020-01": (3, 3, 0, 66.67, 15.0, 1.5, 150.5, 3.0, 0.0),
        # Nothing delivered: no rate, no days.
        "2020-02": (3, 0, 1, None, None, None, 18.0, 4.5, 33.33),
        None: (1, 1, 0, 100.0, 1.0, 0.0, 2.0, 5.0, 0.0),
    }


def test_category_counts_an_order_once_per_category(kpis, rows):
    assert rows(kpis["kpi_category"]) == [
        ("auto", 2, 100.0, 100.0, 5.0, 100.0),
        ("toys", 4, 162.5, 40.63, 3.5, 66.67),
    ]


def test_nps_share_of_reviewed_orders(kpis, rows):
    assert rows(kpis["kpi_nps"]) == [
        (1, 1, 50.5, 20.0, 20.0),
        (3, 1, 10.0, None, 20.0),
        (5, 2, 51.0, 5.5, 40.0),
        (6, 1, 1.0, None, 20.0),
    ]


def test_state_takes_delivered_orders_only(kpis, rows):
    assert rows(kpis["kpi_seller_state"]) == [
        ("RJ", 2, 20.0, 5.0, 50.0, 50.5, 1.0),
        ("SP", 2, 15.0, 1.5, 50.0, 150.5, 3.0),
    ]


def test_silver_preview(silver):
    assert tuple(gold.silver_preview(silver).first()) == (10.3, 9.3, 1.0, 25.0, 50.83, 3.67)


def test_quality_filter_is_optional(silver):
    assert gold.kpi_global(gold.passed_only(silver, False)).first()["total_orders"] == 7
    assert gold.kpi_global(gold.passed_only(silver, True)).first()["total_orders"] == 6


def test_empty_silver(silver):
    none = silver.limit(0)
    got = gold.kpi_global(none).drop("gold_computed_at").first()
    assert tuple(got) == (0, *[None] * 10)
    for name in ("kpi_monthly", "kpi_category", "kpi_nps", "kpi_seller_state"):
        assert gold.KPI_TABLES[name](none).count() == 0


def test_order_without_id_is_not_counted(spark):
    df = spark.createDataFrame([row(None, "canceled", 1, None, None)], SILVER)
    got = gold.kpi_monthly(df).first()
    assert (got["orders"], got["canceled"], got["cancellation_rate_pct"]) == (0, 1, None)
