from __future__ import annotations

import datetime as dt

from ordermill.functions.delivery import parse_timestamps, with_delivery_metrics
from ordermill.plans.silver import refine_orders

ORDER = """order_id STRING, order_status STRING, order_purchase_ts TIMESTAMP, order_approved_ts TIMESTAMP,
    order_delivered_ts TIMESTAMP, order_estimated_ts TIMESTAMP, item_count INT,
    total_items_value DECIMAL(22,2), total_freight DECIMAL(22,2), payment_value DECIMAL(22,2),
    review_score FLOAT"""


def ts(text):
    return None if text is None else dt.datetime.fromisoformat(text)


def order(order_id, status, bought, arrived, promised, items=None, freight=None):
    return (order_id, status, ts(bought), None, ts(arrived), ts(promised), 1, items, freight, None, None)


def metrics(spark, *orders):
    return {r["order_id"]: r for r in with_delivery_metrics(spark.createDataFrame(orders, ORDER)).collect()}


def test_days_are_calendar_days(spark):
    got = metrics(spark, order("a", "delivered", "2020-01-01 23:59", "2020-01-02 00:01", "2020-01-01 00:00"))
    assert got["a"]["delivery_days_actual"] == 1
    assert got["a"]["delivery_days_estimated"] == 0
    assert got["a"]["delivery_delay_days"] == 1


def test_late_needs_a_delivered_order_and_a_known_delay(spark):
    got = metrics(
        spark,
        order("late", "delivered", "2020-01-01", "2020-01-09", "2020-01-08"),
        order("same day", "delivered", "2020-01-01", "2020-01-08 20:00", "2020-01-08 08:00"),
        order("no date", "delivered", "2020-01-01", None, "2020-01-08"),
        order("shipped", "shipped", "2020-01-01", "2020-01-09", "2020-01-08"),
        order("no status", None, "2020-01-01", "2020-01-09", "2020-01-08"),
    )
    assert {k: r["is_late_delivery"] for k, r in got.items()} == {
        "late": True,
        "same day": False,
        "no date": False,
        "shipped": False,
        "no status": False,
    }
    assert got["no date"]["delivery_delay_days"] is None
    assert (got["no status"]["is_delivered"], got["no status"]["is_canceled"]) == (None, None)


def test_value_and_freight_ratio(spark):
    from decimal import Decimal as D

    when = ("2020-01-01", None, None)
    got = metrics(
        spark,
        order("both", "shipped", *when, D("80.00"), D("20.00")),
        order("free", "shipped", *when, D("0.00"), D("20.00")),
        order("no freight", "shipped", *when, D("80.00"), None),
        order("empty", "shipped", *when),
    )
    assert got["both"]["order_value_total"] == D("100.00") and got["both"]["freight_ratio"] == 0.25
    assert got["free"]["freight_ratio"] is None
    assert got["no freight"]["order_value_total"] is None and got["no freight"]["freight_ratio"] is None
    assert got["empty"]["order_value_total"] is None


def test_text_timestamps(spark):
    df = spark.createDataFrame(
        [("2020-01-01 10:00:00", "nan", "", None), ("01/02/2020", "x", "2020-01-05 00:00:00", "nan")],
        "order_purchase_ts STRING, order_approved_ts STRING, order_delivered_ts STRING, order_estimated_ts STRING",
    )
    got = [tuple(r) for r in parse_timestamps(df, "yyyy-MM-dd HH:mm:ss").collect()]
    assert got == [
        (ts("2020-01-01 10:00"), None, None, None),
        (None, None, ts("2020-01-05"), None),
    ]


def test_refined_order_has_processing_time(spark):
    df = spark.createDataFrame([order("a", "shipped", "2020-01-01", None, None)], ORDER)
    assert refine_orders(df).first()["silver_processed_at"] is not None
