from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ordermill.operators import quality

COLUMNS = """order_id STRING, payment_value DOUBLE, item_count INT, delivery_days_actual INT,
    review_score FLOAT, order_purchase_ts TIMESTAMP, order_delivered_ts TIMESTAMP"""
NOON, EVENING = dt.datetime(2020, 1, 1, 12), dt.datetime(2020, 1, 1, 18)

GOOD = dict(order_id="a", payment_value=10.0, item_count=1, delivery_days_actual=5, review_score=3.0,
            order_purchase_ts=NOON, order_delivered_ts=EVENING)


def flags(spark, rules, **changes):
    df = spark.createDataFrame([tuple({**GOOD, **changes}.values())], COLUMNS)
    row = quality.apply_rules(df, rules).first()
    assert row["dq_passed"] == (row["dq_flags"] == "")
    return row["dq_flags"]


def test_order_rules(spark):
    def check(**changes):
        return flags(spark, quality.ORDER_RULES, **changes)

    assert check() == ""
    assert check(order_id=None) == "NULL_ORDER_ID"
    for payment in (None, 0.0, -1.0):
        assert check(payment_value=payment) == "INVALID_PAYMENT_VALUE"
    for count in (None, 0):
        assert check(item_count=count) == "INVALID_ITEM_COUNT"
    assert check(delivery_days_actual=-1) == "DELIVERY_BEFORE_PURCHASE"
    assert check(delivery_days_actual=120) == ""
    assert check(delivery_days_actual=121) == "ANOMALOUS_DELIVERY_DAYS"
    assert check(delivery_days_actual=None) == ""
    assert [check(review_score=s) for s in (1.0, 5.0, None)] == ["", "", ""]
    assert [check(review_score=s) for s in (0.0, 6.0)] == ["INVALID_REVIEW_SCORE"] * 2


def test_flags_are_joined_in_rule_order(spark):
    got = flags(spark, quality.ORDER_RULES, review_score=9.0, payment_value=0.0, order_id=None)
    assert got == "NULL_ORDER_ID|INVALID_PAYMENT_VALUE|INVALID_REVIEW_SCORE"


def test_basic_rules_differ(spark):
    def check(**changes):
        return flags(spark, quality.BASIC_RULES, **changes)

    assert check(payment_value=None) == ""
    assert check(payment_value=0.0) == "ZERO_PAYMENT"
    assert check(review_score=0.0) == ""
    assert check(review_score=6.0) == "INVALID_REVIEW_SCORE"
    assert check(delivery_days_actual=500) == ""
    # Compared by the second, where the other set compares days.
    assert check(order_purchase_ts=EVENING, order_delivered_ts=NOON) == "DELIVERY_BEFORE_PURCHASE"


def test_failed_rules_as_array(spark):
    df = spark.createDataFrame([tuple({**GOOD, "payment_value": 0.0, "item_count": 0}.values()),
                                tuple(GOOD.values())], COLUMNS)
    out = quality.with_failed_rules(df, quality.ORDER_RULES)
    sizes = sorted(r[0] for r in out.select(F.size("dq_failed")).collect())
    assert sizes == [0, 2]


def test_summary_and_distribution(spark):
    df = spark.createDataFrame(
        [("A", False), ("A", False), ("B", False), ("", True)], "dq_flags STRING, dq_passed BOOLEAN"
    )
    assert tuple(quality.quality_summary(df).first()) == (4, 1, 3, 25.0, 75.0)
    assert [tuple(r) for r in quality.flag_distribution(df).collect()] == [("A", 2), ("B", 1)]
    empty = df.limit(0)
    assert tuple(quality.quality_summary(empty).first()) == (0, 0, 0, None, None)
