"""Random small tables against plain Python."""

from __future__ import annotations

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ordermill.operators.dedup import latest_per_key
from ordermill.operators.lookup import spread_join
from ordermill.operators.upsert import upsert
from ordermill.streaming.apply import resolve

few = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
keys = st.one_of(st.none(), st.sampled_from("abcde"))
values = st.one_of(st.none(), st.integers(0, 3))


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def order(value):
    return (value is not None, value if value is not None else 0)


@few
@given(st.lists(st.tuples(keys, values, values), max_size=25))
def test_latest_per_key(spark, table):
    df = spark.createDataFrame(table, "k STRING, at INT, v INT")
    groups = defaultdict(list)
    for row in table:
        groups[row[0]].append(row)
    want = [max(rows, key=lambda r: (order(r[1]), order(r[2]))) for rows in groups.values()]
    assert bag(latest_per_key(df, ["k"], ["at"])) == sorted(want, key=repr)


@few
@given(
    st.lists(st.tuples(keys, values), max_size=12, unique_by=lambda r: r[0] or object()),
    st.lists(st.tuples(keys, values), max_size=12, unique_by=lambda r: r[0] or object()),
)
def test_upsert(spark, old, new):
    ddl = "k STRING, v INT"
    got = upsert(spark.createDataFrame(old, ddl), spark.createDataFrame(new, ddl), "k")
    touched = {k for k, _ in new if k is not None}
    want = list(new) + [row for row in old if row[0] not in touched]
    assert bag(got) == sorted(want, key=repr)


@few
@given(
    st.lists(st.tuples(keys, st.integers(0, 50)), max_size=30),
    st.lists(st.tuples(keys, st.integers(0, 3)), max_size=8),
    st.sampled_from([1 / 2, 1 / 5, 1 / 50]),
)
def test_spread_join(spark, facts, side, share):
    left = spark.createDataFrame(facts, "k STRING, f INT")
    right = spark.createDataFrame(side, "k STRING, s INT")
    got = spread_join(left, right, "k", share=share).select("k", "f", "s")
    want = []
    for k, f in facts:
        partners = [s for key, s in side if key is not None and key == k] or [None]
        want += [(k, f, s) for s in partners]
    assert bag(got) == sorted(want, key=repr)


@few
@given(
    st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from("12345"), st.integers(0, 9)), min_size=1, max_size=15),
    st.integers(0, 15),
)
def test_events_in_any_split_give_the_newest(spark, sent, cut):
    ddl = "order_id STRING, ingested_at STRING, n INT"
    events = [(k, at, n, f"{k}{n}") for k, at, n in sent]
    ddl = f"{ddl}, event_id STRING"
    early, late = events[:cut], events[cut:]
    base = latest_per_key(spark.createDataFrame(late, ddl), ["order_id"], ["ingested_at", "event_id"])
    got = resolve(base, spark.createDataFrame(early, ddl))
    want = {}
    for row in events:
        if row[0] not in want or (row[1], row[3]) > (want[row[0]][1], want[row[0]][3]):
            want[row[0]] = row
    assert bag(got) == sorted(want.values(), key=repr)
