"""Conversation repair against plain versions."""

from __future__ import annotations

import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ordermill.llm import conversations
from tests.llm import brute

ROWS = "conv_id long, turn long, role string, text string"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def reported(spark, rows, **more):
    df = spark.createDataFrame(rows, ROWS).repartition(5).selectExpr("*", *[f"{v} AS {k}" for k, v in more.items()])
    found = conversations.report(df).collect()
    out = {r["conv_id"]: tuple(r[c] for c in COUNTS) for r in found}
    assert len(out) == len(found)
    return out


def some(n_conversations: int, seed: int, most: int = 12) -> list[tuple]:
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "why?", "cut off", "", " \n", "done. ", "done.\t\x0b", "é…", "ok."]
    rows = []
    for conv in range(n_conversations):
        for turn in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "User", "unknown"])
            if rng.random() < 0.6:
                role = ("user", "assistant")[turn % 2]
            at = None if rng.random() < 0.05 else turn + (5 if rng.random() < 0.1 else 0)
            rows.append((conv, at, role, rng.choice([*texts, None, f"Text {conv} {turn}."])))
    return rows


def symbols_of(turns):
    marks = brute.turn_faults(turns)
    out = []
    for (_, role, _), mark in zip(turns, marks, strict=True):
        initial = role[:1] if role[:1] in ("s", "u", "a") else "-"
        upper = {"s": "S", "u": "U", "a": "A", "-": "+"}[initial]
        out.append("x" if mark in ("blank", "duplicate") else upper if mark else initial)
    return "".join(out)


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_parse_finds_the_least_of_all_repairs(n):
    for roles in itertools.product(["user", "assistant", "system", "tool"], repeat=n):
        for texts in itertools.product(["a.", "b", ""], repeat=n):
            turns = [(i, r, t and f"{i}{t}") for i, (r, t) in enumerate(zip(roles, texts, strict=True))]
            want = min((c, a) for c, a, _ in brute.all_repairs(turns))
            assert conversations.finish(conversations.parse({0: (0, "")}, symbols_of(turns))) == want
            assert brute.cheapest_repair(turns)[:2] == want


@settings(max_examples=200, deadline=None)
@given(st.text("suaSUAx-+", max_size=40), st.lists(st.integers(0, 40), max_size=3))
def test_parts_join_to_the_whole(symbols, cuts):
    cuts = sorted({0, len(symbols), *[c for c in cuts if c < len(symbols)]})
    parts = []
    for a, b in itertools.pairwise(cuts):
        part = conversations.Part(conversations.STATES, {})
        part.add(symbols[a:b], symbols[a:b], 0)
        parts.append(part.packed())
    whole = conversations.finish(conversations.parse({0: (0, "")}, symbols))
    assert conversations.joined(parts)[1:] == whole


def test_edits_put_aside_change_nothing(monkeypatch):
    rng = random.Random(4)
    for piece in (1, 3):
        monkeypatch.setattr(conversations, "PIECE", piece)
        for _ in range(50):
            symbols = "".join(rng.choices("uauauaxUAs-", k=60))
            part = conversations.Part((0,), {})
            part.add(symbols, symbols, 0)
            assert conversations.joined([part.packed()])[1:] == conversations.finish(conversations.parse({0: (0, "")}, symbols))


def test_report_against_the_plain_version(spark):
    rows = some(150, 1)
    assert reported(spark, rows) == brute.repaired_conversations(rows)


def test_nulls_ties_repeats_and_clashing_names(spark):
    rows = [(None, None, None, None), (None, None, None, None), (None, 3, "user", "Hm.")]
    rows += [(1, 2, "user", "b."), (1, 2, "user", "a."), (1, 2, "assistant", "a."), (1, 2, "user", "a.")]
    rows += [(2, None, "user", "x."), (2, 9, "user", "x."), (2, -9, "user", "x."), (3, 7, None, "y" * 100_000)]
    rows += [(4, 2**62, "user", "a."), (5, 1, "system", "Only.")]
    names = ("name", "digest", "part", "parse", "audit", "symbol", "n", "found_id", "damage", "copy", "first_turn", "rest", "cost")
    found = reported(spark, rows, **{name: "1" for name in names})
    assert found == brute.repaired_conversations(rows)


def test_conversation_without_rows_after_damage(spark):
    rows = [(i, 0, "user", "Hello.") for i in range(200)]
    gone = [conv for conv, turns in brute.damaged_turns(rows).items() if not turns]
    found = reported(spark, rows)
    assert gone and len(found) == 200
    assert all(found[conv] == (0, 0, 0, 0, 0, 0, "", brute.sha("")) for conv in gone)


def test_long_conversation_over_many_parts(spark):
    rows = [(1, t, ("user", "assistant")[(t + t // 50) % 2], f"Turn {t % 700}.") for t in range(6000)]
    rows += [(0, 0, "user", "First."), (2, 0, "user", "Last."), *some(30, 7)]
    rows = [r if r[0] == 1 else (r[0] + 10, *r[1:]) for r in rows]
    df = spark.createDataFrame(rows, ROWS)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        repair = conversations.Repair(conversations.damaged(df))
        parts = conversations._symbols(conversations.faults(repair.turns))
        assert parts.filter("name = ':1'").select("part").distinct().count() > 3
        found = {r["conv_id"]: (r["cost"], r["audit"], r["repaired_sha256"]) for r in repair.with_digests().collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = brute.repaired_conversations(rows)
    assert {k: v[5:] for k, v in want.items() if k in found} == found


def test_repaired_turns(spark):
    rows = some(60, 3)
    repair = conversations.Repair(conversations.damaged(spark.createDataFrame(rows, ROWS)))
    texts: dict = {}
    for r in repair.conversations().orderBy("conv_id", "position").collect():
        own = texts.setdefault(r["conv_id"], [])
        assert r["position"] == len(own) and r["edit"] in "KRI"
        own.append(f"{r['role']}:{r['text']}")
    want = {conv: brute.cheapest_repair(turns)[2] for conv, turns in brute.damaged_turns(rows).items()}
    assert texts == {conv: done for conv, done in want.items() if done}


def test_empty_table(spark):
    assert reported(spark, []) == {}
    assert conversations.Repair(spark.createDataFrame([], ROWS)).conversations().count() == 0
