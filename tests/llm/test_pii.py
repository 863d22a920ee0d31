"""Disclosing terms against plain counts, and what one text may cost."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from ordermill.llm import pii
from tests.llm import brute

ROWS = "doc_id long, text string"


def some(seed: int, n: int = 240) -> list[tuple]:
    """Names that always, often or rarely go with an address; copies, nulls and repeated or missing ids."""
    rng = random.Random(seed)
    people = [(f"{a}na{a}", f"{a}@{b}.example") for a, b in zip("bcdfgh", "vwxyzq", strict=True)]
    rows = []
    for i in range(n):
        filler = rng.choices([f"word{c}{d}" for c in "abcdefgh" for d in "xyz"], k=rng.randint(0, 12))
        name, mail = rng.choice(people)
        if rng.random() < 0.3:
            extra = [mail, name.title() if rng.random() < 0.9 else "", f"Town{name[:1]}" if rng.random() < 0.5 else "İstanbul"]
            filler += extra + ([f"+49 30 {1000000 + ord(name[0])}"] if rng.random() < 0.5 else [])
        elif rng.random() < 0.12:
            filler.append(name)
        rng.shuffle(filler)
        rows.append((rng.choice([i, 7, None]), " ".join(filler) if i % 50 else None))
    return rows + rng.choices(rows, k=n // 4)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_spans_are_those_of_plain_counts(spark, monkeypatch, seed):
    # Lower shares, so that some terms are generalised and some removed.
    monkeypatch.setattr(pii, "GENERALISE", 0.4)
    monkeypatch.setattr(pii, "REMOVE", 0.9)
    rows = some(seed)
    want = brute.personal_spans(rows, 0.4, 0.9, pii.LEAST_TEXTS)
    joined = [",".join(f"{k}:{a}:{b}" for k, a, b in spans) for spans in want]
    got = pii.report(spark.createDataFrame(rows, ROWS).repartition(4)).collect()
    assert sorted((repr(r["doc_id"]), r["spans"]) for r in got) == sorted((repr(i), s) for (i, _), s in zip(rows, joined, strict=True))
    kinds = {k for spans in want for k, _, _ in spans}
    assert {"term", "drop", "email", "phone"} <= kinds


def test_rows_without_an_id_keep_their_own_words(spark):
    rows = [(None, f"{t} Zebediah writes from zeb@corp.example {t}") for t in ("one", "two", "three", "four")]
    rows += [(None, "A quite other text where Zebediah is named")] + [(i, f"filler text {i}") for i in range(300)]
    out = [r["text"] for r in pii.sanitise(spark.createDataFrame(rows, ROWS)).collect()]
    assert "A quite other text where Zebediah is named" in out
    assert not any("zeb" in t.lower() for t in out if t.startswith(("one", "two", "three", "four")))


def test_other_columns_come_back_whatever_they_are_called(spark):
    names = ["base", "found", "row", "digest", "chosen", "es", "class"]
    df = spark.createDataFrame([(1, "a@b.c d"), (None, None)], ROWS).selectExpr("*", *[f"'MINE' AS {n}" for n in names])
    out = pii.sanitise(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(
        [(1, "<EMAIL> d", *["MINE"] * len(names)), (None, None, *["MINE"] * len(names))], key=repr
    )


def test_many_entities_with_many_terms(spark):
    """A thousand addresses and five thousand terms in three texts are a few classes."""
    mails, terms = [f"u{i}@h{i}.example" for i in range(1000)], ["t" + "".join(chr(97 + int(d)) for d in str(i)) + "q" for i in range(5000)]
    rows = [(i, " ".join([*mails, *terms, f"text {i}"])) for i in range(3)] + [(i, f"other text {i}") for i in range(3, 400)]
    begin = time.time()
    out = pii.sanitise(spark.createDataFrame(rows, ROWS)).filter("doc_id < 3").collect()
    assert time.time() - begin < 40  # seconds on a busy machine; listing all pairs takes minutes
    assert all(r["text"].count("<EMAIL>") == 1000 and "qt" not in r["text"].replace(" ", "") for r in out)


def test_a_text_with_very_many_matches(spark):
    n = 200_000
    text = " ".join(f"a{i % 10}@b.c é" for i in range(n))
    rows = spark.createDataFrame([(1, text)], ROWS)
    begin = time.time()
    got = pii.report(rows).select("n_email", "base_sha256").first()
    assert time.time() - begin < 90
    assert got["n_email"] == n
    want = ",".join(f"email:{9 * i}:{9 * i + 6}" for i in range(n))
    assert got["base_sha256"] == brute.sha(want)
    clean = pii.sanitise(rows).first()["text"]
    assert clean == " ".join(["<EMAIL> é"] * n)


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 1000])
def test_running_totals(spark, n):
    values = F.array(*[F.lit(i % 7) for i in range(n)]).cast("array<int>")
    total, most, out = 0, 0, ([], [])
    for i in range(n):
        total, most = total + i % 7, max(most, i % 7)
        out[0].append(total)
        out[1].append(most)
    got = spark.range(1).select(
        pii.running(values, lambda a, b: a + b).alias("s"), pii.running(values, lambda a, b: F.greatest(a, b)).alias("m")
    )
    assert tuple(got.first()) == out


def test_texts_are_put_together_over_chunks(spark, monkeypatch):
    rng = random.Random(1)
    for chunk in (1, 3, 7):
        monkeypatch.setattr(pii, "CHUNK", chunk)
        text = "".join(rng.choices("aé東🙂 ", k=50))
        spans = [(a, a + rng.randint(1, 6), "ip") for a in sorted(rng.sample(range(44), 8))]
        want, at = "", 0
        for a, b, _ in sorted(spans):
            if a >= at:
                want += text[at:a] + "<IP>"
            at = max(at, b)
        df = spark.createDataFrame([(text, spans)], "t string, m array<struct<start:int,end:int,kind:string>>")
        assert df.select(pii.rewritten(F.col("t"), F.col("m")).alias("x")).first()["x"] == want + text[at:]
