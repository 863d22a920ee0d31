"""Packing: every id in one piece, sequences without gaps, little padding, ids of the tokenizer."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ordermill.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.fixture(scope="module")
def tokens():
    with open(PATH, encoding="utf-8") as file:
        return packing.Tokens(file.read())


def texts() -> list[str | None]:
    rng = random.Random(3)
    words = ["the", "a", "word", "Ünï", "東京", "it's", "x" * 300, "12345", "\n", "", " ", "\t\t", "é", "🙂", "!?", "<|endoftext|>"]
    made = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(150)]
    return [None, "", " ", "  \n ", "a" * 20_000, "word " * 9000, *made]


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t\r  \x1c\x85a'sé1_.東"), st.characters(codec="utf-8")), max_size=60))
def test_ids_are_those_of_the_whole_text(whole, tokens, text):
    assert tokens.encode([text])[0].tolist() == whole(text)


def test_known_pieces_are_forgotten_not_mixed_up(whole, tokens, monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_PIECES", 50)
    for _ in range(2):
        for text in texts():
            assert tokens.encode([text or ""])[0].tolist() == whole(text)


def check(pieces, ids: dict, window: int):
    """Every id of every document in one piece, sequences gapless; gives the padding."""
    by_doc: dict = {}
    by_sequence: dict = {}
    for p in pieces:
        assert p["length"] > 0 and p["doc_tokens"] == len(ids[p["doc_id"]])
        own = ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert len(own) == p["length"] and zlib.crc32(np.array(own, "<u4").tobytes()) == p["ids_crc32"]
        by_doc.setdefault(p["doc_id"], []).append((p["start"], p["length"]))
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert by_doc.keys() == ids.keys()
    for doc, spans in by_doc.items():
        assert sum(n for _, n in spans) == len(ids[doc])
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(spans), sorted(spans)[1:], strict=False))
    padding = 0
    for spans in by_sequence.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:], strict=False))
        size = sum(n for _, n in spans)
        assert size <= window
        padding += 0 if size & (size - 1) == 0 else window - size
    return padding


@pytest.mark.parametrize(("window", "most_open"), [(2048, 4096), (64, 3), (16, 0)])
def test_pack(spark, whole, window, most_open):
    rows = [(i, t) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    pieces = packing.pack(df, PATH, window=window, most_open=most_open).collect()
    assert check(pieces, {i: whole(t) for i, t in rows}, window) == 0


def test_missing_and_repeated_ids_and_clashing_names(spark, whole):
    rows = [(None, "a b"), (None, None), (7, "c"), (7, "c"), (2**60 + 1, "d e f")]
    names = ("start", "length", "ids", "offset", "sequence_id", "doc_tokens")
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", *[f"'x' AS {n}" for n in names])
    pieces = packing.pack(df, PATH).collect()
    assert sum(p["length"] for p in pieces) == sum(len(whole(t)) for _, t in rows)
    assert sorted(map(repr, (p["doc_id"] for p in pieces if p["start"] == 0))) == sorted(repr(i) for i, _ in rows)


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], DOCS), PATH).count() == 0


def test_level_has_the_least_sum_of_squares():
    rng = random.Random(5)
    packer, counts = packing.Packer(20, 100), [0] * 21
    for _ in range(2000):
        n = rng.randint(1, 19)

        def squares(level, n=n):
            after = list(counts)
            if level:
                after[level] -= 1
            if level + n < 20:
                after[level + n] += 1
            return sum(c * c for c in after)

        levels = [0, *[h for h in range(1, 21 - n) if counts[h]]]
        least = min(map(squares, levels))
        level = packer.level_for(n)
        assert level == max(h for h in levels if squares(h) == least)
        if level:
            counts[level] -= 1
        if level + n < 20:
            counts[level + n] += 1
        packer.put((0, n, 0, np.zeros(n, "<u4")))
        assert packer.n_open == sum(counts)


def test_documents_stay_whole_where_they_can(spark, whole):
    """Only the ends of a partition are cut: most documents that fit a window are one piece."""
    rng = random.Random(8)
    rows = [(i, "word " * rng.randint(1, 1500)) for i in range(400)]
    pieces = packing.pack(spark.createDataFrame(rows, DOCS).repartition(2), PATH)
    cut = pieces.groupBy("doc_id").count().filter("count > 1").count()
    assert cut < 0.2 * len(rows)


def test_packed_ids(spark, whole):
    rows = [(i, t) for i, t in enumerate(texts()[:40])]
    df = spark.createDataFrame(rows, DOCS).repartition(2)
    pieces = packing.pack(df, PATH).cache()
    got = {r["sequence_id"]: r["ids"] for r in packing.packed_ids(df, PATH, pieces).collect()}
    want: dict = {}
    for p in sorted(pieces.collect(), key=lambda p: (p["sequence_id"], p["offset"])):
        ids = whole(dict(rows)[p["doc_id"]])
        want.setdefault(p["sequence_id"], []).extend(ids[p["start"] : p["start"] + p["length"]])
    assert got == want
