"""Merkle manifest against a plain version."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ordermill.llm import manifest
from tests.llm import brute

DOCS = "doc_id long, source string, lang string, n_chars long, text string"
COLUMNS = ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def some(sizes: dict, seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    langs = [lang for lang, n in sizes.items() for _ in range(n)]
    ids = rng.sample(range(-100, 10 * len(langs) + 10), len(langs))
    maybe = lambda v: None if rng.random() < 0.1 else v
    return [(i, maybe("é:s"), lang, maybe(i % 50), maybe(f"Tëxt {i}\n")) for i, lang in zip(ids, langs, strict=True)]


def reported(df):
    found = manifest.report(df).collect()
    assert len({r["doc_id"] for r in found}) == len(found)
    return {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in found}


@pytest.mark.parametrize(
    ("sizes", "block"),
    [
        ({"en": 1}, 10),
        ({"en": 2, "de": 1}, 10),
        ({"a": 1, "b": 1, None: 1, "": 1, "é": 1}, 1),
        ({"en": 37, None: 5, "de": 8, "fr": 1}, 2),
        ({"en": 300, "z": 33}, 3),
        ({f"l{i}": 1 + i % 3 for i in range(40)}, 2),
    ],
)
def test_proofs(spark, monkeypatch, sizes, block):
    monkeypatch.setattr(manifest, "BLOCK", block)
    rows = some(sizes)
    assert reported(spark.createDataFrame(rows, DOCS).repartition(3)) == brute.merkle(rows)


def test_merged_joins_give_the_same(spark, monkeypatch):
    rows = some({"en": 600, "de": 3})
    monkeypatch.setattr(manifest, "BROADCAST_BYTES", 0)
    assert reported(spark.createDataFrame(rows, DOCS).repartition(3)) == brute.merkle(rows)


def test_inner_paths_keep_no_group_whole(spark):
    """No join over a short distance, and no grouping, has a key with many rows."""
    rows = some({"en": 200})
    plan = manifest.Manifest(spark.createDataFrame(rows, DOCS)).leaves._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan


def test_missing_and_repeated_ids_and_clashing_names(spark):
    rows = [(None, "s", "en", 1, "a"), (None, "s", "en", 1, "a"), (3, "s", "en", 1, "b"), (3, "s", "en", 1, "c")]
    names = ("key", "group", "leaf", "altered", "part", "at", "number", "tree", "node", "path", "up", "row", "root")
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", *[f"'x' AS {n}" for n in names])
    found = manifest.report(df).collect()
    assert len(found) == 4 and {r["root"] for r in found} == {r["subroot"] for r in found} and len({r["root"] for r in found}) == 1
    assert all(r["verified"] for r in found)
    leaves = [brute.sha("".join("-" if v is None else f"{len(str(v))}:{v}" for v in row)) for row in rows]
    last = sorted(leaves[2:])
    pairs = [brute.sha(leaves[0] * 2), brute.sha("".join(last))]
    assert found[0]["root"] == brute.sha("".join(pairs))


def test_tampering_is_found_and_overflow_is_none(spark):
    doc_id = next(i for i in range(100) if brute.zlib.crc32(str(i).encode()) % 7 == 0)
    rows = [(doc_id, None, "en", 2**63 - 1, ""), (doc_id + 1, None, "en", None, None)]
    found = reported(spark.createDataFrame(rows, DOCS))
    assert found == brute.merkle(rows)
    assert found[doc_id][-1] is False


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert manifest.report(docs).count() == 0
    assert manifest.Manifest(docs).root is None


def test_proof_folds_to_the_root(spark):
    made = manifest.Manifest(spark.createDataFrame(some({"en": 70, "de": 9}), DOCS))
    rows = made.proofs().select(manifest.fold(F.col("leaf"), F.col("path")).alias("r")).distinct().collect()
    assert [r["r"] for r in rows] == [made.root]
