"""SimHash near-duplicates with a Gray-ordered hierarchical index.

Each document gets a 64-bit fingerprint: the majority of every bit over the XXH64 values of its word shingles.
Documents with equal fingerprints are one row from then on, however many they are. Distinct fingerprints are
routed by bands: 64 bits cut into max_distance + 1 bands, so that two fingerprints within the distance agree on at
least one of them. In every bucket of a band the fingerprints are sorted by Gray rank with the band's bits on top; runs of
neighbours share bits, which upper nodes of a tree hold as (mask, pattern) and lower nodes no longer repeat. A
search adds up the differences on its way down and leaves out whole groups as soon as they exceed the distance.
A band value that too many fingerprints share is cut into further bands of the remaining bits, which loses no
pair. Buckets give back a forest of links, and components grow together by large-star / small-star rounds.

Defined results: null text is empty; documents without words have fingerprint zero and link like others; a null
doc_id takes part but is never the smallest id of a component that has another; rows that repeat are kept; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import stored, travels

travels(__name__)

SHINGLE_WORDS = 3
MAX_DISTANCE = 2
SEED = 42
BITS = 64
FANOUT = 8
BUCKET_ROWS = 4096
# Fingerprints that may share a band value before it is cut into further bands.
BAND_ROWS = 32_768
# (query, node) pairs held at once while searching a bucket.
FRONTIER = 2_000_000


# --- fingerprints


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit fingerprint; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    votes = np.zeros(BITS, np.int64)
    for at in range(0, n, 65536):
        stop = min(n, at + 65536)
        columns = [words[at + i : stop + i] for i in range(min(shingle_words, len(words)))]
        hashes = [xxhash.xxh64_intdigest(s, SEED) for s in map(b" ".join, zip(*columns, strict=True))]
        bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """The columns to keep and the fingerprint `fp` (as a signed long) of every row."""
    keep = list(keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle_words) for t in batch["text"]], np.uint64)
            yield batch[keep].assign(fp=found.view(np.int64))

    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema]
    needed = docs.select(*dict.fromkeys((*keep, "text")))
    return needed.mapInPandas(run, ", ".join([*types, "fp long"]))


# --- the index of one bucket


def rotate(x: np.ndarray, by: int) -> np.ndarray:
    by %= BITS
    return x if by == 0 else (x << np.uint64(by)) | (x >> np.uint64(BITS - by))


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of a bit pattern in the reflected Gray code."""
    rank = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Tree over fingerprints in Gray order: each node holds the bits its group shares beyond its parent's."""

    def __init__(self, values: np.ndarray):
        self.values = values[np.argsort(gray_rank(values), kind="stable")]
        every = np.uint64(2**BITS - 1)
        patterns, masks = [self.values], [np.full(len(self.values), every)]
        while len(patterns[-1]) > 1:
            below, shared = patterns[-1], masks[-1]
            starts = np.arange(0, len(below), FANOUT)
            first = np.repeat(below[starts], np.diff(np.append(starts, len(below))))
            same = ~(below ^ first) & shared
            patterns.append(below[starts])
            masks.append(np.bitwise_and.reduceat(same, starts))
        # From the root down, each node keeps the shared bits that no node above it has.
        self.levels = []
        above = np.zeros(1, np.uint64)
        for pattern, mask in zip(reversed(patterns), reversed(masks), strict=True):
            parent = above if len(pattern) == 1 else np.repeat(above, FANOUT)[: len(pattern)]
            self.levels.append((pattern, mask & ~parent))
            above = mask

    def pairs(self, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions i < j in Gray order of all values at most `distance` bits apart."""
        n, found = len(self.values), []
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        work = [(0, np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.uint8))]
        while work:
            level, query, node, seen = work.pop()
            if len(query) > FRONTIER // FANOUT:
                half = len(query) // 2
                work += [(level, query[s], node[s], seen[s]) for s in (slice(half, None), slice(half))]
                continue
            pattern, mask = self.levels[level]
            seen = seen + np.bitwise_count((self.values[query] ^ pattern[node]) & mask[node])
            keep = seen <= distance
            query, node, seen = query[keep], node[keep], seen[keep]
            if level == len(self.levels) - 1:
                found.append((query, node))
                continue
            child = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            query, seen = np.repeat(query, FANOUT), np.repeat(seen, FANOUT)
            # Leaves under a node of the next level start here; only partners behind the query are wanted.
            width = FANOUT ** (len(self.levels) - 2 - level)
            there = (child < len(self.levels[level + 1][0])) & ((child + 1) * width > query)
            work.append((level + 1, query[there], child[there], seen[there]))
        left, right = (np.concatenate(x) for x in zip(*found, strict=True))
        later = right > left
        return left[later], right[later]


def link_forest(values: np.ndarray, distance: int) -> pd.DataFrame:
    """Links (a, b) from each value to the smallest of its component among these values."""
    index = GrayIndex(values)
    left, right = index.pairs(distance)
    root = np.arange(len(index.values))
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        root = root[root]
        if np.array_equal(root, before):
            break
    linked = np.flatnonzero(root != np.arange(len(root)))
    signed = index.values.view(np.int64)
    return pd.DataFrame({"a": signed[linked], "b": signed[root[linked]]})


# --- routing


def _bands(total: int, parts: int) -> list[tuple[int, int]]:
    """(lowest position, width) of `parts` nearly equal runs of `total` bit positions."""
    edges = [round(total * i / parts) for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _bits(value: Column, positions: list[int]) -> Column:
    mask = sum(1 << p for p in positions)
    return value.bitwiseAND(F.lit(mask - 2**BITS if mask >= 2 ** (BITS - 1) else mask))


def routed(distinct: DataFrame, distance: int, band_rows: int = BAND_ROWS) -> DataFrame:
    """fp, route (a long), top (position of the band's highest bit): pairs within the distance share a route."""
    parts = distance + 1
    done = []
    pending = [(list(range(BITS)), distinct.select("fp", F.lit(0).cast("long").alias("route")))]
    while pending:
        free, rows = pending.pop()
        for low, width in _bands(len(free), parts):
            band = free[low : low + width]
            rest = free[:low] + free[low + width :]
            route = F.xxhash64("route", F.lit(band[0]), F.lit(len(free)), _bits(F.col("fp"), band))
            keyed = rows.select("fp", route.alias("route"))
            counts = keyed.groupBy("route").agg(F.count("*").alias("n")).filter(F.col("n") > band_rows).select("route")
            top = F.lit(band[-1]).alias("top")
            if len(rest) <= parts or not (hot := stored(counts, "simhash-hot")).take(1):
                done.append(keyed.select("fp", "route", top))
                continue
            done.append(keyed.join(hot, "route", "left_anti").select("fp", "route", top))
            pending.append((rest, stored(keyed.join(hot, "route", "left_semi").select("fp", "route"), "simhash-split")))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def near_links(distinct: DataFrame, distance: int = MAX_DISTANCE, band_rows: int = BAND_ROWS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints whose components are those of all pairs within the distance."""
    n = distinct.count()
    buckets = max(1, math.ceil(n / bucket_rows))

    def search(key, rows: pd.DataFrame) -> pd.DataFrame:
        by = BITS - 1 - int(rows["top"].iloc[0])
        values = np.unique(rows["fp"].to_numpy().view(np.uint64))
        links = link_forest(rotate(values, by), distance)
        for side in ("a", "b"):
            links[side] = rotate(links[side].to_numpy().view(np.uint64), BITS - by).view(np.int64)
        return links

    bucket = F.pmod(F.xxhash64("route"), F.lit(buckets)).alias("bucket")
    rows = routed(distinct, distance, band_rows).select("fp", "top", bucket)
    return rows.groupBy("top", "bucket").applyInPandas(search, "a long, b long")


# --- components


def components(links: DataFrame) -> DataFrame:
    """(node, root): every node with a link, and the smallest node of its component."""
    a, b = F.col("a"), F.col("b")
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges = stored(edges, "components")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u")
        small = moved.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "components")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """doc_id, fp (signed long), root (smallest fp reachable over links) and component_id (smallest doc_id
    reachable) for every row."""
    marked = stored(fingerprints(docs, shingle_words), "simhash")
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-distinct")
    members = components(near_links(distinct, distance))
    rooted = distinct.join(members, distinct["fp"] == members["node"], "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_fingerprint = rooted.join(ids, "root").select("fp", "root", "component_id")
    return marked.join(by_fingerprint, "fp")
