"""Exact repeats of word sequences, found by fixed-block anchors.

A repeat of `WINDOW` = 35 words always holds a whole block of `BLOCK` = 18 words that starts at a multiple of 18, on
either side. So the non-overlapping blocks of all documents are indexed, and every rolling window of 18 words is looked up among
them. Around hits that are not the block itself, matches are extended to windows of 35 words, and a window is a repeat if
its sequence starts at least twice in the corpus; overlapping repeats join to maximal ones.

Hashes meet in buckets of bounded size. A chunk of documents sends each bucket its distinct hashes only, sorted, as
compressed differences (about two bytes each), and gets one number per hash back, so a passage that thousands of
documents share costs one entry per chunk, and no pair of places is ever listed. Words are hashed to 64 bits; a
bucket of anchors compares `ANCHOR_BITS` further bits (a chance hit only costs time), a bucket of windows 62.

Defined results: null text has no words; a document shorter than a window keeps all; rows that repeat are
documents of their own (and so repeat each other); an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import stored, travels

travels(__name__)

WINDOW = 35
CHUNK_CHARS = 4_000_000
# Bits that anchors are compared by inside a bucket; one probe in some thousands meets a block by chance.
ANCHOR_BITS = 27
BUCKET_WORDS = 2**20
TEXT_LEVEL = 7  # of compression, as texts move twice
CACHED_WORDS = 300_000
# Odd multipliers of the rolling hashes, and their inverses modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

CHUNKS = "chunk long, n_words long, payload binary"
ENTRIES = "chunk long, bucket long, payload binary"
STEPS = (
    "chunk long, bucket long, payload binary, starts binary, doc_id long, n_words long, n_removed long, "
    "kept_sha256 string"
)
STEP_NAMES = ["chunk", "bucket", "payload", "starts", "doc_id", "n_words", "n_removed", "kept_sha256"]


# --- chunks of documents


def _pack(ids: list, texts: list) -> bytes:
    table = pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.large_binary())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", TEXT_LEVEL))) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


class _WordHashes(dict):
    """Word to its 64-bit hash, remembered for the words of recent chunks."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHED_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class Chunk:
    """Words of some documents laid end to end."""

    def __init__(self, payload: bytes, hashes: _WordHashes):
        table = pa.ipc.open_stream(payload).read_all()
        self.ids = table["doc_id"].to_pylist()
        self.texts = table["text"].to_pylist()
        self.words = [text.split() for text in self.texts]
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.ends = np.cumsum(self.lengths)
        self.hashes = np.concatenate([np.zeros(0, np.uint64), *(hashes.of(w) for w in self.words)])

    def starts(self, width: int) -> np.ndarray:
        """Places where a window of that width lies inside one document."""
        room = np.repeat(self.ends, self.lengths) - np.arange(len(self.hashes))
        return np.flatnonzero(room >= width)

    def offsets(self) -> np.ndarray:
        """Position of each word in its document."""
        return np.arange(len(self.hashes)) - np.repeat(self.ends - self.lengths, self.lengths)

    def rolling(self, starts: np.ndarray, width: int, base: int) -> np.ndarray:
        """Hashes of the windows at `starts`: differences of running sums of a polynomial modulo 2**64."""
        n = len(self.hashes)
        powers = np.full(n, base, np.uint64)
        back = np.full(n, pow(base, -1, 2**64), np.uint64)
        if n:
            powers[0] = back[0] = 1
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.hashes * np.cumprod(powers))))
        out = (sums[starts + width] - sums[starts]) * np.cumprod(back)[starts]
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        return out ^ (out >> np.uint64(32))


def pack_chunks(docs: DataFrame, chunk_chars: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        ids, texts, size, n_words = [], [], 0, 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].astype("Int64"), batch["text"], strict=True):
                raw = (text or "").encode("utf-8", "surrogatepass")
                ids.append(None if doc_id is pd.NA else int(doc_id))
                texts.append(raw)
                size, n_words = size + len(raw), n_words + len(raw.split())
                if size >= chunk_chars:
                    yield pd.DataFrame({"chunk": [number], "n_words": [n_words], "payload": [_pack(ids, texts)]})
                    ids, texts, size, n_words = [], [], 0, 0
                    number += 1
        if ids:
            yield pd.DataFrame({"chunk": [number], "n_words": [n_words], "payload": [_pack(ids, texts)]})

    return docs.select("doc_id", "text").mapInPandas(run, CHUNKS)


# --- hashes on their way to buckets and answers on their way back


def _encode(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted distinct keys as differences, byte by byte, with a small count each."""
    steps = np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8)
    raw = np.ascontiguousarray(steps.T).tobytes() + counts.astype(np.uint8).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _decode(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint8)
    n = len(raw) // 9
    steps = np.ascontiguousarray(raw[: 8 * n].reshape(8, n).T).view(np.uint64).ravel()
    return np.cumsum(steps), raw[8 * n :]


class Routing:
    """Distinct (bucket, key) pairs of some hashes, in order."""

    def __init__(self, high: np.ndarray, keys: np.ndarray, buckets: int):
        bucket = ((high >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        order = np.lexsort((keys, bucket))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(bucket[order]) != 0) | (np.diff(keys[order]) != 0)
        self.inverse = np.empty(len(order), np.int64)
        self.inverse[order] = np.cumsum(new) - 1
        self.bucket, self.keys = bucket[order][new], keys[order][new]
        self.names, self.first = np.unique(self.bucket, return_index=True)
        self.stop = np.append(self.first[1:], len(self.bucket))

    def entries(self, chunk: int, weights: np.ndarray) -> pd.DataFrame:
        """One row per bucket; the weight of a key is the capped sum over the hashes that have it."""
        counts = np.minimum(np.bincount(self.inverse, weights, len(self.keys)), 2)
        payload = [_encode(self.keys[a:b], counts[a:b]) for a, b in zip(self.first, self.stop, strict=True)]
        return pd.DataFrame({"chunk": chunk, "bucket": self.names.astype(np.int64), "payload": payload})

    def answers(self, rows: pd.DataFrame) -> np.ndarray:
        """For every hash, what its bucket answered (0 where it was silent)."""
        out = np.zeros(len(self.keys), np.uint8)
        place = dict(zip(self.names.tolist(), zip(self.first, self.stop, strict=True), strict=True))
        for bucket, payload in zip(rows["bucket"], rows["payload"], strict=True):
            first, stop = place[bucket]
            out[first:stop] = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint8)
        return out[self.inverse]


def sum_in_buckets(entries: DataFrame) -> DataFrame:
    """For every entry the sum of its key's counts over all chunks, 2 for more; buckets without any stay silent."""

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        parts = [_decode(p) for p in rows["payload"]]
        keys = np.concatenate([k for k, _ in parts])
        counts = np.concatenate([c for _, c in parts]).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        group = np.empty(len(keys), np.int64)
        group[order] = np.cumsum(np.diff(keys[order], prepend=keys[order][:1]) != 0)
        total = np.minimum(np.bincount(group, counts), 2).astype(np.uint8)[group]
        ends = np.cumsum([len(k) for k, _ in parts])
        pieces = np.split(total, ends[:-1])
        telling = [i for i, piece in enumerate(pieces) if piece.any()]
        packer = zstandard.ZstdCompressor(level=1)
        return pd.DataFrame(
            {
                "chunk": rows["chunk"].to_numpy()[telling],
                "bucket": rows["bucket"].to_numpy()[telling],
                "payload": [packer.compress(pieces[i].tobytes()) for i in telling],
            }
        )

    return entries.groupBy("bucket").applyInPandas(run, ENTRIES)


# --- the three steps


def _anchors(chunk: Chunk, block: int, buckets: int) -> tuple[np.ndarray, np.ndarray, Routing]:
    """Starts of rolling windows, which of them are indexed blocks, and their routing."""
    starts = chunk.starts(block)
    hashes = chunk.rolling(starts, block, BASES[0])
    indexed = chunk.offsets()[starts] % block == 0
    return starts, indexed, Routing(hashes, hashes & np.uint64(2**ANCHOR_BITS - 1), buckets)


def _windows(chunk: Chunk, starts: np.ndarray, width: int, buckets: int) -> Routing:
    high = chunk.rolling(starts, width, BASES[0])
    return Routing(high, chunk.rolling(starts, width, BASES[1]) & np.uint64(2**62 - 1), buckets)


def probe(chunks: DataFrame, block: int, buckets: int) -> DataFrame:
    """All rolling windows as keys; the count says how many indexed blocks the chunk has with that key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _WordHashes()
        for batch in batches:
            for number, payload in zip(batch["chunk"], batch["payload"], strict=True):
                _, indexed, routing = _anchors(Chunk(payload, hashes), block, buckets)
                if len(routing.keys):
                    yield routing.entries(number, indexed)

    return chunks.select("chunk", "payload").mapInPandas(run, ENTRIES)


def extend(chunks: DataFrame, hits: DataFrame, width: int, block: int, buckets: int) -> DataFrame:
    """Finished documents that no hit touches; for the others, a smaller chunk with the starts of windows
    around hits, and the keys of these windows."""
    finished = _finished_rows

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        chunk, number = Chunk(left["payload"].iloc[0], _WordHashes()), left["chunk"].iloc[0]
        starts, indexed, routing = _anchors(chunk, block, buckets)
        # An indexed block always meets itself.
        hit = np.zeros(len(chunk.hashes) + 1, np.int64)
        hit[starts] = routing.answers(right) > indexed if len(starts) else 0
        before = np.concatenate(([0], np.cumsum(hit)))
        candidates = chunk.starts(width)
        candidates = candidates[before[candidates + width - block + 1] > before[candidates]]
        owner = np.repeat(np.arange(len(chunk.ids)), chunk.lengths)
        touched = np.zeros(len(chunk.ids), bool)
        touched[owner[candidates]] = True
        out = [finished(chunk, np.flatnonzero(~touched), np.zeros(len(chunk.hashes), bool))]
        if len(candidates):
            keys = _windows(chunk, candidates, width, buckets)
            out.append(keys.entries(number, np.ones(len(candidates))))
            some = np.flatnonzero(touched)
            moved = np.cumsum(np.where(touched, 0, chunk.lengths))
            starts_now = (candidates - moved[owner[candidates]]).astype(np.uint32)
            packed = _pack([chunk.ids[i] for i in some], [chunk.texts[i] for i in some])
            steps = zstandard.ZstdCompressor(level=1).compress(starts_now.tobytes())
            out.append(pd.DataFrame({"chunk": [number], "payload": [packed], "starts": [steps]}))
        return _step_frame(out)

    return chunks.select("chunk", "payload").groupBy("chunk").cogroup(hits.groupBy("chunk")).applyInPandas(
        lambda left, right: run(left, right) if len(left) else _step_frame([]), STEPS
    )


def cut(chunks: DataFrame, repeats: DataFrame, width: int, buckets: int) -> DataFrame:
    """Documents with hits, without the words that repeated windows cover."""
    finished = _finished_rows

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return _step_frame([])
        chunk = Chunk(left["payload"].iloc[0], _WordHashes())
        raw = zstandard.ZstdDecompressor().decompress(left["starts"].iloc[0])
        starts = np.frombuffer(raw, np.uint32).astype(np.int64)
        repeated = starts[_windows(chunk, starts, width, buckets).answers(right) >= 2]
        change = np.zeros(len(chunk.hashes) + 1, np.int64)
        np.add.at(change, repeated, 1)
        np.add.at(change, repeated + width, -1)
        return _step_frame([finished(chunk, np.arange(len(chunk.ids)), np.cumsum(change)[:-1] > 0)])

    pairs = chunks.groupBy("chunk").cogroup(repeats.groupBy("chunk"))
    return pairs.applyInPandas(run, STEPS)


def _finished_rows(chunk: Chunk, which: np.ndarray, removed: np.ndarray) -> pd.DataFrame:
    rows = []
    for i in which:
        gone = removed[chunk.ends[i] - chunk.lengths[i] : chunk.ends[i]]
        words = chunk.words[i]
        kept = [w for w, out in zip(words, gone, strict=True) if not out] if gone.any() else words
        rows.append((chunk.ids[i], len(words), int(gone.sum()), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept_sha256"])


def _step_frame(parts: list[pd.DataFrame]) -> pd.DataFrame:
    parts = [p for p in parts if len(p)]
    out = pd.concat(parts, ignore_index=True) if parts else pd.DataFrame()
    out = out.reindex(columns=STEP_NAMES).astype(object)
    out = out.where(out.notna(), None)
    for name in ("chunk", "bucket", "doc_id", "n_words", "n_removed"):
        out[name] = out[name].astype("Int64")
    return out


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, chunk_chars: int = CHUNK_CHARS, bucket_words: int = BUCKET_WORDS
) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 of the words outside repeats, joined by one blank."""
    block = (window + 1) // 2
    chunks = stored(pack_chunks(docs, chunk_chars), "substring-chunks")
    n_words = chunks.agg(F.sum("n_words")).first()[0] or 0
    buckets = max(1, math.ceil(n_words / bucket_words))
    hits = sum_in_buckets(probe(chunks, block, buckets))
    steps = stored(extend(chunks, hits, window, block, buckets), "substring-steps")
    keys = steps.filter("bucket IS NOT NULL").select("chunk", "bucket", "payload")
    rest = steps.filter("starts IS NOT NULL").select("chunk", "payload", "starts")
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    done = steps.filter("n_words IS NOT NULL").select(*columns)
    return done.unionByName(cut(rest, sum_in_buckets(keys), window, buckets).select(*columns))
