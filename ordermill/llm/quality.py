"""Quality classifier on random-indexing word vectors.

Words (their stem in lower case, trailing signs, and a mark for capitals are separate pieces) share `ROWS` rows by hash.
Each row has a sparse random index vector; the vector of a row is the sum of the index vectors of its neighbours
within `WINDOW` pieces, counted over the texts of all documents. Documents pool their pieces' vectors (mean and spread), a
two-layer numpy network gives a logit, and a temperature fitted on rows kept out of its training calibrates the
probability.

Word vectors take no labels and cover all documents; sums are whole numbers, so they do not depend on the order
of tasks. The table of vectors has a fixed size (ROWS x DIMS numbers) and is the only thing sent to tasks. The
network is fitted on at most `SAMPLE_ROWS` labelled rows, chosen by a hash of their id, one row of each id.

Defined results: null and empty texts pool to zeros and get a score like others; labels without a document or with
a null are left out, repeated labels count by majority (ties as good); of rows that repeat a labelled id the text with the smallest hash is
fitted; without any labelled rows every score is
0.5; rows that repeat are scored each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import remainder, travels

travels(__name__)

ROWS = 2**14
DIMS = 64
NONZERO = 4
WINDOW = 2
SEED = 17
SAMPLE_ROWS = 20_000
HIDDEN = 32
EPOCHS = 40
BATCH_TOKENS = 500_000
CACHED_WORDS = 300_000
POOLED = 2 * DIMS


class Pieces(dict):
    """Rows of a word's pieces."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > CACHED_WORDS:
            self.clear()
        stem = word
        while stem and not stem[-1].isalnum():
            stem = stem[:-1]
        parts = [stem.lower()] if stem else []
        if len(stem) > 1 and stem.isupper():
            parts.append(" capitals")
        if word[len(stem) :]:
            parts.append(word[len(stem) :])
        rows = self[word] = tuple(zlib.crc32(p.encode("utf-8", "surrogatepass")) % ROWS for p in parts)
        return rows

    def of(self, text: str | None) -> np.ndarray:
        return np.fromiter(chain.from_iterable(map(self.__getitem__, (text or "").split())), np.int32)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of every row's index vector."""
    rng = np.random.default_rng(SEED)
    return rng.integers(0, DIMS, (ROWS, NONZERO)), rng.choice(np.array([-1.0, 1.0]), (ROWS, NONZERO))


# --- word vectors


def add_contexts(total: np.ndarray, rows: list[np.ndarray], places: np.ndarray, signs: np.ndarray) -> None:
    """Adds the neighbours' index vectors of some documents to `total` (ROWS * DIMS)."""
    gap = np.full(WINDOW, -1, np.int32)
    line = np.concatenate([x for doc in rows for x in (doc, gap)]) if rows else gap
    for step in range(1, WINDOW + 1):
        a, b = line[:-step], line[step:]
        both = (a >= 0) & (b >= 0)
        a, b = a[both].astype(np.int64), b[both].astype(np.int64)
        for word, other in ((a, b), (b, a)):
            for j in range(NONZERO):
                total += np.bincount(word * DIMS + places[other, j], signs[other, j], ROWS * DIMS)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """ROWS x DIMS unit vectors from the texts of all documents."""
    names = [f"v{i}" for i in range(DIMS)]
    schema = "row int, " + ", ".join(f"{n} long" for n in names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places, signs = index_vectors()
        total, pieces, held, size = np.zeros(ROWS * DIMS), Pieces(), [], 0
        for batch in batches:
            for text in batch["text"]:
                held.append(pieces.of(text))
                size += len(held[-1])
                if size >= BATCH_TOKENS:
                    add_contexts(total, held, places, signs)
                    held, size = [], 0
        add_contexts(total, held, places, signs)
        table = total.reshape(ROWS, DIMS).astype(np.int64)
        used = np.flatnonzero(table.any(axis=1))
        out = pd.DataFrame(table[used], columns=names)
        out.insert(0, "row", used.astype(np.int32))
        yield out

    sums = docs.select("text").mapInPandas(run, schema).groupBy("row").agg(*[F.sum(n).alias(n) for n in names])
    found = sums.toPandas()
    table = np.zeros((ROWS, DIMS), np.float32)
    table[found["row"].to_numpy(int)] = found[names].to_numpy(float)
    return table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)


def pool(texts: list[str | None], vectors: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Mean and spread of the vectors of each text's pieces; zeros without any."""
    out = np.zeros((len(texts), POOLED), np.float32)
    for i, text in enumerate(texts):
        rows = pieces.of(text)
        if len(rows):
            used, n = np.unique(rows, return_counts=True)
            weight = (n / n.sum()).astype(np.float32)
            mean = weight @ vectors[used]
            out[i, :DIMS] = mean
            out[i, DIMS:] = np.sqrt(np.maximum(weight @ vectors[used] ** 2 - mean**2, 0))
    return out


# --- the network


@dataclass
class Network:
    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.shift) / self.scale) @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def train_network(x: np.ndarray, y: np.ndarray) -> Network:
    """Adam on four fifths of the rows; the temperature on the last fifth."""
    rng = np.random.default_rng(SEED)
    x, y = x.astype(np.float64), y.astype(np.float64)
    net = Network(
        x.mean(axis=0) if len(x) else np.zeros(POOLED),
        x.std(axis=0) + 1e-3 if len(x) else np.ones(POOLED),
        rng.normal(0, POOLED**-0.5, (POOLED, HIDDEN)),
        np.zeros(HIDDEN),
        np.zeros(HIDDEN),
        0.0,
    )
    fit = np.arange(len(x)) % 5 != 4
    values = [net.w1, net.b1, net.w2, np.zeros(1)]
    first, second, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    inputs, wanted = ((x - net.shift) / net.scale)[fit], y[fit]
    for _ in range(EPOCHS if len(inputs) else 0):
        order = rng.permutation(len(inputs))
        for at in range(0, len(order), 128):
            a, t = inputs[order[at : at + 128]], wanted[order[at : at + 128]]
            hidden = np.tanh(a @ values[0] + values[1])
            error = (1 / (1 + np.exp(-(hidden @ values[2] + values[3]))) - t) / len(t)
            back = np.outer(error, values[2]) * (1 - hidden**2)
            grads = [a.T @ back + 1e-4 * values[0], back.sum(axis=0), hidden.T @ error, np.array([error.sum()])]
            step += 1
            for v, g, m, s in zip(values, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    net.b2 = float(values[3][0])
    if (~fit).any():
        logits = net.logits(x[~fit])
        options = np.geomspace(0.25, 4, 65)
        net.temperature = float(options[np.argmin([_loss(logits / t, y[~fit]) for t in options])])
    return net


# --- learning and scoring


def held_out(doc_id: Column) -> Column:
    return remainder(doc_id, 3) == 1


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, text, good: at most `rows` labelled documents that are not held out."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").filter(~held_out(F.col("doc_id")))
    chosen = (
        known.groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # At most `rows` rows of numbers, by the limit above.
    own = docs.select("doc_id", "text", F.xxhash64("text").alias("mark"))
    least = own.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "good").agg(F.min("mark").alias("mark"))
    # Rows that are left of one id have equal texts.
    return own.join(F.broadcast(least), ["doc_id", "mark"]).dropDuplicates(["doc_id"]).select("doc_id", "text", "good")


@dataclass
class Classifier:
    vectors: np.ndarray
    network: Network


def fit(docs: DataFrame, labels: DataFrame) -> Classifier:
    vectors = word_vectors(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = Pieces()
        for batch in batches:
            x = pool(list(batch["text"]), shared.value, pieces).astype(np.float16)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "good": batch["good"], "x": [r.tobytes() for r in x]})

    sample = training_sample(docs, labels).mapInPandas(run, "doc_id long, good int, x binary").toPandas()
    sample = sample.sort_values(["doc_id", "good", "x"])
    order = np.random.default_rng(SEED).permutation(len(sample))
    x = np.frombuffer(b"".join(sample["x"]), np.float16).reshape(-1, POOLED)[order]
    return Classifier(vectors, train_network(x, sample["good"].to_numpy()[order]))


def score(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """The rows of `docs` (doc_id, text, ...) with score and predicted."""
    net = classifier.network
    shared = docs.sparkSession.sparkContext.broadcast((classifier.vectors, vars(net)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vectors, parts = shared.value
        pieces, network = Pieces(), Network(**parts)
        for batch in batches:
            p = network.probability(pool(list(batch["text"]), vectors, pieces))
            yield batch.assign(quality_score=p, quality_predicted=(p >= 0.5).astype(np.int32))

    return docs.mapInPandas(run, schema + ", quality_score double, quality_predicted int")
