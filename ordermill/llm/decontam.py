"""Benchmark decontamination with an Aho-Corasick automaton.

Benchmark items are normalised (A-Z lowered, runs of digits, letters a-z and non-ASCII characters are words) and
numbered word by word. Every window of 13 words holds one of the item's consecutive blocks of 7 words whole, so the automaton
is made of these blocks (and of items shorter than a window): one block in 7 words, not a pattern per window. It reads each
normalised document once; a block found is compared with up to 6 words on either side of it in the item, which gives
all windows around it that occur. Word numbers are mapped back to character offsets of the original text. Words are three
characters in the automaton, so that its nodes have few children.

The benchmark is a stated query set. It is taken in blocks of items, so that one automaton stays within
`BLOCK_WORDS` of benchmark words (some 150 bytes of a worker's memory each) however long the benchmark is; with the usual
sizes there is one block. An item is never divided.

Defined results: null texts have no words, a document without words is never contaminated, an item without words
never occurs, items that repeat count once, an item without an id hits words like others but is in no list of items
(n_items counts ids only), an empty benchmark hits nothing; rows that repeat are judged each, other columns are
ignored unless they are to be kept. Columns to keep come back as they are; a column of the result whose name is taken by one
of them gets underscores behind it (`result_name`).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import lower_ascii, stored, travels

travels(__name__)

WINDOW = 13
BLOCK_WORDS = 1_500_000
# Bytes of words after lowering A-Z are 0-9, a-z and everything outside ASCII.
_WORD_BYTES = re.compile(rb"[0-9a-z\x80-\xff]+")
_BLANKED = bytes(b if _WORD_BYTES.fullmatch(bytes([b])) else 32 for b in range(256))
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RUNS = "array<struct<start:int,end:int>>"
NAMES = ("n_words", "n_hit", "items", "runs", "spans")
TYPES = ("long", "long", "array<string>", RUNS, RUNS)
# Characters of a word number, and digits of each; other words are one that no item has.
CODE, DIGITS = 3, 200
UNKNOWN = "\xff" * CODE
# Surroundings that a found block is compared with one by one; beyond, windows are looked up.
FEW = 16


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_BLANKED).split()


class Pattern:
    """A block of words: the ids of items that consist of it, and what stands around it in longer ones."""

    __slots__ = ("around", "n_words", "whole", "windows")

    def __init__(self, n_words: int):
        self.n_words, self.whole = n_words, None
        self.around: dict[tuple[str, str], set[str]] = {}
        self.windows: dict[str, set[str]] | None = None

    def look_up_windows(self, block: str, window: int) -> None:
        """For a block with very many surroundings: the windows it is part of, by their words."""
        self.windows = {}
        for (left, right), owners in self.around.items():
            run = left + block + right
            for at in range(0, len(run) - window * CODE + 1, CODE):
                self.windows.setdefault(run[at : at + window * CODE], set()).update(owners)
        self.around = {}


def _shared_end(a: str, b: str) -> int:
    """Words that two codes have in common at their ends."""
    most, n = min(len(a), len(b)), 0
    while n < most and a[len(a) - n - CODE : len(a) - n] == b[len(b) - n - CODE : len(b) - n]:
        n += CODE
    return n // CODE


def _shared_start(a: str, b: str) -> int:
    most, n = min(len(a), len(b)), 0
    while n < most and a[n : n + CODE] == b[n : n + CODE]:
        n += CODE
    return n // CODE


class Index:
    """The automaton over some items."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        self.window, self.block = window, (window + 1) // 2
        self.codes: dict[bytes, str] = {}
        patterns: dict[str, Pattern] = {}
        for item_id, text in set(items):
            words = normal_words(text)
            item, ids = "".join(map(self._new_code, words)), set() if item_id is None else {item_id}
            if 0 < len(words) < window:
                pattern = patterns.setdefault(item, Pattern(len(words)))
                pattern.whole = (pattern.whole or set()) | ids
                continue
            size, beside = self.block * CODE, (window - self.block) * CODE
            for at in range(0, len(item) - size + 1, size):
                pattern = patterns.setdefault(item[at : at + size], Pattern(self.block))
                around = item[max(0, at - beside) : at], item[at + size : at + size + beside]
                pattern.around.setdefault(around, set()).update(ids)
        self.automaton = ahocorasick.Automaton() if patterns else None
        for block, pattern in patterns.items():
            if len(pattern.around) > FEW:
                pattern.look_up_windows(block, window)
            self.automaton.add_word(block, pattern)
        if patterns:
            self.automaton.make_automaton()

    def _new_code(self, word: bytes) -> str:
        code = self.codes.get(word)
        if code is None:
            high, low = divmod(len(self.codes), DIGITS)
            code = self.codes[word] = chr(high // DIGITS) + chr(high % DIGITS) + chr(low)
        return code

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, int, set[str]]]:
        """(first word, word after the last, ids) of runs of words that windows of the items cover."""
        if self.automaton is None or not words:
            return
        known = self.codes
        text = "".join([known.get(word, UNKNOWN) for word in words])
        for end, pattern in self.automaton.iter(text):
            # Numbers of neighbouring words may hold another one across them.
            if (end + 1) % CODE:
                continue
            after = (end + 1) // CODE
            first = after - pattern.n_words
            if pattern.whole is not None:
                yield first, after, pattern.whole
            beside = self.window - self.block
            left, right = text[max(0, first - beside) * CODE : first * CODE], text[after * CODE : (after + beside) * CODE]
            for (before, behind), ids in pattern.around.items():
                a, b = _shared_end(left, before), _shared_start(right, behind)
                if a + pattern.n_words + b >= self.window:
                    yield first - a, after + b, ids
            if pattern.windows is not None:
                run, start = left + text[first * CODE : after * CODE] + right, first - len(left) // CODE
                for at in range(len(run) // CODE - self.window + 1):
                    ids = pattern.windows.get(run[at * CODE : (at + self.window) * CODE])
                    if ids is not None:
                        yield start + at, start + at + self.window, ids


class Block:
    """Some benchmark items; broadcast, so that a worker process builds their automaton once for all its tasks."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        self.items, self.window = items, window

    @cached_property
    def index(self) -> Index:
        return Index(self.items, self.window)


def _runs(hit: np.ndarray) -> list[dict[str, int]]:
    """Runs of true values, end exclusive."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _original_spans(text: str | None, runs: list[dict[str, int]]) -> list[dict[str, int]]:
    """Character offsets, in the text as given, of runs of words."""
    if not len(runs):
        return []
    raw = text.encode("utf-8", "surrogatepass").lower()
    words = [m.span() for m in _WORD_BYTES.finditer(raw)]
    is_char = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
    chars = np.concatenate(([0], np.cumsum(is_char)))
    return [
        {"start": int(chars[words[r["start"]][0]]), "end": int(chars[words[r["end"] - 1][1]])} for r in runs
    ]


def scan(text: str | None, index: Index, runs=(), items=()) -> tuple[int, list[dict[str, int]], list[str]]:
    """Number of words, runs of hit words and items found, together with those found before."""
    words = normal_words(text)
    found = list(index.occurrences(words))
    if not found:
        return len(words), list(runs), list(items)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, [first for first, _, _ in found], 1)
    np.add.at(change, [after for _, after, _ in found], -1)
    for run in runs:
        change[run["start"]] += 1
        change[run["end"]] -= 1
    owners = {id(ids): ids for _, _, ids in found}.values()
    return len(words), _runs(np.cumsum(change)[:-1] > 0), sorted(set(items).union(*owners))


def result_name(name: str, taken: Sequence[str]) -> str:
    """The name of a column of the result beside columns to keep; Spark does not tell upper and lower case apart."""
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """For each row of `docs`: the columns to keep, n_words, n_hit, items (sorted ids with occurring windows), runs of
    hit words (word numbers) and spans (character offsets in the original text). Nothing is shuffled."""
    spark = docs.sparkSession
    texts = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    n_words = texts.agg(F.sum(F.regexp_count(lower_ascii(F.col("text")), F.lit(_WORD)))).first()[0] or 0
    n_blocks = max(1, math.ceil(n_words / block_words))
    # What goes into a block and comes out of it has one place each, whatever the columns to keep are called.
    kept = F.struct(*[F.col(c) for c in keep]) if keep else F.lit(None).cast("boolean")
    no_runs, no_items = F.array().cast(RUNS), F.array().cast("array<string>")
    state = docs.select(kept.alias("kept"), F.col("text").alias("text"), no_runs.alias("runs"), no_items.alias("items"))
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in state.schema]
    ends = [f"{name} {kind}" for name, kind in zip(NAMES, TYPES, strict=True)]
    for block in range(n_blocks):
        items = texts.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block).collect()
        shared = spark.sparkContext.broadcast(Block([(r["item_id"], r["text"]) for r in items], window))
        final = block == n_blocks - 1
        state = state.mapInArrow(_scanner(shared, final), ", ".join([types[0], *ends] if final else types))
        if not final:
            state = stored(state, "decontam")
    own = [F.col(name).alias(result_name(name, keep)) for name in NAMES]
    return state.select(*[F.col("kept")[c].alias(c) for c in keep], *own)


def _scanner(shared, final: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value.index
        spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            rows = []
            columns = [batch.column(i).to_pylist() for i in (1, 2, 3)]
            for text, before, items in zip(*columns, strict=True):
                n_words, runs, items = scan(text, index, before, items)
                n_hit = sum(r["end"] - r["start"] for r in runs)
                rows.append((n_words, n_hit, items, runs, _original_spans(text, runs) if final else None))
            n_words, n_hit, items, runs, chars = zip(*rows, strict=True) if rows else ((),) * 5
            out = {"items": pa.array(items, pa.list_(pa.string())), "runs": pa.array(runs, spans)}
            if final:
                # Columns that are kept are passed on as they came.
                counts = {"n_words": pa.array(n_words, pa.int64()), "n_hit": pa.array(n_hit, pa.int64())}
                made = {"kept": batch.column(0), **counts, **out, "spans": pa.array(chars, spans)}
            else:
                made = {"kept": batch.column(0), "text": batch.column(1), "runs": out["runs"], "items": out["items"]}
            yield pa.RecordBatch.from_pydict(made)

    return run


def judge(found: DataFrame) -> DataFrame:
    """The contract's columns; a document is contaminated when at least one word in twenty is hit."""
    joined = F.array_join(F.array_sort("items"), ",").cast("binary")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(joined, 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
        "spans",
    )


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))
