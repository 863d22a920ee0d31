"""Packing of tokenised documents into sequences by the sum-of-squares rule.

Documents arrive one after the other. What fills whole windows is cut off first; the rest goes, in one piece, into the
partially filled window (or a new one) for which the sum of the squares of N(level) becomes least, N(level) being the
number of partially filled windows at that fill level, kept in an array. The rule makes levels even, so that windows for
any rest are at hand and fill up exactly. Equal sums: the fullest window.

Every task packs the documents of its partition in one pass, nothing is shuffled, and sequence numbers begin anew in
each partition (partition number in the high bits). At the end of a partition the emptiest open windows are taken apart
to fill up the fullest, pieces being cut where needed; what is left, less than one window, is cut into sequences whose
lengths are powers of two, which need no padding. The same closing happens earlier when more than `MOST_OPEN` windows are
open, which bounds memory (`MOST_OPEN` windows of 4 bytes a token).

Tokens: those of a `tokenizers` file, whose text is broadcast, then one id that ends a document. Texts are cut before white
space that follows another character, where the pre-tokenizer of a byte-level BPE always cuts too, and pieces already seen are
looked up, so that only new ones are tokenised; the ids are those of the whole text (tested). Strings of special tokens
in a text are ordinary text.

Defined results: a null text is empty and gives the final id alone; rows that repeat or lack an id are packed each; an
empty table gives an empty result; other columns are ignored. A second run over the same files gives the same result;
write it down before it is used twice, as sequence numbers depend on how rows are dealt to partitions.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ordermill.llm.common import text_or_empty, travels

travels(__name__)

WINDOW = 2048
END = 1
MOST_OPEN = 4096
KNOWN_PIECES = 1 << 20
KNOWN_CHARS = 64  # longer pieces are not kept
CHARS_AT_ONCE = 1 << 20
COLUMNS = {
    "doc_id": None, "start": "long", "length": "long", "ids_crc32": "long",
    "doc_tokens": "long", "sequence_id": "long", "offset": "long",
}

Piece = tuple  # (document, tokens of the document, start, ids)


# Characters that Unicode calls white space, as the pre-tokenizer does.
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# A text cut before white space that follows another character.
_PIECES = re.compile(rf"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")


class Tokens:
    """Ids of texts as little-endian unsigned 32-bit numbers."""

    def __init__(self, vocabulary: str):
        # A task has one core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.known = Tokenizer.from_str(vocabulary), {}
        self.tokenizer.encode_special_tokens = True

    @staticmethod
    def of(shared: Broadcast) -> Tokens:
        """Those of a broadcast file; a worker process keeps them beside its text for its next tasks."""
        if "tokens" not in shared.value:
            shared.value["tokens"] = Tokens(shared.value["vocabulary"])
        return shared.value["tokens"]

    def encode(self, texts: Iterable[str], end: int = END) -> list[np.ndarray]:
        cut = [_PIECES.findall(text) for text in texts]
        if len(self.known) > KNOWN_PIECES:
            self.known = {}
        known, last = self.known, array("I", [end]).tobytes()
        new = list(set().union(*cut).difference(known))
        encoded = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        known.update(zip(new, (array("I", e.ids).tobytes() for e in encoded), strict=True))
        ids_of = known.__getitem__
        own = [np.frombuffer(b"".join(map(ids_of, pieces)) + last, np.uint32) for pieces in cut]
        for piece in new:
            if len(piece) > KNOWN_CHARS:
                del known[piece]
        return [ids.astype("<u4", copy=False) for ids in own]


class Packer:
    """Sum-of-squares placing of rests into windows."""

    def __init__(self, window: int, most_open: int):
        self.window, self.most_open = window, most_open
        self.n_open = 0
        self.levels: dict[int, list[list[Piece]]] = {}
        # What the sum of squares changes by when a window leaves a level, or comes to one. A level without windows
        # cannot be left; a new window leaves none, and a full one comes to none.
        self.leaving = np.full(window + 1, np.iinfo(np.int64).max // 4)
        self.leaving[0] = 0
        self.coming = np.ones(window + 1, np.int64)
        self.coming[window] = 0

    def _count(self, level: int, n: int) -> None:
        self.leaving[level] = 1 - 2 * n if n else np.iinfo(np.int64).max // 4
        self.coming[level] = 2 * n + 1

    def level_for(self, n: int) -> int:
        last = self.window - n
        change = self.leaving[: last + 1] + self.coming[n:]
        return last - int(np.argmin(change[::-1]))

    def put(self, piece: Piece) -> list[Piece] | None:
        """Places a piece shorter than a window; gives the window if that is full now."""
        n = len(piece[3])
        level = self.level_for(n)
        window: list[Piece] = []
        if level:
            window = self.levels[level].pop()
            self.n_open -= 1
            self._count(level, len(self.levels[level]))
        window.append(piece)
        if level + n == self.window:
            return window
        self.levels.setdefault(level + n, []).append(window)
        self.n_open += 1
        self._count(level + n, len(self.levels[level + n]))
        return None

    def close(self) -> Iterator[list[Piece]]:
        """All open windows as full ones and less than one window in sequences of powers of two."""
        open_ = [w for level in sorted(self.levels) for w in self.levels[level]]
        for level in self.levels:
            self._count(level, 0)
        self.levels, self.n_open = {}, 0
        emptiest, rest = 0, []
        while emptiest < len(open_) or rest:
            window = open_.pop() if emptiest < len(open_) else []
            room = self.window - sum(len(p[3]) for p in window)
            while room and (rest or emptiest < len(open_)):
                if not rest:
                    rest, emptiest = open_[emptiest], emptiest + 1
                piece, left = _cut(rest.pop(), room)
                window.append(piece)
                rest.extend(left)
                room -= len(piece[3])
            if not room:
                yield window
                continue
            size = self.window - room
            while window:
                power, sequence = 1 << (size.bit_length() - 1), []
                size -= power
                while power:
                    piece, left = _cut(window.pop(), power)
                    sequence.append(piece)
                    window.extend(left)
                    power -= len(piece[3])
                yield sequence


def _cut(piece: Piece, most: int) -> tuple[Piece, list[Piece]]:
    doc, total, start, ids = piece
    if len(ids) <= most:
        return piece, []
    return (doc, total, start, ids[:most]), [(doc, total, start + most, ids[most:])]


def _pieces(docs: Iterator[tuple[object, np.ndarray]], window: int, most_open: int) -> Iterator[list[Piece]]:
    """Sequences, as lists of pieces."""
    packer = Packer(window, most_open)
    for doc, ids in docs:
        whole = len(ids) - len(ids) % window
        for start in range(0, whole, window):
            yield [(doc, len(ids), start, ids[start : start + window])]
        if whole < len(ids):
            # A copy, so that a small rest does not keep a long document's ids.
            full = packer.put((doc, len(ids), whole, ids[whole:].copy()))
            if full:
                yield full
        if packer.n_open > most_open:
            yield from packer.close()
    yield from packer.close()


def _rows(sequences: Iterator[list[Piece]], first: int) -> Iterator[tuple]:
    for number, sequence in enumerate(sequences, first):
        offset = 0
        for doc, total, start, ids in sequence:
            yield doc, start, len(ids), zlib.crc32(ids.tobytes()), total, number, offset
            offset += len(ids)


def _packed(shared, window: int, most_open: int, end: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = Tokens.of(shared)

        def docs() -> Iterator[tuple[object, np.ndarray]]:
            for batch in batches:
                group, chars = [], 0
                for doc, text in zip(batch["doc_id"].tolist(), batch["text"], strict=True):
                    group.append((doc, text))
                    chars += len(text)
                    if chars >= CHARS_AT_ONCE:
                        yield from _encoded(group)
                        group, chars = [], 0
                yield from _encoded(group)

        def _encoded(group: list) -> Iterator[tuple[object, np.ndarray]]:
            yield from zip([d for d, _ in group], tokens.encode((t for _, t in group), end), strict=True)

        out = []
        first = TaskContext.get().partitionId() << 40
        for row in _rows(_pieces(docs(), window, most_open), first):
            out.append(row)
            if len(out) >= 10_000:
                yield pd.DataFrame(out, columns=list(COLUMNS))
                out = []
        yield pd.DataFrame(out, columns=list(COLUMNS))

    return run


def _shared(docs: DataFrame, tokenizer_file: str) -> Broadcast:
    """The file's text, some megabytes; read by the driver only."""
    with open(tokenizer_file, encoding="utf-8") as file:
        return docs.sparkSession.sparkContext.broadcast({"vocabulary": file.read()})


def pack(
    docs: DataFrame, tokenizer_file: str, window: int = WINDOW, end: int = END, most_open: int = MOST_OPEN
) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    shared = _shared(docs, tokenizer_file)
    kind = docs.schema["doc_id"].dataType.simpleString()
    # Text, as pandas turns numbers with gaps into floating ones.
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_or_empty().alias("text"))
    schema = ", ".join(f"`{c}` {t or 'string'}" for c, t in COLUMNS.items())
    packed = rows.mapInPandas(_packed(shared, window, most_open, end), schema)
    return packed.withColumn("doc_id", F.col("doc_id").cast(kind))


def packed_ids(docs: DataFrame, tokenizer_file: str, pieces: DataFrame, end: int = END) -> DataFrame:
    """sequence_id and its ids, as an array, from pieces of documents with ids of their own."""
    shared = _shared(docs, tokenizer_file)

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        return pd.Series([a.astype(np.int32) for a in Tokens.of(shared).encode(texts, end)], index=texts.index)

    encoded = docs.select(F.col("doc_id"), ids(text_or_empty()).alias("ids"))
    part = F.slice("ids", F.col("start").cast("int") + 1, F.col("length").cast("int"))
    each = pieces.join(encoded, "doc_id").select("sequence_id", F.struct("offset", part.alias("ids")).alias("p"))
    parts = F.transform(F.array_sort(F.collect_list("p")), lambda p: p["ids"])
    return each.groupBy("sequence_id").agg(F.flatten(parts).alias("ids"))
