"""Conversation repair: a generalised LR parse of the turns' roles with weighted edits.

The role grammar is Talk -> Open Pairs | nothing, Open -> s | nothing, Pairs -> Pairs u a | u a: an optional system turn,
then pairs of user and assistant, or no turn at all. A graph-structured stack holds all parses of the turns so far;
every turn is kept (0), reroled to user or assistant (2) or deleted (3), empty user or assistant turns may be inserted
anywhere (2), blank and repeated turns must be deleted, and a truncated turn that stays costs 1 more. Equal stack tops
are merged by least (cost, audit), the audit being the edits' initials in order. That is exact: below a top of this
grammar lies one stack only, and of two audits with equal cost for the same turns none begins with the other.

Conversations are read in their order from range partitions, so a long one lies in several tasks. Each task parses
its part from every stack top that the part may begin with, and the parts are then joined from left to right by least
(cost, audit). Which turns repeat earlier ones is found by grouping, equal turns are counted before they move, and
texts move once, for the repaired conversations. A digest of a whole conversation needs its text in order, so one
task reads it as a stream; it holds the audit (a letter a turn), not the text.

Order: by turn (missing ones first), then role, then SHA-256 of the text. Defined results: a null role or text is one
space; a null id is an id like others; roles count by their first character, so "unknown" is kept as user, and a role
with another initial (or none) can be reroled or deleted, not kept; of equal rows one is the first and the others
repeat it; gaps are null where they exceed a long; a conversation of blank turns is repaired to none; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import stored, travels

travels(__name__)

# What the edits cost, and the characters that end a turn and that leave it blank.
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
ENDS = ".!?"
BLANKS = " \t\n\x0b\x0c\r"
ROLES = {"u": "user", "a": "assistant"}
# LR table of the grammar. States: 0 start, 1 s, 2 Open, 3 Open u, 4 Open Pairs, 5 Open Pairs u, 6 and 7 with the a.
SHIFT = {(0, "s"): 1, (2, "u"): 3, (3, "a"): 6, (4, "u"): 5, (5, "a"): 7}
REDUCE = {1: (1, "Open"), 6: (2, "Pairs"), 7: (3, "Pairs")}
GOTO = {(0, "Open"): 2, (2, "Pairs"): 4}
ACCEPT = (0, 4)
# A turn's symbol: the initial of its role ("-" for any other), in capitals ("+") if truncated, "x" if it must go.
GONE = "x"
CAPITALS = {"S": "s", "U": "u", "A": "a", "+": "-"}
PIECE = 512  # turns after which the edits that all parses share are put aside
KNOWN = 32  # turns of the longest conversations whose parse is remembered
MOST_KNOWN = 1 << 16  # parses after which a task forgets

Stack = tuple  # (state, stack below)
Tops = dict  # state on top -> (cost, audit)


def _reduced(stack: Stack, pops: int, left: str) -> Stack:
    for _ in range(pops):
        stack = stack[1]
    return (GOTO[stack[0], left], stack)


def _shifted(stack: Stack, role: str) -> Stack | None:
    if stack[0] == 0 and role == "u":
        stack = _reduced(stack, 0, "Open")
    state = SHIFT.get((stack[0], role))
    if state is None:
        return None
    stack = (state, stack)
    while stack[0] in REDUCE:
        stack = _reduced(stack, *REDUCE[stack[0]])
    return stack


def _moves() -> dict[tuple[int, str], int]:
    """The state on top after a role, for all stacks that can be reached; the state on top tells stacks apart."""
    stacks, moves, new = {0: (0, None)}, {}, [0]
    while new:
        top = new.pop()
        for role in "sua":
            after = _shifted(stacks[top], role)
            if after is not None:
                moves[top, role] = after[0]
                if stacks.setdefault(after[0], after) is after:
                    new.append(after[0])
    return moves


MOVES = _moves()
STATES = tuple(sorted({0, *MOVES.values()}))


def _offer(tops: Tops, top: int | None, cost: int, audit: str) -> bool:
    """Merges equal tops by least (cost, audit)."""
    if top is None or (top in tops and tops[top] <= (cost, audit)):
        return False
    tops[top] = (cost, audit)
    return True


def with_inserts(tops: Tops) -> Tops:
    tops, new = dict(tops), list(tops)
    while new:
        top = new.pop(0)
        cost, audit = tops[top]
        for role in ROLES:
            after = MOVES.get((top, role))
            if _offer(tops, after, cost + INSERT, audit + "I"):
                new.append(after)
    return tops


def parse(tops: Tops, symbols: str) -> Tops:
    """The stack tops after some turns."""
    for symbol in symbols:
        role, more = CAPITALS.get(symbol, symbol), TRUNCATED if symbol in CAPITALS else 0
        out: Tops = {}
        for top, (cost, audit) in with_inserts(tops).items():
            _offer(out, top, cost + DELETE, audit + "D")
            if symbol != GONE:
                _offer(out, MOVES.get((top, role)), cost + more, audit + "K")
                for other in ROLES:
                    _offer(out, MOVES.get((top, other)), cost + REROLE + more, audit + "R")
        tops = out
    return tops


def finish(tops: Tops) -> tuple[int, str]:
    done = with_inserts(tops)
    return min(done[top] for top in ACCEPT if top in done)


class Part:
    """Turns of one conversation in order, parsed from some tops; `put_aside` are the edits that all parses share."""

    def __init__(self, entries: tuple[int, ...], known: dict[tuple[int, str], Tops]):
        self.known = known
        self.put_aside = {top: [] for top in entries}
        self.tops = {top: {top: (0, "")} for top in entries}
        self.fresh, self.first, self.last, self.illegal = True, "", "", 0

    def add(self, symbols: str, initials: str, illegal: int) -> None:
        for entry, tops in self.tops.items():
            if self.fresh and len(symbols) <= KNOWN:
                if (entry, symbols) not in self.known:
                    self.known[entry, symbols] = parse(tops, symbols)
                self.tops[entry] = self.known[entry, symbols]
                continue
            for at in range(0, len(symbols), PIECE):
                tops = parse(tops, symbols[at : at + PIECE])
                shared = len(commonprefix([audit for _, audit in tops.values()]))
                self.put_aside[entry].append(next(iter(tops.values()))[1][:shared])
                tops = {top: (cost, audit[shared:]) for top, (cost, audit) in tops.items()}
            self.tops[entry] = tops
        self.illegal += illegal + (not self.fresh and legal(self.last, initials[0]) is False)
        self.first, self.last, self.fresh = self.first or initials[0], initials[-1], False

    def packed(self) -> str:
        paths = {e: ["".join(self.put_aside[e]), tops] for e, tops in self.tops.items()}
        return json.dumps([paths, self.first, self.last, self.illegal])


def legal(before: str, after: str) -> bool:
    return before + after in ("su", "ua", "au")


def joined(parts: list[str]) -> tuple[int, int, str]:
    """illegal, cost and audit of a conversation from its parts in order."""
    tops: Tops = {0: (0, "")}
    illegal, before = 0, ""
    for part in parts:
        paths, first, last, inside = json.loads(part)
        out: Tops = {}
        for top, (cost, audit) in tops.items():
            shared, after = paths[str(top)]
            for end, (more, rest) in after.items():
                _offer(out, int(end), cost + more, audit + shared + rest)
        tops = out
        illegal += inside + (before != "" and not legal(before, first))
        before = last
    return illegal, *finish(tops)


# --- turns


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _name(column: str = "conv_id") -> Column:
    """The id as text that tells a missing one apart."""
    return F.coalesce(F.concat(F.lit(":"), F.col(column).cast("string")), F.lit(""))


ORDER = ("turn", "role", "digest")


def _turns(rows: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    turns = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    return turns.withColumn("digest", _digest(F.col("text")))


def faults(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest, n (equal rows), blank, truncated, repeated (an earlier turn has role and text)."""
    end = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    keys = ["conv_id", *ORDER]
    slim = turns.select(*keys, (end == "").alias("blank"), (~end.isin("", *ENDS)).alias("truncated"))
    each = slim.groupBy(*keys, "blank", "truncated").agg(F.count("*").alias("n"))
    # The first place of each role and text, by the whole key: no key of this join has more than one row.
    least = F.min(F.struct("turn")).alias("least")
    first = each.groupBy("conv_id", "role", "digest").agg(least)
    first = first.select(*[F.col(c).alias(f"first_{c}") for c in ("conv_id", "role", "digest")], F.col("least.turn").alias("first_turn"))
    same = [F.col(c).eqNullSafe(F.col(f"first_{c}")) for c in keys]
    found = each.join(first.withColumn("is_first", F.lit(True)), same, "left")
    return found.select(*keys, "n", "blank", "truncated", F.col("is_first").isNull().alias("repeated"))


def _counts(found: DataFrame) -> DataFrame:
    """name, conv_id, gaps, blank, duplicate, truncated of each conversation."""
    alone = F.when(F.col("repeated"), 0).otherwise(1)
    by_turn = found.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(~F.col("blank"), F.col("n") - alone).otherwise(0)).alias("duplicate"),
        F.sum(F.when(F.col("truncated"), alone).otherwise(0)).alias("truncated"),
    )
    turn = F.col("turn").cast("decimal(38,0)")
    gaps = (F.max(turn) - F.min(turn) + 1 - F.count("turn")).try_cast("long")
    totals = [F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated")]
    known = F.when(F.count("turn") > 0, gaps).otherwise(F.lit(0).cast("long"))
    return by_turn.groupBy("conv_id").agg(known.alias("gaps"), *totals).withColumn("name", _name())


def _symbols(found: DataFrame) -> DataFrame:
    """name, initial, symbol and rest (rows after the first, all to be deleted) of each row of `found`, sorted, with the
    number of its partition."""
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("-")
    capital = F.translate(initial, "sua-", "SUA+")
    symbol = F.when(F.col("blank") | F.col("repeated"), GONE).when(F.col("truncated"), capital).otherwise(initial)
    order = ["conv_id", *ORDER]
    placed = found.repartitionByRange(*order).sortWithinPartitions(*order)
    rest = (F.col("n") - 1).alias("rest")
    return placed.select(F.spark_partition_id().alias("part"), _name().alias("name"), initial.alias("initial"), symbol.alias("symbol"), rest)


def _repeat(values: np.ndarray, times: np.ndarray) -> np.ndarray:
    return np.repeat(values, times) if times.max() > 1 else values


def _parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each conversation of a partition; its first one may have begun in the partition before."""
    name, part, entries, number, known = None, None, STATES, 0, {}
    for batch in batches:
        if len(known) > MOST_KNOWN:
            known.clear()
        names = batch["name"].to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1])))
        times = batch["rest"].to_numpy() + 1
        rows = []
        number = int(batch["part"].iloc[0])
        initials, symbols = batch["initial"].to_numpy(), batch["symbol"].to_numpy()
        for a, b in zip(starts, [*starts[1:], len(names)], strict=True):
            if part is None or names[a] != name:
                if part is not None:
                    rows.append((name, number, part.packed()))
                part, entries, name = Part(entries, known), (0,), names[a]
            own = "".join(_repeat(initials[a:b], times[a:b]))
            marks = symbols[a:b]
            if times[a:b].max() > 1:
                marks = [s + GONE * int(n - 1) for s, n in zip(marks, times[a:b], strict=True)]
            pairs = len(own) - 1
            good = sum(own.count(p) for p in ("su", "ua", "au"))
            part.add("".join(marks), own, pairs - good)
        yield pd.DataFrame(rows, columns=["name", "part", "parse"])
    if part is not None:
        yield pd.DataFrame([(name, number, part.packed())], columns=["name", "part", "parse"])


def _joins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns, name, parts = ["name", "illegal", "cost", "audit"], None, []
    for batch in batches:
        rows = []
        for own, parse_ in zip(batch["name"], batch["parse"], strict=True):
            if parts and own != name:
                rows.append((name, *joined(parts)))
                parts = []
            name = own
            parts.append(parse_)
        yield pd.DataFrame(rows, columns=columns)
    if parts:
        yield pd.DataFrame([(name, *joined(parts))], columns=columns)


def audits(found: DataFrame) -> DataFrame:
    """name, illegal (adjacent roles that may not be so), cost and audit of each conversation."""
    parts = _symbols(found).mapInPandas(_parts, "name string, part int, parse string")
    return (
        parts.repartition("name")
        .sortWithinPartitions("name", "part")
        .mapInPandas(_joins, "name string, illegal long, cost long, audit string")
    )


# --- repaired conversations


def _repaired(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, list[tuple[str, str, str]], bool]]:
    """(name, repaired turns as (role, text, edit), whether the conversation ends) from rows sorted by name, the audit
    of a conversation before its turns."""
    name, audit, at, expected = None, "", 0, "user"

    def inserted() -> Iterator[tuple[str, str, str]]:
        nonlocal at, expected
        while audit[at : at + 1] == "I":
            yield expected, "", "I"
            at, expected = at + 1, ROLES["a" if expected == "user" else "u"]

    for batch in batches:
        done: list[tuple[str, str, str]] = []
        for own, its_audit, role, text in zip(batch["name"], batch["audit"], batch["role"], batch["text"], strict=True):
            if its_audit is not None:
                if name is not None:
                    done.extend(inserted())
                    yield name, done, True
                name, audit, at, expected, done = own, its_audit, 0, "user", []
                continue
            done.extend(inserted())
            edit = audit[at]
            at += 1
            if edit == "D":
                continue
            done.append((expected if edit == "R" else role, text, edit))
            if edit == "R" or not role.startswith("s"):
                expected = ROLES["a" if expected == "user" else "u"]
        if name is not None:
            yield name, done, False
    if name is not None:
        yield name, list(inserted()), True


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows, digest, empty = [], hashlib.sha256(), True
    for name, turns, ends in _repaired(batches):
        for role, text, _ in turns:
            digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
            empty = False
        if ends:
            rows.append((name, digest.hexdigest()))
            digest, empty = hashlib.sha256(), True
        if len(rows) >= 10_000:
            yield pd.DataFrame(rows, columns=["name", "repaired_sha256"])
            rows = []
    yield pd.DataFrame(rows, columns=["name", "repaired_sha256"])


def _texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    number = 0
    for name, turns, ends in _repaired(batches):
        rows = [(name, number + i, *turn) for i, turn in enumerate(turns)]
        yield pd.DataFrame(rows, columns=["name", "position", "role", "text", "edit"])
        number = 0 if ends else number + len(turns)


def _with_audits(turns: DataFrame, repairs: DataFrame) -> DataFrame:
    """The turns of a conversation in order, after a row that holds its audit."""
    none = F.lit(None)
    text = turns.select(_name().alias("name"), *ORDER, "text", none.cast("string").alias("audit"))
    types = dict(text.dtypes)
    heads = repairs.select("name", *[none.cast(types[c]).alias(c) for c in (*ORDER, "text")], "audit")
    rows = heads.unionByName(text).repartition("name")
    rows = rows.sortWithinPartitions("name", F.col("audit").isNull(), *ORDER)
    return rows.select("name", "audit", "role", "text")


class Repair:
    """What a repair finds; `summary` has conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""

    def __init__(self, rows: DataFrame):
        self.turns = _turns(rows)
        found = stored(faults(self.turns), "conversation-faults")
        self.repairs = stored(audits(found), "conversation-audits")
        self.counts = _counts(found)
        self.summary = self.counts.join(self.repairs, "name").drop("name")

    def conversations(self) -> DataFrame:
        """conv_id, position, role, text and edit (K, R or I) of the repaired turns."""
        schema = "name string, position long, role string, text string, edit string"
        texts = _with_audits(self.turns, self.repairs).mapInPandas(_texts, schema)
        return texts.join(self.counts.select("name", "conv_id"), "name").drop("name")

    def with_digests(self) -> DataFrame:
        """The summary and repaired_sha256, of the repaired turns as role:text, one a line."""
        digests = _with_audits(self.turns, self.repairs).mapInPandas(_digests, "name string, repaired_sha256 string")
        return self.counts.join(self.repairs, "name").join(digests, "name").drop("name")


# --- damage, for trials


def damaged(rows: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or reroled by crc32 of `conv_id:turn`."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = rows.select("conv_id", "turn", "role", "text", (F.crc32(key.cast("binary")) % 20).alias("damage"))
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    damage = F.col("damage")
    copies = F.sequence(F.lit(1), F.when(damage == 3, 2).otherwise(1))
    return rows.filter(damage != 0).select(
        "conv_id",
        "turn",
        F.when(damage == 4, ROLES["u"]).otherwise(role).alias("role"),
        F.when(damage == 1, "").when(damage == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(copies).alias("copy"),
    )


def report(rows: DataFrame) -> DataFrame:
    """The repair of the damaged rows, with a row for every conversation of the table as it was."""
    repaired = Repair(damaged(rows)).with_digests().withColumnRenamed("conv_id", "found_id")
    every = rows.select("conv_id").distinct()
    joined_ = every.join(repaired, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    counts = [F.coalesce(c, F.when(F.col("cost").isNull(), 0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    audit = F.coalesce("audit", F.lit("")).alias("audit")
    digest = F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")
    return joined_.select("conv_id", *counts, audit, digest)
