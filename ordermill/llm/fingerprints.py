"""Document fingerprints by winnowing, and how alike they are.

A text is cut into units: its words, words of more than `UNIT_CHARS` characters into pieces of that length (so that
texts without blanks have units too). Every run of `GRAM` units has a hash; of every `WINDOW` consecutive hashes
the smallest is chosen, the rightmost one on ties, and kept with its position. Two texts that share a run of
GRAM + WINDOW - 1 units share a chosen hash.

The edited text of a document is its text with the last third replaced by the beginning of the next document.
Its fingerprint reuses the choices of the windows before the edit. The next document is found by ranges of ids,
so no task sees all of them; texts are shuffled once.

Defined results: null text is empty; an empty text has no hash, and two empty fingerprints are alike by 1.0, an
empty and another one by 0.0; a text shorter than a gram or a window counts as one; a null doc_id comes after all
others; rows that repeat an id have the same neighbours (where their texts differ, the smallest opening counts);
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import stored, text_or_empty

GRAM = 3
WINDOW = 10
UNIT_CHARS = 16
UNIT = rf"[^\x20\x09-\x0D]{{1,{UNIT_CHARS}}}"
# A chosen gram is one number: 32 bits of hash, then 31 bits that fall with the position, so that the smallest
# number of a window is the smallest hash, and the rightmost of equal ones.
POSITION_BITS = 31
LAST_POSITION = 2**POSITION_BITS - 1
NO_ID = -(2**63)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often and deep inside lambdas it is used."""
    return F.get(F.transform(F.array(value), body), 0)


def units(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(UNIT), F.lit(0))


def _with_choices(df: DataFrame, units_column: str, out: str, first: Column | None = None) -> DataFrame:
    """Adds the chosen grams of a column of units; `first` is the position of its first unit."""
    first = F.lit(0) if first is None else first
    none = F.array().cast("array<long>")

    def count(items: Column, width: int) -> Column:
        return F.greatest(F.size(items) - (width - 1), F.least(F.size(items), F.lit(1)))

    def entries(codes: Column, start: Column) -> Column:
        def entry(i: Column) -> Column:
            gram = F.xxhash64(*[F.get(codes, i + j) for j in range(GRAM)])
            return F.shiftleft(F.shiftrightunsigned(gram, 32), POSITION_BITS).bitwiseOR(start - i)

        return F.when(F.size(codes) > 0, F.transform(F.sequence(F.lit(0), count(codes, GRAM) - 1), entry)).otherwise(none)

    def choices(grams: Column) -> Column:
        lowest = F.transform(F.sequence(F.lit(1), count(grams, WINDOW)), lambda i: F.array_min(F.slice(grams, i, WINDOW)))
        return F.when(F.size(grams) > 0, F.array_distinct(lowest)).otherwise(none)

    codes = F.transform(units_column, lambda u: F.xxhash64(u))
    start = F.lit(LAST_POSITION).cast("long") - first
    grams = _let(start, lambda s: _let(codes, lambda c: entries(c, s)))
    return df.withColumn(out, _let(grams, choices))


def _position(choice: Column) -> Column:
    return F.lit(LAST_POSITION) - choice.bitwiseAND(F.lit(LAST_POSITION).cast("long"))


def _hash(choice: Column) -> Column:
    return F.shiftright(choice, POSITION_BITS)


def winnow(docs: DataFrame) -> DataFrame:
    """doc_id and marks, an array of (hash, position of the gram's first unit) in order of position."""
    chosen = _with_choices(docs.select("doc_id", units(text_or_empty()).alias("u")), "u", "chosen")
    mark = lambda c: F.struct(_hash(c).alias("hash"), _position(c).alias("position"))
    return chosen.select("doc_id", F.transform("chosen", mark).alias("marks"))


def likeness(left: Column, right: Column) -> Column:
    """Jaccard likeness of two arrays of distinct hashes."""
    sizes = F.struct(
        F.size(F.array_intersect(left, right)).alias("both"), (F.size(left) + F.size(right)).alias("sum")
    )
    return _let(
        sizes, lambda n: F.when(n["sum"] == 0, F.lit(1.0)).otherwise(n["both"] / (n["sum"] - n["both"]))
    )


def _hash_set(choices: str) -> Column:
    return F.array_distinct(F.transform(choices, lambda c: (_hash(c) - 2**31).cast("int")))


def fingerprint_text(choices: str) -> Column:
    return F.array_join(F.transform(choices, lambda c: F.lower(F.lpad(F.hex(_hash(c)), 8, "0"))), "")


def neighbours(docs: DataFrame) -> DataFrame:
    """key, next_key in descending order (the first after the last), prev_key and how many characters the
    document before takes from this one. The key is doc_id, a null one as the smallest long."""
    key = F.coalesce("doc_id", F.lit(NO_ID)).alias("key")
    ids = docs.select(key, F.length(text_or_empty()).alias("n")).groupBy("key").agg(F.min("n").alias("n"))
    ranged = stored(
        ids.repartitionByRange(F.col("key").desc()).withColumn("part", F.spark_partition_id()), "fingerprint-ids"
    )
    in_part = Window.partitionBy("part").orderBy(F.col("key").desc())
    # One row per part, of which there are as many as shuffle partitions.
    by_part = Window.orderBy("part")
    parts = (
        ranged.groupBy("part")
        .agg(F.max("key").alias("head"))
        .withColumn("after", F.coalesce(F.lead("head").over(by_part), F.first("head").over(by_part)))
        .drop("head")
    )
    following = (
        ranged.withColumn("next_key", F.lead("key").over(in_part))
        .join(parts, "part")
        .select("key", "n", F.coalesce("next_key", "after").alias("next_key"))
    )
    following = stored(following, "fingerprint-next")
    before = following.select(
        F.col("next_key").alias("key"), F.col("key").alias("prev_key"), F.expr("n div 3").cast("int").alias("asked")
    )
    return following.select("key", "next_key").join(before, "key")


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    key = F.coalesce("doc_id", F.lit(NO_ID)).alias("key")
    own = docs.select(key, text_or_empty().alias("text"), units(text_or_empty()).alias("u"))
    own = _with_choices(own, "u", "chosen").select("key", "text", "chosen")
    placed = own.join(neighbours(docs).select("key", "prev_key", "asked"), "key")
    opening = F.struct(F.expr("substring(text, 1, asked)").alias("opening"), _hash_set("chosen").alias("next_hashes"))
    givers = placed.select(F.col("prev_key").alias("key"), opening.alias("given"))
    givers = givers.groupBy("key").agg(F.min("given").alias("given")).select("key", "given.*")
    joined = placed.select("key", "text", "chosen").join(givers, "key")
    return _compared(joined)


def _compared(joined: DataFrame) -> DataFrame:
    n = F.length("text")
    kept_text = F.expr("substring(text, 1, length(text) - length(text) div 3)")
    # The last kept unit may go on in the replacement, so it is cut again together with it.
    open_end = F.size("kept_units") > 0
    last = F.when(F.col("kept_text").rlike(r"[^\x20\x09-\x0D]\z") & open_end, F.element_at("kept_units", -1))
    n_same = F.size("kept_units") - F.when(last.isNotNull(), 1).otherwise(0)
    # Windows that lie in the units before the edit, and the choice of the last of them.
    n_shared = F.greatest(F.lit(0), F.col("n_same") - (WINDOW + GRAM - 1) + 1)

    def choices_before(n_shared: Column) -> Column:
        in_last = lambda c: (_position(c) >= n_shared - 1) & (_position(c) < n_shared - 1 + WINDOW)
        last_choice = _position(F.array_min(F.filter("chosen", in_last)))
        return _let(last_choice, lambda last: F.filter("chosen", lambda c: _position(c) <= last))

    none = F.array().cast("array<long>")
    out = (
        joined.withColumn("n_chars", n.cast("long"))
        .withColumn("kept_text", kept_text)
        .withColumn("edited_sha256", F.sha2(F.concat("kept_text", "opening").cast("binary"), 256))
        .withColumn("kept_units", units(F.col("kept_text")))
        .withColumn("last", last)
        .withColumn("n_same", n_same)
        .withColumn("n_shared", n_shared)
        .withColumn("new_units", units(F.concat(F.coalesce("last", F.lit("")), F.col("opening"))))
        .withColumn(
            "tail",
            F.concat(
                F.slice("kept_units", F.col("n_shared") + 1, F.greatest(F.lit(0), F.col("n_same") - F.col("n_shared"))),
                F.col("new_units"),
            ),
        )
        # A tail below a window's units adds none after the shared windows.
        .withColumn("tail", F.when((F.col("n_shared") == 0) | (F.size("tail") >= WINDOW + GRAM - 1), F.col("tail")).otherwise(F.array().cast("array<string>")))
        .withColumn("before", F.when(F.col("n_shared") > 0, _let(F.col("n_shared"), choices_before)).otherwise(none))
        .select("key", "n_chars", "edited_sha256", "chosen", "next_hashes", "n_shared", "tail", "before")
    )
    out = _with_choices(out, "tail", "after", F.col("n_shared"))
    out = out.withColumn("edited", F.array_distinct(F.concat("before", "after")))
    return out.select(
        F.when(F.col("key") != NO_ID, F.col("key")).alias("doc_id"),
        "n_chars",
        "edited_sha256",
        fingerprint_text("chosen").alias("fingerprint"),
        fingerprint_text("edited").alias("edited_fingerprint"),
        _let(_hash_set("chosen"), lambda own: _let(_hash_set("edited"), lambda other: likeness(own, other))).alias("near_edited"),
        _let(_hash_set("chosen"), lambda own: likeness(own, F.col("next_hashes"))).alias("near_next"),
    )
