"""Mixing sources to target weights by a low-discrepancy schedule.

Every source gets a target number of words. The schedule is a list of slots of equal length; slot i looks at
the golden-ratio point frac(i * phi) and belongs to the source whose share of the cumulative targets holds that
point, so any stretch of the schedule has nearly the wanted mix. Documents of a source are put into a fixed
pseudo-random order, their words laid end to end and cut into blocks of a slot's length; the slot that is r-th
of its source takes block r. A source that runs out starts again, up to `MAX_REPEATS` rounds.

Positions and ranks are running sums in two levels (inside a bucket, then over bucket totals), so a source with
a third of all rows is spread over many tasks. Only per-source figures (one row a source) meet in one task.

Defined results: null text has no words; a null source is a source of its own, last in order; an empty document
takes 0 words; an empty table gives an empty result; rows that repeat are separate documents; other columns are
ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import WORD, stored, text_or_empty

MAX_REPEATS = 3
BLOCK_WORDS = 4096
GOLDEN = (math.sqrt(5) - 1) / 2
# Cells that carry slots to the shares that overlap them, so that the lookup is an equality join.
CELLS = 4096
# Slots ranked together, and buckets of documents in a source (a prefix of the order key).
SLOT_CHUNK = 4096


@dataclass
class Mix:
    """Documents with their position, targets by source, and the schedule's pieces of documents."""

    documents: DataFrame
    targets: DataFrame
    pieces: DataFrame


def size_of(column: str) -> Column:
    """Number of words of a text."""
    return F.regexp_count(text_or_empty(column), F.lit(WORD)).cast("long")


def document_sizes(docs: DataFrame) -> DataFrame:
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    sized = docs.select(
        "doc_id",
        "source",
        size_of("text").alias("size"),
        order.alias("order_key"),
    )
    bucket = F.floor(F.conv(F.substring("order_key", 1, 3), 16, 10).cast("int") / 4).cast("int")
    return sized.withColumn("bucket", bucket)


def source_targets(sizes: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: size, weight, target, and the whole words to take.

    Sharing by weight with an upper limit for each source, the excess reshared until none is above its limit,
    is min(limit, weight * level) for one level. With sources in order of limit / weight, the level is the
    largest of (total - limits before) / (weights from here on).
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy(F.col("limit_words") / F.col("weight"), "src")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_name.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("src", F.row_number().over(by_name))
        .withColumn("weight", (F.col("src") - 1) % 3 + 1)
        .withColumn("limit_words", F.col("source_size") * max_repeats)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("left_words", F.col("total") - F.coalesce(F.sum("limit_words").over(before), F.lit(0)))
        .withColumn("level", F.col("left_words").cast("double") / F.sum("weight").over(rest))
        .withColumn("level", F.max("level").over(everything))
        .withColumn("target", F.least(F.col("limit_words").cast("double"), F.col("weight") * F.col("level")))
        .withColumn("take", F.floor("target").cast("long"))
        .select("src", "source", "source_size", "weight", "target", "take")
    )


def positions(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Each document's first word in its source's order."""
    inside = Window.partitionBy("source", "bucket").orderBy("order_key", "doc_id", "size")
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sizes.groupBy("source", "bucket")
        .agg(F.sum("size").alias("bucket_size"))
        .withColumn("offset", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)))
        .select(F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"), "offset")
    )
    running = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    by_source = targets.withColumnRenamed("source", "t_source")
    return (
        sizes.withColumn("inside", running - F.col("size"))
        .join(offsets, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket")))
        .withColumn("start", F.col("offset") + F.col("inside"))
        .join(by_source, F.col("source").eqNullSafe(F.col("t_source")))
        .select("doc_id", "source", "size", "src", "start", "source_size", "target", "take")
    )


def source_blocks(placed: DataFrame, block_words: int, max_repeats: int) -> DataFrame:
    """Pieces of documents by block of their source's repeated word sequence, as far as it is taken."""
    size = F.lit(block_words)
    rounds = F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1)))
    begin, end = F.col("source_size") * F.col("round") + F.col("start"), F.col("begin") + F.col("size")
    from_word = F.greatest(F.col("begin"), F.col("block") * size)
    to_word = F.least(F.col("end"), (F.col("block") + 1) * size)
    return (
        placed.filter("size > 0")
        .withColumn("round", rounds)
        .withColumn("begin", begin)
        .filter("begin < take")
        .withColumn("end", F.least(end, F.col("take")))
        .withColumn("block", F.explode(F.sequence(F.expr(f"begin div {block_words}"), F.expr(f"(end - 1) div {block_words}"))))
        .select(
            "doc_id",
            "src",
            "start",
            "size",
            "block",
            (from_word - F.col("begin")).alias("from_word"),
            (to_word - from_word).alias("n_words"),
        )
    )


def schedule(targets: DataFrame, block_words: int) -> DataFrame:
    """(slot, src, block): as many slots for each source as its target needs.

    Points give each source its share up to a few slots; surplus ranks are left out, and ranks that are still
    missing at the end are appended as the tail of the schedule.
    """
    spark = targets.sparkSession
    total = targets.agg(F.sum("target")).first()[0] or 0.0
    n_slots = math.ceil(total / block_words)
    cumulative = Window.orderBy("src").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shares = targets.withColumn("high", F.sum("target").over(cumulative)).withColumn(
        "whole", F.max("high").over(Window.orderBy("src").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    )
    needed = F.ceil(F.col("take") / F.lit(block_words)).cast("long")
    shares = shares.filter("target > 0").select(
        "src",
        needed.alias("needed"),
        ((F.col("high") - F.col("target")) / F.col("whole")).alias("low"),
        (F.col("high") / F.col("whole")).alias("high"),
    )
    cell = F.explode(
        F.sequence(
            F.floor(F.col("low") * CELLS).cast("int"),
            F.least(F.floor(F.col("high") * CELLS).cast("int"), F.lit(CELLS - 1)),
        )
    )
    by_cell = shares.withColumn("cell", cell)
    points = spark.range(n_slots).select(F.col("id").alias("slot"), (F.col("id") * GOLDEN % 1.0).alias("point"))
    points = points.withColumn("cell", F.floor(F.col("point") * CELLS).cast("int"))
    drawn = (
        points.join(by_cell, "cell")
        .filter("point >= low AND point < high")
        .select("slot", "src", "needed", F.expr(f"slot div {SLOT_CHUNK}").alias("chunk"))
    )
    earlier = Window.partitionBy("src").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = drawn.groupBy("src", "chunk").agg(F.count("*").alias("n"))
    offsets = counts.withColumn("offset", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    rank = F.row_number().over(Window.partitionBy("src", "chunk").orderBy("slot")) - 1
    main = (
        drawn.withColumn("rank", rank)
        .join(offsets, ["src", "chunk"])
        .withColumn("block", F.col("offset") + F.col("rank"))
        .filter("block < needed")
        .select("slot", "src", "block")
    )
    given = counts.groupBy("src").agg(F.sum("n").alias("given"))
    tail = (
        shares.join(given, "src", "left")
        .withColumn("given", F.coalesce("given", F.lit(0)))
        .filter("given < needed")
        .withColumn("block", F.explode(F.sequence(F.col("given"), F.col("needed") - 1)))
        .select((F.col("block") + F.lit(n_slots)).alias("slot"), "src", "block")
    )
    return main.unionByName(tail)


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, max_repeats: int = MAX_REPEATS) -> Mix:
    """The mix of `docs` (doc_id, source, text): its pieces, in order of slot, are (slot, src, block, doc_id,
    from_word, n_words); the loader reads words from_word .. from_word + n_words of that document."""
    sizes = stored(document_sizes(docs), "mix-sizes")
    targets = stored(source_targets(sizes, max_repeats), "mix-targets")
    placed = stored(positions(sizes, targets), "mix-positions")
    blocks = source_blocks(placed, block_words, max_repeats)
    pieces = blocks.join(schedule(targets, block_words), ["src", "block"])
    return Mix(placed, targets, pieces)


def words_taken(mixed: Mix) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken."""
    key = ["src", "start", "doc_id", "size"]
    counted = (
        mixed.documents.filter("size > 0")
        .select(*key, F.lit(0).cast("long").alias("n_words"))
        .unionByName(mixed.pieces.select(*key, "n_words"))
        .groupBy(*key)
        .agg(F.sum("n_words").alias("taken"))
        .select("src", "doc_id", "size", "taken")
    )
    empty = mixed.documents.filter("size = 0").select("src", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
    return counted.unionByName(empty).join(mixed.targets.drop("take", "weight"), "src").drop("src")
