"""CSV records that may hold line breaks, read by many tasks per file.

Whether a line begins a record depends on all lines before it in the file: a quoted cell that is open at the end of a
line goes on in the next. Each line is therefore taken as a function of what comes before it, from "outside" or
"inside" a quoted cell to the state it leaves:

    no quote, or quotes that close what they open    keeps the state
    otherwise                                        turns it over, or fixes it whatever it was

Such functions are composed in two levels: over the lines of a split (a part of a file that one task reads), by running
counts within the split, and over the splits of a file, of which there is one row each. Then every line knows its state.
Lines of a record are joined within their split; only the first and the last record of a split can meet others, and
just these are joined across splits.

Cells follow the rules of the CSV reader: a cell is quoted if its first character is a quote, a doubled quote is a quote, and
other quotes are plain characters, so one inside an unquoted cell opens nothing. Records end with a line feed, with or
without a carriage return before it; empty lines between records are left out. The first record of a file is its header.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Lines that end inside a quoted cell: whole cells, then one that is opened and not closed. All loops are possessive, so
# the time is linear and no stack grows with the line.
_OPEN = r'"(?:[^"]++|"")*+'
_ENDS_INSIDE = rf'\A(?:(?:{_OPEN}"[^,]*+|[^",][^,]*+)?+,)*+{_OPEN}\z'

SPLIT = ("file", "block")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block (where its split begins), row (increasing within the split), line, and what the line does: `turns` the
    state over, or `fixes` it to inside (true) or outside (false), or neither."""
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("line"),
    )
    bare = F.regexp_replace("line", r"\r\z", "")
    from_outside = F.rlike(bare, F.lit(_ENDS_INSIDE))
    from_inside = F.rlike(F.concat(F.lit('"'), bare), F.lit(_ENDS_INSIDE))
    has_quote = F.contains("line", F.lit('"'))
    # Of a line with quotes: outside -> a, inside -> b.
    states = lines.withColumn("a", has_quote & from_outside).withColumn("b", ~has_quote | from_inside)
    return states.select(
        *SPLIT, "row", "line", (F.col("a") & ~F.col("b")).alias("turns"), F.when(F.col("a") == F.col("b"), F.col("a")).alias("fixes")
    )


def _in_split(lines: DataFrame) -> DataFrame:
    """With the state before each line if its split begins outside (`if_out`) or inside (`if_in`) a cell.

    That is the state that the last fixing line left, or the one at the beginning, turned over as often as lines since
    have turned it.
    """
    before = Window.partitionBy(*SPLIT).orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*SPLIT).orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = lines.withColumn("n_turns", F.sum(F.col("turns").cast("long")).over(upto))
    fixed = F.when(F.col("fixes").isNotNull(), F.struct("fixes", "n_turns"))
    last = counted.withColumn("last", F.last(fixed, ignorenulls=True).over(before))
    turns = F.col("n_turns") - F.col("turns").cast("long")
    odd = (turns - F.coalesce("last.n_turns", F.lit(0))) % 2 == 1
    return last.select(
        *SPLIT,
        "row",
        "line",
        "turns",
        "fixes",
        (F.coalesce("last.fixes", F.lit(False)) != odd).alias("if_out"),
        (F.coalesce("last.fixes", F.lit(True)) != odd).alias("if_in"),
    )


def _splits(lines: DataFrame) -> DataFrame:
    """file, block, inside (the state in which the split begins), n_records (that begin in it) and the split in which a
    record that is open at its beginning was begun. A row per split."""

    def after(state: str) -> Column:
        return F.max_by(F.coalesce("fixes", F.col(state) != F.col("turns")), "row")

    ends = lines.groupBy(*SPLIT).agg(
        after("if_out").alias("from_out"),
        after("if_in").alias("from_in"),
        F.count_if(~F.col("if_out")).alias("records_out"),
        F.count_if(~F.col("if_in")).alias("records_in"),
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = F.col("from_out") & ~F.col("from_in")
    counted = ends.withColumn("turns", turns).withColumn("n_turns", F.sum(turns.cast("long")).over(upto))
    fixed = F.when(F.col("from_out") == F.col("from_in"), F.struct("from_out", "n_turns"))
    last = counted.withColumn("last", F.last(fixed, ignorenulls=True).over(before))
    since = F.col("n_turns") - F.col("turns").cast("long") - F.coalesce("last.n_turns", F.lit(0))
    inside = F.coalesce("last.from_out", F.lit(False)) != (since % 2 == 1)
    known = last.withColumn("inside", inside)
    n_records = F.when(F.col("inside"), F.col("records_in")).otherwise(F.col("records_out"))
    known = known.withColumn("n_records", n_records)
    begun = F.last(F.when(F.col("n_records") > 0, F.col("block")), ignorenulls=True).over(before)
    return known.select(F.col("file").alias("of_file"), F.col("block").alias("of_block"), "inside", "n_records", begun.alias("begun"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """file, is_header and record (its lines, joined by line feeds) of each record in files that match `path`."""
    lines = _in_split(_lines(spark, path))
    splits = _splits(lines)
    of_split = (F.col("file") == F.col("of_file")) & (F.col("block") == F.col("of_block"))
    # Lines lie together by split from the running counts on, so neither this join nor the grouping moves them again.
    known = lines.join(splits, of_split).drop("of_file", "of_block")
    state = F.when(F.col("inside"), F.col("if_in")).otherwise(F.col("if_out"))
    order = Window.partitionBy(*SPLIT).orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = known.withColumn("number", F.sum((~state).cast("long")).over(order))
    parts = F.array_sort(F.collect_list(F.struct("row", "line")))
    text = F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("text")
    pieces = numbered.groupBy(*SPLIT, "number", "n_records", "begun").agg(text)
    # A record's pieces: all of what an earlier split left open, and the last record of a split.
    is_open = (F.col("number") == 0) | (F.col("number") == F.col("n_records"))
    whole = pieces.filter(~is_open).select("file", ((F.col("block") == 0) & (F.col("number") == 1)).alias("is_header"), "text")
    first = F.when(F.col("number") == 0, F.coalesce("begun", F.lit(0))).otherwise(F.col("block")).alias("first")
    ends = pieces.filter(is_open).select("file", first, "block", "number", "text")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda p: p["text"]), "\n")
    # The header is the first record of the first split, which may also be its last.
    is_header = (F.col("first") == 0) & (F.max(F.when(F.col("block") == F.col("first"), F.col("number"))) <= 1)
    across = ends.groupBy("file", "first").agg(is_header.alias("is_header"), joined.alias("text"))
    bare = F.regexp_replace("text", r"\r\z", "").alias("record")
    return whole.unionByName(across.select("file", "is_header", "text")).select("file", "is_header", bare).filter("record <> ''")
