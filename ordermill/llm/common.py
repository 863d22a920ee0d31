"""Text units and intermediate tables that the corpus operators share."""

from __future__ import annotations

import string
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.session import scratch_dir

# Fixed value: a word is a run of characters other than space and the five ASCII control blanks.
WORD = r"[^\x20\x09-\x0D]+"


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo a divisor; a missing id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder, so that nothing later depends on one executor."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def travels(module: str) -> None:
    """Lets tasks take the functions and classes of a module along, so that executors need no copy of it."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
