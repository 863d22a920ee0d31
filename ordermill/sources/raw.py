"""Raw tables from CSV files (Bronze)."""

from __future__ import annotations

import logging
from collections.abc import Collection, Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.jobs import run_all
from ordermill.schemas import RAW_FILES, RAW_SCHEMAS
from ordermill.sources.files import only_match
from ordermill.sources.records import read_records
from ordermill.sources.tables import table_exists, write_table

log = logging.getLogger(__name__)

# Review texts hold line breaks, so their records are put together from lines first (see `records`). A line break in
# another table shows up as rejected rows; callers can name more tables.
MULTI_LINE_TABLES = frozenset({"order_reviews"})

REPORT_SCHEMA = "table_name STRING, rows BIGINT, rejected BIGINT, error STRING"

# Why a row was rejected, null for good rows.
REASON = "_rejected_for"
_LINE = "_corrupt_record"
_EXACT = "decimal(38,18)"
_CSV = {"quote": '"', "escape": '"', "columnNameOfCorruptRecord": _LINE}


def _cells_of_records(records: DataFrame, as_text: T.StructType) -> DataFrame:
    """Cells of records that may hold line breaks. A header that does not name the columns stops the job, as it
    does when Spark reads the file."""
    options = {**{k: str(v) for k, v in _CSV.items()}, "multiLine": "true", "lineSep": "\n"}
    names = [f.name for f in as_text.fields if f.name != _LINE]
    bare = F.regexp_replace("record", "\\A\ufeff", "")
    cells = records.select("is_header", F.from_csv(bare, as_text.simpleString()[7:-1].replace(":", " "), options).alias("c"))
    same = F.col(f"c.{_LINE}").isNull()
    for name in names:
        same &= F.lower(f"c.{name}").eqNullSafe(name.lower())
    wrong = F.raise_error(F.lit(f"CSV header does not name the columns {', '.join(names)}"))
    kept = F.when(F.col("is_header"), F.when(same, False).otherwise(wrong.cast("boolean"))).otherwise(True)
    return cells.filter(kept).select("c.*")


def parse_raw_csv(
    spark: SparkSession, path: str, table: str, multi_line: Collection[str] = MULTI_LINE_TABLES
) -> DataFrame:
    """All rows of a CSV file with header, in the declared types, and why a row is rejected.

    The header must name the declared columns in order. Cells are read as text and converted here, so that a
    cell that is no value of its type, an amount that does not fit exactly, and a row with too few or too many
    cells are seen instead of becoming null.
    """
    fields = T.StructType.fromDDL(RAW_SCHEMAS[table]).fields
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in fields]).add(_LINE, "string")
    if table in multi_line:
        lines = _cells_of_records(read_records(spark, path), as_text)
    else:
        header = {"header": True, "enforceSchema": False, "columnPruning": False, "encoding": "UTF-8"}
        lines = spark.read.schema(as_text).options(**header, **_CSV).csv(path)

    def bad(field: T.StructField) -> Column:
        cell, kind = F.col(field.name), field.dataType
        wrong = cell.isNotNull() & cell.try_cast(kind).isNull()
        if isinstance(kind, T.DecimalType):
            wrong |= ~cell.try_cast(_EXACT).eqNullSafe(cell.try_cast(kind).cast(_EXACT))
        return F.when(wrong, F.lit(field.name))

    cells = F.concat_ws(", ", *[bad(f) for f in fields])
    reason = F.when(F.col(_LINE).isNotNull(), "number of cells").when(cells != "", cells)
    return lines.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields], _LINE, reason.alias(REASON))


def read_raw_csv(
    spark: SparkSession, path: str, table: str, multi_line: Collection[str] = MULTI_LINE_TABLES
) -> DataFrame:
    """The good rows; zip codes keep their leading zeros."""
    return parse_raw_csv(spark, path, table, multi_line).filter(F.col(REASON).isNull()).drop(_LINE, REASON)


def stamp(df: DataFrame, table: str, at: Column | None = None) -> DataFrame:
    """Provenance: time of ingestion and origin."""
    return df.withColumns(
        {
            "_bronze_ingested_at": F.current_timestamp() if at is None else at,
            "_source": F.lit(f"batch_csv/{table}"),
        }
    )


def rejected_path(bronze: str, table: str) -> str:
    return f"{bronze}/_rejected/{table}"


def ingest_counted(
    spark: SparkSession, path: str, table: str, bronze: str, multi_line: Collection[str] = MULTI_LINE_TABLES
) -> tuple[int, int]:
    """Write one stamped raw table and keep its rejected rows aside; returns the numbers of both.

    Both are counted while the table is written; the file is read again only where rows were rejected.
    """
    parsed, seen = parse_raw_csv(spark, path, table, multi_line), Observation()
    counted = parsed.observe(seen, F.count_if(F.col(REASON).isNotNull()).alias("rejected"))
    good = counted.filter(F.col(REASON).isNull()).drop(_LINE, REASON)
    rows, rejected = write_table(stamp(good, table), f"{bronze}/{table}"), seen.get["rejected"]
    aside = rejected_path(bronze, table)
    if rejected or table_exists(spark, aside):
        write_table(stamp(parsed.filter(F.col(REASON).isNotNull()), table), aside)
    return rows, rejected


def ingest_table(spark: SparkSession, path: str, table: str, bronze: str) -> int:
    return ingest_counted(spark, path, table, bronze)[0]


def ingest_all(
    spark: SparkSession,
    folder: str,
    bronze: str,
    files: Mapping[str, str] = RAW_FILES,
    multi_line: Collection[str] = MULTI_LINE_TABLES,
) -> DataFrame:
    """Ingest the tables side by side; one that fails is reported (its cause is logged) and does not stop the others.

    A pattern must match one file or folder: with a second one, say a copy, rows would count twice.
    """

    def ingest(table: str, pattern: str) -> tuple[int, int]:
        return ingest_counted(spark, only_match(spark, f"{folder}/{pattern}"), table, bronze, multi_line)

    tasks = {table: lambda table=table, pattern=pattern: ingest(table, pattern) for table, pattern in files.items()}
    report = []
    for table, found in run_all(spark, tasks, stop_on_failure=False).items():
        if isinstance(found, Exception):
            log.error("table %s was not ingested", table, exc_info=found)
            report.append((table, None, None, (str(found) or type(found).__name__).splitlines()[0]))
        else:
            report.append((table, *found, None))
    return spark.createDataFrame(report, REPORT_SCHEMA)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table in one job."""
    return _stack(
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    )


def layer_report(layer: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    return row_counts(tables).select(F.lit(layer).alias("layer"), "table_name", "rows")


def _stack(parts: Iterable[DataFrame]) -> DataFrame:
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first
