"""Run every registered query against its SQL counterpart: python tests/check_oracle.py [sf_dir] [names]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as registry  # noqa: E402
from ordermill.session import build_session  # noqa: E402

# Types that both engines must agree on, by their common name.
TYPE_NAMES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def compare(spark, con, name: str, sf_dir: str) -> list[str]:
    """Differences in columns, types and values; empty when the results are equal."""
    df = registry.queries()[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted(tuple(canonical(v) for v in row) for row in df.select(*cols).collect())
    sql = registry.oracle_sql().get(name)
    if sql is None:
        return [] if got else ["no rows"]
    described = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    problems = []
    if sorted(described) != cols:
        return [f"columns {cols} != {sorted(described)}"]
    for column, kind in df.dtypes:
        if TYPE_NAMES.get(kind, kind) != described[column]:
            problems.append(f"type of {column}: {kind} != {described[column]}")
    quoted = ", ".join(f'"{c}"' for c in cols)
    rows = con.execute(f"SELECT {quoted} FROM ({sql})").fetchall()
    want = sorted(tuple(canonical(v) for v in row) for row in rows)
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if not got:
        problems.append("no rows")
    if got != want:
        diff = [(g, w) for g, w in zip(got, want, strict=False) if g != w]
        problems.append(f"{len(diff)} rows differ, first {diff[:1]}")
    return problems


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(registry.queries())
    spark = build_session(
        master="local[8]",
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            problems = compare(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        kind = "value" if name in registry.oracle_sql() else "rows"
        print(f"{'FAIL' if problems else 'ok  '} {name:28s} {kind} {time.time() - start:6.2f}s", *problems)
    print(f"{len(names) - failed} of {len(names)} equal")
    return failed


if __name__ == "__main__":
    sys.exit(main())
