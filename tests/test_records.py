"""CSV records put together from lines, against the reader that takes a file as a whole."""

from __future__ import annotations

import contextlib
import random

import pytest
from pyspark.sql import functions as F

from ordermill.schemas import RAW_SCHEMAS
from ordermill.sources import raw, records

HEADER = ",".join(f.split()[0] for f in RAW_SCHEMAS["order_reviews"].replace("\n", " ").split(",") if f.split())
N_CELLS = HEADER.count(",") + 1


@contextlib.contextmanager
def small_splits(spark, n_bytes: int):
    settings = {"spark.sql.files.maxPartitionBytes": str(n_bytes), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def whole_file(spark, path):
    """The records as the reader for multi-line files sees them."""
    schema = ", ".join(f"c{i} STRING" for i in range(N_CELLS)) + ", _bad STRING"
    reader = spark.read.schema(schema).option("header", True).option("multiLine", True).option("columnNameOfCorruptRecord", "_bad")
    return reader.option("quote", '"').option("escape", '"').option("enforceSchema", True).option("columnPruning", False).csv(path)


def text_cells(spark, path):
    names = [f.split()[0] for f in RAW_SCHEMAS["order_reviews"].replace("\n", " ").split(",")]
    schema = raw.T.StructType([raw.T.StructField(n, raw.T.StringType()) for n in names]).add(raw._LINE, "string")
    return raw._cells_of_records(records.read_records(spark, path), schema)


def some_cells(rng):
    values = ["", "a", "1", "é東", '"x"', '""', 'one "two"', "a,b", "line\nbreak", "\n", 'a\n"b",\nc', ",\n,", "tail\n"]
    return [rng.choice(values) for _ in range(N_CELLS)]


def quoted(cell, rng):
    if rng.random() < 0.3 or any(c in cell for c in ',"\n'):
        return '"' + cell.replace('"', '""') + '"'
    return cell


def write(tmp_path, lines, name="r.csv", end="\n", last=True):
    (tmp_path / name).write_text(end.join([HEADER, *lines]) + (end if last else ""), encoding="utf-8", newline="")
    return str(tmp_path / name)


def same(spark, path):
    got = sorted(repr(tuple(r)[:N_CELLS]) for r in text_cells(spark, path).filter(f"{raw._LINE} IS NULL").collect())
    want = sorted(repr(tuple(r)[:N_CELLS]) for r in whole_file(spark, path).filter("_bad IS NULL").collect())
    assert got == want
    return got


@pytest.mark.parametrize("split", [7, 40, 200, 100_000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_any_split_gives_the_records_of_the_file(spark, tmp_path, split, end):
    rng = random.Random(split)
    lines = [",".join(quoted(c, rng) for c in some_cells(rng)) for _ in range(60)]
    path = write(tmp_path, lines, end=end, last=split != 40)
    with small_splits(spark, split):
        assert len(same(spark, path)) == 60


def test_quotes_inside_plain_cells_open_nothing(spark, tmp_path):
    good = ['r1,o1,5,an 7" pipe,"two\nlines",,', 'r2,o2,4,6" and 7",x,,', 'r3,o3,3,,"closed" twice",,', "r4,o4,2,,z,,"]
    for split in (15, 10_000):
        with small_splits(spark, split):
            got = text_cells(spark, write(tmp_path, good)).collect()
        assert sorted(r["review_id"] for r in got if r[raw._LINE] is None) == ["r1", "r2", "r3", "r4"]
        assert {r["review_id"]: r["review_comment_message"] for r in got}["r1"] == "two\nlines"


def test_rows_with_too_few_or_many_cells_are_rejected_alone(spark, tmp_path):
    lines = ['r1,o1,5,,"a\nb",,', "r2,o2", 'r3,o3,5,,"c\nd",,,8', "r4,o4,1,,,,"]
    with small_splits(spark, 20):
        rows = raw.parse_raw_csv(spark, write(tmp_path, lines), "order_reviews").collect()
    assert {r["review_id"]: r[raw.REASON] for r in rows} == {"r1": None, "r2": "number of cells", "r3": "number of cells", "r4": None}


def test_a_header_that_does_not_fit_stops_the_job(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\n", encoding="utf-8")
    with pytest.raises(Exception, match="header does not name"):
        raw.parse_raw_csv(spark, f"{tmp_path}/x.csv", "order_reviews").collect()


def test_several_files_and_a_record_over_many_splits(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    long = "\n".join(f"line {i}" for i in range(500))
    for n in range(3):
        write(folder, [f'r{n},o,1,,"{long} {n}",,', f"s{n},o,2,,,,"], name=f"{n}.csv")
    with small_splits(spark, 300):
        got = {r["review_id"]: r["review_comment_message"] for r in text_cells(spark, str(folder)).collect()}
    assert got == {**{f"r{n}": f"{long} {n}" for n in range(3)}, **dict.fromkeys(("s0", "s1", "s2"))}


def test_empty_files_and_files_of_a_header(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("")
    (folder / "b.csv").write_text("﻿" + HEADER, encoding="utf-8")
    assert text_cells(spark, str(folder)).count() == 0


def test_long_lines_cost_linear_time(spark, tmp_path):
    cell = '"' + 'a""b,' * 400_000 + '"'
    path = write(tmp_path, [f"r1,o1,5,,{cell},,", f'r2,o2,5,,"{"x" * 2_000_000}\n",,'])
    got = {r["review_id"]: len(r["review_comment_message"]) for r in text_cells(spark, path).collect()}
    assert got == {"r1": 4 * 400_000, "r2": 2_000_001}


def test_a_large_file_is_read_by_several_tasks(spark, tmp_path):
    row = 'r{0},o{0},5,,"' + "words and\nmore words " * 40 + '",,'
    path = write(tmp_path, [row.format(i) for i in range(240_000)])
    found = raw.read_raw_csv(spark, path, "order_reviews")
    with small_splits(spark, 16 << 20):
        assert records._lines(spark, path).rdd.getNumPartitions() >= 12
        assert found.select(F.count("*"), F.count_distinct("review_id")).first()[:2] == (240_000, 240_000)


def test_lines_are_shuffled_once(spark, tmp_path):
    path = write(tmp_path, ['r1,o1,5,,"a\nb",,'])
    plan = records.read_records(spark, path)._jdf.queryExecution().executedPlan().toString()
    moved = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "line" in x]
    assert len({x.split("plan_id")[0] for x in moved}) <= 2, plan
