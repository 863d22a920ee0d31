from __future__ import annotations

import pytest

from ordermill.sources import files, tables


def frame(spark, *rows, columns="k STRING, status STRING"):
    return spark.createDataFrame(list(rows), columns)


def test_write_read_count_exists(spark, tmp_path, rows):
    path = f"{tmp_path}/t"
    assert not tables.table_exists(spark, path)
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, path)
    assert tables.write_table(frame(spark, ("a", "x"), ("b", "y")), path) == 2
    assert tables.table_exists(spark, path)
    assert tables.row_count(spark, path) == 2
    # Overwriting replaces the schema as well; a reader of the older state is not disturbed.
    before = tables.read_table(spark, path)
    assert tables.write_table(frame(spark, ("c", 1), columns="k STRING, n INT"), path) == 1
    assert rows(tables.read_table(spark, path)) == [("c", 1)]
    assert rows(before) == [("a", "x"), ("b", "y")]


def test_history_newest_first(spark, tmp_path):
    path = f"{tmp_path}/t"
    for n in range(4):
        tables.write_table(frame(spark, *[(str(i), "x") for i in range(n + 1)]), path)
    got = tables.history(spark, path, 3).collect()
    assert [(r["version"], r["operation"], r["rows"]) for r in got] == [
        (3, "overwrite", 4), (2, "overwrite", 3), (1, "overwrite", 2)]
    assert got[0]["committed_at"] is not None and got[0]["parameters"] == '{"partition_by": []}'


def test_upsert_moves_rows_between_partitions(spark, tmp_path, rows):
    path = f"{tmp_path}/t"
    assert tables.upsert_table(frame(spark, ("a", "shipped"), ("b", "shipped")), path, "k", ("status",)) == 2
    assert tables.upsert_table(frame(spark, ("a", "delivered"), ("c", "shipped")), path, "k", ("status",)) == 3
    got = tables.read_table(spark, path)
    assert rows(got, "k", "status") == [("a", "delivered"), ("b", "shipped"), ("c", "shipped")]
    delivered = got.filter("status = 'delivered'")
    assert rows(delivered, "k") == [("a",)]
    assert "PartitionFilters: [isnotnull(status" in delivered._jdf.queryExecution().executedPlan().toString()
    assert [r["operation"] for r in tables.history(spark, path).collect()] == ["merge", "create"]


def test_upsert_refuses_repeated_keys(spark, tmp_path, rows):
    path = f"{tmp_path}/t"
    tables.upsert_table(frame(spark, ("a", "x")), path, "k")
    with pytest.raises(ValueError, match="not unique"):
        tables.upsert_table(frame(spark, ("a", "y"), ("a", "z")), path, "k")
    assert rows(tables.read_table(spark, path)) == [("a", "x")]


def test_unfinished_write_is_invisible(spark, tmp_path, rows):
    path = f"{tmp_path}/t"
    tables.write_table(frame(spark, ("a", "x")), path)
    frame(spark, ("broken", "x")).write.parquet(f"{path}/snapshots/v=1")
    assert rows(tables.read_table(spark, path)) == [("a", "x")]
    tables.write_table(frame(spark, ("b", "x")), path)
    assert rows(tables.read_table(spark, path)) == [("b", "x")]


def test_losing_writer_leaves_the_table_as_it_was(spark, tmp_path, rows, monkeypatch):
    path = f"{tmp_path}/t"
    tables.write_table(frame(spark, ("a", "x")), path)
    stale = tables.latest_run(spark, path)
    tables.write_table(frame(spark, ("b", "y"), ("c", "y")), path)
    monkeypatch.setattr(tables, "latest_run", lambda *_: stale)
    with pytest.raises(FileExistsError):
        tables.write_table(frame(spark, ("d", "z")), path)
    monkeypatch.undo()
    assert rows(tables.read_table(spark, path)) == [("b", "y"), ("c", "y")]


def test_version_is_finished_once(spark, tmp_path):
    path = f"{tmp_path}/runs/1.json"
    files.create_text(spark, path, "{}")
    with pytest.raises(FileExistsError):
        files.create_text(spark, path, "{}")
    assert files.list_names(spark, f"{tmp_path}/runs") == ["1.json"]


def test_inventory_reads_names_and_sizes_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text("12345")
    (tmp_path / "b.csv").write_text("1")
    (tmp_path / "c.txt").write_text("1")
    df = files.file_inventory(spark, f"{tmp_path}/*.csv")
    assert sorted(tuple(r) for r in df.collect()) == [("a.csv", 5), ("b.csv", 1)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
