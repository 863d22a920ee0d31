from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest

from ordermill.schemas import SERVING_CONTRACT
from ordermill.sources import serving


def test_contract_selects_orders_and_types(spark):
    df = spark.createDataFrame([(1, 2, 3.0, 4.0, 5.0, 6.0)],
        "extra INT, orders INT, avg_payment_value DOUBLE, avg_delivery_days DOUBLE, review_score_int DOUBLE, pct_of_total DOUBLE")
    got = serving.to_contract(df, "kpi_nps")
    assert got.dtypes == [
        ("review_score_int", "int"), ("orders", "bigint"), ("avg_payment_value", "double"),
        ("avg_delivery_days", "double"), ("pct_of_total", "double")]


def test_missing_column_is_an_error(spark):
    with pytest.raises(ValueError, match="kpi_nps lacks contract columns: avg_payment_value, avg_delivery_days"):
        serving.to_contract(spark.createDataFrame([(5, 2, 1.0)], "review_score_int INT, orders INT, pct_of_total DOUBLE"), "kpi_nps")


def test_file_text_is_plain_and_sorted(spark, tmp_path):
    """Byte for byte what the readers of these files are used to."""
    states = spark.createDataFrame(
        [("MG", 7735, 12.8, -13.4, 95.2, 1208752.0, 4.23), ("SP", 68641, 12.3, -11.2, 92.69, 10017536.0, 4.12),
         ("AA", 7735, None, 0.0, 100.0, 0.05, None)],
        SERVING_CONTRACT["kpi_seller_state"],
    )
    path = serving.export_table(states.repartition(3), "kpi_seller_state", str(tmp_path))
    assert open(path, encoding="utf-8").read() == (
        "seller_state,orders,avg_delivery_days,avg_delay_days,otif_rate_pct,revenue_brl,avg_review_score\n"
        "SP,68641,12.3,-11.2,92.69,10017536.0,4.12\n"
        "AA,7735,,0.0,100.0,0.05,\n"
        "MG,7735,12.8,-13.4,95.2,1208752.0,4.23\n"
    )
    assert sorted(p.name for p in tmp_path.glob("*.csv")) == ["kpi_seller_state.csv"]


def sample(spark):
    clock = dt.datetime(2026, 4, 4, 2, 20, 31, 365233)
    values = {"string": "2017-01", "bigint": 1, "int": 5, "double": 16008872.12, "timestamp": clock}
    return {
        name: spark.createDataFrame([], ddl)
        .unionByName(spark.createDataFrame([tuple(values[t] for _, t in spark.createDataFrame([], ddl).dtypes)], ddl))
        for name, ddl in SERVING_CONTRACT.items()
    }


def test_round_trip_replace_and_report(spark, tmp_path):
    tables, folder = sample(spark), str(tmp_path)
    with pytest.raises(FileNotFoundError):
        serving.read_serving(spark, folder)
    for _ in range(2):
        assert len(serving.export_all(tables, folder)) == 5
    for name, df in serving.read_serving(spark, folder).items():
        assert df.collect() == tables[name].collect()
    files = Path(serving.current_set(spark, folder))
    assert sorted(p.name for p in files.glob("*.csv")) == sorted(f"{name}.csv" for name in SERVING_CONTRACT)
    assert "2026-04-04 02:20:31.365233" in (files / "kpi_global.csv").read_text()
    report = {r["file_name"]: (r["bytes"], r["rows"]) for r in serving.export_report(spark, folder).collect()}
    assert len(report) == 5
    assert report["kpi_nps.csv"] == ((files / "kpi_nps.csv").stat().st_size, 1)


def test_a_failing_table_leaves_the_files_of_the_last_export(spark, tmp_path):
    tables, folder = sample(spark), str(tmp_path)
    serving.export_all(tables, folder)
    before = serving.current_set(spark, folder)
    changed = {name: df.unionByName(df) for name, df in tables.items()}
    third = list(tables)[2]
    changed[third] = tables[third].drop(SERVING_CONTRACT[third].split()[0])
    with pytest.raises(ExceptionGroup, match="tasks failed") as failure:
        serving.export_all(changed, folder)
    assert any("lacks contract columns" in str(e) for e in failure.value.exceptions)
    assert serving.current_set(spark, folder) == before
    assert {r["rows"] for r in serving.export_report(spark, folder).collect()} == {1}
    serving.export_all({name: df.unionByName(df) for name, df in tables.items()}, folder)
    assert serving.current_set(spark, folder) != before
    assert {r["rows"] for r in serving.export_report(spark, folder).collect()} == {2}


def test_export_does_not_round(spark, tmp_path):
    row = [("SP", 1, 0.125, -1.0 / 3, 1e-05, 12345678901.25, 4.0)]
    states = spark.createDataFrame(row, SERVING_CONTRACT["kpi_seller_state"])
    path = serving.export_table(states, "kpi_seller_state", str(tmp_path))
    text = open(path, encoding="utf-8").read().splitlines()[1].split(",")
    assert [float(x) for x in text[2:]] == [0.125, -1.0 / 3, 1e-05, 12345678901.25, 4.0]
    assert not any("e" in x.lower() for x in text[2:])
