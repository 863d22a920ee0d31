from __future__ import annotations

import pytest

from ordermill import session

PARTITIONS = "spark.sql.shuffle.partitions"


def test_shuffles_grow_with_the_input_and_go_back(spark, tmp_path, monkeypatch):
    spark.range(100_000).write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    before = spark.conf.get(PARTITIONS)
    with session.sized_shuffles(spark, [table]) as wanted:
        assert wanted == int(before)
    monkeypatch.setattr(session, "SHUFFLE_TASK_BYTES", 10_000)
    with pytest.raises(RuntimeError), session.sized_shuffles(spark, [table, table]) as wanted:
        assert wanted > 8 and spark.conf.get(PARTITIONS) == str(wanted)
        raise RuntimeError
    assert spark.conf.get(PARTITIONS) == before


def test_unknown_sizes_alone_change_nothing(spark):
    from pyspark.sql import Row

    unknown = spark.createDataFrame(spark.sparkContext.parallelize([Row(a=1)]))
    with session.sized_shuffles(spark, [unknown]) as wanted:
        assert wanted == 8


def test_scratch_goes_to_the_shared_folder(tmp_path):
    class Session:
        conf = {"spark.checkpoint.dir": f"{tmp_path}/shared/"}

    first, second = (session.scratch_dir(Session, "x") for _ in range(2))
    assert first.startswith(f"{tmp_path}/shared/x-") and first != second
    Session.conf = {"spark.master": "local[4]"}
    assert session.scratch_dir(Session, "x") != session.scratch_dir(Session, "x")
    Session.conf = {"spark.master": "yarn"}
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(Session, "x")
