"""Session settings for a large cluster, and the shared folder for intermediate tables."""

from __future__ import annotations

import contextlib
import math
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.operators.lookup import input_bytes, stored_bytes

# Shuffled bytes a task should take in, and how much larger rows are than the compressed files they
# were read from.
SHUFFLE_TASK_BYTES = 128 * 1024 * 1024
EXPANSION = 3

# Stored bytes that a sliced write takes in at once; what it shuffles is several times as much.
SLICE_BYTES = 1024 * 1024 * 1024

# Of tables, messages and intermediate results: takes about two thirds of the space of Spark's default.
COMPRESSED = {"compression": "zstd"}

FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
LEAN = {"spark.sql.streaming.stateStore.compression.codec": "zstd", "spark.sql.streaming.minBatchesToRetain": "2"}

# Spark's stand-in for a size it does not know.
UNKNOWN_BYTES = 2**62

SETTINGS = {
    # Timestamps are truncated to months and days, so the zone must not depend on the machine.
    "spark.sql.session.timeZone": "UTC",
    # Re-plan at run time: merge small shuffle partitions, split skewed ones, switch to broadcast.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Size of a merged or split shuffle partition, and so of a file written after one.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # Above 2000 reducers block sizes are only recorded as averages unless they stand out this much;
    # without it the skew split cannot see the skew.
    "spark.shuffle.accurateBlockSkewedFactor": "5.0",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str = "ordermill", master: str | None = None, **conf: str) -> SparkSession:
    """`master` and sizing (executors, spark.sql.shuffle.partitions) normally come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextlib.contextmanager
def sized_shuffles(spark: SparkSession, inputs: Iterable[DataFrame]) -> Iterator[int]:
    """Enough shuffle partitions for the size of the inputs, so that a task's share fits in memory.

    Never fewer than the session asks for; adaptive execution merges those that turn out small. An input
    of unknown size counts as much as the largest known one.
    """
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    sizes = [input_bytes(df) for df in inputs]
    largest = max((n for n in sizes if n < UNKNOWN_BYTES), default=0)
    size = EXPANSION * sum(n if n < UNKNOWN_BYTES else largest for n in sizes)
    wanted = max(int(before), math.ceil(size / SHUFFLE_TASK_BYTES))
    spark.conf.set(setting, wanted)
    try:
        yield wanted
    finally:
        spark.conf.set(setting, before)


@contextlib.contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def freed_shuffles(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Writes in here, and streams started in here, remove their shuffle files when they (or their batch) end.

    Otherwise the files stay until the driver happens to collect its garbage. Only for writes and streams, which are planned
    anew each time: a DataFrame that is collected a second time would have to shuffle again.
    """
    return _settings(spark, FREED)


def lean_streams(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Streams started in here keep little on disk: no shuffle files of finished batches, state files compressed well, and of
    offsets and states those of the last two batches, as a restart needs no more."""
    return _settings(spark, {**FREED, **LEAN})


def slices(df: DataFrame, key: str, share: float = 1) -> list[DataFrame]:
    """The rows of `df` in several DataFrames by a hash of `key`, to be written one after another.

    Spark moves the filter to the inputs of joins, aggregates and windows by that key, so the shuffles of a slice are a
    slice of the shuffles; inputs are read once per slice. A slice stands for `share` of `SLICE_BYTES` of what `df` reads.
    """
    number = max(1, math.ceil(stored_bytes(df) / (share * SLICE_BYTES)))
    place = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(number))
    return [df] if number == 1 else [df.filter(place == n) for n in range(number)]


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables under the cluster's shared checkpoint folder.

    Tables written there survive the loss of an executor. Where no such folder is named, a session on one
    machine takes a temporary one, and a cluster is refused: its executors would not see each other's files.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix=f"{name}-")
