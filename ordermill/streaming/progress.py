"""A table with one row per micro-batch, kept by a listener.

    <path>/<query id>-<batch>.json     numbers of one batch; a batch that is repeated replaces its file's numbers

The rows come from Spark's progress events, so nothing is counted twice: messages taken in, and what `observed_messages`
counts in passing, those without an order id and those that are no JSON object.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ordermill.sources.files import replace_text
from ordermill.streaming.ingest import identified, message_columns

METRICS = "ordermill_messages"
PROGRESS_SCHEMA = """
    query_id STRING, run_id STRING, query_name STRING, batch_id BIGINT, started_at TIMESTAMP, rows_in BIGINT,
    rows_per_second DOUBLE, without_id BIGINT, unreadable BIGINT, stored BIGINT, milliseconds BIGINT"""


def observed_messages(messages: DataFrame, keep_unknown: bool = False) -> DataFrame:
    """As `parse_messages`, counting on the way; the counts are in the progress of the query and in the log below."""
    unreadable = F.from_json(F.col("value").cast("string"), "map<string,string>").isNull()
    columns = message_columns(messages.withColumn("_unreadable", unreadable), "_unreadable", keep_unknown=keep_unknown)
    counted = columns.observe(
        METRICS,
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if("_unreadable").alias("unreadable"),
        F.count_if(F.col("order_id").isNull() & ~F.col("_unreadable")).alias("without_id"),
        F.count("order_id").alias("stored"),
    )
    return identified(counted.drop("_unreadable"))


class ProgressLog(StreamingQueryListener):
    """Writes a row for every batch of the session's queries, as a context manager around them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.failed: list[Exception] = []
        self._lock = threading.Lock()

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        """Events arrive some time after their batch; all that were sent are written before this returns."""
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)
        if self.failed and error[0] is None:
            raise ExceptionGroup("batches are missing from the progress log", self.failed)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = {
            "query_id": str(p.id),
            "run_id": str(p.runId),
            "query_name": p.name,
            "batch_id": p.batchId,
            "started_at": p.timestamp,
            "rows_in": p.numInputRows,
            "rows_per_second": p.processedRowsPerSecond,
            "milliseconds": p.durationMs.get("triggerExecution"),
        }
        seen = p.observedMetrics.get(METRICS)
        if seen is not None:
            # An operator before the counters may read its source more than once, so these are the better numbers.
            row |= {k: seen[k] for k in ("rows_in", "unreadable", "without_id", "stored")}
        try:
            with self._lock:
                replace_text(self.spark, f"{self.path}/{p.id}-{p.batchId:012d}.json", json.dumps(row))
        except Exception as failure:  # noqa: BLE001 - a listener must not raise; told at the end
            self.failed.append(failure)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS_SCHEMA).json(path)
