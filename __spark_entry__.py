"""Registered queries and their SQL counterparts."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import ORACLE  # noqa: E402
from ordermill.operators import enrich, quality  # noqa: E402
from ordermill.operators.dedup import latest_per_key  # noqa: E402
from ordermill.operators.upsert import upsert  # noqa: E402
from ordermill.plans import gold, pipeline, questions, rollups, star  # noqa: E402
from ordermill.plans.silver import build_silver, enrich_orders, flagged_versions  # noqa: E402
from ordermill.session import COMPRESSED, freed_shuffles, scratch_dir, slices  # noqa: E402
from ordermill.sources import raw as raw_files  # noqa: E402
from ordermill.sources import serving, tables  # noqa: E402
from ordermill.sources.files import delete_folder  # noqa: E402
from ordermill.streaming import apply, dedup, events, ingest, progress  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def plain(df: DataFrame) -> DataFrame:
    """Comparable column types: decimals and floats as double, arrays as text joined by a pipe."""

    def column(field: T.StructField):
        col = F.col(field.name)
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            return col.cast("double").alias(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return F.array_join(col, "|").alias(field.name)
        return col

    return df.select(*[column(f) for f in df.schema.fields])


def _raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return star.raw_tables(spark, sf_dir)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_silver(_raw(spark, sf_dir))


def _kpi(name: str) -> Query:
    return lambda spark, sf_dir: gold.KPI_TABLES[name](_silver(spark, sf_dir))


def _regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.read_star(spark, sf_dir)["nation"].select(F.col("n_name").alias("seller_state"))


def _stored(spark: SparkSession, df: DataFrame, name: str, key: str | None = None, path: str | None = None) -> DataFrame:
    """Input that a query reads several times, computed once and written to the shared folder, in slices of `key` if large."""
    path = path or scratch_dir(spark, name)
    with freed_shuffles(spark):
        for part in slices(df, key) if key else [df]:
            part.write.options(**COMPRESSED).mode("append").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# --- sources and sinks


@query
def bronze_stamp(spark, sf_dir):
    return _raw(spark, sf_dir)["orders"].select("order_id", "order_status", "_source")


@query
def row_counts(spark, sf_dir):
    return raw_files.row_counts(_raw(spark, sf_dir))


def _write_csv(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> str:
    """Raw tables as CSV files, a folder each, to be ingested again."""
    folder, tables_by_name = scratch_dir(spark, "csv"), _raw(spark, sf_dir)
    for name in names:
        df = tables_by_name[name]
        wanted = T.StructType.fromDDL(raw_files.RAW_SCHEMAS[name])
        columns = [
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in wanted
        ]
        out = df.select(*columns).write.option("header", True).option("escape", '"')
        out.csv(f"{folder}/raw/{name}")
    return folder


@query
def ingest_report(spark, sf_dir):
    names = ("orders", "order_payments", "order_reviews", "products")
    folder = _write_csv(spark, sf_dir, names)
    return raw_files.ingest_all(
        spark, f"{folder}/raw", f"{folder}/bronze", {name: name for name in names}
    )


@query
def csv_payments(spark, sf_dir):
    folder = _write_csv(spark, sf_dir, ("order_payments",))
    raw_files.ingest_table(
        spark, f"{folder}/raw/order_payments", "order_payments", f"{folder}/bronze"
    )
    stored = tables.read_table(spark, f"{folder}/bronze/order_payments")
    return plain(stored.drop("_bronze_ingested_at"))


@query
def ingest_rejects(spark, sf_dir):
    """Payments as a CSV file in which fixed orders have a bad amount, one that overflows, or no amount cell."""
    folder = scratch_dir(spark, "rejects")
    number = F.col("order_id").cast("bigint")
    amount = F.when(number % 97 == 3, "abc").when(number % 89 == 5, "1" + "0" * 20)
    names = T.StructType.fromDDL(raw_files.RAW_SCHEMAS["order_payments"]).names
    cells = [*[F.col(n).cast("string") for n in names[:-1]], F.coalesce(amount, F.col(names[-1]).cast("string"))]
    line = F.when(number % 83 == 7, F.concat_ws(",", *cells[:-1])).otherwise(F.concat_ws(",", *cells))
    lines = _raw(spark, sf_dir)["order_payments"].select(line.alias(",".join(names)))
    as_is = {"header": True, "sep": "\u0001", "quote": "\u0000", "escapeQuotes": False}
    lines.write.options(**as_is).csv(f"{folder}/raw")
    raw_files.ingest_counted(spark, f"{folder}/raw", "order_payments", f"{folder}/bronze")
    stored = tables.read_table(spark, f"{folder}/bronze/order_payments")
    aside = tables.read_table(spark, raw_files.rejected_path(f"{folder}/bronze", "order_payments"))
    reasons = aside.groupBy(F.col(raw_files.REASON).alias("reason")).agg(F.count(F.lit(1)).alias("n_rows"))
    good = stored.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("payment_value").cast("double").alias("revenue"))
    return good.select(F.lit("").alias("reason"), "n_rows", "revenue").unionByName(
        reasons.withColumn("revenue", F.lit(None).cast("double"))
    )


@query
def csv_reviews(spark, sf_dir):
    """Reviews as CSV files with line breaks, commas and quotes in cells, and rows with too few cells; those of the
    stored table, and the rejected ones with the reason."""
    folder, number = scratch_dir(spark, "reviews"), F.col("review_id").cast("bigint")
    message = F.when(number % 3 == 0, F.concat(F.lit('first "line",\nsecond\n\n'), F.col("review_id").cast("string"))).when(
        number % 3 == 1, F.lit('said "hi", left')
    )
    reviews = _raw(spark, sf_dir)["order_reviews"].withColumn("review_comment_message", message)
    names = T.StructType.fromDDL(raw_files.RAW_SCHEMAS["order_reviews"]).names
    cells = [F.col(n).cast("string").alias(n) for n in names]
    record = F.when(number % 101 == 7, F.concat_ws(",", *cells[:2])).otherwise(F.to_csv(F.struct(*cells), {"escape": '"'}))
    # Each file begins with the header.
    begins = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)) == 0
    lines = reviews.select(F.concat(F.when(begins, ",".join(names) + "\n").otherwise(""), record).alias("value"))
    lines.write.text(f"{folder}/raw")
    raw_files.ingest_counted(spark, f"{folder}/raw", "order_reviews", f"{folder}/bronze")
    columns = ["review_id", "order_id", "review_score", "review_comment_message"]
    stored = tables.read_table(spark, f"{folder}/bronze/order_reviews").select(*columns, F.lit("").alias("reason"))
    aside = tables.read_table(spark, raw_files.rejected_path(f"{folder}/bronze", "order_reviews"))
    return stored.unionByName(aside.select(*columns, F.col(raw_files.REASON).alias("reason")))


def _stored_gold(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, DataFrame]]:
    root = scratch_dir(spark, "layers")
    silver = pipeline.refresh_silver(spark, _raw(spark, sf_dir), root)
    return root, pipeline.refresh_gold(spark, silver, root)


@query
def serving_export(spark, sf_dir):
    root, kpis = _stored_gold(spark, sf_dir)
    serving.export_all(kpis, f"{root}/serving")
    names = {"kpi_global": "'all'", "kpi_monthly": "order_month", "kpi_nps": "string(review_score_int)"}
    parts = []
    for table, df in serving.read_serving(spark, f"{root}/serving").items():
        figures = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name != "review_score_int"]
        pairs = ", ".join(f"'{c}', double({c})" for c in figures)
        item = names.get(table, df.columns[0])
        stacked = f"stack({len(figures)}, {pairs}) AS (measure, amount)"
        parts.append(df.selectExpr(f"'{table}' AS table_name", f"{item} AS item", stacked))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query
def layer_report(spark, sf_dir):
    _, kpis = _stored_gold(spark, sf_dir)
    return raw_files.layer_report("gold", kpis)


def _order_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir)["orders"].select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp"
    )


@query
def upsert_orders(spark, sf_dir):
    updates = star.order_updates(star.read_star(spark, sf_dir))
    return upsert(_order_table(spark, sf_dir), updates, "order_id").select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "priority"
    )


@query
def table_history(spark, sf_dir):
    path = f"{scratch_dir(spark, 'history')}/orders"
    tables.upsert_table(_order_table(spark, sf_dir), path, "order_id", ("order_status",))
    updates = star.order_updates(star.read_star(spark, sf_dir))
    tables.upsert_table(updates, path, "order_id", ("order_status",))
    return tables.history(spark, path, 3).select("version", "operation", "rows")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.order_events(_raw(spark, sf_dir), ingested_at=F.col("order_purchase_ts"))


@query
def order_events(spark, sf_dir):
    return plain(_events(spark, sf_dir))


# --- streaming


def _messages(payload: DataFrame, time: Column | None = None) -> DataFrame:
    """Messages with the envelope of a broker."""
    number = F.col("order_id").cast("bigint")
    time = F.to_timestamp("order_purchase_ts") if time is None else time
    return events.to_messages(
        payload,
        F.lit("orders").alias("topic"),
        (number % 3).cast("int").alias("partition"),
        number.alias("offset"),
        time.alias("timestamp"),
    )


def _stored_events(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    return _stored(spark, _events(spark, sf_dir), "events", "order_id", path)


def _arriving(spark: SparkSession, folder: str) -> DataFrame:
    """Parsed messages of a folder, whose files are deleted as they are consumed."""
    return ingest.parse_messages(ingest.file_source(spark, folder, max_bytes=ingest.bytes_per_batch(spark), remove=True))


def _send(payload: DataFrame, folder: str, time: Column | None = None) -> None:
    events.publish(_messages(payload, time), "parquet", path=folder)


@query
def stream_ingest(spark, sf_dir):
    root = scratch_dir(spark, "stream")
    _send(_events(spark, sf_dir), f"{root}/in")
    parsed = ingest.parse_messages(ingest.file_source(spark, f"{root}/in", max_files=ingest.files_per_batch(spark, 4)))
    ingest.start_ingest(parsed, f"{root}/bronze", f"{root}/checkpoint", None).awaitTermination()
    return plain(ingest.read_ingested(spark, f"{root}/bronze").drop("bronze_ingested_at"))


@query
def stream_dedup(spark, sf_dir):
    """All messages, then all of them again two hours later, to a stream that was stopped in between."""
    root, kept = scratch_dir(spark, "repeats"), scratch_dir(spark, "events")
    payload = _stored_events(spark, sf_dir, kept)
    seconds = (F.col("order_id").cast("bigint") % 3600).cast("int")
    start = F.lit("2026-01-01").cast("timestamp") + F.make_dt_interval(secs=seconds)
    again = start + F.expr("INTERVAL 2 HOURS")
    for time in (start, again):
        _send(payload, f"{root}/in", time)
        if time is again:
            delete_folder(spark, kept)
        parsed = _arriving(spark, f"{root}/in")
        stream = ingest.start_ingest(dedup.distinct_events(parsed), f"{root}/bronze", f"{root}/checkpoint", None)
        stream.awaitTermination()
        delete_folder(spark, f"{root}/in")
    return plain(ingest.read_ingested(spark, f"{root}/bronze").drop("bronze_ingested_at"))


@query
def stream_schema_merge(spark, sf_dir):
    """A producer that first sends the declared fields, then two more, and counts beyond a 32-bit integer; all are read
    under a schema declared later."""
    root, number = scratch_dir(spark, "evolved"), F.col("order_id").cast("bigint")
    payload = _stored_events(spark, sf_dir)
    coupon = F.struct(F.concat(F.lit("C"), "order_id").alias("code"), (number % 100).cast("decimal(5,2)").alias("pct"))
    wider = payload.filter(number % 2 == 0).withColumns(
        {
            "channel": F.when(number % 3 == 0, "web").otherwise("shop"),
            "coupon": F.when(number % 4 == 0, coupon),
            "item_count": F.col("item_count").cast("long") + F.when(number % 5 == 0, 3 * 10**9).otherwise(0),
        }
    )
    for sent in (payload.filter(number % 2 == 1), wider):
        _send(sent, f"{root}/in")
        parsed = ingest.parse_messages(ingest.file_source(spark, f"{root}/in"), keep_unknown=True)
        ingest.start_ingest(parsed, f"{root}/bronze", f"{root}/checkpoint", None).awaitTermination()
    evolved = "channel STRING, item_count BIGINT, coupon STRUCT<code: STRING, pct: DECIMAL(5,2)>"
    read = ingest.read_ingested(spark, f"{root}/bronze", evolved)
    code, pct = F.col("coupon.code").alias("coupon_code"), F.col("coupon.pct").cast("double").alias("coupon_pct")
    return read.select("event_id", "order_id", "item_count", "channel", code, pct)


@query
def stream_progress(spark, sf_dir):
    """The log of three batches, with messages that are no JSON or have no order id among them."""
    root, number = scratch_dir(spark, "progress"), F.col("key").cast("bigint")
    broken = F.when(number % 17 == 0, "{broken").when(number % 19 == 0, '{"event_id": "x"}').otherwise(F.col("value"))
    messages = _messages(_stored_events(spark, sf_dir)).withColumn("value", broken)
    with progress.ProgressLog(spark, f"{root}/progress"):
        for wave in range(3):
            events.publish(messages.filter(number % 3 == wave), "parquet", path=f"{root}/in")
            parsed = progress.observed_messages(ingest.file_source(spark, f"{root}/in"))
            ingest.start_ingest(parsed, f"{root}/bronze", f"{root}/checkpoint", None).awaitTermination()
    log = progress.read_progress(spark, f"{root}/progress")
    return log.select("batch_id", "rows_in", "unreadable", "without_id", "stored")


@query
def stream_upsert(spark, sf_dir):
    """Three messages per order: the final state arrives before an earlier one, then shipped orders are
    delivered, after the first changes were folded into the base."""
    root, kept = scratch_dir(spark, "apply"), scratch_dir(spark, "events")
    path = f"{root}/silver"

    def consume():
        apply.start_apply(_arriving(spark, f"{root}/in"), path, f"{root}/checkpoint", None).awaitTermination()
        delete_folder(spark, f"{root}/in")

    def at(day: int):
        moment = F.to_timestamp("order_purchase_ts") + F.make_dt_interval(F.lit(day))
        return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")

    state = _stored_events(spark, sf_dir, kept)
    _send(state.withColumn("ingested_at", at(1)), f"{root}/in")
    _send(state.withColumns({"order_status": F.lit("created"), "ingested_at": at(0)}), f"{root}/in")
    shipped = _stored(spark, state.filter("order_status = 'shipped'"), "shipped")
    delete_folder(spark, kept)
    consume()
    apply.compact(spark, path, keep_folded=False)
    delivered = shipped.withColumns(
        {
            "order_status": F.lit("delivered"),
            "order_delivered_ts": F.col("order_estimated_ts"),
            "ingested_at": at(2),
        }
    )
    _send(delivered, f"{root}/in")
    consume()
    current = plain(
        apply.read_current(spark, path).select(
            "order_id",
            "order_status",
            "order_purchase_ts",
            "order_delivered_ts",
            "item_count",
            "payment_value",
            "delivery_delay_days",
            "is_late_delivery",
            "dq_flags",
        )
    )
    return _stored(spark, current, "current", "order_id")


@query
def stream_batch_mixed(spark, sf_dir):
    """Batch, events, batch, events for fixed orders, folded once on the way; times are written in two formats."""
    path, kept = f"{scratch_dir(spark, 'mixed')}/silver", scratch_dir(spark, "events")
    number = F.col("order_id").cast("bigint")
    state = _stored_events(spark, sf_dir, kept)

    def at(day: int):
        return F.to_timestamp("order_purchase_ts") + F.make_dt_interval(F.lit(day))

    def batch(rows: DataFrame, day: int):
        source = F.lit(f"{apply.BATCH_SOURCE}/orders").alias("source")
        rows = rows.select("order_id", "order_status", source, at(day).alias("bronze_ingested_at"))
        tables.upsert_table(rows, path, "order_id", ("order_status",))

    def send(rows: DataFrame, status: str, day: int, batch_id: int):
        blank, mark = (F.date_format(at(day), f) for f in ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss"))
        time = F.when(number % 4 == 0, mark).otherwise(blank)
        payload = rows.withColumns({"order_status": F.lit(status), "ingested_at": time})
        envelope = (F.lit("orders").alias("topic"), F.lit(0).alias("partition"), number.alias("offset"), at(day).alias("timestamp"))
        apply.apply_batch(ingest.parse_messages(events.to_messages(payload, *envelope)), batch_id, path)

    batch(state, 0)
    send(state.filter(number % 2 == 0), "shipped", 2, 0)
    apply.compact(spark, path, keep_folded=False)
    batch(state.filter(number % 3 == 0).withColumn("order_status", F.lit("delivered")), 4)
    send(state.filter(number % 5 == 0), "canceled", 3, 1)
    delete_folder(spark, kept)
    return _stored(spark, apply.read_current(spark, path).select("order_id", "order_status"), "current", "order_id")


# --- rows and joins


@query
def orders_renamed(spark, sf_dir):
    return enrich.rename_orders(_raw(spark, sf_dir)["orders"]).drop("bronze_ingested_at")


@query
def orders_preview(spark, sf_dir):
    first = _silver(spark, sf_dir).orderBy("order_id").limit(10)
    return plain(
        first.select(
            "order_id", "order_status", "order_purchase_ts", "item_count", "payment_value", "review_score"
        )
    )


@query
def dedup_latest(spark, sf_dir):
    versions = star.event_versions(star.read_star(spark, sf_dir))
    return latest_per_key(versions, ["user_id"], ["day"])


def _products(raw: dict[str, DataFrame]) -> DataFrame:
    return enrich.translate_products(raw["products"], raw["category_translation"])


@query
def products_translated(spark, sf_dir):
    return _products(_raw(spark, sf_dir)).select(
        "product_id", "product_category_name", "product_category_name_english"
    )


@query
def items_enriched(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    rich = enrich.enrich_items(raw["order_items"], _products(raw), raw["sellers"])
    return plain(
        rich.select(
            "order_id",
            "order_item_id",
            "product_id",
            "seller_id",
            "price",
            "freight_value",
            "product_category_name_english",
            "seller_state",
        )
    )


@query
def items_agg(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return plain(enrich.items_per_order(raw["order_items"], _products(raw), raw["sellers"]))


@query
def items_agg_shuffled(spark, sf_dir):
    """As if products and sellers were too large to broadcast."""
    raw = _raw(spark, sf_dir)
    return plain(enrich.items_per_order(raw["order_items"], _products(raw), raw["sellers"], limit=-1))


@query
def payments_agg(spark, sf_dir):
    return plain(enrich.payments_per_order(_raw(spark, sf_dir)["order_payments"]))


@query
def payment_mode(spark, sf_dir):
    return plain(enrich.payments_per_order_by_mode(_raw(spark, sf_dir)["order_payments"]))


@query
def reviews_latest(spark, sf_dir):
    return plain(enrich.latest_review_per_order(_raw(spark, sf_dir)["order_reviews"]))


@query
def orders_enriched(spark, sf_dir):
    return plain(enrich_orders(_raw(spark, sf_dir)).drop("bronze_ingested_at"))


@query
def silver_metrics(spark, sf_dir):
    return plain(
        _silver(spark, sf_dir).select(
            "order_id",
            "delivery_days_actual",
            "delivery_days_estimated",
            "delivery_delay_days",
            "is_delivered",
            "is_canceled",
            "is_late_delivery",
            "order_value_total",
            "freight_ratio",
        )
    )


@query
def orders_enriched_bucketed(spark, sf_dir):
    """From raw tables that were stored by order."""
    raw = _raw(spark, sf_dir)
    raw = {**raw, "orders": _stored(spark, raw["orders"], "raw-orders")}
    stored = pipeline.store_by_order(spark, raw, f"{scratch_dir(spark, 'buckets')}/bronze")
    return plain(enrich_orders({**raw, **stored}).drop("bronze_ingested_at"))


# --- quality


@query
def dq_flags(spark, sf_dir):
    return _silver(spark, sf_dir).select("order_id", "dq_flags", "dq_passed")


@query
def dq_flags_basic(spark, sf_dir):
    enriched = enrich_orders(_raw(spark, sf_dir))
    flagged = quality.apply_rules(enriched, quality.BASIC_RULES)
    return flagged.select("order_id", "dq_flags", "dq_passed")


@query
def dq_rule_counts(spark, sf_dir):
    failed = quality.with_failed_rules(_silver(spark, sf_dir), quality.ORDER_RULES)
    return quality.count_by(failed.select(F.explode("dq_failed").alias("rule")), "rule")


@query
def dq_summary(spark, sf_dir):
    return quality.quality_summary(_silver(spark, sf_dir))


@query
def dq_before_dedup(spark, sf_dir):
    """Orders of which every tenth comes twice and every seventeenth has lost its id."""
    raw = _raw(spark, sf_dir)
    number = F.col("order_id").cast("bigint")
    copies = F.explode(F.sequence(F.lit(1), F.when(number % 10 == 0, 2).otherwise(1)))
    orders = raw["orders"].withColumn("copy", copies).drop("copy")
    orders = orders.withColumn("order_id", F.when(number % 17 != 0, F.col("order_id")))
    return quality.deduplication_summary(flagged_versions({**raw, "orders": orders}), "order_id")


@query
def dq_flag_distribution(spark, sf_dir):
    return quality.flag_distribution(_silver(spark, sf_dir))


@query
def status_distribution(spark, sf_dir):
    return quality.count_by(_raw(spark, sf_dir)["orders"], "order_status")


# --- KPIs and reports over them


@query
def kpi_global(spark, sf_dir):
    return gold.kpi_global(_silver(spark, sf_dir)).drop("gold_computed_at")


for _name in ("kpi_monthly", "kpi_category", "kpi_nps", "kpi_seller_state"):
    QUERIES[_name] = _kpi(_name)


def _incremental(table: str) -> Query:
    """A KPI table after a first load and two batches, refreshed by their differences alone: orders that are delivered and
    move to another month, then orders that are canceled, and others, all of the first month among them, removed."""

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw, root = _raw(spark, sf_dir), scratch_dir(spark, "incremental")
        orders, number, placed = _stored(spark, raw["orders"], "raw-orders"), F.col("order_id"), F.col("order_purchase_timestamp")
        raw = {**raw, "orders": orders}
        pipeline.apply_updates(spark, raw, root)
        moved = {"order_status": F.lit("delivered"), "order_purchase_timestamp": placed + F.expr("INTERVAL 40 DAYS")}
        pipeline.apply_updates(spark, {**raw, "orders": orders.filter(number % 7 == 0).withColumns(moved)}, root)
        canceled = orders.filter(number % 13 == 0).withColumn("order_status", F.lit("canceled"))
        first = orders.agg(F.min(F.date_format(placed, "yyyy-MM"))).scalar()
        gone = orders.filter((number % 11 == 0) | (F.date_format(placed, "yyyy-MM") == first)).select("order_id")
        return pipeline.apply_updates(spark, {**raw, "orders": canceled}, root, deleted=gone)[table]

    return build


for _name in ("kpi_monthly", "kpi_category", "kpi_seller_state"):
    QUERIES[f"{_name}_incremental"] = _incremental(_name)


@query
def kpi_monthly_passed(spark, sf_dir):
    return gold.kpi_monthly(gold.passed_only(_silver(spark, sf_dir), True))


@query
def silver_preview(spark, sf_dir):
    return gold.silver_preview(_silver(spark, sf_dir))


@query
def monthly_active(spark, sf_dir):
    return rollups.active_months(gold.kpi_monthly(_silver(spark, sf_dir)), "1997")


@query
def year_kpis(spark, sf_dir):
    years = rollups.year_kpis(gold.kpi_monthly(_silver(spark, sf_dir)))
    return years.withColumns(
        {
            "revenue_brl": F.round("revenue_brl", 2),
            "otif_rate_pct": F.round("otif_rate_pct", 6),
            "avg_review_score": F.round("avg_review_score", 6),
        }
    )


@query
def category_card(spark, sf_dir):
    return rollups.category_card(gold.kpi_category(_silver(spark, sf_dir)), "promo")


@query
def top_categories(spark, sf_dir):
    return rollups.top_categories(gold.kpi_category(_silver(spark, sf_dir)))


@query
def state_coverage(spark, sf_dir):
    states = gold.kpi_seller_state(_silver(spark, sf_dir))
    return rollups.state_coverage(_regions(spark, sf_dir), states)


def _bins(metric: str) -> Query:
    return lambda spark, sf_dir: rollups.state_metric_bins(
        _regions(spark, sf_dir), gold.kpi_seller_state(_silver(spark, sf_dir)), metric
    )


QUERIES["state_metric_bins"] = _bins("otif")
QUERIES["state_metric_bins_delivery"] = _bins("delivery")
QUERIES["state_metric_bins_score"] = _bins("score")


@query
def state_metric_range(spark, sf_dir):
    return rollups.metric_range(gold.kpi_seller_state(_silver(spark, sf_dir)), "otif_rate_pct")


@query
def month_labels(spark, sf_dir):
    return rollups.month_labels(gold.kpi_monthly(_silver(spark, sf_dir)))


@query
def revenue_labels(spark, sf_dir):
    return rollups.revenue_labels(gold.kpi_monthly(_silver(spark, sf_dir)), "order_month")


@query
def order_value_labels(spark, sf_dir):
    paid = _silver(spark, sf_dir).select("order_id", F.col("payment_value").cast("double"))
    return rollups.revenue_labels(paid, "order_id", "payment_value")


@query
def category_labels(spark, sf_dir):
    return rollups.category_labels(gold.kpi_category(_silver(spark, sf_dir)))


def _question(name: str) -> Query:
    def answer(spark: SparkSession, sf_dir: str) -> DataFrame:
        silver = _silver(spark, sf_dir)
        kpis = {table: build(silver) for table, build in gold.KPI_TABLES.items()}
        return questions.ask(spark, name, kpis)

    return answer


for _name in questions.QUESTIONS:
    QUERIES[_name] = _question(_name)


def _corpus_queries() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the corpus operators, where that subpackage is installed."""
    try:
        import corpus_pipeline
        from ordermill.llm import queries as corpus
    except ModuleNotFoundError as e:
        if e.name and (e.name == "corpus_pipeline" or e.name.startswith("ordermill.llm")):
            return {}, {}
        raise
    except ImportError as e:
        if e.name == "ordermill.llm":  # an empty folder is left of it
            return {}, {}
        raise
    sql = dict(corpus.ORACLE)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**corpus.QUERIES, "pipeline": corpus_pipeline.run}, sql


_QUERIES, _SQL = _corpus_queries()
QUERIES.update(_QUERIES)


def entry(spark: SparkSession) -> DataFrame:
    """Monthly delivery and revenue KPIs from the raw tables."""
    return QUERIES["kpi_monthly"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, sql in {**ORACLE, **_SQL}.items() if name in QUERIES}
