"""Stages from the command line: `spark-submit ordermill/__main__.py run --raw DIR --root DIR`.

run       all batch stages          bronze    raw files to Bronze
silver    Bronze to Silver          gold      Silver to the KPI tables
serving   KPI tables to CSV         publish   one event per order to a topic
ingest    topic to Bronze           apply     topic to Silver
compact   fold applied events into Silver
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ordermill.operators import quality  # noqa: E402
from ordermill.plans import gold, pipeline  # noqa: E402
from ordermill.session import build_session  # noqa: E402
from ordermill.sources import raw, serving  # noqa: E402
from ordermill.sources.tables import history, read_table  # noqa: E402
from ordermill.streaming import apply, dedup, events, ingest, progress  # noqa: E402


def bronze(spark, args) -> None:
    raw.ingest_all(spark, args.raw, f"{args.root}/bronze").show(truncate=False)


def silver(spark, args) -> None:
    stored = pipeline.refresh_silver(spark, pipeline.bronze_tables(spark, args.root), args.root)
    quality.quality_summary(stored).show()
    quality.flag_distribution(stored).show(truncate=False)
    gold.silver_preview(stored).show()
    history(spark, pipeline.silver_path(args.root)).show(truncate=False)


def gold_tables(spark, args) -> None:
    stored = read_table(spark, pipeline.silver_path(args.root))
    kpis = pipeline.refresh_gold(spark, stored, args.root, args.only_passed)
    raw.layer_report("gold", kpis).show(truncate=False)


def serve(spark, args) -> None:
    serving.export_all(pipeline.gold_tables(spark, args.root), f"{args.root}/serving")
    serving.export_report(spark, f"{args.root}/serving").show(truncate=False)


def run(spark, args) -> None:
    for stage in (bronze, silver, gold_tables, serve):
        stage(spark, args)


def publish(spark, args) -> None:
    made = events.order_events(pipeline.bronze_tables(spark, args.root))
    target = {"kafka.bootstrap.servers": args.servers, "topic": args.topic}
    events.publish(events.to_messages(made), **target)


def _stream(spark, args, name, start, **parsing) -> None:
    """Messages of the topic, each event once, with a row for every batch in `<root>/progress/<name>`."""
    source = ingest.broker_source(spark, args.servers, args.topic, args.max_offsets)
    parsed = dedup.distinct_events(progress.observed_messages(source, **parsing), args.repeats_within)
    with progress.ProgressLog(spark, f"{args.root}/progress/{name}"):
        query = start(parsed, f"{args.root}/checkpoints/{name}", None if args.once else ingest.INTERVAL)
        query.awaitTermination()
    print(ingest.progress(query))


def ingest_topic(spark, args) -> None:
    target = f"{args.root}/bronze/order_events"
    _stream(spark, args, "bronze_events", lambda df, *how: ingest.start_ingest(df, target, *how), keep_unknown=True)


def apply_topic(spark, args) -> None:
    path = pipeline.silver_path(args.root)
    _stream(spark, args, "silver_events", lambda df, *how: apply.start_apply(df, path, *how))


def compact(spark, args) -> None:
    print(apply.compact(spark, pipeline.silver_path(args.root)), "rows")


STAGES = {
    "run": run, "bronze": bronze, "silver": silver, "gold": gold_tables, "serving": serve,
    "publish": publish, "ingest": ingest_topic, "apply": apply_topic, "compact": compact,
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(
        "ordermill", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter
    )
    parser.add_argument("stage", choices=STAGES)
    parser.add_argument("--raw", help="folder of the raw CSV files")
    parser.add_argument("--root", required=True, help="folder of all layers")
    parser.add_argument("--only-passed", action="store_true", help="leave flagged orders out of the KPIs")
    parser.add_argument("--servers", default="localhost:9092", help="message broker")
    parser.add_argument("--topic", default=events.TOPIC)
    parser.add_argument("--max-offsets", type=int, default=ingest.MAX_OFFSETS)
    parser.add_argument("--once", action="store_true", help="take in what is there, then stop")
    parser.add_argument("--repeats-within", default=dedup.DELAY, help="message time in which a repeated event is known")
    parser.add_argument("--master", help="only without spark-submit")
    args = parser.parse_args(argv)
    STAGES[args.stage](build_session("ordermill", args.master), args)


if __name__ == "__main__":
    main()
