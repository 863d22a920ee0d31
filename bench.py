"""Headline timings as one JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all)

`silver_build` runs the whole path from the raw tables to the stored Silver table. The KPI queries then
read that table, as they do in a batch run. `*_raw` queries start from the raw tables again. Each time is the median
of three runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from ordermill.operators import enrich, quality  # noqa: E402
from ordermill.operators.upsert import upsert  # noqa: E402
from ordermill.plans import gold, incremental, pipeline, rollups, star  # noqa: E402
from ordermill.plans.silver import build_silver, enrich_orders  # noqa: E402
from ordermill.session import build_session, scratch_dir  # noqa: E402
from ordermill.sources import serving  # noqa: E402
from ordermill.streaming.events import order_events, to_messages  # noqa: E402
from ordermill.streaming.ingest import parse_messages  # noqa: E402


RUNS = 3


def consume(df) -> None:
    """Compute every row without keeping any."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    raw = star.raw_tables(spark, sf_dir)
    products = enrich.translate_products(raw["products"], raw["category_translation"])
    root = scratch_dir(spark, "bench")
    timings: dict[str, float] = {}

    def measure(name: str, action, prepare=lambda: None) -> None:
        """Median of some runs, each after its preparation, which is not timed."""
        times = []
        for _ in range(RUNS):
            prepared = prepare()
            start = time.perf_counter()
            action(prepared) if prepared is not None else action()
            times.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(times), 3)

    consume(build_silver(raw))  # start-up and first compilation of the session are not a query

    measure("silver_build", lambda new: pipeline.refresh_silver(spark, raw, new), lambda: scratch_dir(spark, "bench"))
    pipeline.refresh_silver(spark, raw, root)
    measure("silver_upsert", lambda: pipeline.refresh_silver(spark, raw, root))
    silver = pipeline.read_table(spark, f"{root}/silver/orders")
    for name, build in gold.KPI_TABLES.items():
        measure(name, lambda build=build: consume(build(silver)))
    measure("silver_preview", lambda: consume(gold.silver_preview(silver)))
    measure("dq_summary", lambda: consume(quality.quality_summary(silver)))
    measure("dq_flag_distribution", lambda: consume(quality.flag_distribution(silver)))
    measure("year_kpis", lambda: consume(rollups.year_kpis(gold.kpi_monthly(silver))))

    kpis: dict = {}
    measure("gold_refresh", lambda: kpis.update(pipeline.refresh_gold(spark, silver, root)))
    measure("serving_export", lambda: serving.export_all(kpis, f"{root}/serving"))

    # A fiftieth of the orders changes: Gold anew against Gold by the difference of the batch.
    incremental.upsert_orders(silver, f"{root}/changing", known_unique=True)
    incremental.refresh_totals(spark, f"{root}/changing")
    changed = silver.filter("order_id % 50 = 0").withColumn("payment_value", F.col("payment_value") + 1)

    def change() -> str:
        incremental.upsert_orders(changed, f"{root}/changing", known_unique=True)
        return f"{root}/changing"

    measure("gold_by_difference", lambda at: pipeline.write_gold(spark, incremental.refresh_gold(spark, at), at), change)
    by_order = pipeline.store_by_order(spark, raw, f"{root}/by_order")

    measure("items_agg_raw", lambda: consume(
        enrich.items_per_order(raw["order_items"], products, raw["sellers"])))
    measure("items_agg_shuffled_lookup_raw", lambda: consume(
        enrich.items_per_order(raw["order_items"], products, raw["sellers"], limit=-1)))
    measure("orders_enriched_raw", lambda: consume(enrich_orders(raw)))
    measure("orders_enriched_bucketed", lambda: consume(enrich_orders({**raw, **by_order})))
    measure("kpi_global_raw", lambda: consume(gold.kpi_global(build_silver(raw))))
    measure("kpi_monthly_raw", lambda: consume(gold.kpi_monthly(build_silver(raw))))
    updates = star.order_updates(star.read_star(spark, sf_dir))
    measure("upsert_orders_raw", lambda: consume(upsert(raw["orders"], updates, "order_id")))
    envelope = {"topic": F.lit("orders"), "partition": F.lit(0), "offset": F.lit(0),
                "timestamp": F.current_timestamp()}
    messages = to_messages(order_events(raw), *[c.alias(n) for n, c in envelope.items()])
    measure("events_round_trip_raw", lambda: consume(parse_messages(messages)))

    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(os.path.normpath(sf_dir)),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
