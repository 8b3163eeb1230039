"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the table directory, ``BENCH_CPUS`` the number of local cores.  Every query is
written to the ``noop`` sink, so all of its rows are computed and none pass through the driver.
Each value is the median of three runs after one warm-up.  ``jobs`` times the stream and the batch job once each, over
a first, a small second and a large third delivery; they are not part of ``value``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from lakefold.entities import ENTITIES  # noqa: E402
from lakefold.plans import star_schema as star  # noqa: E402
from lakefold.plans.jobs import BatchConfig, run_batch, run_ingest  # noqa: E402
from lakefold.plans.registered import QUERIES  # noqa: E402
from lakefold.session import build_session, new_scratch  # noqa: E402
from lakefold.sources.events import FileEvents  # noqa: E402
from lakefold.streaming.ingest import IngestConfig  # noqa: E402

HEADLINE = (
    "daily_sales",
    "weekly_sales",
    "monthly_sales",
    "product_affinity",
    "customer_rfm",
    "customer_cohorts",
    "product_performance",
    "sales_by_status",
    "current_orders",
    "current_order_items",
    "change_log_profile",
    "decode_change_events",
    "audit_order_totals",
)
RUNS = 3


def seconds(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def job_seconds(spark, sf_dir: str) -> dict[str, float]:
    """The whole path over all events: ingest and a batch run of a first delivery, of a second one that changes one key in a
    hundred, and of a third one with all other changes."""
    root = new_scratch(spark, "bench")
    logs = {"customers": star.customer_log, "orders": star.order_log, "order_items": star.order_item_log}
    config = IngestConfig(
        source=FileEvents(f"{root}/events"), raw_root=f"{root}/raw", checkpoint_root=f"{root}/stream",
        metrics_root=f"{root}/metrics", trigger_every=None,
    )
    batch = BatchConfig(
        raw_root=f"{root}/raw", processed_root=f"{root}/processed", results_root=root, positions=f"{root}/positions",
        state_root=f"{root}/state", metrics_root=f"{root}/metrics", state_buckets=8,
    )
    took = {}
    for run, ops in (("first", ("c", "r")), ("second", ("c", "r")), ("third", ("u", "d"))):
        for name, log in logs.items():
            changes = log(spark, sf_dir).filter(F.col("__op").isin(*ops))
            if run == "second":  # new versions of one key in a hundred
                changes = changes.filter(F.col(ENTITIES[name].key[0]) % 100 == 0).withColumns({
                    "__op": F.lit("u"), "__lsn": F.col("__lsn") + 10**9, "__source_ts_ms": F.col("__source_ts_ms") + 10**9,
                })
            events = star.wire_events(changes, ENTITIES[name])
            events.write.mode("append").parquet(f"{root}/events/{name}")
        for job, work in (("ingest", lambda: run_ingest(spark, config)), ("batch", lambda: run_batch(spark, batch))):
            started = time.perf_counter()
            work()
            took[f"{run}_{job}"] = round(time.perf_counter() - started, 3)
    return took


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = build_session(
        "bench",
        {
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in sys.argv[1:] or HEADLINE:
        seconds(spark, name, sf_dir)
        timings[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "jobs": job_seconds(spark, sf_dir) if len(sys.argv) == 1 else {},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
