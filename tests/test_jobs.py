import glob
import json
import os
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from lakefold.__main__ import batch_config, ingest_config, parse
from lakefold.entities import CUSTOMERS, ENTITIES, ORDER_ITEMS, ORDERS
from lakefold.functions.scoring import REACHABLE_LADDER
from lakefold.operators import quality
from lakefold.operators.profile import change_log_profile
from lakefold.plans.jobs import BatchConfig, run_batch, run_ingest
from lakefold.plans.processing import (
    BY_SOURCE_TIME,
    FULL,
    advance_state,
    load_current,
    process_changes,
)
from lakefold.session import SHUFFLE_CLEANUP, scratch_root, short_shuffles
from lakefold.sinks.tables import published, read_result
from lakefold.sources.events import MESSAGE_SCHEMA, FileEvents
from lakefold.sources.lake import append_metrics, path_exists, read_metrics, read_position, read_processed
from lakefold.streaming.ingest import IngestConfig

DAY_US = 86_400_000_000


def change(key_name, key, op="c", lsn=1, ts=1000, **more):
    row = {key_name: key, "__op": op, "__lsn": lsn, "__source_ts_ms": ts,
           "__deleted": "true" if op == "d" else "false", **more}
    return json.dumps({"payload": row}).encode()


def order(key, *args, **more):
    return change("order_id", key, *args, **more)


def deliver(spark, root, entity, *values):
    rows = [(bytearray(v), datetime(2024, 1, 1)) for v in values]
    spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(
        f"{root}/events/{entity.name}"
    )


def ingest(spark, root, *entities):
    config = IngestConfig(
        source=FileEvents(f"{root}/events"), raw_root=f"{root}/raw",
        checkpoint_root=f"{root}/stream", metrics_root=f"{root}/metrics", trigger_every=None,
    )
    run_ingest(spark, config, entities or tuple(ENTITIES.values()))


def process(spark, root, follow="arrival", positions="positions"):
    return process_changes(
        spark, ORDERS, f"{root}/raw", f"{root}/processed", f"{root}/{positions}", follow
    )


def ids(df):
    return sorted(r[0] for r in df.select("order_id").collect())


def test_late_change_is_processed_by_arrival_but_not_by_source_time(spark, root):
    deliver(spark, root, ORDERS, order(1, ts=5000))
    ingest(spark, root, ORDERS)
    assert process(spark, root) == 1
    deliver(spark, root, ORDERS, order(2, lsn=2, ts=4000), order(3, lsn=3, ts=6000))
    ingest(spark, root, ORDERS)
    assert process(spark, root) == 2
    assert process(spark, root) == 0
    assert ids(load_current(spark, ORDERS, f"{root}/processed")) == [1, 2, 3]

    other = root + "-by-time"
    args = (spark, ORDERS, f"{root}/raw", f"{other}/processed", f"{other}/positions", BY_SOURCE_TIME)
    assert process_changes(*args) == 3
    assert process_changes(*args) == 0
    assert read_position(spark, f"{other}/positions", "orders").source_ts_ms == 6000


def test_crash_between_data_and_position_leaves_no_copies(spark, root):
    deliver(spark, root, ORDERS, order(1), order(2, lsn=2))
    ingest(spark, root, ORDERS)
    process(spark, root, positions="lost")
    process(spark, root)  # as if the first run had died before its position was written
    assert ids(read_processed(spark, f"{root}/processed", ORDERS)) == [1, 2]


def test_full_processing_replaces_the_area(spark, root):
    deliver(spark, root, ORDERS, order(1))
    ingest(spark, root, ORDERS)
    assert [process(spark, root, FULL) for _ in range(2)] == [1, 1]
    assert ids(read_processed(spark, f"{root}/processed", ORDERS)) == [1]


def test_state_moves_forward(spark, root):
    args = (spark, ORDERS, f"{root}/processed", f"{root}/state")
    deliver(spark, root, ORDERS, order(1, status="pending"), order(2, lsn=2), order(3, lsn=3))
    ingest(spark, root, ORDERS)
    process(spark, root)
    assert ids(advance_state(*args)) == [1, 2, 3]
    assert ids(advance_state(*args)) == [1, 2, 3]
    deliver(
        spark, root, ORDERS, order(1, "u", 8, 2000, status="shipped"), order(2, "d", 9, 2000),
        order(4, lsn=4), order(3, "u", 0, 500, status="older"),
    )
    ingest(spark, root, ORDERS)
    process(spark, root)
    state = advance_state(*args)
    assert sorted((r.order_id, r.status) for r in state.collect()) == [(1, "shipped"), (3, None), (4, None)]
    assert ids(state) == ids(load_current(spark, ORDERS, f"{root}/processed"))
    # A late update of the deleted order must not bring it back.
    deliver(spark, root, ORDERS, order(2, "u", 5, 1500))
    ingest(spark, root, ORDERS)
    process(spark, root)
    assert ids(advance_state(*args)) == [1, 3, 4]


def test_raw_area_of_another_writer(spark, root):
    """No batch directories, no rejection columns, 32-bit ids, partitioned by operation only."""
    deliver(spark, root, ORDERS, order(1))
    ingest(spark, root, ORDERS)
    plain = spark.read.parquet(f"{root}/raw/orders").drop(
        "ingest_batch", "attempt", "is_rejected", "reject_reason", "event_text", "origin", "origin_offset"
    )
    plain = plain.withColumn("order_id", plain.order_id.cast("int"))
    other = root + "-plain"
    plain.write.partitionBy("__op").parquet(f"{other}/raw/orders")
    assert process(spark, other) == 1
    assert process(spark, other) == 1
    assert ids(read_processed(spark, f"{other}/processed", ORDERS)) == [1]


def test_missing_raw_area_is_an_error(spark, root):
    with pytest.raises(FileNotFoundError):
        process(spark, root)


def test_only_a_missing_position_table_means_start(spark, root):
    assert read_position(spark, f"{root}/none", "orders").steps == 0
    spark.createDataFrame([("x",)], "a string").write.text(f"{root}/bad")
    with pytest.raises(Exception):
        read_position(spark, f"{root}/bad", "orders")


def shop(spark, root):
    deliver(
        spark, root, CUSTOMERS,
        *(change("customer_id", n, "r", 1, first_name="f", last_name="l", email=f"{n % 3}@x",
                 registration_date=19_000 * DAY_US) for n in range(4)),
    )
    deliver(
        spark, root, ORDERS,
        *(order(n, lsn=n, customer_id=n % 4, order_date=(19_500 + n) * DAY_US, status="shipped",
                total_amount="AnY=") for n in range(8)),
        order(7, "d", 99, 9000),
    )
    deliver(
        spark, root, ORDER_ITEMS,
        *(change("item_id", n, lsn=n, order_id=n // 2, product_id=f"p{n % 3}", product_name="n",
                 quantity=1, unit_price="AnY=", discount="Cg==") for n in range(16)),
    )
    ingest(spark, root)


def batch(root, **changes):
    return BatchConfig(
        raw_root=f"{root}/raw", processed_root=f"{root}/processed", results_root=root,
        positions=f"{root}/positions", state_root=f"{root}/state",
        metrics_root=f"{root}/metrics", **changes,
    )


REPORTS = {
    "daily_sales", "weekly_sales", "weekly_sales_iso", "monthly_sales", "sales_by_status",
    "customer_cohorts", "customer_rfm", "customer_segments", "product_performance", "product_affinity",
}


def test_batch_job_writes_every_table(spark, root):
    shop(spark, root)
    results = run_batch(spark, batch(root))
    assert REPORTS | {"change_log_profile", "audit_order_totals"} <= set(results)
    # 6.30 at ten percent off, fourteen lines on live orders
    assert sum(r.total_sales for r in results["daily_sales"].collect()) == pytest.approx(14 * 5.67)
    folders = {name: f"{root}/analytics/{folder}" for name, (folder, _) in published(spark, root).items()}
    for name, table in results.items():
        assert glob.glob(f"{folders[name].removeprefix('file:')}/csv/{name}/*.csv") or not table.count()
        assert read_result(spark, root, name).count() == table.count()
    csv = spark.read.option("header", True).csv(f"{folders['daily_sales']}/csv/daily_sales")
    assert csv.count() == 7
    assert len(glob.glob(f"{folders['daily_sales'].removeprefix('file:')}/csv/daily_sales/*.csv")) == 1
    orphans = {r.relation: (r.orphan_keys, r.orphan_rows) for r in results["audit_foreign_keys"].collect()}
    assert orphans["order_items.order_id -> orders.order_id"] == (1, 2)
    repeated = {(r.entity, r["columns"]): r.repeated_values for r in results["audit_uniqueness"].collect()}
    assert repeated[("customers", "email")] == 1

    # A second run without changes gives the same tables, with and without a stored state.
    def rows(tables):
        return {name: sorted(map(repr, tables[name].collect())) for name in REPORTS}

    first = rows(results)
    assert rows(run_batch(spark, batch(root, audit=False))) == first
    assert rows(run_batch(spark, batch(root, keep_state=False, audit=False))) == first


def test_missing_entity_stops_before_any_report(spark, root):
    deliver(spark, root, ORDERS, order(1))
    ingest(spark, root, ORDERS)
    with pytest.raises(FileNotFoundError):
        run_batch(spark, batch(root))
    assert not path_exists(spark, f"{root}/analytics")


def test_a_second_run_opens_new_batches_and_state_only(spark, root):
    shop(spark, root)
    run_batch(spark, batch(root, audit=False))
    deliver(spark, root, ORDERS, order(2, "u", 200, 9999, status="delivered", customer_id=2, order_date=19_502 * DAY_US))
    ingest(spark, root)
    opened = []
    plain = DataFrameReader.parquet

    def watched(reader, *paths, **options):
        opened.extend(paths)
        return plain(reader, *paths, **options)

    DataFrameReader.parquet = watched
    try:
        results = run_batch(spark, batch(root, audit=False))
    finally:
        DataFrameReader.parquet = plain
    raw = [p for p in opened if "/raw/orders/" in p]
    assert raw and all("/ingest_batch=1/" in p for p in raw)
    profile = {(r.entity, r.metric): r.value for r in results["change_log_profile"].collect()}
    whole = change_log_profile(read_processed(spark, f"{root}/processed", ORDERS), "orders", ORDERS.key)
    assert {k: v for k, v in profile.items() if k[0] == "orders"} == {
        ("orders", r.metric): r.value for r in whole.collect()}
    scratch = scratch_root(spark).removeprefix("file:")
    assert not glob.glob(f"{scratch}/batch-run-*")


def test_uniqueness_leaves_nulls_out(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",), ("a",), ("b",)], "email string")
    row = quality.audit_uniqueness(df, "customers", ["email"]).first()
    assert (row.repeated_values, row.rows_affected) == (1, 2)


def test_constraint_audit_counts_violations(spark):
    rows = [(1, "ok", None, Decimal(1)), (None, "x" * 21, "lost", None)]
    df = spark.createDataFrame(
        [(a, b, c, d) for a, b, c, d in rows],
        "order_id bigint, payment_method string, status string, total_amount decimal(10,2)",
    )
    found = {r.rule: r.violations for r in quality.audit_constraints(df, ORDERS).collect()}
    assert found == {
        "order_id not null": 1, "total_amount not null": 1, "status at most 20 characters": 0,
        "payment_method at most 50 characters": 0, "status in domain": 1,
    }


def test_order_total_audit_rounds_half_even_and_takes_missing_items_as_zero(spark):
    orders = spark.createDataFrame(
        [(1, Decimal("0.12")), (2, Decimal("0.13")), (3, Decimal("5.00")), (4, Decimal("0.00"))],
        "order_id bigint, total_amount decimal(10,2)",
    )
    items = spark.createDataFrame(
        [(n, 1, Decimal("0.25"), Decimal("0.50")) for n in (1, 2)],  # 0.125
        "order_id bigint, quantity int, unit_price decimal(10,2), discount decimal(5,2)",
    )
    found = {r.order_id: r.difference for r in quality.audit_order_totals(orders, items).collect()}
    assert found == {2: 0.01, 3: 5.0}


def test_command_line(spark):
    options = parse(["ingest", "--bootstrap-servers", "b:9092", "--lake", "s3a://lake"])
    config = ingest_config(options)
    assert config.source.bootstrap_servers == "b:9092" and config.raw_root == "s3a://lake/raw"
    options = parse(["ingest", "--bootstrap-servers", "b:9092", "--lake", "l", "--starting-offsets", "latest",
                     "--topic", "orders=shop.orders", "--max-per-batch", "7", "--dedupe-for", "", "--partitions", "32"])
    config = ingest_config(options)
    assert (config.source.starting_offsets, config.source.topics, config.source.max_events_per_batch) == (
        "latest", {"orders": "shop.orders"}, 7)
    assert config.dedupe_for is None and options.partitions == 32
    options = parse(["batch", "--lake", "/lake", "--results", "/out", "--fold-key", "order_items=order_id,product_id",
                     "--ladder", "reachable", "--no-state"])
    config = batch_config(options)
    assert config.results_root == "/out" and config.keys == {"order_items": ("order_id", "product_id")}
    assert config.rfm_rules.ladder == REACHABLE_LADDER and not config.keep_state
    with pytest.raises(ValueError):
        batch_config(parse(["batch", "--lake", "/lake", "--fold-key", "nothing=x"]))
    options = parse(["batch", "--lake", "/lake", "--follow", "full", "--no-audit"])
    assert batch_config(options).follow == FULL and not batch_config(options).audit


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def test_a_job_leaves_no_shuffle_files(spark, root):
    deliver(spark, root, ORDERS, order(1, customer_id=1), order(2, lsn=2, customer_id=1))
    before = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP)
    ingest(spark, root, ORDERS)
    assert shuffle_files(spark) <= before[0] and spark.conf.get(SHUFFLE_CLEANUP) == before[1]
    with short_shuffles(spark):
        spark.range(100).groupBy(F.col("id") % 7).count().collect()
    assert shuffle_files(spark) <= before[0]


def test_bounded_batches_are_compressed_and_end_their_events(spark, root):
    """A micro-batch takes files up to a number of bytes; ``cleanSource`` removes what is in the lake."""
    for key in (1, 2, 3):
        deliver(spark, root, ORDERS, order(key, lsn=key))
    source = FileEvents(f"{root}/events", options={"cleanSource": "delete"}, max_bytes_per_batch=1)
    config = IngestConfig(
        source=source, raw_root=f"{root}/raw", checkpoint_root=f"{root}/stream", metrics_root=f"{root}/metrics", trigger_every=None)
    run_ingest(spark, config, [ORDERS])
    assert read_metrics(spark, f"{root}/metrics").count() == 3
    assert process(spark, root) == 3
    assert ids(load_current(spark, ORDERS, f"{root}/processed")) == [1, 2, 3]
    local = root.removeprefix("file:")
    for area in ("raw", "processed"):
        files = glob.glob(f"{local}/{area}/**/part-*", recursive=True)
        assert files and all(f.endswith(".zstd.parquet") for f in files)
    assert len(glob.glob(f"{local}/events/orders/part-*")) < 3


def test_metrics_of_an_entity_leave_the_writes_of_others_alone(spark, root):
    """Streams end their batches at the same time; what another has begun in the shared folder must stay."""
    begun = os.path.join(root.removeprefix("file:"), "metrics", "_temporary", "0", "task")
    os.makedirs(begun)
    row = {"entity": "orders", "ingest_batch": 0, "run": "r", "run_batch": 0, "attempt": "a", "accepted_rows": 1, "rejected_rows": 0}
    append_metrics(spark, f"{root}/metrics", row)
    assert os.path.isdir(begun)
    assert [(r.entity, r.accepted_rows) for r in read_metrics(spark, f"{root}/metrics").collect()] == [("orders", 1)]
