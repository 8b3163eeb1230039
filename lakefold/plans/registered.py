"""Named queries over a directory of star-schema tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakefold.entities import CUSTOMERS, ENTITIES, ORDER_ITEMS, ORDER_PRODUCT_KEY, ORDERS
from lakefold.functions.columns import as_double
from lakefold.functions.scoring import REACHABLE_LADDER, RfmRules
from lakefold.operators import customers, fold, products, quality, sales
from lakefold.operators.decode import decode_events, to_processed
from lakefold.operators.profile import change_log_profile
from lakefold.plans import star_schema as star
from lakefold.plans.jobs import BatchConfig, run_batch, run_ingest
from lakefold.plans.processing import BY_SOURCE_TIME, advance_state, load_current, process_changes
from lakefold.session import new_scratch, short_shuffles
from lakefold.sinks.tables import read_result_csv, write_result
from lakefold.sources.events import FileEvents
from lakefold.sources.lake import CODEC, incremental_since, read_metrics, read_raw, read_rejected
from lakefold.streaming.ingest import IngestConfig, ingest_totals

Query = Callable[[SparkSession, str], DataFrame]
# Compressed events of a micro-batch.
MOST_EVENT_BYTES = 2**30


def _order_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.order_sales(star.orders(spark, sf_dir), star.order_items(spark, sf_dir))


def daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.daily_sales(_order_sales(spark, sf_dir))


def weekly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.weekly_sales(_order_sales(spark, sf_dir))


def weekly_sales_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.weekly_sales_iso(_order_sales(spark, sf_dir))


def monthly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.monthly_sales(_order_sales(spark, sf_dir))


def monthly_sales_without_cancelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = sales.order_sales(
        star.orders(spark, sf_dir), star.order_items(spark, sf_dir), exclude_status="cancelled"
    )
    return sales.monthly_sales(kept)


def sales_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.sales_by_status(star.orders(spark, sf_dir))


def customer_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers.customer_cohorts(star.customers(spark, sf_dir), star.orders(spark, sf_dir))


def customer_rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers.customer_rfm(star.customers(spark, sf_dir), star.orders(spark, sf_dir))


def customer_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers.customer_segments(customer_rfm(spark, sf_dir))


def customer_segments_reachable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments by the ladder in which every rung can match."""
    rfm = customers.customer_rfm(
        star.customers(spark, sf_dir),
        star.orders(spark, sf_dir),
        RfmRules(ladder=REACHABLE_LADDER),
    )
    return customers.customer_segments(rfm)


def product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.product_performance(star.order_items(spark, sf_dir))


def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.top_products(star.order_items(spark, sf_dir))


def product_affinity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.product_affinity(star.order_items(spark, sf_dir))


def top_product_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.top_product_pairs(star.order_items(spark, sf_dir))


def current_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_columns(fold.current_state(star.order_log(spark, sf_dir), ORDERS.key))


def _order_columns(folded: DataFrame) -> DataFrame:
    return folded.select(
        "order_id",
        "customer_id",
        F.to_date("order_date").alias("order_date"),
        "status",
        as_double(F.col("total_amount")).alias("total_amount"),
        F.col("__op").alias("op"),
        F.col("__lsn").alias("lsn"),
    )


def current_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _item_columns(fold.current_state(star.order_item_log(spark, sf_dir), ORDER_ITEMS.key))


def current_order_items_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folded by order and product, which keeps one line per product of an order."""
    return _item_columns(fold.current_state(star.order_item_log(spark, sf_dir), ORDER_PRODUCT_KEY))


def _item_columns(folded: DataFrame) -> DataFrame:
    return folded.select(
        "item_id",
        "order_id",
        "product_id",
        "quantity",
        as_double(F.col("discount")).alias("discount"),
        F.col("__lsn").alias("lsn"),
    )


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = change_log_profile(star.order_log(spark, sf_dir), ORDERS.name, ORDERS.key)
    items = change_log_profile(
        star.order_item_log(spark, sf_dir), ORDER_ITEMS.name, ORDER_PRODUCT_KEY
    )
    people = change_log_profile(star.customer_log(spark, sf_dir), CUSTOMERS.name, CUSTOMERS.key)
    # Keys with dozens of versions: all changes to the orders of a customer.
    many = change_log_profile(star.order_log(spark, sf_dir), "orders_by_customer", ["customer_id"])
    return orders.unionByName(items).unionByName(people).unionByName(many)


def decode_change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order event to JSON bytes and back."""
    events = star.wire_events(star.order_log(spark, sf_dir), ORDERS)
    return to_processed(decode_events(events, ORDERS), ORDERS).select(
        "order_id",
        "customer_id",
        F.to_date("order_date").alias("order_date"),
        "status",
        as_double(F.col("total_amount")).alias("total_amount"),
        F.col("__op").alias("op"),
        F.col("__lsn").alias("lsn"),
        F.unix_millis("cdc_timestamp").alias("changed_at_ms"),
        "is_deleted",
        "reject_reason",
    )


def decode_order_item_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = star.wire_events(star.order_item_log(spark, sf_dir), ORDER_ITEMS)
    return to_processed(decode_events(events, ORDER_ITEMS), ORDER_ITEMS).select(
        "item_id",
        "product_id",
        "product_name",
        "quantity",
        as_double(F.col("unit_price")).alias("unit_price"),
        as_double(F.col("discount")).alias("discount"),
        F.col("__lsn").alias("lsn"),
        "is_deleted",
    )


def quarantined_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why damaged events are set aside, with their text."""
    decoded = decode_events(star.damaged_order_events(spark, sf_dir), ORDERS)
    return (
        decoded.filter(F.col("reject_reason").isNotNull())
        .groupBy("reject_reason", "event_text")
        .agg(F.count("*").alias("events"))
    )


def incremental_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes after the mean source time, and the next high-water mark, per operation."""
    log = star.order_log(spark, sf_dir)
    mark = log.agg(F.floor(F.avg("__source_ts_ms")).alias("mark")).scalar()
    return incremental_since(log, mark).groupBy(F.col("__op").alias("op")).agg(
        F.count("*").alias("changes"), F.max("__source_ts_ms").alias("next_mark")
    )


def _deliver(events: DataFrame, root: str, entity_name: str) -> None:
    with short_shuffles(events.sparkSession):
        events.write.mode("append").option("compression", CODEC).parquet(f"{root}/events/{entity_name}")


def _ingest_config(root: str, checkpoints: str = "stream-checkpoints") -> IngestConfig:
    return IngestConfig(
        # Deliveries are the query's own: a file goes once it is in the lake, and so do the shuffles of each bounded micro-batch.
        source=FileEvents(f"{root}/events", options={"cleanSource": "delete"}, max_bytes_per_batch=MOST_EVENT_BYTES),
        raw_root=f"{root}/raw",
        checkpoint_root=f"{root}/{checkpoints}",
        metrics_root=f"{root}/metrics",
        trigger_every=None,
    )


def _batch_config(root: str, **changes) -> BatchConfig:
    return BatchConfig(
        raw_root=f"{root}/raw",
        processed_root=f"{root}/processed",
        results_root=root,
        positions=f"{root}/positions",
        state_root=f"{root}/state",
        metrics_root=f"{root}/metrics",
        state_buckets=4, **changes,
    )


def _creates(log: DataFrame) -> DataFrame:
    return log.filter(F.col("__op") == "c")


def stream_ingest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the stream; the second receives every event of the first again."""
    root = new_scratch(spark, "stream-orders")
    log = star.order_log(spark, sf_dir)
    for delivery in (_creates(log), log):
        _deliver(star.wire_events(delivery, ORDERS), root, ORDERS.name)
        run_ingest(spark, _ingest_config(root), [ORDERS])
    return read_raw(spark, f"{root}/raw", ORDERS, f"{root}/metrics").select(
        "order_id",
        F.col("__op").alias("op"),
        F.col("__lsn").alias("lsn"),
        F.col("__source_ts_ms").alias("source_ts_ms"),
        "is_deleted",
    )


def stream_ingest_new_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second stream with a new checkpoint over the same lake: nothing of either is lost in the fold."""
    root = new_scratch(spark, "stream-checkpoint")
    log = star.order_log(spark, sf_dir)
    for delivery, checkpoints in ((_creates(log), "first"), (log.filter(F.col("__op") != "c"), "second")):
        _deliver(star.wire_events(delivery, ORDERS), root, ORDERS.name)
        run_ingest(spark, _ingest_config(root, checkpoints), [ORDERS])
    config = _batch_config(root)
    process_changes(
        spark, ORDERS, config.raw_root, config.processed_root, config.positions, metrics_root=config.metrics_root
    )
    return _order_columns(load_current(spark, ORDERS, config.processed_root))


def stream_rejected_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged events of one time, many with equal texts, delivered twice: each place in the source counts once."""
    root = new_scratch(spark, "stream-rejected")
    for _ in range(2):
        _deliver(star.damaged_order_events(spark, sf_dir), root, ORDERS.name)
        run_ingest(spark, _ingest_config(root), [ORDERS])
    rejected = read_rejected(spark, f"{root}/raw", ORDERS, f"{root}/metrics")
    return rejected.groupBy("reject_reason").agg(
        F.count("*").alias("events"), F.max("origin_offset").alias("last_offset")
    )


def stream_ingest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query per entity, side by side; rows written and rejected as the metrics table has them."""
    root = new_scratch(spark, "stream-metrics")
    _deliver(star.wire_events(star.customer_log(spark, sf_dir), CUSTOMERS), root, "customers")
    _deliver(star.damaged_order_events(spark, sf_dir), root, "orders")
    _deliver(star.wire_events(star.order_item_log(spark, sf_dir), ORDER_ITEMS), root, "order_items")
    run_ingest(spark, _ingest_config(root))
    totals = ingest_totals(read_metrics(spark, f"{root}/metrics"))
    return totals.select("entity", "total_rows_written", "total_rows_rejected")


def incremental_checkpoint_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries, each processed from the stored position; a third run finds nothing new."""
    root = new_scratch(spark, "incremental")
    log = star.order_log(spark, sf_dir)
    config = _batch_config(root)
    for delivery in (_creates(log), log.filter(F.col("__op") != "c"), None):
        if delivery is not None:
            _deliver(star.wire_events(delivery, ORDERS), root, ORDERS.name)
            run_ingest(spark, _ingest_config(root), [ORDERS])
        process_changes(
            spark, ORDERS, config.raw_root, config.processed_root, config.positions, metrics_root=config.metrics_root
        )
        state = advance_state(spark, ORDERS, config.processed_root, config.state_root)
    return _order_columns(state)


def incremental_by_source_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Like ``incremental_checkpoint_run``, following source time and folding the whole log."""
    root = new_scratch(spark, "by-source-time")
    log = star.order_log(spark, sf_dir)
    config = _batch_config(root, follow=BY_SOURCE_TIME)
    middle = log.agg(F.floor(F.avg("__source_ts_ms")).alias("middle")).scalar()
    older = log.filter(F.col("__source_ts_ms") <= middle)
    newer = log.filter(F.col("__source_ts_ms") > middle)
    for delivery in (older, newer):
        _deliver(star.wire_events(delivery, ORDERS), root, ORDERS.name)
        run_ingest(spark, _ingest_config(root), [ORDERS])
        process_changes(
            spark, ORDERS, config.raw_root, config.processed_root, config.positions, config.follow,
            config.metrics_root,
        )
    return _order_columns(load_current(spark, ORDERS, config.processed_root))


def results_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sales written as Parquet and single-file CSV; the CSV read back."""
    root = new_scratch(spark, "results")
    written = write_result(daily_sales(spark, sf_dir), root, "daily_sales", True, ["order_date"])
    return read_result_csv(spark, root, "daily_sales", written.schema)


def batch_job_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pipeline: events of all entities, streams, processing, fold, all reports."""
    root = new_scratch(spark, "batch-job")
    logs = {
        "customers": star.customer_log(spark, sf_dir),
        "orders": star.order_log(spark, sf_dir),
        "order_items": star.order_item_log(spark, sf_dir),
    }
    for name, log in logs.items():
        _deliver(star.wire_events(log, ENTITIES[name]), root, name)
    run_ingest(spark, _ingest_config(root))
    return run_batch(spark, _batch_config(root))["daily_sales"]


def _job_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All result tables after two deliveries to all streams and a batch run after each."""
    root = new_scratch(spark, "batch-job-tables")
    logs = {
        "customers": star.customer_log(spark, sf_dir),
        "orders": star.order_log(spark, sf_dir),
        "order_items": star.order_item_log(spark, sf_dir),
    }
    results = {}
    for first in (True, False):
        for name, log in logs.items():
            part = F.col("__op").isin("c", "r")
            _deliver(star.wire_events(log.filter(part if first else ~part), ENTITIES[name]), root, name)
        run_ingest(spark, _ingest_config(root))
        results = run_batch(spark, _batch_config(root, audit=False))
    return results


# Result table -> its key columns; the other columns are measures.
JOB_KEYS = {
    "daily_sales": ("order_date",),
    "weekly_sales": ("year", "week"),
    "weekly_sales_iso": ("iso_year", "week"),
    "monthly_sales": ("year_month",),
    "sales_by_status": ("status",),
    "customer_cohorts": ("registration_cohort", "order_month"),
    "customer_rfm": ("customer_id", "segment", "first_name", "last_name", "email"),
    "customer_segments": ("segment",),
    "product_performance": ("product_id", "product_name"),
    "product_affinity": ("product_a_id", "product_a_name", "product_b_id", "product_b_name"),
    "change_log_profile": ("entity", "metric"),
}


def batch_job_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every result table of the batch job as ``table_name, row_key, measure, value``."""
    tall = None
    for name, df in _job_tables(spark, sf_dir).items():
        keys = JOB_KEYS[name]
        measures = [
            F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in df.columns if c not in keys
        ]
        part = df.select(
            F.lit(name).alias("table_name"),
            F.concat_ws("|", *(F.col(k).cast("string") for k in keys)).alias("row_key"),
            F.inline(F.array(*measures)),
        )
        tall = part if tall is None else tall.unionByName(part)
    return tall


def audit_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule, on tables with faults of every kind."""
    return (
        quality.audit_constraints(star.faulty_customers(spark, sf_dir), CUSTOMERS)
        .unionByName(quality.audit_constraints(star.faulty_orders(spark, sf_dir), ORDERS))
        .unionByName(quality.audit_constraints(star.faulty_order_items(spark, sf_dir), ORDER_ITEMS))
    )


def audit_foreign_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of unknown customers, and items of orders that the change log has deleted."""
    orders = fold.current_state(star.order_log(spark, sf_dir), ORDERS.key)
    items, people = star.order_items(spark, sf_dir), star.customers(spark, sf_dir)
    return quality.audit_foreign_key(
        star.faulty_orders(spark, sf_dir), people, "orders", "customer_id", "customers", "customer_id"
    ).unionByName(
        quality.audit_foreign_key(items, orders, "order_items", "order_id", "orders", "order_id")
    )


def audit_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean keys, and mail addresses that are shared, missing or both."""
    people, items = star.customers(spark, sf_dir), star.order_items(spark, sf_dir)
    checks = [
        quality.audit_uniqueness(people, "customers", ["customer_id"]),
        quality.audit_uniqueness(star.faulty_customers(spark, sf_dir), "customers", ["email"]),
        quality.audit_uniqueness(star.orders(spark, sf_dir), "orders", ["order_id"]),
        quality.audit_uniqueness(items, "order_items", ["item_id"]),
        quality.audit_uniqueness(items, "order_items", list(ORDER_PRODUCT_KEY)),
    ]
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return result


def audit_order_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.audit_order_totals(star.reconciled_orders(spark, sf_dir), star.order_items(spark, sf_dir))


def product_affinity_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products bought by the same customer, with baskets of many blocks: for every product its name, with how many others it was bought
    and by how many customers, summed over these.  A pair counts for both of its products."""
    owners = star.orders(spark, sf_dir).select("order_id", "customer_id")
    bought = star.order_items(spark, sf_dir).join(owners, "order_id").drop("order_id")
    pairs = products.product_affinity(bought.withColumnRenamed("customer_id", "order_id"), basket_block=8)
    names = ["product_a_id", "product_a_name"]
    turned = pairs.select(F.col("product_b_id").alias(names[0]), F.col("product_b_name").alias(names[1]), "count")
    # Each side is summed by itself, so that no row of a pair with its names is shuffled.
    sides = [side.groupBy(*names).agg(F.count("*").alias("partners"), F.sum("count").alias("customers")) for side in (pairs, turned)]
    return sides[0].unionByName(sides[1]).groupBy(*names).agg(F.sum("partners").alias("partners"), F.sum("customers").alias("customers"))


QUERIES: dict[str, Query] = {
    "daily_sales": daily_sales,
    "weekly_sales": weekly_sales,
    "weekly_sales_iso": weekly_sales_iso,
    "monthly_sales": monthly_sales,
    "monthly_sales_without_cancelled": monthly_sales_without_cancelled,
    "sales_by_status": sales_by_status,
    "customer_cohorts": customer_cohorts,
    "customer_rfm": customer_rfm,
    "customer_segments": customer_segments,
    "customer_segments_reachable": customer_segments_reachable,
    "product_performance": product_performance,
    "top_products": top_products,
    "product_affinity": product_affinity,
    "product_affinity_by_customer": product_affinity_by_customer,
    "top_product_pairs": top_product_pairs,
    "current_orders": current_orders,
    "current_order_items": current_order_items,
    "current_order_items_composite": current_order_items_composite,
    "change_log_profile": profile,
    "decode_change_events": decode_change_events,
    "decode_order_item_events": decode_order_item_events,
    "quarantined_events": quarantined_events,
    "incremental_since": incremental_changes,
    "incremental_checkpoint_run": incremental_checkpoint_run,
    "incremental_by_source_time": incremental_by_source_time,
    "stream_ingest_orders": stream_ingest_orders,
    "stream_ingest_metrics": stream_ingest_metrics,
    "stream_ingest_new_checkpoint": stream_ingest_new_checkpoint,
    "stream_rejected_events": stream_rejected_events,
    "results_roundtrip": results_roundtrip,
    "batch_job_daily_sales": batch_job_daily_sales,
    "batch_job_tables": batch_job_tables,
    "audit_constraints": audit_constraints,
    "audit_foreign_keys": audit_foreign_keys,
    "audit_uniqueness": audit_uniqueness,
    "audit_order_totals": audit_order_totals,
}
