"""The two jobs: continuous ingest and the analytics batch.  Only this layer runs actions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakefold.entities import CUSTOMERS, ENTITIES, FOREIGN_KEYS, ORDER_ITEMS, ORDERS, Entity
from lakefold.functions.scoring import RfmRules
from lakefold.operators import customers as customer_reports
from lakefold.operators import products as product_reports
from lakefold.operators import deltas, quality
from lakefold.operators import sales as sales_reports
from lakefold.operators.profile import change_log_profile
from lakefold.plans.incremental import KeptState
from lakefold.plans.processing import BY_ARRIVAL, load_current, process_changes
from lakefold.session import at_once, drop_folder, new_scratch, short_shuffles
from lakefold.sinks.tables import ResultVersion, materialize
from lakefold.sources.lake import read_processed
from lakefold.streaming.ingest import IngestConfig, start_ingest


PERIOD_ORDER = {
    "daily_sales": ("order_date",), "weekly_sales": ("year", "week"), "weekly_sales_iso": ("iso_year", "week"),
    "monthly_sales": ("year_month",),
}
PROFILE_ORDER = ("entity", "place", "metric")
COHORT_ORDER = ("registration_cohort", "order_month")


def run_ingest(
    spark: SparkSession, config: IngestConfig, entities: Sequence[Entity] = tuple(ENTITIES.values())
) -> None:
    """Run one query per entity.

    A continuous run ends when any query ends: the others are stopped and the failure is raised.  A
    run over what is available ends when all queries have finished.
    """
    queries = []
    # Forget queries that ended earlier in this session, or the wait would return at once.
    spark.streams.resetTerminated()
    try:
        with short_shuffles(spark):  # queries take the settings they are started with
            for entity in entities:
                queries.append(start_ingest(spark, config, entity))
        if config.trigger_every is None:
            for query in queries:
                query.awaitTermination()
        else:
            spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


@dataclass(frozen=True)
class BatchConfig:
    """Where the batch job reads and writes, and how it counts.

    ``keys`` replaces the fold key of an entity, for instance by ``ORDER_PRODUCT_KEY``.
    ``keep_state`` stores fold and sums between runs and needs ``follow`` to be ``arrival``; ``state_buckets`` is about the
    bytes of the largest table by 128 MB, and another number starts a new state.  ``writers`` results are written at a time.
    ``metrics_root`` is the stream's and keeps the job off the batch being written; None is for a
    raw area that nobody writes to meanwhile.
    """

    raw_root: str
    processed_root: str
    results_root: str
    positions: str
    state_root: str
    metrics_root: str | None = None
    follow: str = BY_ARRIVAL
    keep_state: bool = True
    keys: Mapping[str, Sequence[str]] = field(default_factory=dict)
    exclude_status: str | None = None
    rfm_rules: RfmRules = field(default_factory=RfmRules)
    audit: bool = True
    state_buckets: int = 16
    writers: int = 4


def run_batch(spark: SparkSession, config: BatchConfig) -> dict[str, DataFrame]:
    """Process new changes of all entities, fold them and publish every result table as one version (``read_result``).

    Any failure leaves the published version as it was.  What the run keeps for itself meanwhile
    is removed at its end; the returned tables are read from the results.
    """
    scratch = new_scratch(spark, "batch-run")
    try:
        with short_shuffles(spark):
            return _run_batch(spark, config, scratch)
    finally:
        drop_folder(spark, scratch)


def _run_batch(spark: SparkSession, config: BatchConfig, scratch: str) -> dict[str, DataFrame]:
    for entity in ENTITIES.values():  # one after the other, as their positions are appended to one table
        process_changes(
            spark, entity, config.raw_root, config.processed_root, config.positions, config.follow, config.metrics_root
        )
    if not _keeps_state(config):
        return _publish(spark, config, _whole_reports(spark, config, scratch))
    kept = KeptState(spark, config.state_root, config.keys, config.exclude_status, config.state_buckets, config.writers)
    try:
        kept.advance(config.processed_root, scratch)
        return _publish(spark, config, _kept_reports(kept, config))
    finally:
        kept.close()


def _keeps_state(config: BatchConfig) -> bool:
    return config.keep_state and config.follow == BY_ARRIVAL


@dataclass(frozen=True)
class Report:
    """A result table to be written.  ``small`` ones have a row per period, status, cohort or segment and get a single CSV file;
    those that grow with customers or products do not, and are not sorted.  ``made_from`` names unchanging inputs."""

    name: str
    table: DataFrame
    small: bool
    order: tuple = ()
    made_from: str | None = None


def _publish(spark: SparkSession, config: BatchConfig, reports: Sequence[Report]) -> dict[str, DataFrame]:
    """Write all reports, ``writers`` of them at a time, and publish them together."""
    version = ResultVersion(spark, config.results_root)
    written = at_once(
        [partial(version.write, r.table, r.name, r.small, r.order, r.made_from) for r in reports], config.writers
    )
    results = {r.name: table for r, table in zip(reports, written)}
    # Segments are counted from the written customer table.
    scores = next(r for r in reports if r.name == "customer_rfm")
    segments = customer_reports.customer_segments(results["customer_rfm"])
    results["customer_segments"] = version.write(
        segments, "customer_segments", True, (F.desc("customer_count"), "segment"), scores.made_from
    )
    version.publish()
    return results


def _whole_reports(spark: SparkSession, config: BatchConfig, scratch: str) -> list[Report]:
    """The reports from the whole processed log.  The folded tables and the sales per day, which several reports share, are
    written to scratch."""

    def folded(entity: Entity) -> DataFrame:
        current = load_current(spark, entity, config.processed_root, config.keys.get(entity.name, entity.key))
        return materialize(current, f"{scratch}/{entity.name}")

    state = dict(zip(ENTITIES, at_once([partial(folded, e) for e in ENTITIES.values()], config.writers)))
    customers, orders, items = (state[e.name] for e in (CUSTOMERS, ORDERS, ORDER_ITEMS))
    profiles = [
        change_log_profile(read_processed(spark, config.processed_root, e), e.name, config.keys.get(e.name, e.key))
        for e in ENTITIES.values()
    ]
    sales = sales_reports.order_sales(orders, items, config.exclude_status)
    days = materialize(sales_reports.day_totals(sales), f"{scratch}/days")
    reports = [
        Report("change_log_profile", reduce(DataFrame.unionByName, profiles), True, PROFILE_ORDER),
        *_period_reports(days),
        Report("sales_by_status", sales_reports.sales_by_status(orders), True, ("status",)),
        Report("customer_cohorts", customer_reports.customer_cohorts(customers, orders, config.exclude_status), True, COHORT_ORDER),
        Report("customer_rfm", customer_reports.customer_rfm(customers, orders, config.rfm_rules), False),
        Report("product_performance", product_reports.product_performance(items, ordered=False), False),
        Report("product_affinity", product_reports.product_affinity(items), False),
    ]
    return reports + (_audits(state) if config.audit else [])


def _kept_reports(kept: KeptState, config: BatchConfig) -> list[Report]:
    """The same reports from the kept sums; only customers' scores and the audits read folded tables."""
    profile = reduce(DataFrame.unionByName, (kept.profile(entity) for entity in ENTITIES.values()))
    of_log = [f"{part}-{name}" for name in ENTITIES for part in ("operations", "versions")]
    state = {name: kept.current(entity) for name, entity in ENTITIES.items()}
    scores = customer_reports.customer_rfm(state[CUSTOMERS.name], state[ORDERS.name], config.rfm_rules)
    reports = [
        Report("customer_rfm", scores, False, (), f"{config.rfm_rules}:{kept.made_from(CUSTOMERS, ORDERS)}"),
        Report("product_affinity", kept.pairs(), False, (), kept.made_from("pairs")),
        Report("change_log_profile", profile, True, PROFILE_ORDER, kept.made_from(*of_log)),
        *_period_reports(deltas.day_table(kept.sums("days")), kept.made_from("days")),
        Report("sales_by_status", deltas.status_table(kept.sums("statuses")), True, ("status",), kept.made_from("statuses")),
        Report("customer_cohorts", deltas.cohort_table(kept.sums("cohorts")), True, COHORT_ORDER, kept.made_from("cohorts")),
        Report("product_performance", deltas.product_table(kept.sums("products")), False, (), kept.made_from("products")),
    ]
    return reports + (_audits(state, kept.made_from) if config.audit else [])


def _period_reports(days: DataFrame, made_from: str | None = None) -> list[Report]:
    tables = sales_reports.periods_of(days)
    return [Report(name, tables[name], True, order, made_from) for name, order in PERIOD_ORDER.items()]


def _audits(state: Mapping[str, DataFrame], made_from: Callable[..., str | None] = lambda *entities: None) -> list[Report]:
    constraints = [quality.audit_constraints(state[name], entity) for name, entity in ENTITIES.items()]
    keys = [quality.audit_uniqueness(state[name], name, entity.key) for name, entity in ENTITIES.items()]
    keys.append(quality.audit_uniqueness(state[CUSTOMERS.name], CUSTOMERS.name, ["email"]))
    relations = [
        quality.audit_foreign_key(state[child], state[parent], child, column, parent, key)
        for child, column, parent, key in FOREIGN_KEYS
    ]
    totals = quality.audit_order_totals(state[ORDERS.name], state[ORDER_ITEMS.name])
    everything = made_from(*ENTITIES.values())
    return [
        Report("audit_constraints", reduce(DataFrame.unionByName, constraints), True, (), everything),
        Report("audit_uniqueness", reduce(DataFrame.unionByName, keys), True, (), everything),
        Report("audit_foreign_keys", reduce(DataFrame.unionByName, relations), True, (), everything),
        Report("audit_order_totals", totals, False, (), made_from(ORDERS, ORDER_ITEMS)),
    ]
