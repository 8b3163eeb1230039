"""Command line for ``spark-submit``: ``ingest`` streams changes in, ``batch`` writes reports, ``pack`` tidies the raw area."""

from __future__ import annotations

import argparse

from lakefold.entities import ENTITIES
from lakefold.functions.scoring import REACHABLE_LADDER, RfmRules
from lakefold.plans.jobs import BatchConfig, run_batch, run_ingest
from lakefold.plans.packing import pack_batches
from lakefold.plans.processing import BY_ARRIVAL, BY_SOURCE_TIME, FULL
from lakefold.session import build_session
from lakefold.sources.events import FileEvents, KafkaEvents
from lakefold.streaming.ingest import IngestConfig


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="lakefold")
    jobs = parser.add_subparsers(dest="job", required=True)

    ingest = jobs.add_parser("ingest", help="stream change events into the raw area")
    source = ingest.add_mutually_exclusive_group(required=True)
    source.add_argument("--bootstrap-servers", help="Kafka brokers")
    source.add_argument("--events", help="folder with one sub-folder of messages per entity")
    ingest.add_argument("--lake", required=True)
    ingest.add_argument("--trigger-every", default="1 minute")
    ingest.add_argument("--once", action="store_true", help="take what is available and stop")
    ingest.add_argument("--dedupe-for", default="1 hour", help="empty: keep every delivery")
    ingest.add_argument("--starting-offsets", default="earliest", help="earliest, latest or JSON; first start only")
    ingest.add_argument("--topic", action="append", default=[], metavar="ENTITY=TOPIC")
    ingest.add_argument("--max-per-batch", type=int, help="events (Kafka) or files of a micro-batch")

    batch = jobs.add_parser("batch", help="process new changes and write all result tables")
    batch.add_argument("--lake", required=True)
    batch.add_argument(
        "--follow", choices=(BY_ARRIVAL, BY_SOURCE_TIME, FULL), default=BY_ARRIVAL
    )
    batch.add_argument("--exclude-status")
    batch.add_argument("--no-audit", action="store_true")
    batch.add_argument("--results", help="root of the result tables; the lake if not given")
    batch.add_argument("--fold-key", action="append", default=[], metavar="ENTITY=COLUMN,COLUMN")
    batch.add_argument("--ladder", choices=("default", "reachable"), default="default")
    batch.add_argument("--no-state", action="store_true", help="fold the whole log instead of a kept state")
    batch.add_argument("--state-buckets", type=int, default=16, help="about the bytes of the largest table by 128 MB; kept for good")
    pack = jobs.add_parser("pack", help="pack finished micro-batches of the raw area into large files")
    pack.add_argument("--lake", required=True)
    for job in (ingest, batch, pack):
        job.add_argument(
            "--partitions", type=int,
            help="shuffle partitions, about the shuffled bytes by 128 MB; a stream keeps those of its first start",
        )
    return parser.parse_args(arguments)


def _named_values(pairs: list[str]) -> dict[str, str]:
    """``ENTITY=VALUE`` arguments as a dictionary."""
    values = dict(pair.split("=", 1) for pair in pairs)
    unknown = set(values) - set(ENTITIES)
    if unknown:
        raise ValueError(f"no such entity: {', '.join(sorted(unknown))}")
    return values


def ingest_config(options: argparse.Namespace) -> IngestConfig:
    if options.events:
        bound = {} if options.max_per_batch is None else {"max_files_per_batch": options.max_per_batch}
        source = FileEvents(options.events, **bound)
    else:
        bound = {} if options.max_per_batch is None else {"max_events_per_batch": options.max_per_batch}
        source = KafkaEvents(
            options.bootstrap_servers, options.starting_offsets, topics=_named_values(options.topic), **bound
        )
    return IngestConfig(
        source=source,
        raw_root=f"{options.lake}/raw",
        checkpoint_root=f"{options.lake}/stream-checkpoints",
        metrics_root=f"{options.lake}/metrics",
        dedupe_for=options.dedupe_for or None,
        trigger_every=None if options.once else options.trigger_every,
    )


def batch_config(options: argparse.Namespace) -> BatchConfig:
    return BatchConfig(
        raw_root=f"{options.lake}/raw",
        processed_root=f"{options.lake}/processed",
        results_root=options.results or options.lake,
        positions=f"{options.lake}/checkpoints",
        state_root=f"{options.lake}/state",
        metrics_root=f"{options.lake}/metrics",
        follow=options.follow,
        exclude_status=options.exclude_status,
        audit=not options.no_audit,
        keep_state=not options.no_state,
        state_buckets=options.state_buckets,
        keys={name: tuple(columns.split(",")) for name, columns in _named_values(options.fold_key).items()},
        rfm_rules=RfmRules(ladder=REACHABLE_LADDER) if options.ladder == "reachable" else RfmRules(),
    )


def main(arguments: list[str] | None = None) -> None:
    options = parse(arguments)
    partitions = {"spark.sql.shuffle.partitions": str(options.partitions)} if options.partitions else {}
    spark = build_session(f"lakefold {options.job}", partitions)
    if options.job == "ingest":
        run_ingest(spark, ingest_config(options))
    elif options.job == "pack":
        for entity in ENTITIES.values():
            pack_batches(spark, f"{options.lake}/raw", f"{options.lake}/metrics", entity)
    else:
        run_batch(spark, batch_config(options))


if __name__ == "__main__":
    main()
