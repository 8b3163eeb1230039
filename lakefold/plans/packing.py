"""Pack finished micro-batches of the raw area, and their metrics, into few large files."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lakefold.entities import Entity
from lakefold.session import drop_folder
from lakefold.sources.lake import (
    BATCH_COLUMN,
    NO_BATCH,
    PACKED_COLUMN,
    _raw_area,
    append_pack,
    entity_metrics,
    loose_metrics,
    pack_path,
    packed_metrics_path,
    read_packs,
)

# Newest batches that stay as the stream has written them.
LEAVE = 10
# A pack is made of so many batches at least.
LEAST_BATCHES = 32


def pack_batches(
    spark: SparkSession, raw_root: str, metrics_root: str, entity: Entity, leave: int = LEAVE, least: int = LEAST_BATCHES
) -> int:
    """Pack the complete batches that no pack has, but for the newest ``leave``; returns their number, 0 if fewer than ``least``.

    Rows keep the number of their batch, so positions of readers stay valid, and lie in the order of it, so a reader of new batches skips
    the rest of a file.  Adaptive execution makes files of the advisory partition size.  The pack and its metrics are written first
    and come into force by one appended manifest row: readers see the batches or the pack, never both, and a run that
    dies leaves unused files only.  What a pack stands for is removed by the next one, when nobody reads it any more.
    """
    packs = read_packs(spark, metrics_root, entity.name)
    done = max((p["last_batch"] for p in packs), default=NO_BATCH)
    pending = entity_metrics(spark, metrics_root, entity.name).filter(F.col(BATCH_COLUMN) > done)
    newest = pending.agg(F.max(BATCH_COLUMN)).first()[0]
    if newest is None:
        return 0
    chosen = pending.filter(F.col(BATCH_COLUMN) <= newest - leave)
    first, last, n = chosen.agg(F.min(BATCH_COLUMN), F.max(BATCH_COLUMN), F.count("*")).first()
    if n < least:
        return 0
    folder = uuid.uuid4().hex
    rows = _raw_area(spark, raw_root, entity, metrics_root, done).filter(F.col(BATCH_COLUMN) <= last)
    (
        rows.withColumn(PACKED_COLUMN, F.col(BATCH_COLUMN)).drop(BATCH_COLUMN)
        .hint("rebalance", "is_rejected", "__op")
        .sortWithinPartitions("is_rejected", "__op", PACKED_COLUMN)
        .write.partitionBy("is_rejected", "__op").parquet(pack_path(raw_root, entity, folder))
    )
    chosen.coalesce(1).write.parquet(packed_metrics_path(metrics_root, folder))
    append_pack(spark, metrics_root, entity.name, first, last, folder)
    _remove_packed(spark, raw_root, metrics_root, entity, done)
    return n


def _remove_packed(spark: SparkSession, raw_root: str, metrics_root: str, entity: Entity, upto: int) -> None:
    """Remove the folders and metrics files of batches that packs before the newest one hold."""
    loose = loose_metrics(spark, metrics_root, entity.name)
    if loose is None or upto == NO_BATCH:
        return
    old = loose.filter(F.col(BATCH_COLUMN) <= upto).select(BATCH_COLUMN, F.input_file_name().alias("file"))
    for row in old.collect():  # the batches of one pack
        drop_folder(spark, f"{raw_root}/{entity.name}/{BATCH_COLUMN}={row[BATCH_COLUMN]}")
        drop_folder(spark, row["file"])
