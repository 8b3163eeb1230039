"""Shards along a Hilbert curve: documents in the order of a curve through several metadata dimensions, cut into runs.

Each dimension is quantised to ``2 ** BITS`` cells: strings by the share of rows whose value comes before (so a source with a
third of all rows takes a third of the cells), sizes by octave, ids linearly between the smallest and the largest.  Documents are
sorted by the place of their cell on the curve and by id inside a cell, and the order is cut into runs, by number of rows or by bytes.
A run is a compact region, so the least and greatest value of each dimension per shard tell a reader of a few dimensions which
shards it can leave out.

The sort is one range exchange whose last key numbers the rows, so equal documents spread as well; ranks
come from counts per range, which is one row per task.

Defined results: a null text has no bytes and the checksum of no bytes (0); nulls of a dimension come after all values
(an id: before) and are shown by the manifest as a count; equal documents are neighbours and each has a slot of its own; an empty
table gives no rows and no shards; columns other than ``doc_id, text, lang, source`` are not read by ``place``.  ``write_shards`` keeps
every column of the documents whatever its name and finds another name for the folder column if theirs has it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakefold.llm.common import broadcast_if_small, column, unused, whole_row, written
from lakefold.llm.hilbert import curve_index

BITS = 4
# What a document counts for besides its text.
ROW_BYTES = 16
BY_ROWS = "rows"
BY_BYTES = "bytes"
# Sizes start at the octave of an empty text.
LEAST_OCTAVE = ROW_BYTES.bit_length()
# The dimensions of the curve, and what the manifest keeps the least and greatest value of.
DIMENSIONS = ("lang", "source", "size", "doc_id")
# ``monotonically_increasing_id`` counts the rows of a partition in the bits below the partition's number.
ROW_BITS = 33


def with_places(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` in ``order`` as a written table, with ``part`` (a range of the order) and ``nth`` (from 0 inside it)."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(ranged.withColumn("place", F.monotonically_increasing_id()), name)
    return placed.withColumns({
        "part": F.shiftright("place", ROW_BITS), "nth": F.col("place").bitwiseAND(F.lit((1 << ROW_BITS) - 1)),
    }).drop("place")


def before_parts(placed: DataFrame, **sums: Column) -> DataFrame:
    """Per ``part``, the ``sums`` over all earlier parts.  The window sees one row per part."""
    parts = placed.groupBy("part").agg(*(v.alias(k) for k, v in sums.items()))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(
        "part", *(F.coalesce(F.sum(k).over(earlier), F.lit(0)).cast("long").alias(k) for k in sums)
    )


def string_cells(measured: DataFrame, name: str, n: int, bits: int) -> DataFrame:
    """``value, cell`` of the distinct strings of a dimension: the share of rows with an earlier value."""
    counted = measured.groupBy(F.col(name).alias("value")).agg(F.count("*").alias("rows"))
    placed = with_places(counted, [F.col("value").asc_nulls_last()], f"values-{name}")
    inside = Window.partitionBy("part").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("rows").over(inside), F.lit(0)) + F.col("earlier")
    starts = before_parts(placed, earlier=F.sum("rows"))
    return placed.join(F.broadcast(starts), "part").select(
        "value", F.floor(before * (1 << bits) / n).cast("int").alias("cell")
    )


def measured(docs: DataFrame, kept: Column) -> DataFrame:
    """``kept`` as ``row`` with the metadata dimensions, the checksum of the text and a number for each row."""
    text = F.col("text")
    return docs.select(
        kept.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.monotonically_increasing_id().alias("number"),
    )


def along_curve(rows: DataFrame, shards: int, law: str, bits: int = BITS) -> DataFrame:
    """``rows`` (a written ``measured`` table) with ``curve, law, shard, slot, grown_shard``."""
    if law not in (BY_ROWS, BY_BYTES):
        raise ValueError(f"unknown law of shards: {law}")
    n, low, high, all_bytes = rows.agg(F.count("*"), F.min("doc_id"), F.max("doc_id"), F.sum("size")).first()
    top = (1 << bits) - 1
    celled = rows
    for name in ("lang", "source"):
        cells = string_cells(rows, name, max(n, 1), bits).select(
            F.col("value").alias(f"{name}_value"), F.col("cell").alias(f"{name}_cell")
        )
        cells = broadcast_if_small(written(cells, f"cells-{name}"))
        celled = celled.join(cells, F.col(name).eqNullSafe(F.col(f"{name}_value"))).drop(f"{name}_value")
    octave = F.length(F.bin("size")) - LEAST_OCTAVE
    low, high = float(low or 0), float(high or 0)
    share = (F.col("doc_id").cast("double") - low) / (high - low + 1.0) * (top + 1)
    cells = [
        F.col("lang_cell"), F.col("source_cell"), F.greatest(F.lit(0), F.least(octave, F.lit(top))),
        F.coalesce(F.least(F.floor(share).cast("int"), F.lit(top)), F.lit(0)),
    ]
    placed = with_places(
        celled.withColumn("curve", curve_index(cells, bits)).drop("lang_cell", "source_cell"),
        [F.col(c).asc_nulls_first() for c in ("curve", "doc_id", "text_crc32", "size", "number")], "curve",
    )
    starts = F.broadcast(before_parts(placed, rows_before=F.count("*"), bytes_before=F.sum("size")))
    ranked = placed.join(starts, "part").withColumn("rank", F.col("rows_before") + F.col("nth"))
    if law == BY_ROWS:
        shard = F.expr(f"rank * {shards} div {max(n, 1)}")
        first = F.expr(f"(shard * {n} + {shards - 1}) div {shards}")
        cut = ranked.withColumn("shard", shard)
    else:
        inside = Window.partitionBy("part").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
        start = F.col("bytes_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
        # A document belongs to the shard in which its middle byte lies.
        middle = start.cast("decimal(38,0)") + F.expr("size div 2")
        ranked = ranked.withColumn("shard", F.floor(middle * shards / F.lit(max(all_bytes or 1, 1))).cast("long"))
        firsts = written(ranked.groupBy("shard").agg(F.min("rank").alias("first_rank")), "first-ranks")
        cut = ranked.join(F.broadcast(firsts), "shard")  # one row per shard
        first = F.col("first_rank")
    return cut.select(
        "row", "doc_id", "lang", "source", "size", "text_crc32", "curve", F.lit(law).alias("law"),
        F.col("shard").cast("int").alias("shard"), (F.col("rank") - first).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def place(docs: DataFrame, shards: int = 40, law: str = BY_ROWS, bits: int = BITS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, curve``, one row per document."""
    rows = written(measured(docs, F.lit(None).cast("int")).drop("row"), "measured")
    return along_curve(rows.withColumn("row", F.lit(None).cast("int")), shards, law, bits).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "curve"
    )


def shard_manifest(placed: DataFrame) -> DataFrame:
    """Per shard its rows, bytes, place on the curve and, per dimension, least and greatest value and number of nulls."""
    bounds = [
        part for c in DIMENSIONS for part in (
            F.min(c).alias(f"least_{c}"), F.max(c).alias(f"greatest_{c}"), F.count_if(F.col(c).isNull()).alias(f"null_{c}"))
    ]
    return placed.groupBy("shard").agg(
        F.count("*").alias("rows"), F.sum("size").alias("bytes"), F.min("curve").alias("first_curve"),
        F.max("curve").alias("last_curve"), *bounds,
    )


def write_shards(docs: DataFrame, path: str, shards: int = 40, law: str = BY_BYTES, bits: int = BITS) -> None:
    """Write whole documents below ``path/shards``, a folder per shard in slot order, and the manifest beside them."""
    rows = written(measured(docs, whole_row(docs.columns)), "measured")
    placed = written(along_curve(rows, shards, law, bits), "placed")
    folder = unused(docs.columns, "shard")
    (
        placed.sortWithinPartitions("shard", "slot").select("row.*", F.col("shard").alias(folder))
        .write.partitionBy(folder).parquet(f"{path}/shards")
    )
    shard_manifest(placed).coalesce(1).write.parquet(f"{path}/manifest")


def shards_to_read(manifest: DataFrame, wanted: Mapping[str, tuple]) -> DataFrame:
    """The shards that may hold a document with every dimension of ``wanted`` between its two values (None: open)."""
    keep = F.lit(True)
    for name, (low, high) in wanted.items():
        if name not in DIMENSIONS:
            raise ValueError(f"the manifest has no bounds of {name}")
        keep &= F.lit(True) if low is None else F.col(f"greatest_{name}") >= low
        keep &= F.lit(True) if high is None else F.col(f"least_{name}") <= high
    return manifest.where(keep).select("shard")


def read_shards(spark: SparkSession, path: str, wanted: Mapping[str, tuple]) -> DataFrame:
    """The documents with ``doc_id``, ``lang`` or ``source`` in the given ranges; opens only the shards that may hold some."""
    shards = [r[0] for r in shards_to_read(spark.read.parquet(f"{path}/manifest"), wanted).collect()]  # one number a shard
    docs = spark.read.parquet(f"{path}/shards")
    folder = docs.columns[-1]
    docs = docs.where(column(folder).isin(shards)).drop(folder)
    for name, (low, high) in wanted.items():
        value = F.octet_length("text") + ROW_BYTES if name == "size" else column(name)
        docs = docs if low is None else docs.where(value >= low)
        docs = docs if high is None else docs.where(value <= high)
    return docs

