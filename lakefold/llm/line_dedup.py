"""Line deduplication over levelled sorted runs of line hashes.

The store keeps runs of ``key, first_doc``: tables bucketed and sorted by key, in levels.  A batch of lines is
reduced to its keys, merge-anti-joined with every run (no run is shuffled or sorted again), and what is new becomes a run of
level 0.  When a level holds ``fanout`` runs they are merged into one run of the next level, so there are few runs
and a key is rewritten once per level.  Batches must come in order of document id: then the first document to
hold a key is the smallest.

Defined results: null or empty text is one empty line; null doc_ids count as one document after all others; repeated
rows of one document lose the same lines, and never each other's; an empty table gives an empty result; other columns pass
through, whatever their names, but ``n_lines`` and ``n_dropped`` are replaced if they exist.  Runs are entered in the session's catalog
only as long as they are in use; their files stay in the shared folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakefold.llm.common import ascii_lower, new_folder, whole_row

SPACE = "\t\n\x0b\x0c\r "
LEAST_LENGTH = 10
FANOUT = 3
# Documents are loaded in this many ranges of ids of about equal size.
BATCHES = 4
LAST_ID = 2**63 - 1


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column, least_length: int = LEAST_LENGTH) -> Column:
    """128-bit hash of the stripped, lower-cased line; null if it is too short to be compared."""
    stripped = F.btrim(line, F.lit(SPACE))
    return F.when(F.length(stripped) >= least_length, F.unhex(F.md5(ascii_lower(stripped))))


class LineRuns:
    """Levelled sorted runs of ``key, first_doc`` in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}

    def tables(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def keys(self) -> DataFrame:
        """All keys with their first document, each once; read without the buckets, so that a join can split a frequent key."""
        first, *others = (
            self.spark.read.schema("key binary, first_doc long").parquet(self.paths[name]) for level in self.levels for name in level
        )
        for other in others:
            first = first.unionByName(other)
        return first

    def admit(self, lines: DataFrame) -> None:
        """Add the keys of a batch (``key, doc``) that no run has yet."""
        fresh = lines.groupBy("key").agg(F.min("doc").alias("first_doc"))
        for run in self.tables():
            fresh = fresh.join(run.hint("merge"), "key", "left_anti")
        self._place(fresh, 0)

    def _place(self, keys: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        self.paths[name] = new_folder(self.spark, name)
        (
            keys.repartition(self.buckets, "key").write.bucketBy(self.buckets, "key").sortBy("key")
            .option("path", self.paths[name]).saveAsTable(name)
        )
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fanout:
            full, self.levels[level] = self.levels[level], []
            merged = self.spark.table(full[0])
            for other in full[1:]:
                merged = merged.unionByName(self.spark.table(other))
            self._place(merged, level + 1)
            self._forget(full)

    def _forget(self, names: list[str]) -> None:
        # The tables have paths of their own, so only their entries go.
        for name in names:
            self.spark.sql(f"drop table if exists {name}")

    def close(self) -> None:
        """Take all runs out of the catalog; ``keys`` reads their files and still works."""
        self._forget([name for level in self.levels for name in level])


def _identified(docs: DataFrame, *more: Column) -> DataFrame:
    # Rows of one doc_id with different texts are kept apart by a hash of the text.
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("_doc"), F.xxhash64("text").alias("_text"), *more)


def line_flags(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT,
               least_length: int = LEAST_LENGTH) -> DataFrame:
    """``_doc, _text, flags``: for each document, in order of lines, whether the line is dropped."""
    spark = docs.sparkSession
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"))
    shares = [i / batches for i in range(1, batches)]
    bounds = (ids.agg(F.percentile_approx("id", shares).alias("at")).first()["at"] or []) if shares else []
    batch = F.lit(0)
    for bound in sorted(set(bounds)):
        batch = batch + (F.col("doc") > bound).cast("int")
    # The outer form of explode: the plain one adds a filter that would split each text twice.
    lines = (
        _identified(docs, F.col("text"))
        .select(F.col("_doc").alias("doc"), F.col("_text").alias("text_hash"),
                F.posexplode_outer(split_lines(F.col("text"))).alias("place", "line"))
        .select("doc", F.col("text_hash").alias("text"), "place", line_key(F.col("line"), least_length).alias("key"))
    )
    path = new_folder(spark, "lines")
    lines.withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(lines.schema.add("batch", "integer")).parquet(path)
    runs = LineRuns(spark, fanout)
    for number in range(len(set(bounds)) + 1):
        runs.admit(lines.where((F.col("batch") == number) & F.col("key").isNotNull()))
    runs.close()
    judged = lines.where("key is not null").join(runs.keys(), "key").select(
        "doc", "text", "place", (F.col("first_doc") < F.col("doc")).alias("drop")
    )
    short = lines.where("key is null").select("doc", "text", "place", F.lit(False).alias("drop"))
    return (
        judged.unionByName(short)
        .groupBy(F.col("doc").alias("_doc"), F.col("text").alias("_text"))
        .agg(F.array_sort(F.collect_set(F.struct("place", "drop"))).getField("drop").alias("flags"))
    )


def dedup_lines(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT,
                least_length: int = LEAST_LENGTH) -> DataFrame:
    """``docs`` with ``text`` without its dropped lines, and ``n_lines`` and ``n_dropped``."""
    flags = line_flags(docs, batches, fanout, least_length)
    kept = F.array_join(
        F.zip_with(split_lines(F.col("_row.text")), F.col("flags"),
                   lambda line, drop: F.when(~drop, line)), "\n"
    )
    columns = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    return (
        _identified(docs, whole_row(columns).alias("_row"))
        .join(flags, ["_doc", "_text"])
        .select(
            *(kept.alias(c) if c == "text" else F.col("_row").getField(c).alias(c) for c in columns),
            F.size("flags").cast("long").alias("n_lines"),
            F.size(F.filter("flags", lambda drop: drop)).cast("long").alias("n_dropped"),
        )
    )
