"""Mixing sources to target weights: repeat or thin each source until its words meet a target.

Words are summed per source, a target per source follows from its weight, and the repetition rate of a
source is target / words.  A document is emitted ``floor(rate)`` times, and once more if a number drawn
from the hash of its id is below the fraction of the rate.

Defined results: a null text has no words; null is a source of its own, after all others; a null doc_id
draws like the text "null"; repeated rows draw alike; an empty table gives an empty mix; sources
without words get target 0 and rate 0.  Only the named columns are read; other columns of the documents pass
through ``mix`` untouched, whatever their names; only one named ``copy`` is replaced by the column that it adds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakefold.llm.common import broadcast_if_small, whole_row, written

# Weights of the sources in code-point order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
MOST_REPEATS = 3
WORD = r"[^\x20\x09-\x0D]+"
DRAW_RANGE = 2**32


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column) -> Column:
    """A number in [0, 1) from the hash of the id: the same on every run, in every partitioning."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(DRAW_RANGE))


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_repeats: int = MOST_REPEATS
) -> DataFrame:
    """``source, source_size, target`` from ``source, size``.

    Sources share all words by weight; a target stops at ``most_repeats`` times the source's words and what is
    above goes to the others by weight until none is above.  That is a water level: with the sources in order
    of words per weight, the first ones are full, and the level is what is left over divided by the weights left.
    The windows run over one row per source, never over documents.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1
    )
    fullest = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fullest.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    full_size = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most_repeats
    full_weight = F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levelled = (
        sources.withColumn("weight", weight)
        .withColumn(
            "level",
            (F.sum("source_size").over(everything) - full_size)
            / (F.sum("weight").over(everything) - full_weight),
        )
        .withColumn("open", F.col("level") * F.col("weight") <= F.col("source_size") * most_repeats)
        # The level of the first source that it does not fill holds for all after it.
        .withColumn("level", F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
            fullest.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )
    cap = (F.col("source_size") * most_repeats).cast("double")
    return levelled.select(
        "source",
        F.col("source_size").cast("long").alias("source_size"),
        F.least(cap, F.coalesce(F.col("level") * F.col("weight"), cap)).alias("target"),
    )


def repeats(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """``docs`` (with ``doc_id, source``) with ``source_size, target`` and the number of ``copies``."""
    wanted = targets.select(F.col("source").alias("_source"), "source_size", "target")
    joined = docs.join(wanted, docs["source"].eqNullSafe(F.col("_source"))).drop("_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate)
    return joined.withColumn(
        "copies", (whole + (draw(F.col("doc_id")) < rate - whole).cast("long")).cast("long")
    )


def plan(docs: DataFrame, weights=WEIGHTS, most_repeats=MOST_REPEATS) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies``, one row per document."""
    sizes = written(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mixing-sizes"
    )
    targets = written(source_targets(sizes, weights, most_repeats), "mixing-targets")
    return repeats(sizes, broadcast_if_small(targets))


def mix(docs: DataFrame, weights=WEIGHTS, most_repeats=MOST_REPEATS) -> DataFrame:
    """The mixed documents themselves, each as often as it is taken, numbered by ``copy`` from 1."""
    sizes = docs.select("source", word_count(F.col("text")).alias("size"))
    targets = written(source_targets(sizes, weights, most_repeats), "mixing-targets")
    columns = [c for c in docs.columns if c.lower() != "copy"]
    rows = docs.select("doc_id", "source", whole_row(columns).alias("row"))
    return (
        repeats(rows, broadcast_if_small(targets))
        .where("copies > 0")
        .select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
        .select(*(F.col("row").getField(c).alias(c) for c in columns), "copy")
    )
