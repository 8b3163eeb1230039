"""What the operators share: the shared folder, written tables, text columns and size-checked broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# A table of at most this many rows is broadcast; the callers join narrow rows only, so this is a
# few dozen MB at most.
BROADCAST_ROWS = 200_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else below the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or spark.conf.get("spark.sql.warehouse.dir") + "/shared").rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends there and survives lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, a cheap table of narrow rows, marked for broadcast if it has at most ``most`` rows.

    A larger one is left as it is, so that Spark shuffles the join and splits its skewed keys.
    """
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; ``lower`` alone would also change other alphabets."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def unused(columns: list[str], name: str) -> str:
    """``name``, with underscores before it as long as a column has that name."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def column(name: str) -> Column:
    """A column by its plain name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(columns: list[str]) -> Column:
    """All of ``columns`` as one struct: so carried, no name of theirs meets a name that an operator uses inside."""
    return F.struct(*(column(c) for c in columns))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
