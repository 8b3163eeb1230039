"""Near-duplicates among embeddings by binary codes of randomly rotated vectors.

A unit vector is rotated by a random orthogonal matrix; the signs of its coordinates are its code, and the inner
product of the code with the rotated vector is the stored correction factor.  The inner product of a code with another
rotated vector, divided by the factor, is an unbiased estimate of the cosine, with an error that falls with the root of
the dimension.  Only pairs whose upper confidence bound reaches the threshold are computed exactly, in double precision.

Pairs are met in buckets: vectors that agree in ``k`` sign bits of further rotations.  ``k`` grows with the logarithm of the number of
vectors, and the number of bucket tables follows from the wanted recall at the threshold (pairs above it are found more surely).
A pair is counted in the first table where it meets.  Equal vectors are one vector with a multiplicity; large
buckets are cut into blocks, and block pairs are compared apart, so no task sees more than two blocks.  A task returns counts
of links and, instead of the links, a star over what it found connected.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and vectors without an id, link
with nothing; vectors of different lengths do not link; equal rows are separate vectors that link; rows sharing a vec_id
with different vectors share links and component; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakefold.llm.common import broadcast_if_small, written
from lakefold.llm.components import connected

THRESHOLD = 0.9
RECALL = 0.995
BUCKET = 256
BLOCK = 1024
CONFIDENCE = 4.0  # standard errors of an estimate
SEED = 20240607
LINK_COLUMNS = "vec_id long, n long, other long"


def bucket_plan(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """Bits per bucket and number of tables for ``n`` vectors."""
    bits = max(1, math.ceil(math.log2(max(n, 2) / BUCKET)))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def rotation(dim: int, number: int) -> np.ndarray:
    """The ``number``-th random orthogonal matrix of a dimension."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, dim, number]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def encode(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signs of the rotated vectors (true: positive) and correction factors."""
    rotated = units @ rotation(units.shape[1], 0).T
    return rotated > 0, np.abs(rotated).sum(axis=1) / math.sqrt(units.shape[1])


def bucket_keys(units: np.ndarray, bits: int, tables: int) -> np.ndarray:
    dim, wanted = units.shape[1], bits * tables
    planes = np.concatenate([rotation(dim, 1 + i) for i in range(-(-wanted // dim))])[:wanted]
    signs = (units @ planes.T > 0).reshape(len(units), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def upper_bounds(signs: np.ndarray, factors: np.ndarray, rotated: np.ndarray, confidence: float) -> np.ndarray:
    """Upper confidence bounds of the cosines of coded vectors (rows) with rotated ones (columns)."""
    dim = signs.shape[1]
    estimate = (np.where(signs, np.float32(1), np.float32(-1)) @ rotated.T.astype(np.float32)) / np.float32(math.sqrt(dim))
    factor = factors[:, None].astype(np.float32)
    spread = confidence * np.sqrt(np.maximum(1 - factor**2, 0)) / math.sqrt(max(dim - 1, 1))
    return (estimate + spread) / factor


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64)


def _unpacked(column: pa.ChunkedArray, dtype) -> np.ndarray:
    rows = column.combine_chunks().to_pylist()
    return np.frombuffer(b"".join(rows), dtype).reshape(len(rows), -1)


def _linked(ids, weight, signs, factors, vectors, keys, table, left, right, threshold, confidence):
    """Counts and stars of the links between two lists of row numbers (or within one, if they are the same)."""
    units = unit(vectors)
    rotated = units @ rotation(units.shape[1], 0).T
    within = left is right
    n = len(ids)
    links = np.zeros((n, n), bool)
    one, two = np.nonzero(upper_bounds(signs[left], factors[left], rotated[right], confidence) >= threshold)
    one, two = left[one], right[two]
    keep = ids[one] != ids[two]
    if within:
        keep &= one < two
    one, two = one[keep], two[keep]
    for i in range(0, len(one), 1 << 16):
        a, b = one[i : i + (1 << 16)], two[i : i + (1 << 16)]
        exact = np.einsum("ij,ij->i", units[a], units[b]) >= threshold
        exact &= ~(keys[a, :table] == keys[b, :table]).any(axis=1)  # met before
        links[a[exact], b[exact]] = True
    links |= links.T
    touched = np.flatnonzero(links.any(axis=1))
    counts = links[touched] @ weight
    star = np.full(n, -1)
    for i in touched[np.argsort(ids[touched], kind="stable")]:
        if star[i] < 0:
            front = np.array([i])
            star[i] = i
            while len(front):
                front = np.flatnonzero(links[front].any(axis=0) & (star < 0))
                star[front] = i
    return ids[touched], counts, ids[star[touched]]


def link_parts(rows: DataFrame, n: int, threshold: float, recall: float, confidence: float) -> DataFrame:
    """``vec_id, n, other``: partial numbers of links of distinct vectors, each with a vector that it is connected to."""
    bits, tables = bucket_plan(n, threshold, recall)

    def code(batches):
        for batch in batches:
            if not len(batch):
                continue
            lengths = np.array([len(v) for v in batch.column("vector").to_pylist()])
            for dim in np.unique(lengths):
                part = batch.take(pa.array(np.flatnonzero(lengths == dim)))
                vectors = _matrix(part.column("vector"))
                units = unit(vectors)
                signs, factors = encode(units)
                keys = bucket_keys(units, bits, tables)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("weight"), pa.array([int(dim)] * len(part), pa.int32()),
                     pa.array([x.tobytes() for x in np.packbits(signs, axis=1)], pa.binary()), pa.array(factors),
                     pa.array([x.tobytes() for x in vectors], pa.binary()),
                     pa.array(keys.astype(np.int32).tolist(), pa.list_(pa.int32()))],
                    ["vec_id", "weight", "dim", "code", "factor", "vector", "keys"],
                )

    coded = written(rows.mapInArrow(
        code, "vec_id long, weight long, dim int, code binary, factor double, vector binary, keys array<int>"
    ), "codes")
    met = coded.select("*", F.posexplode("keys").alias("bucket_table", "bucket"))
    place = ["dim", "bucket_table", "bucket"]
    blocks = met.groupBy(*place).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n_blocks"))
    own = F.pmod(F.xxhash64("vec_id"), F.col("n_blocks")).cast("int")
    paired = (
        met.join(broadcast_if_small(written(blocks, "buckets")), place).withColumn("own", own)
        .withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .withColumns({"low": F.least("own", "mate"), "high": F.greatest("own", "mate")})
        .drop("n_blocks", "mate")
    )

    def compare(key, group):
        table, low, high = key[1].as_py(), key[3].as_py(), key[4].as_py()
        own = group.column("own").to_numpy()
        dim = key[0].as_py()
        left = np.flatnonzero(own == low)
        ids, counts, stars = _linked(
            group.column("vec_id").to_numpy(), group.column("weight").to_numpy(),
            np.unpackbits(_unpacked(group.column("code"), np.uint8), axis=1)[:, :dim].astype(bool),
            group.column("factor").to_numpy(), _unpacked(group.column("vector"), np.float64),
            np.array(group.column("keys").to_pylist(), np.int32), table,
            left, left if low == high else np.flatnonzero(own == high), threshold, confidence,
        )
        return pa.table({"vec_id": pa.array(ids, pa.int64()), "n": pa.array(counts, pa.int64()),
                         "other": pa.array(stars, pa.int64())})

    return paired.groupBy(*place, "low", "high").applyInArrow(compare, LINK_COLUMNS)


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL,
                    confidence: float = CONFIDENCE) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row per row of ``embeddings`` (``vec_id, embedding``)."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    fit = F.coalesce(F.col("vec_id").isNotNull() & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    # Equal vectors meet by 128 bits of hash; -0.0 is made 0.0 first.
    plain = F.transform("v", lambda x: x + F.lit(0.0))
    rows = rows.withColumn("fit", fit).withColumns({
        "h1": F.when(F.col("fit"), F.xxhash64(plain)), "h2": F.when(F.col("fit"), F.xxhash64(F.lit("second"), plain)),
    })
    classes = written(
        rows.where("fit").groupBy("h1", "h2").agg(
            F.min("vec_id").alias("vec_id"), F.count("*").alias("weight"), F.first("v").alias("vector")), "vectors")
    parts = written(
        link_parts(classes.select("vec_id", "weight", "vector"), classes.count(), threshold, recall, confidence), "link-parts")
    counts = parts.groupBy("vec_id").agg(F.sum("n").alias("n"))
    found = connected(parts.select(F.col("vec_id").alias("a"), F.col("other").alias("b")))
    judged = (
        classes.select("h1", "h2", F.col("vec_id").alias("first_id"), "weight")
        .join(counts, F.col("first_id") == counts["vec_id"], "left").drop("vec_id")
        .join(found, F.col("first_id") == F.col("node"), "left")
        .select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                F.coalesce("component", "first_id").alias("component_id"))
    )
    return rows.select("vec_id", "h1", "h2").join(judged, ["h1", "h2"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(False)).alias("kept"),
    )
