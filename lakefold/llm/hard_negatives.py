"""Hard negatives: for an anchor and one of its positives, the best rows of other labels inside a window of scores.

Candidates lie in Parquet blocks: rows of one label in the order of a Hilbert curve through the dimensions of
greatest spread, at most ``BLOCK_ROWS`` each, with the least and greatest value of every dimension (a zone map).
For an anchor ``a`` and a block with zone ``[low, high]``, interval arithmetic bounds every score of the block: the sum over
the dimensions of the smaller and of the larger of ``a * low`` and ``a * high``.  These bounds choose which blocks are read:

1. Positives: blocks of the anchor's label whose upper bound reaches a floor.  The floor is the score that enough rows are known to
   reach: of the anchor's neighbours in its own block, or of blocks by their lower bounds.
2. Negatives: blocks of other labels whose bounds meet one of the anchor's windows, and reach the floor of that window.

Anchors meet zone maps in tiles of ``PACK`` anchors and ``PACK`` blocks, and a block only the anchors that must read
it, so a task holds a few blocks and anchors at a time.  Each task reduces what it has found to the best few per window before it
sends anything on.  Zone maps and blocks are read from the shared folder again if an executor is lost.

Defined results: rows with a null id, label or vector, or with a null or non-finite component take no part, nor do
vectors of a quantised length of ``2 ** 27`` or more, as windows would not fit a long.  A shorter vector counts as padded by zeros.
Repeated rows are rows of their own: a copy of an anchor is an "other row", and both are anchors.  Equal scores are ordered by
vec_id.  An empty table gives no rows; columns other than ``vec_id, label, embedding`` are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakefold.llm.common import written
from lakefold.llm.hilbert import curve_places

BLOCK_ROWS = 1024
# Anchors of a pack and zone maps of a tile.
PACK = 256
CURVE_DIMS, CURVE_BITS = 6, 5
STEPS = 256  # a component x becomes floor(STEPS * x)
LONGEST = 2.0**27
NO_SCORE = np.iinfo(np.int64).min
# Findings that a task holds before it reduces them, and after that before it sends them on.
HELD_ROWS = 200_000

CANDIDATE = "label long, vec_id long, curve long, vector binary"
BLOCK = "block long, label long, n int, low binary, high binary, ids binary, vectors binary"
ANCHOR = "place long, anchor_id long, label long, vector binary, floor long"
FOUND = "place long, slot int, anchor_id long, found_id long, found_place long, score long"


def quantised(embeddings: DataFrame, steps: int = STEPS) -> DataFrame:
    """``vec_id, label, vector`` (integers) of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), x.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    length = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + (x * steps) * (x * steps))
    known = F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    fit = F.when(known & finite, length < LONGEST**2)
    return rows.where(F.coalesce(fit, F.lit(False))).select(
        "vec_id", "label", F.transform("v", lambda x: F.floor(x * steps).cast("long")).alias("vector")
    )


def _padded(vectors: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    """A list column as an integer matrix, short rows padded by zeros."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = np.diff(vectors.offsets.to_numpy())
    matrix = np.zeros((len(vectors), dims), np.int64)
    matrix[np.arange(dims) < lengths[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    return matrix


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Binary rows of 32-bit integers, one vector or many each, as one matrix."""
    return np.frombuffer(b"".join(x.as_py() for x in column), np.int32).reshape(-1, dims)


def spread(rows: DataFrame) -> list:
    """``dim, n, least, greatest, variance`` per dimension: sums per task, added up by dimension."""

    def part(batches):
        total = None
        for batch in batches:
            if not len(batch):
                continue
            width = max(np.diff(batch.column("vector").offsets.to_numpy()).max(), 0 if total is None else total.shape[1])
            values = _padded(batch.column("vector"), width).astype(float)
            now = np.stack([values.sum(0), (values * values).sum(0), values.min(0), values.max(0)])
            if total is None:
                total = now
                continue
            total = np.pad(total, ((0, 0), (0, width - total.shape[1])))
            total = np.stack([total[0] + now[0], total[1] + now[1], np.minimum(total[2], now[2]), np.maximum(total[3], now[3])])
        if total is not None:
            yield pa.RecordBatch.from_pydict({"dim": np.arange(total.shape[1], dtype=np.int32), "s": total[0], "q": total[1],
                                              "lo": total[2], "hi": total[3]})

    parts = rows.select("vector").mapInArrow(part, "dim int, s double, q double, lo double, hi double")
    return parts.groupBy("dim").agg(
        F.sum("s").alias("s"), F.sum("q").alias("q"), F.min("lo").alias("least"), F.max("hi").alias("greatest")
    ).orderBy("dim").collect()  # a row per dimension


def write_blocks(rows: DataFrame) -> tuple[DataFrame, int]:
    """The block table of ``quantised`` rows and its number of dimensions.

    Rows of a block are in the order of their ids, so that a stable sort by score breaks ties by id.
    """
    rows = written(rows, "candidates")
    n, bounds = rows.count(), spread(rows)
    dims = max(len(bounds), 1)
    variance = np.array([b.q / n - (b.s / n) ** 2 for b in bounds])
    chosen = np.argsort(-variance, kind="stable")[:CURVE_DIMS]
    least = np.array([bounds[i].least for i in chosen])
    width = np.array([bounds[i].greatest - bounds[i].least + 1 for i in chosen])

    def place(batches):
        for batch in batches:
            matrix = _padded(batch.column("vector"), dims)
            share = (matrix[:, chosen] - least) / width
            cells = np.clip((share * (1 << CURVE_BITS)).astype(np.int64), 0, (1 << CURVE_BITS) - 1)
            curve = curve_places(cells, CURVE_BITS) if len(chosen) else np.zeros(len(matrix), np.int64)
            vectors = [x.tobytes() for x in matrix.astype(np.int32)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("vec_id"), pa.array(curve), pa.array(vectors, pa.binary())],
                ["label", "vec_id", "curve", "vector"],
            )

    def pack(batches):
        number = (TaskContext.get().partitionId() << 32) if TaskContext.get() else 0
        label, ids, vectors = None, [], []

        def block():
            nonlocal number, ids, vectors
            order = np.argsort(np.array(ids, np.int64), kind="stable")
            matrix = np.stack([np.frombuffer(v, np.int32) for v in vectors])[order]
            row = {"block": [number], "label": [label], "n": pa.array([len(ids)], pa.int32()),
                   "low": [matrix.min(0).tobytes()], "high": [matrix.max(0).tobytes()],
                   "ids": [np.array(ids, np.int64)[order].tobytes()], "vectors": [matrix.tobytes()]}
            number, ids, vectors = number + 1, [], []
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            for here, vec_id, vector in zip(*(batch.column(c).to_pylist() for c in ("label", "vec_id", "vector"))):
                if ids and (here != label or len(ids) == BLOCK_ROWS):
                    yield block()
                label = here
                ids.append(vec_id)
                vectors.append(vector)
        if ids:
            yield block()

    coded = written(rows.mapInArrow(place, CANDIDATE), "candidates-coded")
    order = ["label", "curve", "vec_id"]
    ranged = coded.withColumn("number", F.monotonically_increasing_id()).repartitionByRange(*order, "number")
    return written(ranged.sortWithinPartitions(*order).drop("number").mapInArrow(pack, BLOCK), "blocks"), dims


def _scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows: in doubles where every sum stays below 2 ** 53."""
    if not len(left) or not len(right):
        return np.zeros((len(left), len(right)), np.int64)
    longest = [np.sqrt((m.astype(float) ** 2).sum(1).max()) for m in (left, right)]
    if longest[0] * longest[1] < 2.0**52:
        return (left.astype(float) @ right.astype(float).T).astype(np.int64)
    return left.astype(np.int64) @ right.astype(np.int64).T


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that rows of each zone can have with each anchor."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return _scores(up, low) + _scores(down, high), _scores(up, high) + _scores(down, low)


def floors(lower: np.ndarray, sizes: np.ndarray, usable: np.ndarray, enough: int) -> np.ndarray:
    """Per anchor, a score that at least ``enough`` rows of the usable blocks reach, by the blocks' lower bounds."""
    floor = np.full(len(lower), NO_SCORE)
    order = np.argsort(-lower, axis=1, kind="stable")
    counts = np.cumsum(np.take_along_axis(np.where(usable, sizes, 0), order, axis=1), axis=1)
    reached = counts >= enough
    rows = np.flatnonzero(reached.any(axis=1))
    first = reached[rows].argmax(axis=1)
    floor[rows] = np.take_along_axis(lower[rows], order[rows], axis=1)[np.arange(len(rows)), first]
    return floor


def _anchors(blocks: DataFrame, dims: int, every: int, positives: int) -> DataFrame:
    """The anchors, each with a score that ``positives`` other rows of its own block reach, if there are as many."""

    def pick(batches):
        for batch in batches:
            for i in range(len(batch)):
                block, label = batch.column("block")[i].as_py(), batch.column("label")[i].as_py()
                ids = np.frombuffer(batch.column("ids")[i].as_py(), np.int64)
                vectors = _matrix(batch.column("vectors").slice(i, 1), dims)
                chosen = np.flatnonzero(ids % every == 0)
                scores = _scores(vectors[chosen], vectors)
                scores[np.arange(len(chosen)), chosen] = NO_SCORE
                floor = np.full(len(chosen), NO_SCORE)
                if len(ids) > positives:
                    floor = -np.partition(-(scores + 1), positives - 1, axis=1)[:, positives - 1] - 1 if len(chosen) else floor
                yield pa.RecordBatch.from_pydict({
                    "place": pa.array(block * BLOCK_ROWS + chosen, pa.int64()), "anchor_id": pa.array(ids[chosen], pa.int64()),
                    "label": pa.array([label] * len(chosen), pa.int64()),
                    "vector": pa.array([v.tobytes() for v in vectors[chosen]], pa.binary()), "floor": pa.array(floor, pa.int64()),
                })

    return blocks.select("block", "label", "ids", "vectors").mapInArrow(pick, ANCHOR)


def _tiles(blocks: DataFrame, n_tiles: int) -> DataFrame:
    """Zone maps, ``PACK`` of neighbouring blocks in a row, spread over the tile numbers."""

    def pack(batches):
        yield from _packed(batches, ("block", "label", "n", "low", "high"))

    zones = blocks.select("block", "label", F.col("n").cast("long").alias("n"), "low", "high")
    tiles = zones.mapInArrow(pack, "block binary, label binary, n binary, low binary, high binary")
    return tiles.select("*", F.pmod(F.xxhash64("block"), n_tiles).alias("tile"))


def _packed(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """Rows of integers and binaries joined to one binary per column, ``PACK`` rows at a time."""

    def joined(rows):
        parts = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([b"".join(p) if isinstance(p[0], bytes) else np.array(p, np.int64).tobytes()], pa.binary()) for p in parts],
            list(columns))

    held = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns)):
            held.append(row)
            if len(held) == PACK:
                yield joined(held)
                held = []
    if held:
        yield joined(held)


def _reads(anchors: DataFrame, tiles: DataFrame, n_tiles: int, dims: int, extra: tuple[str, ...], choose: Callable) -> DataFrame:
    """Which anchors each block must be read for: packs of anchors meet every tile of zone maps.

    ``choose(pack, lower, upper, labels, sizes)`` says so as a matrix of anchors and blocks.
    """
    columns = ("place", "anchor_id", "label", "vector", *extra)

    def pack(batches):
        yield from _packed(batches, columns)

    def read(batches):
        for batch in batches:
            for i in range(len(batch)):
                packed = {c: np.frombuffer(batch.column(c)[i].as_py(), np.int64) for c in columns if c != "vector"}
                vectors = np.frombuffer(batch.column("vector")[i].as_py(), np.int32).reshape(-1, dims)
                tile = {c: np.frombuffer(batch.column(f"zone_{c}")[i].as_py(), np.int64) for c in ("block", "label", "n")}
                low, high = (np.frombuffer(batch.column(f"zone_{c}")[i].as_py(), np.int32).reshape(-1, dims) for c in ("low", "high"))
                lower, upper = bounds(vectors, low, high)
                wanted = choose(packed, lower, upper, tile["label"], tile["n"])
                hit = np.flatnonzero(wanted.any(axis=0))
                rows = [np.flatnonzero(wanted[:, b]) for b in hit]
                info = [np.stack([packed[c] for c in ("place", "anchor_id", *extra)], axis=1)[r] for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tile["block"][hit], pa.int64()), pa.array([x.tobytes() for x in info], pa.binary()),
                     pa.array([vectors[r].tobytes() for r in rows], pa.binary())], ["block", "info", "anchors"])

    packs = anchors.repartitionByRange("place").sortWithinPartitions("place").select(*columns).mapInArrow(
        pack, ", ".join(f"{c} binary" for c in columns))
    zones = tiles.select("tile", *(F.col(c).alias(f"zone_{c}") for c in ("block", "label", "n", "low", "high")))
    met = packs.withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_tiles - 1).cast("long")))).join(zones, "tile")
    return met.drop("tile").mapInArrow(read, "block long, info binary, anchors binary")


def _best(found: np.ndarray, keep: int) -> np.ndarray:
    """Of rows ``place, slot, anchor_id, found_id, found_place, score`` the best ``keep`` per place and slot."""
    found = found[np.lexsort((found[:, 4], found[:, 3], -found[:, 5], found[:, 1], found[:, 0]))]
    start = np.ones(len(found), bool)
    start[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    first = np.flatnonzero(start)
    return found[np.arange(len(found)) - first[np.cumsum(start) - 1] < keep]


def _found(reads: DataFrame, blocks: DataFrame, dims: int, extra: int, keep: int, search: Callable) -> DataFrame:
    """Read the chosen blocks; ``search(info, scores, ids)`` gives rows of an anchor, slot and row of the block."""

    def batch_of(found):
        return pa.RecordBatch.from_arrays(
            [pa.array(found[:, i].astype(np.int32) if i == 1 else found[:, i]) for i in range(6)],
            ["place", "slot", "anchor_id", "found_id", "found_place", "score"])

    def compare(batches):
        held, n = [], 0
        for batch in batches:
            for i in range(len(batch)):
                info = np.frombuffer(batch.column("info")[i].as_py(), np.int64).reshape(-1, 2 + extra)
                ids = np.frombuffer(batch.column("ids")[i].as_py(), np.int64)
                scores = _scores(_matrix(batch.column("anchors").slice(i, 1), dims), _matrix(batch.column("vectors").slice(i, 1), dims))
                places = batch.column("block")[i].as_py() * BLOCK_ROWS + np.arange(len(ids))
                a, slot, row = search(info, scores, places)
                if not len(a):
                    continue
                held.append(np.stack([info[a, 0], slot, info[a, 1], ids[row], places[row], scores[a, row]], axis=1))
                n += len(a)
                if n > HELD_ROWS:
                    best = _best(np.concatenate(held), keep)
                    if len(best) > HELD_ROWS // 2:
                        yield batch_of(best)
                        best = best[:0]
                    held, n = [best], len(best)
        if n:
            yield batch_of(_best(np.concatenate(held), keep))

    chosen = blocks.select("block", "ids", "vectors")
    found = reads.join(chosen, "block").mapInArrow(compare, FOUND)
    best = Window.partitionBy("place", "slot").orderBy(F.desc("score"), "found_id", "found_place")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)


def _top_columns(scores: np.ndarray, allowed: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``keep`` greatest allowed scores of each row, the earlier column first among equals."""
    order = np.argsort(np.where(allowed, -scores, np.iinfo(np.int64).max), axis=1, kind="stable")[:, :keep]
    a = np.repeat(np.arange(len(scores)), order.shape[1])
    kept = np.take_along_axis(allowed, order, axis=1).ravel()
    return a[kept], order.ravel()[kept]


def mine(embeddings: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose id ``every`` divides.  A negative's score lies between ``low`` and ``high`` hundredths of the
    positive's.
    """
    blocks, dims = write_blocks(quantised(embeddings))
    n_tiles = -(-blocks.count() // PACK) or 1
    anchors = written(_anchors(blocks, dims, every, positives), "anchors")
    tiles = written(_tiles(blocks, n_tiles), "zone-tiles")

    def same_label(pack, lower, upper, labels, sizes):
        same = pack["label"][:, None] == labels
        # One row of the usable blocks may be the anchor itself.
        floor = np.maximum(pack["floor"], floors(np.where(same, lower, NO_SCORE + 1), sizes, same, positives + 1))
        return same & (upper >= floor[:, None])

    def others(info, scores, places):
        a, row = _top_columns(scores, info[:, :1] != places, positives)
        return a, np.zeros(len(a), np.int64), row

    reads = _reads(anchors, tiles, n_tiles, dims, ("floor",), same_label)
    nearest = written(_found(reads, blocks, dims, 1, positives, others), "positives").select(
        "place", F.col("rank").alias("slot"), F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"))

    scores = nearest.groupBy("place").agg(*(
        F.max(F.when(F.col("slot") == i + 1, F.col("positive_score"))).alias(f"score{i}") for i in range(positives)))
    none = F.lit(int(NO_SCORE))
    windowed = anchors.drop("floor").join(scores, "place").select(
        "place", "anchor_id", "label", "vector", *(F.coalesce(f"score{i}", none).alias(f"score{i}") for i in range(positives)))
    extra = tuple(f"score{i}" for i in range(positives))

    def window(score):
        # A missing positive and a negative score leave no room; their windows are made empty.
        known = score >= 0
        score = np.where(known, score, 0)
        return np.where(known, -(-low * score // 100), 1), np.where(known, high * score // 100, 0)

    def other_labels(pack, lower, upper, labels, sizes):
        other = pack["label"][:, None] != labels
        wanted = np.zeros(other.shape, bool)
        for name in extra:
            least, most = window(pack[name])
            inside = other & (lower >= least[:, None]) & (upper <= most[:, None])
            floor = np.maximum(least, floors(np.where(inside, lower, NO_SCORE + 1), sizes, inside, negatives))
            wanted |= other & (lower <= most[:, None]) & (upper >= floor[:, None]) & (least <= most)[:, None]
        return wanted

    def in_windows(info, scores, places):
        parts = []
        for i in range(positives):
            least, most = window(info[:, 2 + i])
            a, row = _top_columns(scores, (scores >= least[:, None]) & (scores <= most[:, None]), negatives)
            parts.append((a, np.full(len(a), i + 1), row))
        return tuple(np.concatenate(p) for p in zip(*parts))

    reads = _reads(written(windowed, "anchor-windows"), tiles, n_tiles, dims, extra, other_labels)
    found = _found(reads, blocks, dims, positives, negatives, in_windows)
    return found.join(nearest, ["place", "slot"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("found_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
