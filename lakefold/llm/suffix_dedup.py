"""Passages that repeat across documents, found with a sparse suffix array.

A suffix is kept where its first ``K`` words are the minimum hash of a window of ``W`` such places, so any common passage of
``W + K - 1`` words or more has a kept suffix in both documents, at the same place of the passage.  Suffixes whose first words no other
document has are dropped first.  The rest are sorted by the hashes of the words that follow (range partitions; equal ones are
split by a hash of where they stand, so a passage in very many documents fills no task), neighbours of different documents are compared, by the
words that follow and by those that precede, and matches are extended to the right and to the left.  Extensions reach ``PASSAGE`` words each way and kept suffixes are closer together, so
the union of what they cover is the whole passage.

Suffixes whose first words lie in more than one range partition are reduced to classes of equal ones, which are sorted again by what
precedes; members get the ranges of their class, but for those whose matches in their partition already reach as far as their words: of
these, two of equal ones stand for their class.  A class of several documents is settled by itself.  The nearest ones of both orders bound
how far a suffix can agree with any other; where no match has met the bound, or a partition ended before a neighbour of another document, all
runs of ``PASSAGE`` words around the suffix that could still add something are looked up, by hash, among those of all suffixes with these first words.

Words are runs of non-blanks with A-Z lower-cased, compared by 32 bits of hash.

Defined results: null or wordless text has no passages; rows with one doc_id are one document and do not repeat each other; null
doc_ids count as one document; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakefold.llm.common import BROADCAST_ROWS, broadcast_if_small, written
from lakefold.llm.mixing import word_count
from lakefold.llm.scan import fold_table, mixed, multipliers, text_slices, word_hashes

PASSAGE = 50
K = 8
SPACE = b"\t\n\x0b\x0c\r "
SLICE = 2 << 20
SUFFIX_BYTES = 1 << 23  # of suffix rows that are made at once
LAST_ID = 2**63 - 1
SUFFIXES = "doc long, text long, place int, right binary, left binary"
# Spans have ``first`` and ``last``; other rows are suffixes: how far they agree at most with what follows and precedes, and in matches so far.
FOUND = ("doc long, text long, first int, last int, place int, right binary, left binary, "
         "most_right int, most_left int, best_right int, best_left int")
BEST = ["most_right", "most_left", "best_right", "best_left"]


def sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (a ufunc, minimum or maximum) of each run of ``width`` values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    fill = np.uint64(0) if best is np.maximum else np.uint64(2**64 - 1)
    blocks = np.full(-(-len(values) // width) * width, fill)
    blocks[: len(values)] = values
    blocks = blocks.reshape(-1, width)
    ahead = best.accumulate(blocks, axis=1).reshape(-1)
    behind = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return best(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(hashes: np.ndarray, doc: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose first ``k`` words are the least of a window inside their document, and the hash of those words."""
    n = max(len(hashes) - k + 1, 0)
    total = np.zeros(n, np.uint64)
    for i, factor in enumerate(multipliers(k, 4)):
        total += hashes[i : i + n] * factor
    grams = mixed(total)
    least = sliding(grams, window, np.minimum)
    if len(least) == 0:
        return np.zeros(0, np.int64), grams[:0]
    inside = doc[: len(least)] == doc[window + k - 2 : window + k - 2 + len(least)]
    least = np.where(inside, least, 0)
    edge = np.zeros(window - 1, np.uint64)
    chosen = np.flatnonzero(sliding(np.concatenate([edge, least, edge]), window, np.maximum) == grams)
    return chosen, grams[chosen]


def _words(text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and document of each word, and the number of the first word of each document."""
    hashes, first, _ = word_hashes(text, fold_table(SPACE))
    return hashes, np.searchsorted(starts, first, side="right") - 1, np.searchsorted(first, starts)


def _anchor_rows(docs: DataFrame, passage: int, k: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "text_hash"))
            for first, _, text, starts in text_slices(batch.column("text"), SLICE):
                hashes, doc, begin = _words(text, starts)
                at, grams = anchors(hashes, doc, k, passage - k + 1)
                row = doc[at] + first
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row]), pa.array(texts[row]), pa.array((at - begin[doc[at]]).astype(np.int32)),
                     pa.array(grams.astype(np.int64))], ["doc", "text", "place", "gram"])

    return docs.mapInArrow(find, "doc long, text long, place int, gram long")


def _around(words: np.ndarray, at: np.ndarray, step: int, low: np.ndarray, high: np.ndarray, reach: int) -> np.ndarray:
    """``reach`` words from each place on, in steps of 1 or -1, 0 beyond the document."""
    places = at[:, None] + step * np.arange(reach) + min(step, 0)
    inside = (places >= low[:, None]) & (places < high[:, None])
    return np.where(inside, words[np.clip(places, 0, len(words) - 1)], 0).astype(">u4")


def _suffix_rows(docs: DataFrame, passage: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = (batch.column(c).to_numpy() for c in ("doc", "text_hash"))
            places = batch.column("places")
            for first, last, text, starts in text_slices(batch.column("text"), SLICE):
                hashes, _, begin = _words(text, starts)
                words = (hashes >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
                mine = places.slice(first, last - first)
                row = np.repeat(np.arange(last - first), mine.value_lengths().to_numpy())
                place = mine.flatten().to_numpy()
                step = max(1, SUFFIX_BYTES // (8 * passage))
                for i in range(0, len(row), step):
                    r, p = row[i : i + step], place[i : i + step]
                    low, high = begin[r], begin[r + 1]
                    sides = [_around(words, low + p, s, low, high, passage) for s in (1, -1)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[first + r]), pa.array(texts[first + r]), pa.array(p.astype(np.int32)),
                         *[pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * passage), len(r), [None, pa.py_buffer(x.tobytes())])
                           .cast(pa.binary()) for x in sides]], ["doc", "text", "place", "right", "left"])

    return docs.mapInArrow(cut, SUFFIXES)


def _agreement(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Number of equal words at the beginning of each row; 0 is beyond the document and equals nothing."""
    differ = (x != y) | (x == 0)
    return np.where(differ.any(axis=1), differ.argmax(axis=1), x.shape[1])


def _neighbours(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of sorted suffixes the nearest row before and behind that is of another document, or -1."""
    n = len(doc)
    cuts = np.flatnonzero(np.diff(doc) != 0) + 1
    starts = np.concatenate([[0], cuts])
    ends = np.concatenate([cuts, [n]])
    run = np.repeat(np.arange(len(starts)), ends - starts)
    before, behind = starts[run] - 1, ends[run]
    return before, np.where(behind < n, behind, -1)


def _nearest(doc: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Pairs (rows of two) of each row with its neighbours of another document in its group."""
    pairs = []
    for other in _neighbours(doc):
        at = np.flatnonzero(other >= 0)
        at = at[group[at] == group[other[at]]]
        pairs.append(np.stack([at, other[at]]))
    return np.concatenate(pairs, axis=1)


def _bound(doc: np.ndarray, most: np.ndarray, words: np.ndarray) -> np.ndarray:
    """``most``, or all words of the document where rows beyond the partition may agree longer."""
    unknown = np.zeros(len(doc), bool)
    for other in _neighbours(doc):
        unknown |= other < 0
    return np.where(unknown, (words != 0).sum(axis=1), most)


def _matches(doc, right, left, passage, k) -> tuple[np.ndarray, ...]:
    """How far each of the sorted suffixes agrees with others at most by what follows, and in matches of ``passage`` words ahead and back.

    The first array numbers the groups of rows with equal first words.

    Neighbours by what follows and neighbours by what precedes bound how far a row can agree at all.
    Rows for which these neighbours do not reach both bounds are compared with further ones, as far as the words that
    follow agree enough; the words that precede can add no more than their bound.
    """
    n = len(doc)
    next_to = np.concatenate([[0], _agreement(right[1:], right[:-1])])
    group = np.cumsum(next_to < k)
    back_order = np.lexsort((np.ascontiguousarray(left).view(f"S{4 * left.shape[1]}").reshape(-1), group))
    most_right, most_left, best_right, best_left = (np.zeros(n, np.int64) for _ in range(4))

    def compare(a: np.ndarray, b: np.ndarray) -> None:
        apart = doc[a] != doc[b]
        a, b = a[apart], b[apart]
        ahead, back = _agreement(right[a], right[b]), _agreement(left[a], left[b])
        long = ahead + back >= passage
        for x in (a, b):
            np.maximum.at(most_right, x, ahead)
            np.maximum.at(most_left, x, back)
            np.maximum.at(best_right, x[long], ahead[long])
            np.maximum.at(best_left, x[long], back[long])

    compare(*_nearest(doc, group))
    compare(*back_order[_nearest(doc[back_order], group[back_order])])
    open_ = np.flatnonzero((most_left + most_right >= passage) & ((best_left < most_left) | (best_right < most_right)))
    for way in (1, -1):
        at, agreed, distance = open_, np.full(len(open_), right.shape[1]), 0
        while len(at):
            distance += way
            at, agreed = (x[(at + distance >= 0) & (at + distance < n)] for x in (at, agreed))
            other = at + distance
            agreed = np.minimum(agreed, next_to[other + (way < 0)])
            on = (agreed >= k) & (agreed + most_left[at] >= passage)
            on &= (best_left[at] < most_left[at]) | (best_right[at] < most_right[at])  # else nothing can be added
            at, agreed, other = at[on], agreed[on], other[on]
            compare(at, other)
    return group, _bound(doc, most_right, right), best_right, best_left


def _columns(batches) -> tuple | None:
    if sum(map(len, batches)) == 0:
        return None
    table = pa.Table.from_batches(batches)
    doc, text, place = (table.column(c).to_numpy() for c in ("doc", "text", "place"))
    right, left = (np.frombuffer(b"".join(table.column(c).to_pylist()), ">u4").reshape(len(doc), -1) for c in ("right", "left"))
    return doc, text, place, right, left


def _ends(doc: np.ndarray, right: np.ndarray, left: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Of the ``rows`` with equal words on both sides, those of the smallest and the largest document."""
    if len(rows) == 0:
        return rows
    both = np.concatenate([right[rows], left[rows]], axis=1)
    words = both.view(f"S{4 * both.shape[1]}").reshape(-1)
    order = np.lexsort((doc[rows], words))
    cuts = np.flatnonzero(words[order[1:]] != words[order[:-1]])
    return rows[order[np.unique(np.concatenate([[0], cuts, cuts + 1, [len(order) - 1]]))]]


def _rows_found(columns: tuple, passage: int, kept: np.ndarray, bounds: list[np.ndarray], settled: np.ndarray | None = None) -> pa.RecordBatch:
    """Spans of the rows that match, and the suffixes ``kept`` with their ``bounds``; ``settled`` ones have no place."""
    doc, text, place, right, left = columns
    best_right, best_left = bounds[2:]
    rows = np.flatnonzero(best_left + best_right >= passage)
    spans, others = [None] * len(rows), [None] * len(kept)
    no_place = np.zeros(len(kept), bool) if settled is None else settled[kept]
    return pa.RecordBatch.from_arrays([
        pa.array(np.concatenate([doc[rows], doc[kept]])), pa.array(np.concatenate([text[rows], text[kept]])),
        pa.array((place - best_left)[rows].tolist() + others, pa.int32()), pa.array((place + best_right)[rows].tolist() + others, pa.int32()),
        pa.array(spans + [None if done else p for p, done in zip(place[kept].tolist(), no_place)], pa.int32()),
        *[pa.array(spans + [w.tobytes() for w in x[kept]], pa.binary()) for x in (right, left)],
        *[pa.array(spans + x[kept].tolist(), pa.int32()) for x in bounds],
    ], ["doc", "text", "first", "last", "place", "right", "left", *BEST])


def _compare(passage: int, k: int):
    """Spans, and the suffixes of the first and last group of each range partition, which may go on in the next.

    A suffix whose matches reach as far as its words is settled: no other can add to its span.  Settled ones only go on to stand for
    their class, without a place, and two of equal ones tell all that counts of it, however many copies there are.
    """
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not (columns := _columns(list(batches))):
            return
        doc, _, _, right, left = columns
        group, most_right, best_right, best_left = _matches(doc, right, left, passage, k)
        n_right, n_left = ((x != 0).sum(axis=1) for x in (right, left))
        settled = (best_right >= n_right) & (best_left >= n_left) & (best_right + best_left >= passage)
        edge = (group == group[0]) | (group == group[-1])
        kept = np.concatenate([np.flatnonzero(edge & ~settled), _ends(doc, right, left, np.flatnonzero(edge & settled))])
        yield _rows_found(columns, passage, kept, [most_right, n_left, best_right, best_left], settled)

    return compare


def _compare_back(passage: int, k: int):
    """Spans by the nearest rows of suffixes in order of first words and what precedes, and the suffixes that other ones may add to."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if not (columns := _columns(batches)):
            return
        doc, _, _, right, left = columns
        table = pa.Table.from_batches(batches)
        n_right, n_left = ((x != 0).sum(axis=1) for x in (right, left))
        most_right, _, best_right, best_left = (
            np.minimum(table.column(c).to_numpy(), n) for c, n in zip(BEST, (n_right, n_left, n_right, n_left)))
        group = np.concatenate([[0], np.cumsum((right[1:, :k] != right[:-1, :k]).any(axis=1))])
        a, b = _nearest(doc, group)
        ahead, back = _agreement(right[a], right[b]), _agreement(left[a], left[b])
        most_left, long = np.zeros(len(doc), np.int64), ahead + back >= passage
        for x in (a, b):
            np.maximum.at(most_left, x, back)
            np.maximum.at(best_right, x[long], ahead[long])
            np.maximum.at(best_left, x[long], back[long])
        most_left = _bound(doc, most_left, left)
        open_ = (most_left + most_right >= passage) & ((best_left < most_left) | (best_right < most_right))
        yield _rows_found(columns, passage, np.flatnonzero(open_), [most_right, most_left, best_right, best_left])

    return compare


def _runs(passage: int, wanted: np.ndarray | None, missing: bool):
    """The runs of ``passage`` words that begin up to as many words before a suffix, by hash; only those among ``wanted``.

    ``missing``: only those that could add to the matches of the suffix.
    """
    factors = multipliers(passage, 5)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, SUFFIX_BYTES // (8 * passage))
            for i in range(0, len(batch), step):
                part = batch.slice(i, step)
                right, left = (np.frombuffer(b"".join(part.column(c).to_pylist()), ">u4").reshape(len(part), -1) for c in ("right", "left"))
                words = np.concatenate([left[:, ::-1], right], axis=1).astype(np.uint64)
                total = np.zeros((len(part), passage + 1), np.uint64)
                for j, factor in enumerate(factors):
                    total += words[:, j : j + passage + 1] * factor
                total = mixed(total).view(np.int64)
                before = passage - np.arange(passage + 1)  # words of the run that precede the suffix
                n_left, n_right = ((x != 0).sum(axis=1)[:, None] for x in (left, right))
                inside = (before <= n_left) & (passage - before <= n_right)
                if missing:
                    most_right, most_left, best_right, best_left = (part.column(c).to_numpy()[:, None] for c in BEST)
                    inside &= (before <= most_left) & (passage - before <= most_right)
                    inside &= (before > best_left) | (passage - before > best_right)
                if wanted is not None:
                    inside &= np.isin(total, wanted)
                row, column = np.nonzero(inside)
                doc, text, place = (part.column(c).to_numpy()[row] for c in ("doc", "text", "place"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(total[row, column]), pa.array(doc), pa.array(text), pa.array((place - before[column]).astype(np.int32))],
                    ["run", "doc", "text", "first"])

    return hashed


RUNS = "run long, doc long, text long, first int"


def _classes(suffixes: DataFrame, passage: int) -> DataFrame:
    """Equal suffixes as one row: ``text`` is ``klass``, ``place`` 0 and ``doc`` their document, or ``many`` if they have several.

    Those of several documents agree with each other in all their words, so nothing else can add to them.
    """
    several = F.col("low") < F.col("high")
    grouped = suffixes.groupBy("right", "left").agg(
        F.min("doc").alias("low"), F.max("doc").alias("high"), F.min("most_right").alias("most_right"),
        F.min("most_left").alias("most_left"), F.max("best_right").alias("best_right"), F.max("best_left").alias("best_left"))
    return grouped.select(
        F.when(several, F.xxhash64("right", "left")).otherwise(F.col("low")).alias("doc"), F.xxhash64("left", "right").alias("text"),
        F.lit(0).alias("place"), "right", "left", *(F.when(several, passage).otherwise(F.col(c)).alias(c) for c in BEST))


def _across(edges: DataFrame, parts: int, passage: int, k: int) -> DataFrame:
    """Spans of the suffixes whose first words lie in more than one range partition; ``edges`` has ``part``, the partition."""
    first_words = F.substring("right", 1, 4 * k).alias("gram")
    edges = edges.select("*", first_words)
    split = edges.groupBy("gram").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("gram")
    members = edges.join(broadcast_if_small(written(split, "split")), "gram").select(
        "doc", "text", "place", "right", "left", *BEST, F.xxhash64("left", "right").alias("klass"), F.xxhash64("right", "left").alias("many"))
    members = written(members, "across")
    classes = written(_classes(members, passage).select("*", first_words), "classes")
    order = ["gram", "left", F.xxhash64("doc", "text")]
    again = classes.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    found = written(again.select("doc", "text", "place", "right", "left", *BEST).mapInArrow(_compare_back(passage, k), FOUND), "back")
    spans = found.where("first is not null")
    open_ = found.where("first is null").select("*", first_words)
    asked = written(open_.mapInArrow(_runs(passage, None, True), RUNS), "asked")
    hashes = asked.select("run").distinct()
    few = hashes.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    wanted = hashes.toArrow().column("run").to_numpy() if few else None
    partners = classes.join(broadcast_if_small(written(open_.select("gram").distinct(), "open")), "gram", "left_semi")
    runs = partners.mapInArrow(_runs(passage, wanted, False), RUNS)
    repeated = runs.groupBy("run").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("run")
    more = asked.join(written(repeated, "runs"), "run").select("doc", "text", "first", (F.col("first") + passage).alias("last"))
    # All ranges of a class meet at the suffix's place, so they are one range.
    ranges = spans.select("doc", "text", "first", "last").unionByName(more).groupBy("doc", "text").agg(
        F.min("first").alias("first"), F.max("last").alias("last"))
    ranges = ranges.withColumnsRenamed({"doc": "_doc", "text": "_klass"})
    same = (F.col("klass") == F.col("_klass")) & F.col("_doc").isin(F.col("doc"), F.col("many"))
    return members.where("place is not null").join(ranges, same).select(
        "doc", "text", (F.col("place") + F.col("first")).alias("first"), (F.col("place") + F.col("last")).alias("last"))


def repeated_spans(docs: DataFrame, passage: int = PASSAGE, k: int = K) -> DataFrame:
    """``doc, text, first, last``: ranges of words (from 0, end exclusive) that another document has too.

    ``doc`` is the doc_id, or the largest number for null, and ``text`` a hash of the text.  Ranges may overlap.
    """
    plain = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"), F.xxhash64("text").alias("text_hash"), "text"
    )
    kept = written(_anchor_rows(plain, passage, k), "anchors")
    repeated = kept.groupBy("gram").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("gram")
    # A table of its own, so that the join below is between two shuffles and Spark can split frequent first words.
    repeated = written(repeated, "grams")
    places = (
        kept.join(repeated, "gram").groupBy(F.col("doc").alias("_doc"), F.col("text").alias("_text"))
        .agg(F.sort_array(F.collect_set("place")).alias("places"))
    )
    held = plain.join(places, (F.col("doc") == F.col("_doc")) & (F.col("text_hash") == F.col("_text"))).drop("_doc", "_text")
    order = ["right", F.xxhash64("doc", "place", "text")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    suffixes = written(_suffix_rows(held, passage), "suffixes")
    sorted_suffixes = suffixes.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    matches = sorted_suffixes.mapInArrow(_compare(passage, k), FOUND).withColumn("part", F.spark_partition_id())
    found = written(matches, "matches")
    spans = ["doc", "text", "first", "last"]
    result = found.where("first is not null").select(*spans)
    return result.unionByName(_across(found.where("first is null"), parts, passage, k))


def merged(spans: DataFrame) -> DataFrame:
    """``doc, text, spans``: the ranges of each document, those that touch or overlap as one, in order."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ranges in batch.column("ranges").to_pylist():
                joined: list[list[int]] = []
                for r in ranges:
                    if joined and r["first"] <= joined[-1][1]:
                        joined[-1][1] = max(joined[-1][1], r["last"])
                    else:
                        joined.append([r["first"], r["last"]])
                out.append([{"first": a, "last": b} for a, b in joined])
            kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("text"), pa.array(out, kind)], ["doc", "text", "spans"])

    ranges = spans.groupBy("doc", "text").agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("ranges"))
    return ranges.mapInArrow(merge, "doc long, text long, spans array<struct<first:int,last:int>>")


def find_repeats(docs: DataFrame, passage: int = PASSAGE, k: int = K) -> DataFrame:
    """``doc_id, n_words, n_repeated, n_spans, spans``, one row per row of ``docs``; ``spans`` is "first:last,..." in words."""
    found = merged(repeated_spans(docs, passage, k)).withColumnsRenamed({"doc": "_doc", "text": "_text"})
    words = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), word_count(F.col("text")).alias("n_words"))
    doc = F.coalesce(words["doc_id"].cast("long"), F.lit(LAST_ID))
    size = F.aggregate("spans", F.lit(0), lambda total, s: total + s["last"] - s["first"])
    shown = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["first"], s["last"])), ",")
    return words.join(found, (doc == found["_doc"]) & (words["text_hash"] == found["_text"]), "left").select(
        "doc_id", "n_words", F.coalesce(size, F.lit(0)).cast("long").alias("n_repeated"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"), F.coalesce(shown, F.lit("")).alias("spans"),
    )
