"""Benchmark decontamination with a positional inverted index over the training documents.

Each benchmark item is cut into windows of consecutive words.  Term frequencies over all documents tell the rarest
``anchors`` terms of each window; the index stores the postings of those terms, each with its position and the words around
it.  A posting at position p of the term at place j of an item puts the item at p - j: these offset-adjusted lists are
intersected, and where two different terms put an item at the same place, the windows there are compared word by word with the
stored surroundings.  ``proximity_matches`` reads the same postings for windows whose rarest terms stand close together.

Defined results: null or wordless text has no words and no hits; an item without words has no windows; an item of fewer words
than a window is one window; documents with one doc_id and different texts are judged apart, equal rows alike; a null
doc_id is a document, a null item_id is named "null"; empty tables give no hits.  Other columns of the documents are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from lakefold.llm.common import BROADCAST_ROWS, ascii_lower, broadcast_if_small, unused, written

# Of text with A-Z lower-cased, these runs are those of [^\x00-\x2F\x3A-\x60\x7B-\x7F]; named classes match faster.
WORD = r"[\p{Alnum}\P{ASCII}]+"
WINDOW = 10
ANCHORS = 2


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item, part, first, n, terms``: the windows of each item; ``first`` counts its words from 1."""
    size = F.size("w")
    return (
        benchmark.select(
            F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
            F.xxhash64("text").alias("part"), words(F.col("text")).alias("w"),
        )
        .dropDuplicates(["item", "part"])
        .where(size > 0)
        .withColumn("first", F.explode(F.sequence(F.lit(1), F.greatest(size - window + 1, F.lit(1)))))
        .withColumn("terms", F.slice("w", F.col("first"), F.lit(window)))
        .select("item", "part", "first", F.size("terms").alias("n"), "terms")
    )


def _tokens(docs: DataFrame, *more: Column) -> DataFrame:
    split = docs.select("doc_id", F.xxhash64("text").alias("text"), words(F.col("text")).alias("w"))
    # The outer form: the plain one adds a filter on the size of w, which would split each text twice.
    exploded = split.select("doc_id", "text", "w", F.posexplode_outer("w").alias("p", "term"))
    return exploded.select("doc_id", "text", "term", (F.col("p") + 1).alias("position"), *more)


def _of_terms(tokens: DataFrame, terms: DataFrame) -> DataFrame:
    """The tokens with one of the ``terms``, with their columns; looked up by a 64-bit hash, then compared."""
    wanted = terms.withColumnRenamed("term", "_term").withColumn("_hash", F.xxhash64("_term"))
    # Each a prefix of the other: equal, but not a second join key beside the hash.
    same = F.startswith(tokens["term"], wanted["_term"]) & F.startswith(wanted["_term"], tokens["term"])
    met = (F.xxhash64(tokens["term"]) == wanted["_hash"]) & same
    return tokens.join(wanted, met).drop("_term", "_hash")


def term_frequencies(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``term, n``: occurrences in all documents of the given terms that occur at all."""
    tokens = _tokens(docs)
    if terms.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return tokens.groupBy("term").agg(F.count("*").alias("n")).join(terms, "term", "left_semi")
    numbered = written(terms.withColumn("number", F.monotonically_increasing_id()), "terms")
    counts = _of_terms(tokens, F.broadcast(numbered)).groupBy("number").agg(F.count("*").alias("n"))
    return counts.join(F.broadcast(numbered), "number").select("term", "n")


def anchored(windows: DataFrame, frequencies: DataFrame, anchors: int = ANCHORS) -> DataFrame:
    """``windows`` with ``rarest``: the terms of each window with their places in the item, rarest first."""
    rank = Window.partitionBy("item", "part", "first").orderBy("n_term", "term", "place")
    ranked = (
        windows.select("item", "part", "first", "n", "terms", F.posexplode("terms").alias("i", "term"))
        .join(frequencies.withColumnRenamed("n", "n_term"), "term", "left")
        .withColumns({"n_term": F.coalesce("n_term", F.lit(0)), "place": F.col("first") + F.col("i")})
        .withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") <= anchors)
    )
    return ranked.groupBy("item", "part", "first").agg(
        F.first("n").alias("n"), F.first("terms").alias("terms"),
        F.array_sort(F.collect_list(F.struct("rank", "term", "place"))).alias("rarest"),
    )


@dataclass(frozen=True)
class PositionalIndex:
    """Stored postings ``doc_id, text, term, position, before, around`` of the terms that windows are anchored at.

    ``around`` holds the words next to the position, the first of them at position ``before``.
    """

    postings: DataFrame
    windows: DataFrame
    window: int


def build_index(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, anchors: int = ANCHORS) -> PositionalIndex:
    windows = written(benchmark_windows(benchmark, window), "windows")
    terms = windows.select(F.explode("terms").alias("term")).distinct()
    frequencies = broadcast_if_small(written(term_frequencies(docs, terms), "frequencies"))
    windows = written(anchored(windows, frequencies, anchors), "anchored")
    wanted = (
        windows.select(F.explode("rarest").alias("r")).groupBy(F.col("r.term").alias("term"))
        .agg(F.min("r.rank").alias("rank"))
    )
    before = F.greatest(F.col("position") - (window - 1), F.lit(1))
    postings = (
        _of_terms(_tokens(docs, F.col("w")), broadcast_if_small(wanted))
        .select(
            "doc_id", "text", "term", "position", before.alias("before"),
            # Only the rarest term of a window is compared word by word.
            F.when(F.col("rank") == 1, F.slice("w", before, F.col("position") + window - before)).alias("around"),
        )
    )
    return PositionalIndex(written(postings, "postings"), windows, window)


def phrase_matches(index: PositionalIndex) -> DataFrame:
    """``doc_id, text, item, position, n``: where windows of items occur exactly in documents."""
    keys = ["doc_id", "text", "item", "part", "at"]
    places = (
        index.windows.select("item", "part", F.explode("rarest").alias("r"), (F.col("n") == 1).alias("alone"))
        .groupBy("item", "part", F.col("r.term").alias("term"), F.col("r.place").alias("place"))
        .agg(F.min("r.rank").alias("rank"), F.max("alone").alias("alone"))
    )
    lists = index.postings.join(broadcast_if_small(places), "term").withColumn("at", F.col("position") - F.col("place"))
    agreed = (
        lists.groupBy(*keys).agg(F.min("place").alias("a"), F.max("place").alias("b"), F.max("alone").alias("alone"))
        .where("a < b or alone").select(*keys)
    )
    # Null ids must meet as well, so keys are compared null-safely.
    left, right = lists.where("rank = 1").alias("l"), agreed.alias("r")
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    rarest = index.windows.select(
        "item", "part", "first", "n", "terms", F.element_at("rarest", 1).getField("place").alias("place")
    )
    start = F.col("at") + F.col("first")
    return (
        left.join(right, same, "left_semi")
        .join(broadcast_if_small(rarest), ["item", "part", "place"])
        .where((start >= 1) & (F.slice("around", F.greatest(start - F.col("before") + 1, F.lit(1)), F.col("n")) == F.col("terms")))
        .select("doc_id", "text", "item", start.alias("position"), "n")
    )


def proximity_matches(index: PositionalIndex, slop: int = 20) -> DataFrame:
    """``doc_id, text, item, first, distance``: windows whose two rarest terms stand within ``slop`` words of each other.

    ``distance`` is the smallest one.  Positions meet by blocks of ``slop`` words, so a document is never paired with all of itself.
    """
    pairs = index.windows.where(F.size("rarest") > 1).select(
        "item", "part", "first", F.element_at("rarest", 1).getField("term").alias("term"),
        F.element_at("rarest", 2).getField("term").alias("second"),
    )
    postings = index.postings.select("doc_id", "text", "term", "position")
    one = postings.join(broadcast_if_small(pairs), "term").withColumn("block", F.floor(F.col("position") / slop))
    other = (
        postings.withColumnsRenamed({"doc_id": "_doc", "text": "_text", "term": "_term", "position": "_position"})
        .withColumn("_block", F.explode(F.array(*[F.floor(F.col("_position") / slop) + i for i in (-1, 0, 1)])))
    )
    distance = F.abs(F.col("position") - F.col("_position"))
    return (
        one.join(other, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text") == F.col("_text"))
                 & (F.col("second") == F.col("_term")) & (F.col("block") == F.col("_block"))
                 & distance.between(1, slop))
        .groupBy("doc_id", "text", "item", "first").agg(F.min(distance).alias("distance"))
    )


def hits(matches: DataFrame) -> DataFrame:
    """``doc_id, text, n_hit, items``: hit words and the items found, per document with any."""
    hit = (
        matches.select("doc_id", "text", F.explode(F.expr("sequence(position, position + n - 1)")).alias("p"))
        .distinct().groupBy("doc_id", "text").agg(F.count("*").alias("n_hit"))
    )
    items = matches.select("doc_id", "text", "item").distinct().groupBy("doc_id", "text").agg(
        F.sort_array(F.collect_list("item")).alias("items"))
    other = items.withColumnsRenamed({"doc_id": "_doc", "text": "_text"})
    return hit.join(
        other, hit["doc_id"].eqNullSafe(other["_doc"]) & (hit["text"] == other["_text"])
    ).select("doc_id", "text", "n_hit", "items")


def judge(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, text_hash, n_words, n_hit, items``, one row per document."""
    found = written(phrase_matches(build_index(docs, benchmark, window)), "phrases")
    marked = hits(found).withColumnsRenamed({"doc_id": "_doc", "text": "_text"})
    counted = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"),
    )
    return counted.join(
        marked, counted["doc_id"].eqNullSafe(marked["_doc"]) & (counted["text_hash"] == marked["_text"]), "left"
    ).select(
        "doc_id", "text_hash", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with all their columns."""
    found = written(phrase_matches(build_index(docs.select("doc_id", "text"), benchmark, window)), "phrases")
    doc, text = unused(docs.columns, "_doc"), unused(docs.columns, "_text")
    bad = found.select(F.col("doc_id").alias(doc), F.col("text").alias(text)).distinct()
    return docs.join(
        broadcast_if_small(bad),
        docs["doc_id"].eqNullSafe(F.col(doc)) & (F.xxhash64(docs["text"]) == F.col(text)), "left_anti",
    )
