"""Spelling variants: words that differ by one letter, each led to its far more frequent form.

Candidates come from PartEnum signatures.  The letters of a word are a multiset, which is a binary vector with a dimension for each
letter and each number of its occurrences.  One inserted or deleted letter changes one dimension, one replaced letter two.  The dimensions
are partitioned by letter into parts of about equal weight; if two vectors differ in at most ``k`` dimensions, at most ``k``
parts differ, so the vectors agree on all of some ``parts - k`` parts.  Every such choice of parts, with what the word has in them, is a
signature; words that share one are candidates and no pair is missed.  Words of equal length differ by a replacement (``k`` = 2), words whose
lengths differ by one by an insertion (``k`` = 1), and each kind has signatures of its own, keyed by the shorter length.

A difference of one letter also leaves the first or the second half of the word alone, counted in the shorter length, so a signature
is met once with the hash of each half.  That splits a signature that many words share (anagrams, words of few letters) and loses no pair.
Signatures meet in an equi-join whose condition holds the check: a bitmap of the multiset first, then the edit distance.

Words are counted on the map side, and what is joined is the vocabulary.  The chain of forms is followed by doubling; each
step up has ten times the count, so a few rounds end it.

Defined results: null and empty texts have no words; a null doc_id is written as ``null``; repeated rows count each; ties between
forms go to the word that is smaller in code points; an empty table gives no rows; columns other than ``doc_id, text`` are not read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakefold.llm.common import ascii_lower, broadcast_if_small, written

LEAST_LENGTH = 7
LEAST_COUNT = 2
# A form has at least so many times the count of its variant.
TIMES = 10
# One run in so many loses a letter, as a test of the grouping with known answers.
DELETE_ONE_IN = 31
# Parts of the letters, for words of equal length and for words whose lengths differ by one.
REPLACE_PARTS, INSERT_PARTS = 4, 2
RUNS = f"[a-z\\u00C0-\\u00FF]{{{LEAST_LENGTH},}}"


def occurrences(docs: DataFrame, delete_one_in: int = DELETE_ONE_IN) -> DataFrame:
    """``word`` of every run of letters that is long enough, with the letters that the test deletes left out."""
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("id"),
        F.explode(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(RUNS), 0)).alias("run"),
    ).withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % delete_one_in == 0, shorter).otherwise(F.col("run"))
    return runs.select(word.alias("word")).where(F.length("word") >= LEAST_LENGTH)


def vocabulary(words: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of the words that occur often enough."""
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def signature_parts(parts: int, k: int) -> list[tuple[int, ...]]:
    """The choices of parts on which two vectors that differ in ``k`` dimensions may agree; one always does."""
    if parts <= k:
        raise ValueError("there must be more parts than differences")
    return list(combinations(range(parts), parts - k))


def deal_letters(counts: list[tuple[str, int]], parts: int) -> list[str]:
    """The letters of each part: each letter, the most frequent first, goes to the part with the least weight so far."""
    dealt, weight = [""] * parts, [0] * parts
    for letter, n in sorted(counts, key=lambda c: (-c[1], c[0])):
        least = weight.index(min(weight))
        dealt[least] += letter
        weight[least] += n
    return dealt


def letter_table(vocab: DataFrame, dealt: dict[str, list[str]]) -> DataFrame:
    """``word, n`` with ``bits`` of its multiset and, for each way to deal the letters, a hash of what each part has."""
    split = F.array_sort(F.split("word", ""))
    # A bit for each element of the multiset; where several share a bit, differences can only vanish.
    element = F.transform(split, lambda x, i: F.concat(x, (i - F.array_position(split, x) + 1).cast("string")))
    one = F.lit(1).cast("long")
    bits = F.aggregate(
        element, F.lit(0).cast("long"),
        lambda acc, x: acc.bitwiseXOR(F.call_function("shiftleft", one, F.pmod(F.xxhash64(x), F.lit(64)).cast("int"))))
    hashes = {
        f"{kind}{i}": F.xxhash64(F.translate("letters", "".join(x for x in parts if x != own), ""))
        for kind, parts in dealt.items() for i, own in enumerate(parts)
    }
    words = vocab.where(F.length("word") > 0).select("word", "n", F.array_join(split, "").alias("letters"), bits.alias("bits"))
    return written(words.withColumns(hashes).drop("letters"), "letters")


def _halves(word: Column, shorter: Column) -> list[Column]:
    """The first and the last half of a word, as its partner of length ``shorter`` (or itself) divides it."""
    first = F.floor(shorter / 2).cast("int")
    last = shorter - first
    return [F.substring(word, F.lit(1), first), F.substring(word, F.length(word) - last + 1, last)]


def _signatures(words: DataFrame, kind: str, parts: int, k: int, shorter: Column) -> DataFrame:
    """``signature, word, n, bits`` of each word: one row per choice of parts and half."""
    first, last = _halves(F.col("word"), shorter)
    keyed = words.withColumns({"first": F.xxhash64(first), "last": F.xxhash64(last), "shorter": shorter})
    signatures = [
        F.xxhash64(F.lit(f"{kind}:{number}:{half}"), F.col("shorter"), F.col(half), *(F.col(f"{kind}{i}") for i in chosen))
        for number, chosen in enumerate(signature_parts(parts, k)) for half in ("first", "last")
    ]
    return keyed.select(F.explode(F.array(*signatures)).alias("signature"), "word", "n", "bits")


def near_pairs(vocab: DataFrame, replace_parts: int = REPLACE_PARTS, insert_parts: int = INSERT_PARTS) -> DataFrame:
    """``a, n_a, b, n_b`` of the pairs of ``vocab`` (``word, n``) that differ by exactly one letter, each once."""
    # As many rows as the alphabet has letters.
    counts = [tuple(r) for r in vocab.select(F.explode(F.split("word", "")).alias("x")).groupBy("x").count().collect()]
    words = letter_table(vocab, {"replace": deal_letters(counts, replace_parts), "insert": deal_letters(counts, insert_parts)})
    length = F.length("word")
    same = _signatures(words, "replace", replace_parts, 2, length)
    short = _signatures(words, "insert", insert_parts, 1, length)
    long = _signatures(words, "insert", insert_parts, 1, length - 1)

    def met(left: DataFrame, right: DataFrame, differences: int, order: Column) -> DataFrame:
        close = F.bit_count(F.col("l.bits").bitwiseXOR(F.col("r.bits"))) <= differences
        one = F.levenshtein(F.col("l.word"), F.col("r.word"), 1) == 1
        return left.alias("l").join(right.alias("r"), (F.col("l.signature") == F.col("r.signature")) & order & close & one).select(
            F.col("l.word").alias("a"), F.col("l.n").alias("n_a"), F.col("r.word").alias("b"), F.col("r.n").alias("n_b"))

    replaced = met(same, same, 2, F.col("l.word") < F.col("r.word"))
    inserted = met(short, long, 1, F.length("l.word") < F.length("r.word"))
    return replaced.unionByName(inserted).distinct()


def forms(vocab: DataFrame, pairs: DataFrame, times: int = TIMES) -> DataFrame:
    """``word, n_near, form, form_n`` of the words that have a near word."""
    both = F.array(
        F.struct(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("other"), F.col("n_b").alias("m")),
        F.struct(F.col("b").alias("word"), F.col("n_b").alias("n"), F.col("a").alias("other"), F.col("n_a").alias("m")),
    )
    found = pairs.select(F.inline(both)).groupBy("word").agg(
        F.count("*").alias("n_near"), F.max("n").alias("n"),
        F.min(F.struct((-F.col("m")).alias("m"), F.col("other").alias("form"))).alias("best"),
    )
    enough = -F.col("best.m") >= times * F.col("n")
    return found.select(
        "word", "n_near", F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.m")).alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """``word, root`` of the words that have a form (``word, form``): the last form, by doubling the steps until none moves on."""
    steps = written(formed.where("form is not null").select("word", F.col("form").alias("root")), "forms")
    while True:
        next_step = broadcast_if_small(steps.select(F.col("word").alias("root"), F.col("root").alias("further")))
        longer = written(steps.join(next_step, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "forms")
        steps = longer.drop("moved")
        if longer.where("moved").isEmpty():
            return steps


def group_variants(docs: DataFrame, delete_one_in: int = DELETE_ONE_IN, times: int = TIMES) -> DataFrame:
    """``word, form, root, n, n_near, form_n``, one row per word of ``docs`` (``doc_id, text``)."""
    vocab = written(vocabulary(occurrences(docs, delete_one_in)), "vocabulary")
    formed = written(forms(vocab, near_pairs(vocab), times), "near-words")
    last = roots(formed)
    return vocab.join(formed, "word", "left").join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form_n",
    )
