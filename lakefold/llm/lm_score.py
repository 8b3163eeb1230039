"""Document scores by masked pseudo-likelihood of a bidirectional window network.

The network predicts each token from the ``SIDE`` tokens on either side, never from itself: a hidden layer adds one embedding per offset
and token, and the output is a class of tokens and a member of the class, two small softmaxes instead of one over the
whole vocabulary.  A document's score is the sum of the log-probabilities of all its tokens given their surroundings.

All words are counted over all documents.  The most frequent ones are tokens of their own, the others fall into one of ``SPARE``
tokens by hash.  Such a word's probability is that of its token times its share of the token's occurrences; these shares stay
a distributed table, which is met with the rare words of each document.  A word that was not counted gets the
share of one further occurrence, less than any that was; the probabilities of the counted words add up to 1.

Training is data-parallel: in each round every partition trains a
copy of the network by mini-batches on every ``STRIDE``-th token of its documents, each round on others, so that all rounds together
have every token as a target once; the copies are averaged, weighted by their examples, a fixed number at a time, until one is left.  What is gathered thus grows with the corpus, and no task or
driver holds more than a fixed number of networks.

Words are runs of letters and digits (all bytes above ASCII count as letters) with A-Z lower-cased, and are told apart by 64-bit
hashes.

Defined results: null or wordless text has no tokens, log-likelihood 0 and a null mean; every row is scored by itself; without any
token at all the network stays as it began; an empty table gives an empty result; only ``doc_id, text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from lakefold.llm.common import written
from lakefold.llm.scan import fold_table, text_slices, word_hashes

SIDE = 2
HIDDEN = 24
CLASSES = 46
MEMBERS = 46
SPARE = 64
ROUNDS = 2
STRIDE = ROUNDS  # every token is a target in one of the rounds
BATCH = 8192
SCORED = 1 << 13  # tokens scored at once
RATE = 0.15
SEED = 7
SLICE = 1 << 20
AVERAGED = 32  # networks that one task averages
SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())


@dataclass(frozen=True)
class Shape:
    side: int = SIDE
    hidden: int = HIDDEN
    classes: int = CLASSES
    members: int = MEMBERS
    spare: int = SPARE

    @property
    def tokens(self) -> int:
        return self.classes * self.members

    @property
    def known(self) -> int:
        return self.tokens - self.spare

    def sizes(self) -> dict[str, tuple[int, ...]]:
        # The last row of ``embed`` stands for what is outside the document.
        return {
            "embed": (2 * self.side, self.tokens + 1, self.hidden), "bias": (self.hidden,),
            "classes": (self.hidden, self.classes), "class_bias": (self.classes,),
            "members": (self.classes, self.hidden, self.members), "member_bias": (self.classes, self.members),
        }


@dataclass
class Network:
    shape: Shape
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def begin(cls, shape: Shape, seed: int = SEED) -> Network:
        draw = np.random.default_rng(seed)
        weights = {name: (draw.standard_normal(size) * (0.0 if "bias" in name else 0.1)).astype(np.float32)
                   for name, size in shape.sizes().items()}
        return cls(shape, weights)

    def packed(self) -> bytes:
        return b"".join(w.tobytes() for w in self.weights.values())

    @classmethod
    def unpacked(cls, shape: Shape, data: bytes) -> Network:
        flat, weights, at = np.frombuffer(data, np.float32).copy(), {}, 0
        for name, size in shape.sizes().items():
            n = int(np.prod(size))
            weights[name] = flat[at : at + n].reshape(size)
            at += n
        return cls(shape, weights)

    def hidden_layer(self, around: np.ndarray) -> np.ndarray:
        """``around``: tokens at each offset (rows) of each example (columns)."""
        total = self.weights["embed"][0].take(around[0], axis=0)
        total += self.weights["bias"]
        for i in range(1, len(around)):
            total += self.weights["embed"][i].take(around[i], axis=0)
        return np.tanh(total, out=total)

    def log_probabilities(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log-probability of each target given what stands around it."""
        w, n = self.weights, len(target)
        order = _in_order(target, self.shape.tokens)
        target = target[order]
        h, (of, member) = self.hidden_layer(around[:, order]), np.divmod(target, self.shape.members)
        found = _log_softmax_of(_layer(w["classes"], w["class_bias"], h), of)
        for c, a, b in _class_runs(of, self.shape.classes):
            found[a:b] += _log_softmax_of(_layer(w["members"][c], w["member_bias"][c], h[a:b]), member[a:b])
        result = np.empty(n, found.dtype)
        result[order] = found
        return result

    def learn(self, around: np.ndarray, target: np.ndarray, squares: dict[str, np.ndarray], rate: float = RATE) -> None:
        """One step of gradient descent on the mean negative log-probability; step sizes shrink by past squares.

        Examples are put in order of their targets, so that those of a class are one slice of every array.
        """
        w, n = self.weights, len(target)
        order = _in_order(target, self.shape.tokens)
        around, target = around[:, order], target[order]
        h, (of, member) = self.hidden_layer(around), np.divmod(target, self.shape.members)
        error = _softmax_error(_layer(w["classes"], w["class_bias"], h), of)
        back = error.T @ w["classes"].T
        steps = {"classes": (error @ h).T, "class_bias": error.sum(axis=1)}
        steps["members"], steps["member_bias"] = np.zeros_like(w["members"]), np.zeros_like(w["member_bias"])
        for c, a, b in _class_runs(of, self.shape.classes):
            error = _softmax_error(_layer(w["members"][c], w["member_bias"][c], h[a:b]), member[a:b])
            back[a:b] += error.T @ w["members"][c].T
            steps["members"][c], steps["member_bias"][c] = (error @ h[a:b]).T, error.sum(axis=1)
        h *= h
        back *= np.subtract(1, h, out=h)
        steps["bias"] = back.sum(axis=0)
        for name, step in steps.items():
            step *= np.float32(1 / n)
            squares[name] += step * step
            step *= rate
            w[name] -= np.divide(step, np.sqrt(squares[name] + 1e-8), out=step)
        for i, tokens in enumerate(around):
            order = _in_order(tokens, self.shape.tokens + 1)
            tokens = tokens[order]
            begin = np.concatenate([[0], np.flatnonzero(tokens[1:] != tokens[:-1]) + 1])
            token = tokens[begin]
            step = np.add.reduceat(back.take(order, axis=0), begin, axis=0) * np.float32(1 / n)
            past = squares["embed"][i][token] + step * step
            squares["embed"][i][token] = past
            w["embed"][i][token] -= rate * step / np.sqrt(past + 1e-8)


def _layer(weights: np.ndarray, bias: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Outputs (rows) of each example (columns): sums over outputs then run along whole rows."""
    x = weights.T @ h.T
    x += bias[:, None]
    x -= x.max(axis=0)
    return x


def _log_softmax_of(x: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The log-probability of the chosen output of each example; ``x`` is overwritten."""
    found = x[chosen, np.arange(x.shape[1])]
    return found - np.log(np.exp(x, out=x).sum(axis=0))


def _softmax_error(x: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Probabilities less 1 for the chosen output of each example, in place of ``x``."""
    np.exp(x, out=x)
    x /= x.sum(axis=0)
    x[chosen, np.arange(x.shape[1])] -= 1
    return x


def _in_order(tokens: np.ndarray, most: int) -> np.ndarray:
    """The order of tokens below ``most``; numpy sorts short numbers by their digits."""
    return np.argsort(tokens.astype(np.uint16) if most <= 1 << 16 else tokens, kind="stable")


def _class_runs(of: np.ndarray, classes: int) -> Iterator[tuple[int, int, int]]:
    """Class, begin and end of each run of the sorted classes ``of``."""
    at = np.searchsorted(of, np.arange(classes + 1)).tolist()
    for c in range(classes):
        if at[c] < at[c + 1]:
            yield c, at[c], at[c + 1]


def tokens_of(text: np.ndarray, starts: np.ndarray, vocabulary: np.ndarray, token: np.ndarray, shape: Shape):
    """Token, document and hash of each word; ``vocabulary`` has sorted word hashes and ``token`` their tokens."""
    hashes, first, _ = word_hashes(text, fold_table(SEPARATORS))
    spare = shape.known + (hashes % np.uint64(shape.spare)).astype(np.int64)
    if len(vocabulary):
        at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
        spare = np.where(vocabulary[at] == hashes, token[at], spare)
    return spare, np.searchsorted(starts, first, side="right") - 1, hashes


def spaced(tokens: np.ndarray, doc: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """The tokens with ``side`` tokens for the outside around each document, and the places of the former among them."""
    place = np.arange(len(tokens)) + shape.side * (doc + 1)
    padded = np.full(int(place[-1]) + shape.side + 1 if len(place) else 0, shape.tokens, np.int64)
    padded[place] = tokens
    return padded, place


def windows(padded: np.ndarray, place: np.ndarray, shape: Shape) -> np.ndarray:
    """The tokens around each place of ``padded``, in order of offset; outside the document the token after the last."""
    around = np.empty((2 * shape.side, len(place)), np.int64)
    for i, offset in enumerate([*range(-shape.side, 0), *range(1, shape.side + 1)]):
        padded.take(place + offset, out=around[i])
    return around


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n``: hashes of all words with their number; each slice of text sends a word once."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, text, _ in text_slices(batch.column("text"), 4 * SLICE):
                words, n = np.unique(word_hashes(text, fold_table(SEPARATORS))[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], ["word", "n"])

    found = docs.select("text").mapInArrow(count, "word long, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, shape: Shape) -> list[Row]:
    """The most frequent words, which are tokens of their own, in order of frequency."""
    return counts.orderBy(F.col("n").desc(), "word").limit(shape.known).collect()


def spare_token(word: Column, shape: Shape) -> Column:
    """Which of the ``spare`` tokens a word has; hashes are unsigned, longs are not."""
    signed = F.pmod(word, F.lit(shape.spare))
    return F.when(word < 0, F.pmod(signed + (1 << 64) % shape.spare, F.lit(shape.spare))).otherwise(signed)


def rare_words(counts: DataFrame, known: list[Row], shape: Shape) -> tuple[DataFrame, np.ndarray]:
    """``word, log_share`` of the counted words outside the vocabulary, and the logarithm of an uncounted word's share in each spare token."""
    # The vocabulary is a beginning of the counts in their order, so its last word tells which words are in it.
    last = known[-1] if len(known) == shape.known else Row(word=0, n=0)
    outside = (F.col("n") < last["n"]) | ((F.col("n") == last["n"]) & (F.col("word") > last["word"]))
    rare = counts.where(outside).withColumn("token", spare_token(F.col("word"), shape))
    totals = np.zeros(shape.spare)
    for row in rare.groupBy("token").agg(F.sum("n").alias("n")).collect():  # one row per spare token
        totals[row["token"]] = row["n"]
    total = F.element_at(F.array(*map(F.lit, totals.tolist())), (F.col("token") + 1).cast("int"))
    return rare.select("word", F.log(F.col("n") / total).alias("log_share")), -np.log1p(totals)


def targets(doc: np.ndarray, starts: np.ndarray, number: int, stride: int) -> np.ndarray:
    """The words that are targets in a round: by their places in their documents, however these are dealt to slices."""
    begin = np.searchsorted(doc, np.arange(len(starts)))
    return np.flatnonzero((np.arange(len(doc)) - begin[doc] + number) % stride == 0)


def _trained(docs: DataFrame, network: Network, words, number: int, stride: int) -> DataFrame:
    """``shard, n, weights``: the network as each partition trained it, and on how many examples."""
    shape, start = network.shape, network.packed()
    shared = docs.sparkSession.sparkContext.broadcast((start, *words))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, known, token = shared.value
        mine, seen, shard = Network.unpacked(shape, start), 0, None
        squares = {name: np.zeros_like(w) for name, w in mine.weights.items()}
        for batch in batches:
            shard = batch.column("shard")[0].as_py() if shard is None and len(batch) else shard
            for _, _, text, starts in text_slices(batch.column("text"), SLICE):
                tokens, doc, _ = tokens_of(text, starts, known, token, shape)
                at = targets(doc, starts, number, stride)
                padded, place = spaced(tokens, doc, shape)
                for i in range(0, len(at), BATCH):
                    part = at[i : i + BATCH]
                    mine.learn(windows(padded, place[part], shape), tokens[part], squares)
                    seen += len(part)
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([seen]), pa.array([mine.packed()], pa.binary())], ["shard", "n", "weights"])

    return docs.select(F.spark_partition_id().alias("shard"), "text").mapInArrow(train, "shard int, n long, weights binary")


def _average(group: pa.Table) -> pa.Table:
    rows = sorted(group.to_pylist(), key=lambda r: r["shard"])
    n = sum(r["n"] for r in rows)
    total = np.zeros(len(rows[0]["weights"]) // 4, np.float64)
    for r in rows:
        total += np.frombuffer(r["weights"], np.float32) * (r["n"] / n)
    return pa.table({"shard": pa.array([rows[0]["next"]], pa.int32()), "n": pa.array([n], pa.int64()),
                     "weights": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


def averaged(copies: DataFrame) -> bytes | None:
    """The weighted mean of all networks, ``AVERAGED`` at a time."""
    copies = written(copies, "networks")
    while (n := copies.count()) > 1:
        most = copies.agg(F.max("shard")).first()[0]
        # Shard numbers may have gaps, so it is their range that shrinks.
        grouped = copies.withColumn("next", F.floor(F.col("shard") / AVERAGED).cast("int")).groupBy("next")
        copies = written(grouped.applyInArrow(_average, "shard int, n long, weights binary"), "networks")
        if most == 0:
            raise AssertionError(f"{n} networks of one shard")
    row = copies.first()
    return row and bytes(row["weights"])


@dataclass(frozen=True)
class Model:
    network: Network
    words: tuple[np.ndarray, np.ndarray]  # sorted hashes of the vocabulary, and their tokens
    shares: DataFrame
    uncounted: np.ndarray


def fit(docs: DataFrame, shape: Shape = Shape(), rounds: int = ROUNDS, stride: int = STRIDE) -> Model:
    counts = written(word_counts(docs), "counts")
    known = vocabulary(counts, shape)
    hashes = np.array([r["word"] for r in known], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    words = hashes[order], order
    network = Network.begin(shape)
    for number in range(rounds):
        found = averaged(_trained(docs, network, words, number, stride))
        network = Network.unpacked(shape, found) if found else network
    return Model(network, words, *rare_words(counts, known, shape))


def _rare_of(tokens: np.ndarray, doc: np.ndarray, hashes: np.ndarray, n_docs: int, shape: Shape) -> pa.ListArray:
    """Per document its words outside the vocabulary, each once with its number."""
    rare = np.flatnonzero(tokens >= shape.known)
    rare = rare[np.lexsort((hashes[rare], doc[rare]))]
    word, of = hashes[rare], doc[rare]
    begin = np.flatnonzero((np.diff(word, prepend=word[:1]) != 0) | (np.diff(of, prepend=-1) != 0))
    pairs = pa.StructArray.from_arrays(
        [pa.array(word[begin].view(np.int64)), pa.array(np.diff(begin, append=len(rare)).astype(np.int64))], ["word", "n"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(of[begin], np.arange(n_docs + 1)).astype(np.int32)), pairs)


def token_scores(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, n_tokens, log_likelihood, rare`` of the tokens alone, with the words outside the vocabulary as ``word, n``."""
    shape = model.network.shape
    shared = docs.sparkSession.sparkContext.broadcast((model.network.packed(), *model.words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, known, token = shared.value
        network = Network.unpacked(shape, data)
        for batch in batches:
            for first, last, text, starts in text_slices(batch.column("text"), SLICE):
                tokens, doc, hashes = tokens_of(text, starts, known, token, shape)
                found, (padded, place) = np.zeros(len(tokens)), spaced(tokens, doc, shape)
                for i in range(0, len(tokens), SCORED):
                    at = slice(i, i + SCORED)
                    found[at] = network.log_probabilities(windows(padded, place[at], shape), tokens[at])
                n = np.bincount(doc, minlength=last - first)
                # Of no words at all, numpy counts in whole numbers.
                total = np.bincount(doc, found, minlength=last - first).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, last - first), pa.array(n), pa.array(total),
                     _rare_of(tokens, doc, hashes, last - first, shape)],
                    ["doc_id", "n_tokens", "log_likelihood", "rare"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, log_likelihood double, rare array<struct<word: bigint, n: bigint>>")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, n_tokens, log_likelihood, mean_log_likelihood``, one row per row of ``docs``."""
    # Written once, so that a row keeps its number whatever is lost later.
    rows = written(token_scores(docs, model).withColumn("row", F.monotonically_increasing_id()), "token_scores")
    uncounted = F.array(*map(F.lit, model.uncounted.tolist()))
    unseen = F.element_at(uncounted, (spare_token(F.col("word"), model.network.shape) + 1).cast("int"))
    # Words outside the vocabulary are rarer than each one in it, so no key of this join is a hot one.
    shares = (
        rows.select("row", F.inline("rare")).join(model.shares, "word", "left")
        .groupBy("row").agg(F.sum(F.col("n") * F.coalesce("log_share", unseen)).alias("of_rare"))
    )
    total = F.col("log_likelihood") + F.coalesce("of_rare", F.lit(0.0))
    return rows.join(shares, "row", "left").select(
        "doc_id", "n_tokens", total.alias("log_likelihood"),
        F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias("mean_log_likelihood"),
    )
