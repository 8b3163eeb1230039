"""Language identification by cross-parsing.

Per language a suffix automaton of labelled text is built.  A document is parsed with it from left to right into the longest
phrases that occur in the language's text; the language that needs the fewest phrases, normalised as bits
per symbol, wins.  The automaton and the restart after each phrase are one transition array, so a pass over
the bytes counts the phrases of many documents at once.

The automata are fitted on a bounded sample: about ``SAMPLE_DOCS`` labelled documents per language, drawn by a hash of
their id, of which ``SAMPLE_SYMBOLS`` symbols are used.  Everything else reads whole texts.

Defined results: null text and text without a letter are ``und`` with score 0, as is every text if nothing was
learned; rows without a label teach nothing; a null doc_id counts as the empty id, which is held out; an empty
table gives an empty result; ties go to the language first in code-point order; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakefold.llm.common import column
from lakefold.llm.scan import SEPARATOR, marked, text_slices

UNDETERMINED = "und"
FOLDS = 5
SAMPLE_DOCS = 60
SAMPLE_SYMBOLS = 24_000
ROWS = 1000  # that are lower-cased together
BLANK = 1  # symbol of everything that is not a letter; 0 is the separator
UNSEEN = 2  # letters that no sample has


@dataclass(frozen=True)
class Parser:
    """Transition array of one language; a state below ``limit`` begins a phrase."""

    language: str
    table: np.ndarray
    limit: int
    bits_per_phrase: float


@dataclass(frozen=True)
class Model:
    symbol: np.ndarray
    parsers: tuple[Parser, ...]


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def _symbols(text: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of lower-cased bytes with runs of blanks as one, and which bytes were kept."""
    symbols = symbol[text]
    kept = symbols != BLANK
    kept[1:] |= symbols[:-1] != BLANK
    return symbols[kept], kept


def suffix_automaton(symbols: list[int], n_symbols: int) -> np.ndarray:
    """Transitions (-1: none) of the automaton of all substrings; state 0 is the empty one."""
    ways, link, length, last = [[-1] * n_symbols], [-1], [0], 0
    for s in symbols:
        new = len(ways)
        ways.append([-1] * n_symbols)
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and ways[p][s] < 0:
            ways[p][s] = new
            p = link[p]
        if p >= 0:
            q = ways[p][s]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                clone = len(ways)
                ways.append(ways[q][:])
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and ways[p][s] == q:
                    ways[p][s] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return np.array(ways, np.int32)


def phrase_table(ways: np.ndarray) -> np.ndarray:
    """One array for parsing: where a symbol cannot extend the phrase, it begins the next one.

    State s < n_symbols means "a phrase has just begun with symbol s"; automaton states follow.  Values are states times
    n_symbols.
    """
    n = ways.shape[1]
    begins = np.arange(n, dtype=np.int32)
    table = np.empty((n + len(ways), n), np.int32)
    table[n:] = np.where(ways >= 0, ways + n, begins)
    for s in range(n):  # a begun phrase goes on like the automaton's state after one symbol
        table[s] = table[n + ways[0, s]] if ways[0, s] >= 0 else begins
    table[:, 0] = 0  # a separator ends every phrase
    return table * n


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_symbols: int = SAMPLE_SYMBOLS) -> Model:
    """Automata of the languages in ``docs`` (``doc_id, text, lang``), from documents that are not held out."""
    taught = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {row["lang"]: row["n"] for row in taught.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for language, n in counts.items():
        share = F.when(F.col("lang") == language, min(1.0, sample_docs / n)).otherwise(share)
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    # A sampled text is cut at what can be used of it, which bounds what reaches the driver.
    sample = (
        taught.where(place < share).select("lang", place.alias("place"), F.substring("text", 1, sample_symbols).alias("text"))
        .collect()
    )
    texts: dict[str, list[str]] = {language: [] for language in sorted(counts)}
    for row in sorted(sample, key=lambda r: (r["lang"], r["place"], r["text"])):
        texts[row["lang"]].append(row["text"].lower())
    joined = {language: " ".join(parts).encode() for language, parts in texts.items() if parts}
    seen = sorted({b for text in joined.values() for b in text if b >= 0x80} | set(range(ord("a"), ord("z") + 1)))
    symbol = np.full(256, BLANK, np.uint8)
    symbol[0x80:] = UNSEEN
    symbol[seen] = np.arange(UNSEEN + 1, UNSEEN + 1 + len(seen))
    symbol[SEPARATOR] = 0
    n_symbols = UNSEEN + 1 + len(seen)
    parsers = []
    for language, text in joined.items():
        symbols = _symbols(np.frombuffer(text, np.uint8), symbol)[0][:sample_symbols]
        table = phrase_table(suffix_automaton(symbols.tolist(), n_symbols))
        parsers.append(Parser(language, table.reshape(-1), n_symbols * n_symbols, float(np.log2(len(symbols) + 1))))
    return Model(symbol, tuple(parsers))


def bits(model: Model, text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Bits per symbol of each document (rows) in each language (columns)."""
    symbols, kept = _symbols(text, model.symbol)
    # A separator is always kept, so every document has a symbol.
    ends = np.concatenate([[0], np.cumsum(np.add.reduceat(kept, starts[:-1], dtype=np.int64))])
    sizes = np.maximum(np.diff(ends) - 1, 1)  # without the separator
    found = np.empty((len(starts) - 1, len(model.parsers)))
    for i, parser in enumerate(model.parsers):
        begun = marked(symbols, parser.table, 0, parser.limit) & (symbols != 0)
        # Sums between the places of the documents; the separator at the end of each has none of its own.
        found[:, i] = np.add.reduceat(begun, ends[:-1], dtype=np.int64) * parser.bits_per_phrase / sizes
    return found


def predict(docs: DataFrame, model: Model, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (in place of columns of these names): how much better the winner is than the next language, 0 to 1.

    Without ``keep_text`` the texts are read but not handed back.
    """
    columns = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    returned = [c for c in columns if keep_text or c != "text"]
    # Plain arrays: a broadcast value is unpickled by executors that need not have this package.
    plain_model = (model.symbol, [(p.language, p.table, p.limit, p.bits_per_phrase) for p in model.parsers])
    shared = docs.sparkSession.sparkContext.broadcast(plain_model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbol, parsers = shared.value
        model = Model(symbol, tuple(Parser(*p) for p in parsers))
        names = np.array([p.language for p in model.parsers], object)
        for part in (b.slice(i, ROWS) for b in batches for i in range(0, len(b), ROWS)):
            for first, last, text, starts in text_slices(pc.utf8_lower(part.column("text"))):
                rows = part.slice(first, last - first)
                worded = np.array([x is not None and any(map(str.isalpha, x))
                                   for x in rows.column("text").to_pylist()], bool)
                languages = np.full(len(rows), UNDETERMINED, object)
                score = np.zeros(len(rows))
                if len(names):
                    found = bits(model, text, starts)
                    best = found.argmin(axis=1)
                    lowest = np.sort(found, axis=1)
                    languages[worded] = names[best[worded]]
                    if len(names) > 1:
                        score[worded] = (1 - lowest[:, 0] / np.maximum(lowest[:, 1], 1e-9))[worded]
                    else:
                        score[worded] = 1.0
                kept = rows.select(returned)
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array(languages, pa.string()), pa.array(score)], [*returned, "lang_pred", "score"]
                )

    plain = docs.select(*columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields if f.name in returned)
    return plain.mapInArrow(scan, f"{schema}, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """The documents whose language is one that was learned, with their own columns, whatever the names of these."""
    numbered = {c: c if c == "text" else f"column_{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(*(column(c).alias(n) for c, n in numbered.items()))
    known = predict(plain, model).where(F.col("lang_pred") != UNDETERMINED)
    return known.select(*(F.col(n).alias(c) for c, n in numbered.items()))
