"""Running a transition array over many bytes at once with numpy, and reading text columns as bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# A byte that UTF-8 never contains; it stands between documents.
SEPARATOR = 0xFF
SLICE_BYTES = 3 << 20
LANE = 1024
WARM_UP = 64


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first, last, bytes, starts``: rows of a text column as one byte array, a separator after each.

    A slice has about ``most`` bytes, or one longer text.  ``starts`` has the first byte of each row and the end.
    Null is empty.
    """
    column = column.cast(pa.large_binary()) if not pa.types.is_binary(column.type) else column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1)
        sizes = np.diff(offsets[first : last + 1])
        starts = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes + 1, out=starts[1:])
        joined = np.full(starts[-1], SEPARATOR, np.uint8)
        inside = np.ones(starts[-1], bool)
        inside[starts[1:] - 1] = False
        joined[inside] = data[offsets[first] : offsets[last]]
        yield first, last, joined, starts
        first = last


def _run(table: np.ndarray, columns: np.ndarray, state: np.ndarray, limit: int, marks: np.ndarray | None) -> np.ndarray:
    at = np.empty(len(state), np.int64)
    for step in range(len(columns)):
        np.add(state, columns[step], out=at)
        state = table.take(at)
        if marks is not None:
            np.less(state, limit, out=marks[step])
    return state


def marked(symbols: np.ndarray, table: np.ndarray, start: int, limit: int, lane: int = LANE) -> np.ndarray:
    """For each symbol, whether the state after it is below ``limit``.

    ``table[state + symbol]`` is the next state; states are multiples of the number of symbols.  Symbol 0 must
    lead to ``start`` from every state.  The array is cut into lanes that advance together.  A lane
    begins with the state reached over the end of the lane before it; those that
    turn out to have begun wrong are run again, so the result is that of one pass.
    """
    lanes = -(-len(symbols) // lane)
    padded = np.zeros(lanes * lane, symbols.dtype)
    padded[: len(symbols)] = symbols
    columns = np.ascontiguousarray(padded.reshape(lanes, lane).T)
    begun = np.full(lanes, start, table.dtype)
    begun[1:] = _run(table, columns[-WARM_UP:, :-1], begun[1:], limit, None)
    marks = np.empty((lane, lanes), bool)
    ended = _run(table, columns, begun, limit, marks)
    while len(wrong := np.flatnonzero(ended[:-1] != begun[1:]) + 1):
        begun[wrong] = ended[wrong - 1]
        again = np.empty((lane, len(wrong)), bool)
        ended[wrong] = _run(table, np.ascontiguousarray(columns[:, wrong]), begun[wrong], limit, again)
        marks[:, wrong] = again
    return np.ascontiguousarray(marks.T).reshape(-1)[: len(symbols)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def multipliers(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit numbers."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def word_hashes(text: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``hashes, starts, ends`` of the words in bytes; ``fold`` maps a byte to what is hashed, 0 between words."""
    folded = fold[text]
    inside = folded != 0
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    if len(starts) == 0:
        return np.zeros(0, np.uint64), starts, ends
    lengths = ends - starts
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(lengths.sum()) - np.repeat(first, lengths)
    terms = multipliers(int(lengths.max()), 1)[place]
    terms *= folded[inside]
    return mixed(np.add.reduceat(terms, first) + lengths.astype(np.uint64)), starts, ends


def fold_table(separators: bytes) -> np.ndarray:
    """``fold`` for words between ``separators`` with A-Z lower-cased; values are the byte + 1."""
    fold = np.arange(1, 257, dtype=np.uint64)
    fold[ord("A") : ord("Z") + 1] += np.uint64(32)
    fold[np.frombuffer(separators, np.uint8)] = 0
    fold[SEPARATOR] = 0
    return fold
