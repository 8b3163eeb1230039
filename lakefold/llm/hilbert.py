"""The Hilbert curve through a grid of any few dimensions, as column expressions and for numpy.

From the top bit down, the bits of all coordinates at one level make a label.  A state, which is how the curve
lies in the present cell (its entry corner and its direction), turns the label into the next digit of the index and
into the state of the sub-cell.  Neighbours on the curve are neighbours in the grid.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# The table of steps has dims * 4 ** dims entries.
MOST_DIMS = 8


def _turn_left(x, by: int, dims: int):
    by %= dims
    return (x << by | x >> (dims - by)) & ((1 << dims) - 1)


def _trailing_ones(x: int) -> int:
    return ((x ^ (x + 1)).bit_length() - 1) if x & 1 else 0


def steps(dims: int) -> np.ndarray:
    """``table[state << dims | label] = next_state << dims | digit``; a state is ``entry * dims + direction``."""
    if not 1 <= dims <= MOST_DIMS:
        raise ValueError(f"a curve has 1 to {MOST_DIMS} dimensions, not {dims}")
    cells = 1 << dims
    table = np.zeros(cells * dims * cells, np.int64)
    digits = np.arange(cells)
    entry = np.maximum(digits - 1, 0) // 2 * 2
    entry ^= entry >> 1
    turn = np.array([0 if w == 0 else _trailing_ones(w if w & 1 else w - 1) % dims for w in range(cells)])
    for corner in range(cells):
        for direction in range(dims):
            # The label of each digit: its Gray code, turned and reflected as the cell lies.
            label = _turn_left(digits ^ digits >> 1, direction + 1, dims) ^ corner
            after = corner ^ _turn_left(entry, direction + 1, dims)
            state = after * dims + (direction + turn + 1) % dims
            table[(corner * dims + direction << dims) + label] = state << dims | digits
    return table


def curve_index(cells: list[Column], bits: int) -> Column:
    """The place on the curve of a cell, from its coordinates (0 to ``2 ** bits - 1``); null if one is null."""
    dims = len(cells)
    table = F.lit([int(x) for x in steps(dims)])
    labels = []
    for level in reversed(range(bits)):
        label = F.lit(0)
        for i, cell in enumerate(cells):
            label = label.bitwiseOR(F.shiftleft(F.shiftright(cell.cast("int"), level).bitwiseAND(F.lit(1)), i))
        labels.append(label)

    def step(acc: Column, label: Column) -> Column:
        found = F.get(table, F.shiftleft(acc["state"], dims).bitwiseOR(label))
        digit = found.bitwiseAND(F.lit((1 << dims) - 1))
        return F.struct(
            F.shiftright(found, dims).cast("int").alias("state"),
            F.shiftleft(acc["place"], dims).bitwiseOR(digit).cast("long").alias("place"),
        )

    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("place"))
    return F.aggregate(F.array(*labels), start, step)["place"]


def curve_places(cells: np.ndarray, bits: int) -> np.ndarray:
    """``curve_index`` of the rows of an integer matrix."""
    n, dims = cells.shape
    table = steps(dims)
    state, place = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for level in reversed(range(bits)):
        label = ((cells >> level & 1) << np.arange(dims)).sum(axis=1) if dims else state
        found = table[state << dims | label]
        state, place = found >> dims, place << dims | found & (1 << dims) - 1
    return place
