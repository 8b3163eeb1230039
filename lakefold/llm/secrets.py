"""Secret scans with one combined deterministic automaton.

All rule patterns become one automaton of bytes by subset construction, minimised, as a transition array.  It reads patterns backwards,
so one pass over the bytes marks every place where a match of any rule starts.  From those places a second automaton,
the same rules forwards, finds the longest end; matches of a rule are taken from the left and do not overlap.

Rules with a least length have it in the pattern where that is equivalent (a run of one class: a run that is too
short holds no other match); for ``assign`` it is checked after matching, as a short value still uses up its text.

Defined results: null text is empty; each row is scanned by itself, so repeated rows give equal results; an empty table gives an
empty result; only ``doc_id, text`` are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakefold.llm.scan import SEPARATOR, marked, text_slices


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: bytes
    group: int = 0
    least: int = 0


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The rules of the contract, in their order.
BASE = (
    Rule(
        "assign",
        ("(" + "|".join(map(either_case, ("password", "passwd", "secret", "token", "api_?key")))
         + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""").encode(),
        group=2, least=12,
    ),
    Rule("access", rb"AKIA[A-Z0-9]{14,}"),
    Rule("hex", rb"[0-9a-f]{16,}"),
)
MORE = (
    Rule("pem", rb"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", rb"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + MORE


class _Nfa:
    """States with byte edges and empty edges, built from a parsed pattern."""

    def __init__(self) -> None:
        self.edges: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[set[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.empty.append(set())
        return len(self.edges) - 1

    def add(self, parsed, at: int) -> int:
        """Append a parsed pattern behind state ``at``; the state behind it."""
        for op, value in parsed:
            at = self._item(str(op), value, at)
        return at

    def _item(self, op: str, value, at: int) -> int:
        if op == "SUBPATTERN":
            return self.add(value[3], at)
        end = self.state()
        if op == "BRANCH":
            for option in value[1]:
                self.empty[self.add(option, at)].add(end)
        elif op == "MAX_REPEAT":
            least, most, part = value
            for _ in range(least):
                at = self.add(part, at)
            if most is re._parser.MAXREPEAT:
                loop = self.state()
                self.empty[at].add(loop)
                self.empty[self.add(part, loop)].add(loop)
                at = loop
            else:
                for _ in range(most - least):
                    self.empty[at].add(end)
                    at = self.add(part, at)
            self.empty[at].add(end)
        elif op == "LITERAL":
            self.edges[at].append((frozenset([value]), end))
        elif op == "IN":
            wanted: set[int] = set()
            for kind, x in value:
                wanted |= {x} if str(kind) == "LITERAL" else set(range(x[0], x[1] + 1)) if str(kind) == "RANGE" else set()
            if str(value[0][0]) == "NEGATE":
                wanted = set(range(SEPARATOR)) - wanted
            self.edges[at].append((frozenset(wanted), end))
        else:
            raise ValueError(f"patterns with {op} are not supported")
        return end

    def closed(self, states) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for other in self.empty[todo.pop()] - found:
                found.add(other)
                todo.append(other)
        return frozenset(found)

    def reversed(self) -> _Nfa:
        other = _Nfa()
        for _ in self.edges:
            other.state()
        for state, edges in enumerate(self.edges):
            for wanted, target in edges:
                other.edges[target].append((wanted, state))
            for target in self.empty[state]:
                other.empty[target].add(state)
        return other


@dataclass(frozen=True)
class Automaton:
    """``table[state, symbol]`` is the next state; ``accepts[state]`` has bit k if rule k ends here, ``alive[state]`` if it
    ends here or behind any further symbols."""

    symbol: np.ndarray
    n_symbols: int
    table: np.ndarray
    accepts: np.ndarray
    start: int
    alive: np.ndarray


def _determined(nfa: _Nfa, starts: set[int], ends: list[int], everywhere: bool) -> Automaton:
    # Bytes that no edge tells apart are one symbol; symbol 0 is the separator.
    signature = [tuple(b in wanted for edges in nfa.edges for wanted, _ in edges) for b in range(256)]
    kinds = {s: i + 1 for i, s in enumerate(dict.fromkeys(signature[:SEPARATOR]))}
    symbol = np.array([kinds[s] for s in signature[:SEPARATOR]] + [0], np.uint8)
    example = {v: b for b, v in reversed(list(enumerate(symbol[:SEPARATOR])))}
    begin = nfa.closed(starts)
    number: dict[frozenset[int], int] = {frozenset(): 0}
    number.setdefault(begin, len(number))
    todo, rows = list(number), {}
    while todo:
        states = todo.pop()
        row = [begin if everywhere else frozenset()]
        for s in range(1, len(kinds) + 1):
            byte = int(example[s])
            reached = {t for q in states for wanted, t in nfa.edges[q] if byte in wanted}
            row.append(nfa.closed(reached | (starts if everywhere else set())) if reached or everywhere else frozenset())
        for target in row:
            if target not in number:
                number[target] = len(number)
                todo.append(target)
        rows[states] = [number[target] for target in row]
    order = sorted(rows, key=number.get)
    table = np.array([rows[states] for states in order], np.int64)
    accepts = np.array([sum(1 << k for k, end in enumerate(ends) if end in states) for states in order], np.int64)
    block = np.unique(accepts, return_inverse=True)[1]
    while True:  # split blocks of states until equal ones lead to equal ones
        refined = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)[1].reshape(-1)
        if refined.max() == block.max():
            break
        block = refined
    # Accepting blocks come first, so that one comparison tells them.
    one = np.unique(block, return_index=True)[1]
    rank = np.empty(len(one), np.int64)
    rank[np.argsort(accepts[one] == 0, kind="stable")] = np.arange(len(one))
    by_rank = one[np.argsort(rank)]
    table, accepts = rank[block[table[by_rank]]], accepts[by_rank]
    alive, before = accepts, None
    while before is None or (alive != before).any():
        alive, before = alive | np.bitwise_or.reduce(alive[table], axis=1), alive
    return Automaton(symbol, len(kinds) + 1, table, accepts, int(rank[block[number[begin]]]), alive)


@dataclass(frozen=True)
class Scanner:
    """Rules with their two automata: the backward one runs everywhere, the forward one from a start."""

    rules: tuple[Rule, ...]
    backward: Automaton
    forward: Automaton
    first_bytes: tuple[np.ndarray, ...]


def compiled(rules: tuple[Rule, ...] = RULES) -> Scanner:
    nfa, starts, ends, first_bytes = _Nfa(), [], [], []
    for rule in rules:
        starts.append(nfa.state())
        ends.append(nfa.add(re._parser.parse(rule.pattern), starts[-1]))
        may = np.zeros(256, bool)
        for state in nfa.closed([starts[-1]]):
            for wanted, _ in nfa.edges[state]:
                may[list(wanted)] = True
        first_bytes.append(may)
    return Scanner(
        rules, _determined(nfa.reversed(), set(ends), starts, everywhere=True),
        _determined(nfa, set(starts), ends, everywhere=False), tuple(first_bytes),
    )


def _longest(table: list, accepts: list[bool], alive: list[bool], state: int, symbols: bytes, start: int) -> int:
    """The end of the longest match of a rule from ``start``, or ``start``; stops where this rule cannot match any more."""
    end = start
    for at in range(start, len(symbols)):
        state = table[state][symbols[at]]
        if accepts[state]:
            end = at + 1
        elif not alive[state]:
            break
    return end


def scan_bytes(text: np.ndarray, scanner: Scanner) -> list[tuple[int, int, int]]:
    """``rule, start, end`` of all matches in bytes that may hold separators, by rule and start."""
    backward, forward = scanner.backward, scanner.forward
    n = backward.n_symbols
    limit = int((backward.accepts != 0).sum()) * n
    flat = (backward.table * n).reshape(-1).astype(np.int32)
    symbols = backward.symbol[text[::-1]]
    hits = np.flatnonzero(marked(symbols, flat, backward.start * n, limit)[::-1])
    found = []
    if not len(hits):
        return found
    # Which rules match at a marked place is told by a run forwards from it.
    table, forward_symbols = forward.table.tolist(), forward.symbol[text].tobytes()
    for number, rule in enumerate(scanner.rules):
        pattern = re.compile(rule.pattern)
        accepts, alive = ((bits >> number & 1).astype(bool).tolist() for bits in (forward.accepts, forward.alive))
        starts = hits[scanner.first_bytes[number][text[hits]]]
        place = 0
        while place < len(starts):
            start = int(starts[place])
            end = _longest(table, accepts, alive, forward.start, forward_symbols, start)
            if end > start:
                match = pattern.fullmatch(text[start:end].tobytes())
                if len(match.group(rule.group)) >= rule.least:
                    found.append((number, start, end))
                place = int(np.searchsorted(starts, end))
            else:
                place += 1
    return found


def _document(doc: np.ndarray, matches: list[tuple[int, int, int]], rules, n_base: int) -> tuple:
    """The result columns of one document from its matches, offsets in code points."""
    before = np.concatenate([[0], np.cumsum((doc & 0xC0) != 0x80)])
    spans = sorted((int(before[start]), rule, int(before[end])) for rule, start, end in matches)
    shown = [f"{rules[rule].kind}:{start}:{end}" for start, rule, end in spans]
    base = [text for text, (_, rule, _) in zip(shown, spans) if rule < n_base]
    counts = [sum(rule == k for _, rule, _ in spans) for k in range(n_base)]
    return (*counts, hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(shown))


def find_secrets(docs: DataFrame, more: tuple[Rule, ...] = MORE) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans``, one row per row of ``docs``."""
    rules = BASE + more
    scanner = compiled(rules)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = _document(np.zeros(0, np.uint8), [], rules, len(BASE))
        for batch in batches:
            for first, last, text, starts in text_slices(batch.column("text")):
                by_doc: dict[int, list[tuple[int, int, int]]] = {}
                for rule, start, end in scan_bytes(text, scanner):
                    doc = int(np.searchsorted(starts, start, side="right")) - 1
                    by_doc.setdefault(doc, []).append((rule, start - int(starts[doc]), end - int(starts[doc])))
                rows = [nothing] * (last - first)
                for doc, matches in by_doc.items():
                    rows[doc] = _document(text[starts[doc] : starts[doc + 1] - 1], matches, rules, len(BASE))
                n_assign, n_access, n_hex, base, spans = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, last - first), pa.array(n_assign, pa.int64()),
                     pa.array(n_access, pa.int64()), pa.array(n_hex, pa.int64()), pa.array(base), pa.array(spans)],
                    ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        scan, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )
