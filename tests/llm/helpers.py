"""Small tables with awkward rows, and brute-force versions of the operators."""

from __future__ import annotations

import random
import re

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
TO_LOWER = str.maketrans(UPPER, UPPER.lower())
BLANKS = r"[^\x20\x09-\x0D]+"

# Columns whose names the operators use inside, to show that they do not clash.
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, copies long, size long, n_lines long, _doc string"


def words(text: str | None) -> list[str]:
    return re.findall(BLANKS, (text or "").translate(TO_LOWER))


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdeghilnorstué") for _ in range(rng.randint(2, 9))) for _ in range(n))


def documents(spark, rows: list[tuple], clash: bool = False):
    """A table of documents from ``(doc_id, text, lang, source)``, with clashing columns if wanted."""
    if not clash:
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return spark.createDataFrame([(*r, len(r[1] or ""), 7, 7, 7, "x") for r in rows], CLASHING)


def awkward_rows() -> list[tuple]:
    """Nulls, empty and long texts, ties and repeated rows."""
    rng = random.Random(5)
    long_text = sentence(rng, 3000) + "\n" + sentence(rng, 2000)
    shared = sentence(rng, 70)
    return [
        (1, None, None, None), (2, "", "en", "a"), (3, " \n\t\n", None, "a"), (4, long_text, "en", None),
        (5, long_text + " end", "en", "b"), (6, "One Short line\nsecond ünï line here\nx", "de", "b"),
        (7, "one short LINE \nsecond ünï line here\nx", "de", "b"), (7, "one short LINE \nsecond ünï line here\nx", "de", "b"),
        (8, sentence(rng, 40) + " " + shared + " " + sentence(rng, 30), "en", "c"),
        (9, sentence(rng, 20) + " " + shared + " " + sentence(rng, 50), "en", "c"),
        (None, "a document without an id, of more than five words", "en", "a"),
        (None, "another document without an id, quite unlike the first", None, "a"),
        (10, "12345 67890 --- !!!", None, "a"), (11, "word", "en", "é"), (12, "word", "en", "Z"),
    ]


def components(nodes, links) -> dict:
    """The smallest node that each node reaches."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def shingles(text: str | None, n: int = 5) -> frozenset:
    w = words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))) if w else frozenset()
