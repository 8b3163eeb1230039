"""N-gram Jaccard join: documents whose sets of word shingles have a Jaccard similarity of at least 0.8.

1. One pass over the texts makes the set of shingle hashes of each document.  Equal sets are one *node*, named by a hash of the set.
   Sets travel as packed arrays, a few rows per slice of text, to the tasks that count each shingle.
2. A shingle that only one node has cannot link anything.  What returns to the nodes is their shared shingles with the
   number of nodes that have them; ordered rare-first, with the unshared ones before all.  A node with less than
   0.8 of its shingles shared has no partner.
3. Prefix filter: nodes that link share a shingle in their prefixes, the first ``n - ceil(0.8 n) + 1`` in that order.
   Nodes that meet at a prefix shingle pass the length and the positional filter and a bitmap bound, each pair once, then
   the suffix filter and the exact overlap.
4. Components only need enough links: first the nodes of each prefix list meet one hub of it, are verified and connected, and
   at last all pairs that meet in a list but are in different components.  So a large group of near copies costs a pair
   per member, not all pairs, and no link between components is left out.

A shingle that many documents of one slice hold is known to be shared and frequent there.  It is ordered after
all others by everyone, and only a mark of it travels, so a shingle in a third of all documents fills no task.

Shingles are told apart by 48 bits of a 64-bit hash in steps 2 to 4 and nodes by 64 bits; a pair of documents of
500 shingles meets a false agreement of one shingle with a chance of about 1e-9.

Defined results: null or wordless text has an empty set and links with nothing (its component is itself); fewer words than a
shingle are one shingle; rows without doc_id link like others, and a component of only such rows is named null; repeated rows
are copies of each other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakefold.llm.common import broadcast_if_small, written
from lakefold.llm.components import connected
from lakefold.llm.scan import fold_table, mixed, multipliers, text_slices, word_hashes

WORDS = 5
SPACE = b"\t\n\x0b\x0c\r "
SLICE = 1 << 20
FLUSH = 800_000  # shingles that are packed together
HOT = 64  # nodes of one flush that make a shingle frequent
SKETCH = 8  # words of 64 bits
ROUNDS = 2
COUNTED = 4  # parts in which a task counts its shingles
LAST_ID = 2**63 - 1
PRINT_MASK = np.uint64((1 << 48) - 1)
FREQUENT = np.uint32(0xFFFFFFFF)
POSTINGS, MARKS, KNOWN, DOCUMENTS = range(4)
# Of documents, ``counts`` are set sizes, ``prints`` ids and ``extra`` hashes of texts.
PACKED = "bucket int, kind int, nodes binary, counts binary, prints binary, extra binary"
PACKED_ARROW = pa.schema([("bucket", pa.int32()), ("kind", pa.int32())]
                         + [(c, pa.binary()) for c in ("nodes", "counts", "prints", "extra")])
SETS = (
    "doc_id long, text_hash long, n long, node long, shared int, prefix array<long>, sketch array<long>, prints binary"
)


def needed(n: int) -> int:
    """Least overlap of a set of ``n`` with any partner: ceil(0.8 n)."""
    return -(-4 * n // 5)


def overlap_needed(a, b):
    """Least overlap of sets of a and b shingles with 100 * overlap >= 80 * union: ceil(4 (a + b) / 9)."""
    return -(-4 * (a + b) // 9)


def shingle_sets(text: np.ndarray, starts: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each document, and their number per document."""
    hashes, first, _ = word_hashes(text, fold_table(SPACE))
    n_docs = len(starts) - 1
    doc = np.searchsorted(starts, first, side="right") - 1
    factor = multipliers(words, 2)
    total = np.zeros(max(len(hashes) - words + 1, 0), np.uint64)
    for i in range(words):
        total += hashes[i : i + len(total)] * factor[i]
    whole = doc[: len(total)] == doc[words - 1 :] if len(total) else np.zeros(0, bool)
    shingles, owner = mixed(total[whole]), doc[: len(total)][whole]
    per_doc = np.bincount(doc, minlength=n_docs)
    short = np.flatnonzero((per_doc > 0) & (per_doc < words))
    if len(short):
        begin = np.searchsorted(doc, short)
        extra = np.array([int(((hashes[b : b + k] * factor[:k]).sum() + np.uint64(k)) & np.uint64(2**64 - 1))
                          for b, k in zip(begin, per_doc[short])], np.uint64)
        shingles, owner = np.concatenate([shingles, mixed(extra)]), np.concatenate([owner, short])
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    new = np.ones(len(shingles), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    return shingles[new], np.bincount(owner[new], minlength=n_docs)


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def _pack(prints: np.ndarray) -> bytes:
    return prints.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(data: bytes) -> np.ndarray:
    six = np.frombuffer(data, np.uint8).reshape(-1, 6)
    eight = np.zeros((len(six), 8), np.uint8)
    eight[:, :6] = six
    return eight.reshape(-1).view("<u8")


def _by_node(kind, target, nodes, prints, extra=None) -> Iterator[tuple]:
    """Packed rows of entries ``node, print``, one per value of ``target``, sorted by node."""
    order = np.lexsort((nodes, target))
    target, nodes, prints = target[order], nodes[order], prints[order]
    extra = None if extra is None else extra[order]
    cuts = np.flatnonzero(np.diff(target, prepend=-1, append=-1))
    for a, b in zip(cuts[:-1], cuts[1:]):
        head = np.flatnonzero(np.diff(nodes[a:b], prepend=~nodes[a]))
        yield (int(target[a]), kind, nodes[a:b][head].tobytes(), np.diff(head, append=b - a).astype(np.int32).tobytes(),
               _pack(prints[a:b]), b"" if extra is None else extra[a:b].tobytes())


def _entries(rows) -> tuple[np.ndarray, np.ndarray]:
    """``node, print`` of each entry of packed rows."""
    counts = np.frombuffer(b"".join(r["counts"] for r in rows), np.int32)
    nodes = np.frombuffer(b"".join(r["nodes"] for r in rows), np.uint64)
    return np.repeat(nodes, counts), _unpack(b"".join(r["prints"] for r in rows))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(PACKED_ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PACKED_ARROW)], schema=PACKED_ARROW)


def _flush(parts: list[tuple], buckets: int, hot: int) -> pa.RecordBatch:
    """Packed rows of slices of sets: postings by shingle, marks of frequent ones, and the documents."""
    ids, texts, counts, shingles = (np.concatenate(x) for x in zip(*parts))
    node = _sums(mixed(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)), counts)
    many, rows = np.uint64(buckets), []
    home = (node % many).astype(np.int64)
    for bucket in np.unique(home):
        own = home == bucket
        rows.append((int(bucket), DOCUMENTS, node[own].tobytes(), counts[own].astype(np.int32).tobytes(),
                     ids[own].tobytes(), texts[own].tobytes()))
    first = np.zeros(len(node), bool)
    first[np.unique(node, return_index=True)[1]] = True
    first &= counts > 0
    kept = np.repeat(first, counts)
    prints, nodes = shingles[kept] & PRINT_MASK, np.repeat(node, counts)[kept]
    ordered = np.sort(prints)
    value, begin = np.unique(ordered, return_index=True)
    frequent = value[np.diff(begin, append=len(ordered)) > hot]
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, prints), len(frequent) - 1)
        known = frequent[at] == prints
        rows += _by_node(KNOWN, (nodes[known] % many).astype(np.int64), nodes[known], prints[known])
        place = (frequent % many).astype(np.int64)
        for bucket in np.unique(place):
            rows.append((int(bucket), MARKS, b"", b"", _pack(frequent[place == bucket]), b""))
        prints, nodes = prints[~known], nodes[~known]
    rows += _by_node(POSTINGS, (prints % many).astype(np.int64), nodes, prints)
    return _batch(rows)


def _packed_sets(docs: DataFrame, words: int, buckets: int, hot: int) -> DataFrame:
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            ids = batch.column("doc_id").fill_null(LAST_ID).to_numpy(zero_copy_only=False)
            texts = batch.column("text_hash").to_numpy()
            for first, last, text, starts in text_slices(batch.column("text"), SLICE):
                shingles, counts = shingle_sets(text, starts, words)
                parts.append((ids[first:last], texts[first:last], counts, shingles))
                size += len(shingles)
                if size >= FLUSH:
                    yield _flush(parts, buckets, hot)
                    parts, size = [], 0
        if parts:
            yield _flush(parts, buckets, hot)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return plain.mapInArrow(sets, PACKED)


def _shared(nodes: np.ndarray, prints: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entries whose shingle more than one node has, with the number of such nodes."""
    if len(prints) == 0:
        return nodes, prints, np.zeros(0, np.uint32)
    order = np.lexsort((nodes, prints))
    nodes, prints = nodes[order], prints[order]
    new = np.ones(len(prints), bool)
    new[1:] = (prints[1:] != prints[:-1]) | (nodes[1:] != nodes[:-1])
    nodes, prints = nodes[new], prints[new]
    begin = np.flatnonzero(np.diff(prints, prepend=~prints[0]))
    run = np.diff(begin, append=len(prints))
    times = np.repeat(run, run).astype(np.uint32)
    if len(marks):
        at = np.minimum(np.searchsorted(marks, prints), len(marks) - 1)
        times[marks[at] == prints] = FREQUENT
    kept = times > 1
    return nodes[kept], prints[kept], times[kept]


def _count_shared(buckets: int):
    def count(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        out = [tuple(r.values()) for r in rows if r["kind"] in (KNOWN, DOCUMENTS)]
        postings = [r for r in rows if r["kind"] == POSTINGS]
        if postings:
            nodes, prints = _entries(postings)
            marks = np.unique(_unpack(b"".join(r["prints"] for r in rows if r["kind"] == MARKS)))
            shared = [[], [], []]
            # A part at a time, for the sake of memory; equal shingles are in one part.
            part = (prints // np.uint64(buckets)) % np.uint64(COUNTED)
            for number in range(COUNTED):
                own = part == number
                for column, values in zip(shared, _shared(nodes[own], prints[own], marks)):
                    column.append(values)
            nodes, prints, times = map(np.concatenate, shared)
            out += _by_node(POSTINGS, (nodes % np.uint64(buckets)).astype(np.int64), nodes, prints, times)
        return pa.Table.from_batches([_batch(out)])

    return count


def parity_sketch(prints: np.ndarray) -> list[int]:
    """Bits that tell for each hash value whether an odd number of shingles has it.

    Two sketches differ in at most as many bits as the sets have shingles that the other has not.
    """
    odd = (np.bincount((prints % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64).tolist()


def _assemble(group: pa.Table) -> pa.Table:
    """Documents as they are, and nodes that may have a partner with their shared shingles, rare-first."""
    rows, out, size = group.to_pylist(), [], {}
    for r in rows:
        if r["kind"] == DOCUMENTS:
            ids, sizes = np.frombuffer(r["prints"], np.int64), np.frombuffer(r["counts"], np.int32)
            node, texts = np.frombuffer(r["nodes"], np.int64), np.frombuffer(r["extra"], np.int64)
            out += zip(*(x.tolist() for x in (ids, texts, sizes, node)), *[[None] * len(ids)] * 4)
            size.update(zip(node.tolist(), sizes.tolist()))
    entries = [r for r in rows if r["kind"] in (POSTINGS, KNOWN)]
    if entries:
        nodes, prints = _entries(entries)
        times = np.concatenate([
            np.frombuffer(r["extra"], np.uint32) if r["kind"] == POSTINGS else np.full(len(r["prints"]) // 6, FREQUENT)
            for r in entries])
        order = np.lexsort((prints, times, nodes))
        nodes, prints = nodes[order], prints[order]
        new = np.ones(len(prints), bool)
        new[1:] = (prints[1:] != prints[:-1]) | (nodes[1:] != nodes[:-1])
        nodes, prints = nodes[new], prints[new]
        begin = np.flatnonzero(np.diff(nodes, prepend=~nodes[0]))
        for a, b in zip(begin, np.append(begin[1:], len(nodes))):
            node = int(nodes[a].astype(np.int64))
            n, shared = size[node], int(b - a)
            if shared >= needed(n):
                prefix = n - needed(n) + 1 - (n - shared)
                out.append((None, None, n, node, shared,
                            prints[a : a + prefix].astype(np.int64).tolist(), parity_sketch(prints[a:b]), prints[a:b].tobytes()))
    columns = list(zip(*out)) or [[]] * 8
    kinds = (*[pa.int64()] * 4, pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
    names = ("doc_id", "text_hash", "n", "node", "shared", "prefix", "sketch", "prints")
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def sets_and_nodes(docs: DataFrame, words: int = WORDS, hot: int = HOT) -> DataFrame:
    """Rows ``doc_id, text_hash, n, node`` of all documents, and rows with ``prefix`` of the nodes that may link."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = _packed_sets(docs, words, buckets, hot).groupBy("bucket").applyInArrow(_count_shared(buckets), PACKED)
    return written(counted.groupBy("bucket").applyInArrow(_assemble, SETS), "sets")


def suffix_may_reach(a: np.ndarray, b: np.ndarray, need: int) -> bool:
    """Suffix filter on two sorted arrays: cut both at the middle value of one; sides cannot overlap across."""
    if len(a) == 0 or len(b) == 0:
        return need <= 0
    middle = a[len(a) // 2]
    i, j = len(a) // 2, int(np.searchsorted(b, middle))
    return min(i, j) + min(len(a) - i, len(b) - j) >= need


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for a, b, n_a, n_b, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "n_a", "n_b", "prints_a", "prints_b"))):
            x, y = (np.sort(np.frombuffer(v, np.uint64)) for v in (x, y))
            need = overlap_needed(n_a, n_b)
            if min(len(x), len(y)) >= need and suffix_may_reach(x, y, need):
                both = np.sort(np.concatenate([x, y]))
                if int((both[1:] == both[:-1]).sum()) >= need:
                    found.append((a, b))
        columns = list(zip(*found)) or [[], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])


def _verified(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of nodes that link; each pair is verified once."""
    sets = nodes.select("node", "n", "prints")
    one = sets.withColumnsRenamed({"node": "a", "n": "n_a", "prints": "prints_a"})
    two = sets.withColumnsRenamed({"node": "b", "n": "n_b", "prints": "prints_b"})
    return pairs.distinct().join(one, "a").join(two, "b").mapInArrow(_verify, "a long, b long")


def _may_link(a, b):
    """Length and positional filter on two entries of one prefix list, given as functions of column names.

    At the first shingle that two sets share, what is left of either bounds the overlap.
    """
    need = _need(a, b)
    return (
        (a("n") * 5 >= b("n") * 4) & (b("n") * 5 >= a("n") * 4)
        & (F.least(a("n") - a("place"), b("n") - b("place")) >= need)
    )


def _need(a, b):
    return F.ceil((a("n") + b("n")) * 4 / F.lit(9.0) - 1e-9)


def _sketches_allow(a, b):
    """Bitmap filter: only shared shingles can overlap, and the sketches bound from below by how many they differ."""
    differing = F.lit(0)
    for i in range(SKETCH):
        differing = differing + F.bit_count(a("sketch")[i].bitwiseXOR(b("sketch")[i]))
    return differing <= a("shared") + b("shared") - _need(a, b) * 2


def _paired(one: DataFrame, two: DataFrame, more) -> DataFrame:
    """Pairs ``a, b`` of nodes that meet in a prefix list and pass the filters and the condition ``more``."""
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    met = one.alias("x").join(two.alias("y"), (x("shingle") == y("shingle")) & more(x, y) & _may_link(x, y))
    return met.select(F.least(x("node"), y("node")).alias("a"), F.greatest(x("node"), y("node")).alias("b"))


def links(nodes: DataFrame) -> DataFrame:
    """Verified links ``a, b``: enough to connect all nodes that are connected."""
    entries = written(nodes.select(
        "node", "n", "shared", F.posexplode("prefix").alias("i", "shingle")
    ).select("node", "n", "shingle", (F.col("i") + F.col("n") - F.col("shared")).cast("int").alias("place")), "prefixes")
    apart = lambda x, y: x("component") != y("component")
    found, placed = [], entries.withColumn("component", F.col("node"))
    for number in range(ROUNDS):
        # Each list's nodes meet a hub, first of the whole list and then of its largest component: the node with the
        # fewest shingles of its own, which is the likeliest to link with the others.
        likely = placed if number == 0 else placed.join(_largest_components(placed), "shingle").where("component = largest")
        hubs = written(
            likely.groupBy("shingle").agg(
                F.min(F.struct("place", "node", "n", "component")).alias("hub")
            ).select("shingle", "hub.*"), "hubs")
        found.append(written(_verified(_paired(placed, hubs, apart), nodes), "links"))
        joined = connected(functools.reduce(DataFrame.unionByName, found))
        placed = written(
            entries.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node")), "placed")
    # What remains: pairs that meet in a list but not yet in a component.  These could be many, so sketches come along.
    mixed_lists = placed.join(_largest_components(placed), "shingle")
    mixed_lists = written(mixed_lists.join(nodes.select("node", "shared", "sketch"), "node"), "mixed")
    rest = _paired(
        mixed_lists.where("component <> largest"), mixed_lists,
        lambda x, y: apart(x, y) & ((y("component") == x("largest")) | (x("component") < y("component"))) & _sketches_allow(x, y),
    )
    found.append(written(_verified(rest, nodes), "links"))
    return functools.reduce(DataFrame.unionByName, found)


def _largest_components(placed: DataFrame) -> DataFrame:
    """``shingle, largest``: of each list with more than one component the one with the most nodes."""
    return written(
        placed.groupBy("shingle", "component").agg(F.count("*").alias("m"))
        .groupBy("shingle").agg(F.max(F.struct("m", "component")).alias("top"), F.count("*").alias("k"))
        .where("k > 1").select("shingle", F.col("top.component").alias("largest")), "largest")


def grouped(docs: DataFrame, words: int = WORDS, hot: int = HOT) -> DataFrame:
    """``doc_id, text_hash, n, group``, one row per row of ``docs``; a missing id is ``LAST_ID``, a missing group null."""
    table = sets_and_nodes(docs, words, hot)
    documents = table.where("prefix is null").select("doc_id", "text_hash", "n", "node")
    found = connected(links(table.where("prefix is not null"))).withColumnRenamed("node", "linked")
    joined = documents.join(found, documents["node"] == found["linked"], "left")
    own = F.coalesce("component", "node")
    return joined.select("doc_id", "text_hash", "n", F.when(F.col("n") > 0, own).alias("group"))


def near_copies(docs: DataFrame, words: int = WORDS, hot: int = HOT) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row per row of ``docs`` (``doc_id, text``)."""
    rows = written(grouped(docs, words, hot), "groups")
    # Written, so that the join is between two shuffles and Spark can split a large group.
    names = written(rows.where("group is not null").groupBy("group").agg(F.min("doc_id").alias("component_id")), "names")
    component = F.coalesce("component_id", "doc_id")  # a row without a group is its own
    return rows.join(names, "group", "left").select(
        F.nullif("doc_id", F.lit(LAST_ID)).alias("doc_id"), F.col("n").alias("n_shingles"),
        F.nullif(component, F.lit(LAST_ID)).alias("component_id"),
    )


def first_of_each(docs: DataFrame, words: int = WORDS, hot: int = HOT) -> DataFrame:
    """One row of each component, of the smallest doc_id, with all its columns; rows without words all stay."""
    rows = written(grouped(docs.select("doc_id", "text"), words, hot), "groups").where("group is not null")
    first = written(rows.groupBy("group").agg(F.min(F.struct("doc_id", "text_hash")).alias("first")), "first")
    dropped = rows.join(first, "group").where(
        (F.col("doc_id") != F.col("first.doc_id")) | (F.col("text_hash") != F.col("first.text_hash"))
    ).select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_text")).distinct()

    def same(other: DataFrame):
        doc = F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST_ID))
        return (doc == other["_doc"]) & (F.xxhash64(docs["text"]) == other["_text"])

    dropped = broadcast_if_small(written(dropped, "dropped"))
    kept = docs.join(dropped, same(dropped), "left_anti")
    # Rows that are repeated as a whole are left, as often as they come; one of them stays.
    repeated = written(
        rows.groupBy(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_text")).agg(F.count("*").alias("k"))
        .where("k > 1").drop("k"), "repeated")
    if repeated.isEmpty():
        return kept
    repeated = broadcast_if_small(repeated)
    once = kept.join(repeated, same(repeated), "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(repeated, same(repeated), "left_anti").unionByName(once)
