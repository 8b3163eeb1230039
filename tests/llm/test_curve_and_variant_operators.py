"""Hilbert shards, hard negatives and spelling variants against brute force, on small tables with awkward rows."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import TO_LOWER, awkward_rows, documents

from lakefold.llm import hard_negatives, hilbert, sharding, spelling
from lakefold.llm.common import new_folder
from lakefold.llm.registered import QUERIES


@pytest.mark.parametrize("dims,bits", [(1, 4), (2, 4), (3, 3), (4, 2), (6, 2)])
def test_curve_visits_each_cell_once_and_steps_to_neighbours(dims, bits):
    grid = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    places = hilbert.curve_places(grid, bits)
    assert sorted(places) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(places)], axis=0)).sum(axis=1) == 1).all()


def test_curve_column_equals_numpy(spark):
    grid = list(itertools.product(range(4), repeat=3))
    df = spark.createDataFrame(grid, "a int, b int, c int")
    got = df.select(hilbert.curve_index([df.a, df.b, df.c], 2)).collect()
    assert [r[0] for r in got] == hilbert.curve_places(np.array(grid), 2).tolist()


def check_shards(rows, texts, shards, law):
    assert sorted((r.size, r.text_crc32) for r in rows) == sorted(
        (len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for t in texts)
    by_shard = defaultdict(list)
    for r in rows:
        assert (r.law, r.grown_shard) == (law, None) and 0 <= r.shard < shards
        by_shard[r.shard].append(r)
    for own in by_shard.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    in_order = [r for s in sorted(by_shard) for r in sorted(by_shard[s], key=lambda r: r.slot)]
    assert [r.curve for r in in_order] == sorted(r.curve for r in rows)
    return by_shard


@pytest.mark.parametrize("clash", [False, True])
def test_shards_of_awkward_rows(spark, clash):
    rows = awkward_rows()
    docs = documents(spark, rows, clash)
    for shards in (1, 4, 40):
        found = check_shards(sharding.place(docs, shards).collect(), [r[1] for r in rows], shards, "rows")
        counts = [len(found[s]) for s in range(shards)]
        assert max(counts) - min(counts) <= 1


def test_shards_by_bytes_are_near_equal(spark):
    rng = random.Random(1)
    # A third of all rows are one document, another third one source.
    rows = [(i % 3 and i, "same text" if i % 3 == 0 else "x" * rng.randint(0, 900), "en", "hot" if i % 3 else f"s{i % 50}") for i in range(3000)]
    found = check_shards(sharding.place(documents(spark, rows), 8, sharding.BY_BYTES).collect(), [r[1] for r in rows], 8, "bytes")
    sizes = [sum(r.size for r in found[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 2 * 916


def test_shards_of_an_empty_table_and_unknown_law(spark):
    assert sharding.place(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        sharding.place(documents(spark, []), law="nothing")


def test_written_shards_are_pruned_and_whole(spark):
    rng = random.Random(2)
    rows = [(i, "w" * rng.randint(1, 2000), rng.choice(["de", "en", "fr", None]), f"s{rng.randint(0, 9)}", i) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, shard long")
    path = new_folder(spark, "sharded")
    sharding.write_shards(docs, path, 32)
    manifest = spark.read.parquet(f"{path}/manifest")
    assert manifest.count() == 32
    wanted = {"lang": ("de", "de"), "doc_id": (0, 400)}
    chosen = sharding.shards_to_read(manifest, wanted).count()
    assert chosen <= 12
    got = sharding.read_shards(spark, path, wanted)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == sorted(r for r in rows if r[2] == "de" and r[0] <= 400)
    everything = sharding.read_shards(spark, path, {})
    assert sorted(map(repr, everything.collect())) == sorted(map(repr, docs.collect()))
    with pytest.raises(ValueError):
        sharding.shards_to_read(manifest, {"text": ("a", "b")})


def mined(rows, every=100, positives=5, negatives=10, low=30, high=90):
    """``rows`` are ``(vec_id, label, vector)`` that take part; scores of all pairs."""
    quantised = [(i, label, [int(np.floor(256 * x)) for x in v]) for i, label, v in rows]
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    found = []
    for p, (i, label, v) in enumerate(quantised):
        if i % every:
            continue
        others = sorted((-score(v, w), j, q, m) for q, (j, m, w) in enumerate(quantised) if q != p)
        for s, j, _, _ in [o for o in others if o[3] == label][:positives]:
            window = [(n, k) for n, k, _, m in others if m != label and low * -s <= 100 * -n <= high * -s]
            found += [(i, j, rank + 1, k, -s, -n) for rank, (n, k) in enumerate(window[:negatives])]
    return sorted(found)


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<float>, place string, floor int")


MINED = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@pytest.mark.parametrize("block_rows", [8, 1024])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, block_rows):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(hard_negatives, "PACK", 4 if block_rows == 8 else 256)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 12))
    rows = [(i, int(rng.integers(0, 4)), (centres[rng.integers(0, 6)] + rng.normal(size=12) * 0.2).astype(np.float32).tolist()) for i in range(400)]
    rows += [(500 + i, i % 2, rows[0][2]) for i in range(30)]  # equal vectors: ties by id
    rows += [(0, *rows[0][1:]), (-200, 1, rows[7][2]), (600, 9, rows[3][2])]  # a repeated anchor, a label of one row
    bad = [(None, 1, [1.0] * 12), (700, None, [1.0] * 12), (800, 1, None), (900, 1, [float("nan")] * 12),
           (1000, 1, [None] + [1.0] * 11), (1100, 1, [float("inf")] * 12), (1200, 1, [3e30] * 12)]
    got = hard_negatives.mine(vectors(spark, rows + bad))
    assert got.columns == list(MINED)
    assert sorted(map(tuple, got.collect())) == mined(rows)


def test_hard_negatives_of_few_short_and_no_vectors(spark):
    assert hard_negatives.mine(vectors(spark, [])).collect() == []
    rows = [(0, 1, [1.0, 0.5]), (1, 1, [1.0]), (2, 2, [0.5, 0.25, 9.0]), (3, 2, []), (100, 3, [])]
    assert sorted(map(tuple, hard_negatives.mine(vectors(spark, rows)).collect())) == mined(rows)


def test_zone_maps_bound_all_scores_and_leave_blocks_out(spark):
    rng = np.random.default_rng(4)
    anchors = rng.integers(-300, 300, size=(20, 8))
    blocks = [rng.integers(-300, 300, size=(1, 8)) + rng.integers(-9, 9, size=(15, 8)) for _ in range(30)]
    lower, upper = hard_negatives.bounds(anchors, np.stack([b.min(0) for b in blocks]), np.stack([b.max(0) for b in blocks]))
    for i, block in enumerate(blocks):
        scores = anchors @ block.T
        assert (lower[:, i] <= scores.min(axis=1)).all() and (upper[:, i] >= scores.max(axis=1)).all()
    sizes = np.full(30, 15)
    floor = hard_negatives.floors(lower, sizes, np.ones((20, 30), bool), 20)
    everything = np.sort(anchors @ np.concatenate(blocks).T, axis=1)
    assert (floor <= everything[:, -20]).all() and (upper < floor[:, None]).any()


def variants(rows, delete_one_in=31):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[a-zÀ-ÿ]+", (text or "").translate(TO_LOWER)):
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % delete_one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 7
    counts = {w: n for w, n in counts.items() if n >= 2}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    around = {w: [v for v in counts if near(w, v)] for w in counts}
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 10 * counts[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w) or "", root(w), n, len(around[w]), counts.get(form.get(w)) or 0) for w, n in counts.items())


def as_variants(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())


def test_variants_of_awkward_rows_equal_brute_force(spark):
    rng = random.Random(6)
    words = ["".join(rng.choice("abé") for _ in range(rng.randint(6, 9))) for _ in range(200)]
    rows = [(r[0], r[1]) for r in awkward_rows()]
    rows += [(100 + i, " ".join(rng.choice(words) for _ in range(60))) for i in range(40)]
    # Chains of forms: ten times as often with every step, and a tie between two forms.
    chain = ["straighten", "straightem", "straightom"]
    rows += [(300 + i, f"{chain[0]} " * 200 + f"{chain[1].upper()}, " * 20 + f"{chain[2]};" * 2) for i in range(2)]
    rows += [(400, "forbidden " * 40 + "forbidder " * 40 + "forbiddex " * 3), (None, "ÉCOLIERS écoliers Écoliers " * 9)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int")
    for delete_one_in in (31, 3):
        assert as_variants(spelling.group_variants(docs, delete_one_in)) == variants(rows, delete_one_in)
    found = {r.word: r for r in spelling.group_variants(docs, 10**9).collect()}
    assert found["straightom"].root == "straighten" and found["forbiddex"].form == "forbidden"


def test_variants_of_an_empty_table(spark):
    assert spelling.group_variants(documents(spark, [(1, None, None, None), (2, "", None, None)])).collect() == []


@pytest.mark.parametrize("parts,k", [(3, 1), (2, 1), (4, 2), (6, 2), (5, 3)])
def test_signatures_miss_no_pair(parts, k):
    chosen = signature = spelling.signature_parts(parts, k)
    for differing in itertools.combinations(range(parts), k):
        assert any(not set(differing) & set(c) for c in chosen)
    assert len(signature) == len(set(signature))
    with pytest.raises(ValueError):
        spelling.signature_parts(k, k)


def test_letters_are_dealt_evenly():
    dealt = spelling.deal_letters([("e", 50), ("a", 30), ("t", 25), ("z", 1)], 2)
    assert sorted("".join(dealt)) == ["a", "e", "t", "z"] and dealt == ["ez", "at"]


def test_variants_of_the_table_equal_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(40).collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_variants(spelling.group_variants(docs)) == variants(rows)
    assert "op13_spelling_variants" in QUERIES
