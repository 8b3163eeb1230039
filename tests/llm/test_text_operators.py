"""Languages, lines, windows, mixes and secrets against plain versions, with awkward rows."""

import hashlib
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward_rows, documents, sentence, words
from pyspark.sql import functions as F

from lakefold.llm import decontaminate, language_id, line_dedup, mixing, scan, secrets

EMPTY = "doc_id long, text string, lang string, source string"


# Lines

def plain_lines(rows):
    def key(line):
        line = line.strip("\t\n\x0b\x0c\r ")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line) if len(line) >= 10 else None

    first = {}
    ids = [(2**63 - 1 if r[0] is None else r[0], (r[1] or "").split("\n")) for r in rows]
    for doc, lines in ids:
        for k in map(key, lines):
            if k:
                first[k] = min(first.get(k, doc), doc)
    out = []
    for doc, lines in ids:
        kept = [x for x in lines if not key(x) or first[key(x)] == doc]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out)


# All names that the stages use inside, and some that need quotes.
INSIDE = ["_doc", "_text", "_flags", "flags", "_row", "row", "place", "drop", "key", "batch", "_source", "target", "source_size", "copies",
          "size", "rate", "_bits", "lang_pred", "score", "column_0", "n_hit", "items", "item", "part", "bucket", "component", "a.b", "c`d"]


@pytest.mark.parametrize("stage", ["lines", "benchmark", "mix", "language", "copies"])
def test_stages_keep_columns_with_names_used_inside(spark, stage):
    from lakefold.llm import ngram_join

    rows = awkward_rows()
    plain = documents(spark, rows)
    extra = plain.select("*", *(F.concat_ws(" ", F.lit(i), "doc_id", "source").alias(c) for i, c in enumerate(INSIDE)))
    items = spark.createDataFrame([("i", " ".join(words(rows[8][1])[3:20]))], "item_id string, text string")
    run = {"lines": line_dedup.dedup_lines, "benchmark": lambda d: decontaminate.clean(d, items), "mix": mixing.mix,
           "language": lambda d: language_id.keep_known(d, language_id.fit(plain)), "copies": ngram_join.first_of_each}[stage]
    got, before = run(extra), run(plain)
    assert got.columns == extra.columns + [c for c in before.columns if c not in plain.columns]
    assert sorted(map(str, got.select(*before.columns).collect())) == sorted(map(str, before.collect()))
    for row in got.collect():
        for i, c in enumerate(INSIDE):
            assert row[c] == " ".join(str(x) for x in (i, row.doc_id, row.source) if x is not None)
    empty = run(extra.limit(0))
    assert empty.columns == got.columns and empty.count() == 0


@pytest.mark.parametrize("batches, fanout", [(1, 2), (3, 2), (6, 2)])
def test_lines_with_awkward_rows_and_compaction(spark, batches, fanout):
    rows = awkward_rows() + [(20 + i, "common line of all\nown line number %d\nCommon line of all " % i, "en", "a") for i in range(9)]
    docs = documents(spark, rows, clash=True)
    before = line_tables(spark)
    got = line_dedup.dedup_lines(docs, batches, fanout)
    assert set(got.columns) == set(docs.columns) | {"n_dropped"}
    found = [(2**63 - 1 if r.doc_id is None else r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()]
    assert sorted(found) == plain_lines(rows)
    assert line_tables(spark) == before


def line_tables(spark):
    return [t.name for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_line_runs_are_merged_by_levels(spark):
    runs = line_dedup.LineRuns(spark, fanout=2, buckets=2)
    for batch in range(5):
        rows = [(bytes([k]), batch * 10 + k) for k in range(batch, batch + 3)]
        runs.admit(spark.createDataFrame(rows, "key binary, doc long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert sorted((r.key[0], r.first_doc) for r in runs.keys().collect()) == [(0, 0), (1, 1), (2, 2), (3, 13), (4, 24), (5, 35), (6, 46)]
    run = spark.table(runs.levels[2][0])
    batch = spark.createDataFrame([(b"z", 1)], "key binary, doc long").groupBy("key").agg(F.min("doc"))
    plan = batch.join(run.hint("merge"), "key", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # of the batch; runs are neither shuffled nor sorted


# Benchmark windows

def plain_hits(rows, items, size=10):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    windows = []
    for item, text in items:
        w = re.findall(pattern, lower(text))
        n = min(size, len(w))
        windows += [("null" if item is None else str(item), w[i : i + n]) for i in range(len(w) - n + 1 if w else 0)]
    out = []
    for doc, text, *_ in rows:
        w = re.findall(pattern, lower(text))
        hit, found = set(), set()
        for item, window in windows:
            for i in range(len(w) - len(window) + 1):
                if w[i : i + len(window)] == window:
                    hit |= set(range(i, i + len(window)))
                    found.add(item)
        out.append((str(doc), len(w), len(hit), sorted(found)))
    return sorted(out)


def test_benchmark_windows_with_awkward_rows(spark):
    rng = random.Random(3)
    passage = sentence(rng, 25)
    items = [(1, passage), (2, "Word"), (3, None), (4, "--"), (None, "one short, line"), (5, "a a a a a a a a a a a"), (5, "second ünï"), (1, passage)]
    rows = awkward_rows() + [
        (30, "x " + passage.upper() + " y", "en", "a"), (31, " ".join(passage.split()[4:15]), "en", "a"),
        (32, " ".join(passage.split()[4:13]), "en", "a"), (33, "a " * 15, "en", "a"), (34, "word, word; WORD", "en", "a"),
    ]
    judged = decontaminate.judge(documents(spark, rows, clash=True), spark.createDataFrame(items, "item_id long, text string"))
    found = sorted((str(r.doc_id), r.n_words, r.n_hit, list(r["items"])) for r in judged.collect())
    assert found == plain_hits(rows, items)
    clean = decontaminate.clean(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    kept = sorted(str(r.doc_id) for r in clean.collect())
    assert kept == sorted(str(d) for d, _, n_hit, _ in plain_hits(rows, items) if n_hit == 0)


def test_terms_beyond_the_broadcast_bound_are_shuffled(spark, monkeypatch):
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    docs = documents(spark, [(1, "x alpha beta gamma", "en", "a"), (2, "beta gamma", "en", "a")])
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(decontaminate, "broadcast_if_small", lambda df: df)
    assert sorted((r.doc_id, r.n_hit) for r in decontaminate.judge(docs, items).collect()) == [(1, 3), (2, 0)]


def test_proximity(spark):
    items = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    docs = documents(spark, [(1, "alpha x y beta", "en", "a"), (2, "beta" + " z" * 9 + " alpha", "en", "a"), (3, "alpha", "en", "a")])
    index = decontaminate.build_index(docs, items)
    found = [(r.doc_id, r.item, r.distance) for r in decontaminate.proximity_matches(index, slop=5).collect()]
    assert found == [(1, "1", 3)]


# Mixing

def test_water_level(spark):
    sizes = [("a", 100), ("b", 1000), ("c", 10), ("d", 0), (None, 500)]
    rows = spark.createDataFrame([(s, n) for s, n in sizes], "source string, size long")
    targets = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    weight = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2]))
    want, full = {}, {}
    while True:  # share, stop at three times, share the rest again
        rest = 1610 - sum(full.values())
        open_ = {s: w for s, w in weight.items() if s not in full}
        want = full | {s: rest * w / sum(open_.values()) for s, w in open_.items()}
        above = {s: 3.0 * n for s, n in sizes if s not in full and want[s] > 3 * n}
        if not above:
            break
        full |= above
    assert {s: pytest.approx(t) for s, t in targets.items()} == want


def test_mix_takes_what_the_plan_says(spark):
    rng = random.Random(1)
    rows = awkward_rows() + [(100 + i, sentence(rng, rng.randint(1, 60)), "en", "xyz"[i % 3]) for i in range(900)]
    docs = documents(spark, rows, clash=True).drop("copies")
    plan = mixing.plan(docs).collect()
    assert len(plan) == len(rows)
    by_source = {}
    for r in plan:
        assert 0 <= r.copies <= 3
        total = by_source.setdefault(r.source, [r.target, 0, 0.0])
        total[1] += r.copies * r.size
        fraction = r.target / r.source_size % 1 if r.source_size else 0
        total[2] += r.size**2 * fraction * (1 - fraction)
    for target, taken, variance in by_source.values():
        assert abs(taken - target) <= 5 * variance**0.5 + 1
    taken = mixing.mix(docs)
    assert taken.count() == sum(r.copies for r in plan)
    assert sorted(map(str, mixing.mix(docs).collect())) == sorted(map(str, taken.collect()))


# Languages

def test_languages_of_held_out_documents(spark):
    documents_ = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit(documents_)
    told = language_id.predict(documents_.withColumn("held", language_id.held_out(F.col("doc_id"))), model)
    right, n = told.where("held and length(text) > 100").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right > 0.99


def test_language_of_awkward_rows(spark):
    docs = documents(spark, awkward_rows(), clash=True).withColumn("score", F.lit("x"))
    model = language_id.fit(docs)
    rows = language_id.predict(docs, model).collect()
    assert len(rows) == len(awkward_rows())
    for r in rows:
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not lettered) and 0 <= r.score <= 1
    assert language_id.keep_known(docs, model).columns == docs.columns
    untaught = language_id.fit(docs.where("lang is null"))
    assert {r.lang_pred for r in language_id.predict(docs, untaught).collect()} == {"und"}


def test_phrases_are_the_longest_in_the_sample():
    rng = random.Random(2)
    symbols = [rng.randint(3, 6) for _ in range(400)]
    text = [rng.randint(2, 6) for _ in range(3000)]
    table = language_id.phrase_table(language_id.suffix_automaton(symbols, 7)).reshape(-1)
    begun = scan.marked(np.array(text, np.uint8), table, 0, 49, lane=64)
    sample, want, at = bytes(symbols), [], 0
    while at < len(text):
        end = at + 1
        while end < len(text) and bytes(text[at : end + 1]) in sample:
            end += 1
        want.append(at)
        at = end
    assert np.flatnonzero(begun).tolist() == want


# Secrets

def plain_secrets(text):
    found = []
    for k, rule in enumerate(secrets.RULES):
        pattern, least = rule.pattern, rule.least
        if rule.kind == "hex":
            pattern, least = rb"[0-9a-f]+", 16
        if rule.kind == "access":
            pattern, least = rb"AKIA[A-Z0-9]+", 18
        for m in re.finditer(pattern, text.encode()):
            if len(m.group(rule.group)) >= least:
                start, end = (len(text.encode()[:x].decode()) for x in m.span())
                found.append((start, k, end))
    return [f"{secrets.RULES[k].kind}:{a}:{b}" for a, k, b in sorted(found)], [k for _, k, _ in sorted(found)]


def test_secrets_against_regular_expressions(spark):
    rng = random.Random(1)
    parts = ["password", "PassWd", "secret", "token", "api_key", "APIkey", '"', "'", " ", "=", ":", "abc", "0123", "deadbeef", "AKIA",
             "ABCD12", "é", "\n", "-----BEGIN ", "RSA ", "PRIVATE KEY-----", "eyJ", ".", "xyzw1234"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["a" * 9000, "AKIA" * 3000, "token=token" * 3000, "", None, "token = é12345678901234"]
    docs = documents(spark, [(i % 2900, t, "en", "a") for i, t in enumerate(texts)] + [(None, "secret: 0123456789abcdef", None, None)], clash=True)
    got = sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in secrets.find_secrets(docs).collect())
    want = []
    for r in docs.select("doc_id", "text").collect():
        shown, kinds = plain_secrets(r.text or "")
        base = ",".join(s for s, k in zip(shown, kinds) if k < 3)
        want.append((str(r.doc_id), *(kinds.count(k) for k in range(3)), hashlib.sha256(base.encode()).hexdigest(), ",".join(shown)))
    assert got == sorted(want)


def test_slices_of_text_columns():
    column = pa.array(["ab", None, "", "ç" * 50, "x"])
    for part in (column, column.slice(1)):
        rows = []
        for first, last, text, starts in scan.text_slices(part, 20):
            assert len(starts) == last - first + 1 and (text[starts[1:] - 1] == scan.SEPARATOR).all()
            rows += [text[a : b - 1].tobytes().decode() for a, b in zip(starts, starts[1:])]
        assert rows == [x or "" for x in part.to_pylist()]


# Empty tables

@pytest.mark.parametrize("run", [
    lambda d: line_dedup.dedup_lines(d), lambda d: mixing.plan(d), lambda d: mixing.mix(d), lambda d: secrets.find_secrets(d),
    lambda d: language_id.predict(d, language_id.fit(d)),
    lambda d: decontaminate.judge(d, d.selectExpr("doc_id as item_id", "text")),
    lambda d: decontaminate.clean(d, d.selectExpr("doc_id as item_id", "text")),
])
def test_empty_tables(spark, run):
    assert run(spark.createDataFrame([], EMPTY)).count() == 0


def test_words_of_the_sizes():
    assert words(" A\tb c ") == ["a", "b c"]


@pytest.mark.parametrize("text", [
    "0123456789abcdef" * 65_536, "ae" * 500_000, "token=" * 170_000, "eyJ" * 340_000, "eyJabcdefgh." * 85_000,
    "secret:" + "A" * 1_000_000, "AKIA" * 250_000, "-----BEGIN " * 90_000,
])
def test_secrets_of_a_megabyte_take_linear_time(text):
    """Runs in which every place starts a rule: seconds, where following each to the end took hours."""
    scanner = secrets.compiled()
    started = time.process_time()
    found = secrets.scan_bytes(np.frombuffer(text.encode() + b"\xff", np.uint8), scanner)
    assert time.process_time() - started < 20
    expected = []
    for number, rule in enumerate(scanner.rules):
        for match in re.finditer(rule.pattern, text.encode()) if number < 3 else ():
            if len(match.group(rule.group)) >= rule.least:
                expected.append((number, *match.span()))
    assert [f for f in found if f[0] < 3] == expected
