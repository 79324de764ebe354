"""Periodic runs, whitening and decontamination against plain versions."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import documents, frame, prose
from pyspark.sql import functions as F

from series_lake.llm.decontamination import find_passages, offsets, normal_words, without_passages
from series_lake.llm.periodic_runs import dropped, lag_classes, periodic_runs, runs_of
from series_lake.llm.queries import QUERIES
from series_lake.llm.whitening import whiten

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- periodic runs


def plain_runs(w):
    """Every diagonal in full: all earlier occurrences of every word."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i < n - q and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(6, 4 * q):
                out.append((s, i - s + q, q))
    stretches = {}
    for s, z, q in out:  # of the periods of one stretch the smallest counts
        stretches[s, z] = min(q, stretches.get((s, z), q))
    return sorted([(s, z, q) for (s, z), q in stretches.items()], key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), max_size=4), st.integers(1, 14))
def test_runs_equal_all_diagonals(texts, period):
    texts = [*texts, *[[t[i % min(period, len(t))] for i in range(len(t))] for t in texts if t]]
    assert runs_of([np.array(t, dtype=np.int64) for t in texts]) == [plain_runs(t) for t in texts]


def test_lag_classes_cover_every_lag_with_two_periods():
    expected = 1
    for a, b, size in lag_classes(100_000):
        assert a == expected and b > a
        assert all(2 * d <= size <= 3 * d for d in (a, b - 1))
        expected = b
    assert expected > 100_000


def test_long_texts_take_linear_work():
    one = np.zeros(500_000, dtype=np.int64)
    rng = np.random.default_rng(1)
    block = np.tile(rng.integers(0, 50, 1000), 300)
    assert runs_of([one, block]) == [[(0, 500_000, 1)], [(0, 300_000, 1000)]]
    assert dropped(6, [(0, 6, 1)]).tolist() == [False, *[True] * 5]


def altered(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def plain_row(doc_id, text):
    words = altered(doc_id, WORD.findall(text or ""))
    runs = plain_runs(words) if len(words) < 5000 else plain_runs_of_one(words)
    gone = {i for s, z, q in runs for i in range(s + q, s + z)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (str(doc_id), len(runs), *told, sha("".join(f"{s},{z},{q}\n" for s, z, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def plain_runs_of_one(words):
    assert len(set(words)) == 1
    return [(0, len(words), 1)]


def run_rows():
    rng = random.Random(8)
    rows = [r for r in documents() if r[0] != 92]
    for i in range(1000, 1300):
        rows.append((i, prose(rng, "en", rng.randrange(0, 90)) if i % 3 else " ".join(rng.choice("ab") for _ in range(rng.randrange(50))), None, None))
    return rows


def test_runs_query(spark, tmp_path):
    rows = run_rows()
    frame(spark, rows, clashes=False).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()
    told = sorted(((str(r.doc_id), r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in got), key=repr)
    assert told == sorted((plain_row(r[0], r[1]) for r in rows), key=repr)
    assert sum(r.n_runs > 1 for r in got) > 3


def test_runs_keep_columns_and_take_odd_tables(spark):
    rows = documents()
    got = periodic_runs(frame(spark, rows), ["doc_id", "length", "n"])
    assert got.columns == ["doc_id", "length", "n", "n_words", "runs", "collapsed"] and got.count() == len(rows)
    assert periodic_runs(frame(spark, []), ["doc_id"]).count() == 0
    clash = frame(spark, rows).withColumns({"runs": F.lit(1), "collapsed": F.lit(2)})
    one = periodic_runs(clash, clash.columns).where("doc_id = 91").first()
    assert [tuple(r) for r in one.runs] == [(0, 60_000, 1)] and one.collapsed == "ab" and one.n_words == 60_000
    with pytest.raises(ValueError):
        periodic_runs(clash, [], times=3)


# --- whitening


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, x int, z int, w int").repartition(3)


def vector_rows(n=400, dims=12, seed=2):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dims)) * np.linspace(2, 0.3, dims)
    rows = [(i, [float(c) for c in v], 1, 1, 1) for i, v in enumerate(base.astype(np.float32))]
    rows += [(1000 + i, rows[0][1], 1, 1, 1) for i in range(200)]  # a hot group of equal vectors
    rows += [(None, rows[3][1], None, None, None), rows[5], rows[5]]
    odd = [None, [None] * dims, [float("nan"), *[0.0] * (dims - 1)], [float("inf")] * dims]
    return rows, rows + [(2000 + i, v, 1, 1, 1) for i, v in enumerate(odd)]


@pytest.mark.parametrize("weights", ["counts", "one"])
def test_whitening_equals_plain_version(spark, weights):
    usable, rows = vector_rows()
    got = whiten(vectors(spark, rows), weights=weights, heavy=20).collect()
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in r[1]] for r in usable])
    fit = x if weights == "counts" else np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - fit.mean(axis=0)
    v = centred.T @ centred / n
    values, axes = np.linalg.eigh(v)
    order = np.argsort(-values)[:8]
    z = (x - sums / n) @ axes[:, order] / np.sqrt(values[order])
    deviation = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    assert len(got) == 8 * len(usable)
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    for k in range(8):
        own = sorted(((r.vec_id is None, r.vec_id or 0, r.deviation, r.whitened) for r in got if r.component == k + 1))
        want = sorted((u[0] is None, u[0] or 0, d, c) for u, d, c in zip(usable, deviation, z[:, k], strict=True))
        assert [o[:3] for o in own] == [w[:3] for w in want]
        a, b = np.array([o[3] for o in own]), np.array([w[3] for w in want])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-9
        assert abs(next(r.explained for r in got if r.component == k + 1) - values[order][k] / np.trace(v)) < 1e-12


def test_whitening_of_odd_tables(spark):
    assert whiten(vectors(spark, [])).count() == 0
    assert whiten(vectors(spark, [(1, [1.0, 2.0], 1, 1, 1)] * 5)).count() == 0  # no direction at all
    assert whiten(vectors(spark, [(1, [], 1, 1, 1)])).count() == 0
    flat = [(i, [float(i % 7), 2.0 * (i % 7), 5.0], 1, 1, 1) for i in range(30)]
    got = whiten(vectors(spark, flat)).collect()  # a line in space has one component
    assert {r.component for r in got} == {1} and len(got) == 30 and abs(got[0].explained - 1) < 1e-12
    padded = whiten(vectors(spark, [(1, [1.0], 1, 1, 1), (2, [2.0, 0.0], 1, 1, 1), (3, [3.0, 0.5], 1, 1, 1)]))
    assert {r.vec_id for r in padded.collect()} == {1, 2, 3}
    big = whiten(vectors(spark, [(i, [float(i) * 2**35, -float(i)], 1, 1, 1) for i in range(50)])).collect()
    want = {i: sum((50 * c[i] - sum(c)) ** 2 for c in ([math.floor(1024 * float(k) * 2**35) + 100_000 for k in range(50)], [math.floor(-1024.0 * k) + 100_000 for k in range(50)])) for i in range(50)}
    assert {r.vec_id: r.deviation for r in big} == {i: d if d < 2**63 else None for i, d in want.items()}
    with pytest.raises(ValueError):
        whiten(vectors(spark, flat), weights="two")


# --- decontamination

NORMAL = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_hits(text, items, width=10):
    words = NORMAL.findall(lower(text))
    hit, found = set(), set()
    for item, own in items:
        own = NORMAL.findall(lower(own))
        grams = [own[i : i + width] for i in range(len(own) - width + 1)] if len(own) >= width else [own] if own else []
        for g in grams:
            for i in range(len(words) - len(g) + 1):
                if words[i : i + len(g)] == g:
                    hit |= set(range(i, i + len(g)))
                    found.add("" if item is None else str(item))
    return len(words), len(hit), sorted(found)


def leaks():
    rng = random.Random(6)
    items = [(i, prose(rng, "en", rng.randrange(11, 40))) for i in range(12)]
    items += [(50, "Short Ünit-test"), (51, "the"), (52, ""), (53, None), (54, "!!! ---"), (None, prose(rng, "fr", 20)), (3, prose(rng, "de", 30)), (55, items[0][1])]
    rows = [r for r in documents() if r[0] not in (90, 91, 92)]
    for k, (_, text) in enumerate(items):
        words = (text or "").split()
        for cut in (0, 1, 9, 10, 11):
            part = words[cut : cut + rng.randrange(8, 40)]
            rows.append((5000 + 100 * k + cut, f"Ö{prose(rng, 'de', 6)}! " + "--".join(p.upper() for p in part) + " ende", None, None))
    rows.append((9000, f"{items[1][1]}, {items[2][1]} {items[1][1]}", None, None))
    return rows, items


@pytest.mark.parametrize("most_words", [200_000, 60])
def test_passages_equal_plain_version(spark, most_words):
    rows, items = leaks()
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumns({"words": F.lit(1), "n": F.lit(2)})
    got = find_passages(frame(spark, rows), benchmark, ["doc_id", "spans", "n"], most_words=most_words).collect()
    assert sorted((str(r.doc_id), (r.n_words, r.n_hit, r.items)) for r in got) == sorted((str(r[0]), plain_hits(r[1], items)) for r in rows)
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        if r.doc_id is not None and r.doc_id >= 5000:
            assert sum(len(normal_words(texts[r.doc_id][s.start : s.end])) for s in r.spans) == r.n_hit
    assert sum(r.n_hit > 0 for r in got) > 20


def test_decontamination_query(spark, tmp_path):
    rows, items = leaks()
    frame(spark, rows, clashes=False).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = QUERIES["op13_decontamination"](spark, str(tmp_path)).collect()
    want = []
    for r in rows:
        n, hit, found = plain_hits(r[1], items)
        want.append((str(r[0]), n, hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), hit > 0))
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == sorted(want)


def test_passages_are_cut_out(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    rows = [(1, "é One, two THREE four; five six seven eight nine ten eleven! end", None, None), (2, "clean", None, None), (3, None, None, None)]
    got = {r.doc_id: r.text for r in without_passages(frame(spark, rows), items).collect()}
    assert got == {1: "é  ! end", 2: "clean", 3: None}
    none = spark.createDataFrame([], "item_id long, text string")
    assert find_passages(frame(spark, rows), none, ["doc_id"]).where("n_hit > 0").count() == 0
    assert find_passages(frame(spark, []), items, ["doc_id"]).count() == 0
    assert offsets("ab, cd", [(0, 2)]) == [(0, 6)]
