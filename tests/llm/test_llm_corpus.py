import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import documents, frame
from pyspark.sql import functions as F
from test_llm_join import roots, shingles, similar

import corpus_pipeline
from series_lake.llm import mixing
from series_lake.llm.mixing import mix, mix_counts, split_tree, targets
from series_lake.llm.packing import encoder, fullest, pack, pieces_of, plan_bins
from series_lake.llm.topk import search


def slow_encoder():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


# --- mixing


def test_targets():
    assert targets({"a": 100, "b": 100, None: 100}) == pytest.approx({"a": 187.5, "b": 75.0, None: 37.5})
    capped = targets({"a": 10, "b": 1000, "c": 1000})
    assert capped["a"] == 30 and capped["b"] / capped["c"] == pytest.approx(2) and sum(capped.values()) == pytest.approx(2010)
    assert targets({}) == {} and targets({"a": 0, "b": 5}) == pytest.approx({"a": 0.0, "b": 5.0})
    assert list(targets({"é": 1, "z": 1, None: 1, "Z": 1})) == ["Z", "z", "é", None]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 200), max_size=6), st.integers(1, 9), st.integers(0, 5))
def test_split_is_exact(draws, shards, seed):
    parts = split_tree(draws, shards, np.random.default_rng(seed))
    assert parts.shape == (shards, len(draws)) and (parts >= 0).all() and parts.sum(axis=0).tolist() == draws
    if draws:
        sizes = parts.sum(axis=1)
        assert sizes.max() - sizes.min() <= 2 * int(np.ceil(np.log2(shards)) + 1)


def test_words_taken_come_near_the_targets(spark):
    rows = documents()
    table = frame(spark, [(i, *r[1:]) for i, r in enumerate(rows)])
    got = {r.doc_id: r for r in mix_counts(table).collect()}
    sizes = [len((r[1] or "").split()) for r in rows]
    total = defaultdict(int)
    for r, n in zip(rows, sizes, strict=True):
        total[r[3]] += n
    want = targets(dict(total))
    taken = defaultdict(int)
    for i, r in enumerate(rows):
        assert (got[i].size, got[i].source_size, got[i].target) == (sizes[i], total[r[3]], pytest.approx(want[r[3]]))
        assert 0 <= got[i].taken <= 3 * sizes[i] and (sizes[i] == 0 or got[i].taken % sizes[i] == 0)
        taken[r[3]] += got[i].taken
    for source in total:
        assert abs(taken[source] - want[source]) <= max(n for r, n in zip(rows, sizes, strict=True) if r[3] == source)
    assert {i: r.taken for i, r in got.items()} == {r.doc_id: r.taken for r in mix_counts(table.repartition(5)).collect()}


def test_mixed_rows_agree_with_the_counts(spark):
    table = frame(spark, [(i, *r[1:]) for i, r in enumerate(documents())])
    copies = {r.doc_id: r.copies for r in mix_counts(table).collect()}
    out = mix(table, shard_words=2000, blocks_per_shard=4)
    assert out.columns == [*table.columns, "mix_shard"]
    rows = out.collect()
    assert Counter(r.doc_id for r in rows) == Counter({i: n for i, n in copies.items() if n})
    shards = Counter(r.mix_shard for r in rows)
    assert None not in shards and len(shards) > 5
    assert {r.doc_id for r in rows[:40]} != set(range(40))  # shuffled
    assert mix(frame(spark, [])).count() == 0 and mix_counts(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        mix_counts(table, max_sources=2)


def test_counts_come_from_written_shards(spark, monkeypatch):
    dealt, written = [], []
    write = mixing.Staging.write

    def spied(area, out, keep=False):
        back = write(area, out, keep)
        if "mix_shard" in out.columns:
            written.append((back.columns, Counter(r.doc_id for r in back.collect()), back.select("mix_shard").distinct().count()))
        return back

    monkeypatch.setattr(mixing, "split_tree", lambda draws, shards, rng: dealt.append(shards) or split_tree(draws, shards, rng))
    monkeypatch.setattr(mixing.Staging, "write", spied)
    table = frame(spark, [(i, *r[1:]) for i, r in enumerate(documents())])
    got = {r.doc_id: r.copies for r in mix_counts(table, shard_words=2000, blocks_per_shard=4).collect()}
    (columns, copies, shards), = written
    assert dealt[0] >= shards > 5 and set(table.columns) < set(columns)
    assert got == {i: copies[i] for i in range(len(documents()))}


def test_identical_rows_are_split_where_the_target_is(spark):
    rows = [(1, "same words here", None, "a")] * 500 + [(2 + i, "x y z", None, "b") for i in range(500)]
    got = mix_counts(frame(spark, rows)).groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    per = mix_counts(frame(spark, rows)).groupBy(F.col("doc_id") == 1).agg(F.sum("taken").alias("t"), F.max("target").alias("g")).collect()
    assert got and all(abs(r.t - r.g) <= 3 for r in per)


# --- packing


def test_pieces():
    assert pieces_of(5, 4) == [(0, 1), (1, 4)] and pieces_of(8, 4) == [(0, 4), (4, 4)] and pieces_of(4, 4) == [(0, 4)] and pieces_of(1, 4) == [(0, 1)]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=9), st.integers(0, 20))
def test_fullest_combination(lengths, room):
    sums = {0}
    for n in lengths:
        sums |= {s + n for s in sums if s + n <= room}
    counts = Counter(lengths)
    chosen = fullest(counts, room)
    assert sum(n * c for n, c in chosen.items()) == max(s for s in sums if s <= room)
    assert all(c <= counts[n] for n, c in chosen.items())


def test_packing_restores_every_document(spark):
    rows = [(i, *r[1:]) for i, r in enumerate(documents())] + [(500, "a <|endoftext|> b", None, None), (501, "日本語 ünï", None, None)]
    encode = slow_encoder()
    got = pack(frame(spark, rows), with_ids=True).collect()
    pieces = defaultdict(list)
    for r in got:
        assert r.length == len(r.ids) <= 1024 and r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        pieces[r.doc_id].append(r)
    for i, text, *_ in rows:
        own = sorted(pieces[i], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and [r.start for r in own] == [0, *np.cumsum([r.length for r in own])[:-1].tolist()]
        assert [x for r in own for x in r.ids] == [*encode(text or ""), 2]
        assert all(r.length == 1024 for r in own[1:])
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    total = sum(r.length for r in got)
    assert len(sequences) <= -(-total // 1024) + 2
    assert pack(frame(spark, [])).count() == 0


def test_bins_are_nearly_full():
    rng = random.Random(1)
    counts = Counter(rng.randint(1, 700) for _ in range(20_000))
    plan, bins = plan_bins(counts, 1024)
    assert bins <= 1.002 * sum(n * c for n, c in counts.items()) / 1024 + 1
    placed = Counter()
    for n, _, times, per, _, _ in plan:
        placed[n] += times * per
    assert placed == counts and plan_bins({}, 1024) == ([], 0)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x2FF, exclude_categories=("Cs",)), max_size=60))
def test_both_tokenizers_give_the_same_ids(text):
    global _encoders
    try:
        both = _encoders
    except NameError:
        both = _encoders = (encoder("byte_bpe_50k.json"), slow_encoder())
    assert both[0](text) == both[1](text)


# --- search


def brute_search(rows, k):
    usable = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(np.float32(x)) for x in v):
            usable.append((i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]))
    queries = {(i, tuple(v)) for i, v in usable if i % 100 == 0}
    out = []
    for q, v in queries:
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in usable if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def test_search_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=6), 2 if i % 2 else 0)]) for i in range(700)]
    rows += [(1000 + i, [1.0] * 6) for i in range(300)]  # ties
    rows += [(1, [9.0] * 6), (1, [9.0] * 6), (None, [50.0] * 6), (2, None), (3, [None] * 6), (4, [float("nan")] * 6), (5, [float("inf")] * 6), (6, [7.0, 7.0]), (8, [])]
    rows += [(1000, [1.0] * 6), (7, [2.0**20] * 6), (9, [1.0] * 8)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"q": F.lit(1), "score": F.lit(2)}).repartition(5)
    for block in (1024, 3):
        got = search(table, table.where("vec_id % 100 = 0"), 10, block=block).collect()
        assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == brute_search(rows, 10)


def test_search_corner_cases(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    everything = lambda t: search(t, t.where("vec_id % 100 = 0")).collect()
    assert everything(make([])) == [] and everything(make([(100, [1.0])])) == []
    assert [(r.query_id, r.vec_id, r.score) for r in everything(make([(100, [1.0]), (3, [0.5])]))] == [(100, 3, 1024 * 512)]
    huge = everything(make([(100, [3e38, 1.0]), (3, [3e38, 0.0]), (4, [-3e38, 0.0]), (5, [0.0, 1.0])]))
    assert [r.vec_id for r in huge] == [3, 5, 4] and huge[0].score == 2**63 - 1


# --- pipeline


def test_pipeline_stages(spark, tmp_path):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "ngram_join", "source_mixing", "packing"] and corpus_pipeline.ORACLE_SQL is None
    docs = frame(spark, clashes=False).withColumn("n_chars", F.length("text").cast("long"))
    start, seen = docs, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != names[-1]:
            assert docs.columns == start.columns
        seen.append(docs.collect())
    kept = {r.doc_id for r in seen[0]}
    assert set(range(60)) <= kept and not kept & {82, 83, 84, 88}
    assert all(r.text.strip() for r in seen[1] if len(r.text) > 100)
    rows = sorted({(r.doc_id is None, r.doc_id or 0, r.text) for r in seen[1]})
    sets = [shingles(r[2], 5) for r in rows]
    root = roots(len(rows), similar(sets, 80, 100))
    assert len(seen[2]) == len({root[i] if s else ("empty", i) for i, s in enumerate(sets)}) < len(rows)
    pieces = {(r.doc_id, r.piece) for r in seen[4]}
    assert {i for i, _ in pieces} == {r.doc_id for r in seen[3]}


def test_pipeline_run(spark, tmp_path):
    frame(spark, clashes=False).withColumn("n_chars", F.length("text").cast("long")).write.parquet(str(tmp_path / "documents.parquet"))
    first = sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).drop("sequence_id", "offset").collect()), key=str)
    again = sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).drop("sequence_id", "offset").collect()), key=str)
    assert first == again and first
