"""Cases that earlier versions got wrong."""

import random

from llm_cases import PROSE, frame, prose
from pyspark.sql import functions as F

import corpus_pipeline
from series_lake.llm.language import identify, learn, trigrams
from series_lake.llm.line_dedup import Lines, _linked, _near, _sets, dedup_lines
from series_lake.llm.mixing import mix


def labelled(n=90):
    rng = random.Random(12)
    return [(i, prose(rng, ("en", "de", "fr")[i % 3], 80), ("en", "de", "fr")[i % 3], f"s{i % 3}") for i in range(n)]


def test_short_texts_have_evidence(spark):
    assert len(trigrams("a")) == 1 and len(trigrams("ab")) == 2 and len(trigrams(" 1 ! ")) == 0
    rows = [*labelled(), (500, "für", None, None), (501, "très", None, None), (502, "the", None, None), (503, "5", None, None)]
    docs = frame(spark, rows)
    got = {r.doc_id: r for r in identify(docs, learn(docs), ["doc_id"]).where("doc_id >= 500").collect()}
    assert [got[i]["__lang_pred"] for i in (500, 501, 502, 503)] == ["de", "fr", "en", "und"]


def test_language_stage_keeps_mixed_texts_and_all_when_nothing_is_learned(spark):
    rng = random.Random(4)
    mixed = "\n".join(" ".join(rng.choice(PROSE[x]) for _ in range(30)) for x in ("en", "de", "fr"))
    rows = [*labelled(), (500, mixed, "en", None), (501, "12 34", "en", None), (502, None, "en", None)]
    docs = frame(spark, rows, clashes=False)
    left = corpus_pipeline.language_id(spark, docs, "")
    assert {r.doc_id for r in left.collect()} == {r[0] for r in rows} - {501, 502}
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language_id(spark, unlabelled, "").count() == len(rows)


def test_one_task_per_shard(spark):
    rows = [(i, "w " * 50, None, "s") for i in range(400)]
    mixed = mix(frame(spark, rows), shard_words=500)
    told = mixed.select("mix_shard", F.spark_partition_id().alias("p")).distinct().collect()
    assert len(told) == len({r.p for r in told}) == len({r.mix_shard for r in told}) == 40


def test_hot_lines_are_removed_like_others(spark):
    rows = [(i, f"common line of text here\nown line number {i} {'abcdefghij'[i % 10] * 30}\ncommon line of text herf", None, None) for i in range(300)]
    got = {r.doc_id: r for r in dedup_lines(frame(spark, rows), Lines()).collect()}
    assert got[0].text.startswith("common line of text here\nown line")
    assert all("common" not in got[i].text for i in range(1, 300))


def test_pair_check_equals_sets():
    import pyarrow as pa

    rng = random.Random(5)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(5, 90))) for _ in range(60)]
    near = [t[:k] + "x" + t[k + 1 :] for t in base for k in (0, len(t) // 2)]
    texts = base + near
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if rng.random() < 0.3]
    batch = pa.RecordBatch.from_pydict({"a": [i for i, _ in pairs], "b": [j for _, j in pairs], "x": [texts[i] for i, _ in pairs], "y": [texts[j] for _, j in pairs]})
    got = {(a, b) for out in _linked(Lines())(iter([batch])) for a, b in zip(out.column(0).to_pylist(), out.column(1).to_pylist(), strict=True)}
    sets = _sets(texts, 5)
    assert got == {(i, j) for i, j in pairs if _near(sets[i], sets[j], Lines())} and len(got) > 20
