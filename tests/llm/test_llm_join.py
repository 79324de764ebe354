import random
import re
from collections import defaultdict

import corpus_pipeline
import numpy as np
import pytest
from llm_cases import documents, frame
from pyspark.sql import functions as F

from series_lake.llm import line_dedup
from series_lake.llm.components import connected, pairs_within
from series_lake.llm.hashing import Words
from series_lake.llm.line_dedup import EVERY_LINE, Lines, dedup_lines
from series_lake.llm.ngram_join import Join, near_duplicates, one_of_each
from series_lake.llm.queries import QUERIES
from series_lake.llm.staging import KEPT, Staging, release, staging

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    return [find(i) for i in range(n)]


def similar(sets, num, den):
    """All pairs of rows whose sets are similar enough, by counting common members."""
    holders, links = defaultdict(list), []
    for i, own in enumerate(sets):
        common = defaultdict(int)
        for member in own:
            for j in holders[member]:
                common[j] += 1
            holders[member].append(i)
        links += [(i, j) for j, c in common.items() if den * c >= num * (len(own) + len(sets[j]) - c)]
    return links


def shingles(text, width):
    words = WORD.findall((text or "").translate(FOLD))
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} if len(words) >= width else ({tuple(words)} if words else set())


def brute(rows, join):
    sets = [shingles(r[1], join.width) for r in rows]
    root = roots(len(rows), similar(sets, join.num, join.den))
    least = defaultdict(list)
    for r, at in zip(rows, root, strict=True):
        least[at].append(r[0])
    return sorted((str(r[0]), len(s), str(min((x for x in least[at] if x is not None), default=None))) for r, s, at in zip(rows, sets, root, strict=True))


@pytest.mark.parametrize("join, classes", [(Join(3, 90, 100), {}), (Join(3, 90, 100), {"rare": 2, "frequent": 6}), (Join(), {"rare": 2, "frequent": 6}), (Join(2, 60, 100), {"rare": 1, "frequent": 2}), (Join(3, 90, 100), {"rare": 1, "frequent": 2, "heavy": 5})])
def test_join_equals_brute_force(spark, join, classes):
    got = near_duplicates(frame(spark), join, **classes).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute(documents(), join)


def test_join_of_nothing(spark):
    assert near_duplicates(frame(spark, [])).count() == 0
    got = near_duplicates(frame(spark, [(1, None, None, None), (2, "", None, None), (None, None, None, None)])).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == [("1", 0, "1"), ("2", 0, "2"), ("None", 0, "None")]


def test_many_near_copies_lose_no_link(spark):
    """Variants of one text around the threshold: components hang on single links."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for k in rng.choice(120, size=int(rng.integers(0, 4)), replace=False):
            words[k] = f"v{i}y{k}" if rng.random() < 0.7 else f"v{k}"
        rows.append((i, " ".join(words), None, None))
    join = Join(3, 90, 100)
    for classes in ({}, {"rare": 3, "frequent": 20}):
        got = near_duplicates(frame(spark, rows), join, **classes).collect()
        assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute(rows, join)


def test_one_of_each(spark):
    rows = documents()
    left = one_of_each(frame(spark)).select("doc_id", "text", "node").collect()
    sets = [shingles(r[1], 5) for r in rows]
    root = roots(len(rows), similar(sets, 80, 100))
    groups = defaultdict(set)
    for i, r in enumerate(rows):
        groups[root[i] if sets[i] else ("empty", r[0], r[1])].add((r[0], r[1]))
    assert len(left) == len(groups)
    kept = {(r.doc_id, r.text) for r in left}
    for members in groups.values():
        assert len(kept & members) == 1
        least = min((m[0] is None, m[0] or 0) for m in members)
        assert {(m[0] is None, m[0] or 0) for m in kept & members} == {least}


def test_words_are_cut_at_the_given_characters():
    words, data = Words(lower=True), "É ab c\x0bAB\x1cd  x\n".encode()
    hashes, places = words(np.frombuffer(data, dtype=np.uint8))
    assert [data[p : p + 1] for p in places] == [b"\xc3", b"a", b"A", b"x"]
    assert len(set(hashes.tolist())) == 4
    one = words(np.frombuffer(b"Hello HELLO hello world " * 60_000, dtype=np.uint8))[0]  # over the part size
    assert len(one) == 240_000 and len(set(one.tolist())) == 2


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(3, 3)]
    with staging(spark, "t") as area:
        got = dict(connected(area, spark.createDataFrame(edges, "a long, b long")).distinct().collect())
    assert got == {i: 100 for i in range(100, 141)} | {i: 7 for i in range(200, 260)} | {7: 7}
    with staging(spark, "t") as area:
        assert connected(area, spark.createDataFrame([], "a long, b long")).count() == 0


def test_pairs_within_groups():
    found = [p for i, j in pairs_within(np.array([0, 3, 4, 6]), chunk=2) for p in zip(i.tolist(), j.tolist(), strict=True)]
    assert found == [(0, 1), (0, 2), (1, 2), (4, 5)]


def test_staged_copies_go(spark):
    import pathlib

    from series_lake.workspace import shared_root

    folder = lambda: {f.name for f in pathlib.Path(shared_root(spark).removeprefix("file:"), "series_lake").glob("*")}
    before, kept = folder(), list(KEPT)
    near_duplicates(frame(spark)).count()
    release(spark, [p for p in KEPT if p not in kept])
    assert folder() == before
    with pytest.raises(Exception, match="broken"):
        near_duplicates(frame(spark).withColumn("text", F.raise_error(F.lit("broken")))).count()
    assert folder() == before


def brute_lines(rows, lines):
    docs = sorted({(r[0] is None, r[0] or 0, r[1]) for r in rows if r[1] is not None})
    places, sets = [], []
    for d, (_, _, text) in enumerate(docs):
        for k, line in enumerate(text.split("\n")):
            if len(line) >= lines.least:
                places.append((d, k))
                sets.append({line[q : q + lines.width] for q in range(len(line) - lines.width + 1)})
    root = roots(len(sets), similar(sets, lines.num, lines.den))
    first, gone = {}, defaultdict(set)
    for (d, k), at in zip(places, root, strict=True):
        if first.setdefault(at, (d, k)) != (d, k):
            gone[d].add(k)
    return docs, {docs[d]: "\n".join(x for k, x in enumerate(docs[d][2].split("\n")) if k not in gone[d]) for d in range(len(docs))}


def test_lines_equal_brute_force(spark):
    docs, want = brute_lines(documents(), Lines())
    got = dedup_lines(frame(spark)).collect()
    assert len(got) == len(documents())
    known = {}
    texts = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in got if r.text is not None)
    repeats = [(r[0] is None, r[0] or 0, want[(r[0] is None, r[0] or 0, r[1])]) for r in documents() if r[1] is not None]
    assert texts == sorted(repeats), known
    assert sum(r.text is None for r in got) == 1
    assert sum(r.n_removed for r in got) > 10


def test_lines_near_copies_and_short_lines(spark):
    rng = np.random.default_rng(2)
    words = [f"word{i}" for i in range(400)]
    line = " ".join(rng.choice(words, 60))
    rows = [(1, f"{line}\nshort line", None, None), (2, f"short line\n{line.replace(line.split()[30], 'other', 1)}\nshort line", None, None), (3, " ".join(rng.choice(words, 60)), None, None)]
    rows += [(10 + i, f"{line} tail{i}", None, None) for i in range(40)]
    got = {r.doc_id: r.text for r in dedup_lines(frame(spark, rows), Lines(least=40)).collect()}
    assert got[1] == rows[0][1] and got[2] == "short line\nshort line" and got[3] == rows[2][1]
    assert all(got[10 + i] == "" for i in range(40))
    assert dedup_lines(frame(spark, [])).count() == 0


def lines_query(spark, folder, rows):
    frame(spark, rows, clashes=False).write.parquet(str(folder / "documents.parquet"))
    return {r.doc_id: r.text for r in QUERIES["op7_line_minhash"](spark, str(folder)).collect()}


def test_short_lines_are_compared_and_blank_ones_are_not(spark, tmp_path):
    rows = [(1, "Les.\n\n \t\nShare this article\nx\n日", None, None), (2, "Les.\n\n \t\nLes\nShare this article\n日\nb\nab\nba", None, None)]
    rows += [(10 + i, f"All rights reserved.\n{i}\n\nx", None, None) for i in range(50)]
    want = {1: rows[0][1], 2: "\n \t\nLes\nb\nab\nba", 10: "All rights reserved.\n0\n"} | {10 + i: f"{i}\n" for i in range(1, 50)}
    assert lines_query(spark, tmp_path, rows) == want
    staged = corpus_pipeline.line_dedup(spark, frame(spark, rows, clashes=False).withColumn("n_chars", F.lit(0).cast("long")), "")
    assert {r.doc_id: r.text for r in staged.collect()} == want


def test_whole_lines_equal_brute_force(spark):
    rng = random.Random(8)
    rows = [(i, "\n".join("".join(rng.choice("ab c") for _ in range(rng.randrange(0, 14))) for _ in range(8)), None, None) for i in range(60)]
    rows += [(60 + i, "\n".join(x if rng.random() < 0.5 else x[:-1] for x in rows[i][1].split("\n")), None, None) for i in range(30)]
    places, sets = [], []
    for i, text, _, _ in rows:
        for k, line in enumerate(text.split("\n")):
            if line.strip():
                places.append((i, k))
                sets.append({line[q : q + EVERY_LINE.width] for q in range(max(1, len(line) - EVERY_LINE.width + 1))})
    first, gone = {}, set()
    for place, at in zip(places, roots(len(sets), similar(sets, EVERY_LINE.num, EVERY_LINE.den)), strict=True):
        if first.setdefault(at, place) != place:
            gone.add(place)
    want = {i: "\n".join(x for k, x in enumerate(text.split("\n")) if (i, k) not in gone) for i, text, _, _ in rows}
    assert {r.doc_id: r.text for r in dedup_lines(frame(spark, rows), EVERY_LINE).collect()} == want


def test_edits_in_ordinary_lines_are_found(spark, tmp_path):
    rng = random.Random(3)
    rows = []
    for i, size in enumerate(range(50, 121)):
        line = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(size - 1)) + "."
        at = rng.randrange(6, size - 6)
        rows += [(2 * i, line, None, None), (2 * i + 1, f"{line[:at]}#{line[at + 1 :]}", None, None)]
    for i, size in enumerate(range(90, 121)):  # one word of five letters for another
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(size // 6 + 1)]
        other = [*words]
        other[len(words) // 2] = "?????"
        rows += [(1000 + 2 * i, " ".join(words), None, None), (1001 + 2 * i, " ".join(other), None, None)]
    got = lines_query(spark, tmp_path, rows)
    assert all(got[i] == text for i, text, _, _ in rows if i % 2 == 0)
    lost = [i for i, *_ in rows if i % 2 and got[i]]
    assert len(lost) <= 2  # of 102, by the recall of the bands


def test_bitmaps_rule_out_no_similar_lines():
    """Lines of many lengths, some with repeated shingles, whose bitmaps have different lengths."""
    rng, lines = random.Random(11), Lines()
    texts = []
    for size in (5, 6, 30, 60, 90, 200, 400, 900):
        base = "".join(rng.choice("abcdefgh ") for _ in range(size))
        for _ in range(12):
            own = list(base)
            for k in rng.sample(range(size), min(size, rng.randrange(0, max(2, size // 25)))):
                own[k] = rng.choice("XYZ")
            texts += ["".join(own), "".join(own) + "".join(own[: size // 10])]
    texts += ["".join(rng.choice("abcdefgh ") for _ in range(200)) for _ in range(30)]
    texts += ["ab" * 5, "ab" * 400, "ab" * 90_000, "aaaaa", "a" * 3000]
    codes = line_dedup._codes("\n".join(texts))
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    _, _, bits = line_dedup.signatures(codes, ends - [len(t) for t in texts], ends, lines)
    i, j = np.triu_indices(len(texts), 1)
    near = line_dedup.Bitmaps(bits, np.array([len(t) - 4 for t in texts]), lines).near(i, j)
    sets = line_dedup._sets(texts, lines.width)
    alike = np.array([line_dedup._near(sets[a], sets[b], lines) for a, b in zip(i.tolist(), j.tolist(), strict=True)])
    others = (i >= 8 * 24) & (j < 8 * 24 + 30)
    assert alike.sum() > 300 and near[alike].all() and near[others].mean() < 0.02


def test_texts_of_lines_that_cannot_be_alike_are_not_sent(spark, monkeypatch):
    """Lines that share half of their shingles meet in a band, all with all, and are not alike."""
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    rows = []
    for i in range(40):
        common = word(120)
        rows += [(10 * i + k, common + word(80), None, None) for k in range(6)]
    rows += [(1000, rows[0][1] + "x", None, None)]
    sent, write = [], Staging.write

    def counted(area, table, keep=False):
        back = write(area, table, keep)
        if "line" in back.columns:
            sent.append(back.count())
        return back

    monkeypatch.setattr(Staging, "write", counted)
    got = dedup_lines(frame(spark, rows), EVERY_LINE).where("n_removed > 0").select("doc_id").collect()
    assert [r.doc_id for r in got] == [1000]
    assert sum(sent) <= 20  # of 241 lines
