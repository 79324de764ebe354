"""The index of signatures in arrays: no pair is lost, and few rows go to Spark."""

import numpy as np
import pyarrow as pa
import pytest

from series_lake.llm import components, line_dedup, ngram_join
from series_lake.llm.components import dealt, members
from series_lake.llm.line_dedup import Lines, described, signatures


def entries(rng, kind, n=6000, sigs=900, nodes=400):
    rows = np.zeros(n, dtype=kind)
    rows["sig"] = _spread(rng.integers(0, sigs, n))
    rows["sig"][:300] = rows["sig"][0]
    rows["node"] = rng.integers(-nodes, nodes, n)
    if "n" in kind.names:
        rows["n"] = 20 + 13 * (rows["node"] % 7)
    if "e" in kind.names:
        rows["e"] = rng.integers(0, 3, n)
    return rows


def _spread(x):
    with np.errstate(over="ignore"):
        return (x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def by_bucket(batches):
    return pa.Table.from_batches(batches).sort_by("bucket").to_batches(max_chunksize=7)


@pytest.mark.parametrize("run", [1 << 21, 40])
@pytest.mark.parametrize("kind", [line_dedup.ENTRY, ngram_join.ENTRY])
def test_every_pair_of_a_signature_meets(monkeypatch, kind, run):
    monkeypatch.setattr(components, "RUN", run)
    monkeypatch.setattr(components, "SENT", 16)
    rows = entries(np.random.default_rng(3), kind)
    near = line_dedup._alike_in_size(Lines()) if "n" in kind.names else None
    size = dict(zip(rows["node"].tolist(), rows["n"].tolist() if near else [1] * len(rows), strict=True))
    batches = [dealt(rows[:2500], 5), dealt(rows[2500:], 5)]
    found = pa.concat_tables(pa.Table.from_batches([b]) for b in members(kind, near)(iter(by_bucket(batches)))).to_pylist()
    pairs, rest = set(), {}
    for r in found:
        assert r["node"] != r["hub"]
        if r["pair"]:
            pairs.add((r["sig"], *sorted((r["node"], r["hub"]))))
        if r["rest"]:
            rest.setdefault(r["sig"], set()).add(r["node"])
    held = {}
    for s, x in zip(rows["sig"].tolist(), rows["node"].tolist(), strict=True):
        held.setdefault(s, set()).add(x)
    wanted = {(s, a, b) for s, own in held.items() for a in own for b in own if a < b and 100 * min(size[a], size[b]) >= 80 * max(size[a], size[b])}
    left = {p for p in wanted if p not in pairs and not {p[1], p[2]} <= rest.get(p[0], set())}
    assert wanted and not left
    assert pairs <= wanted


def test_an_index_is_few_rows():
    rows = entries(np.random.default_rng(4), line_dedup.ENTRY, n=50_000, sigs=40_000)
    told = dealt(rows, 3)
    assert told.num_rows < 60 and sum(len(x.as_py()) for x in told.column("held")) == rows.nbytes
    assert dealt(rows[:0], 3).num_rows == 0


def test_lines_know_how_many_shingles_they_have():
    texts = ["abcde" * 30, "abcde", "the quick brown fox jumps over the lazy dog", "a" * 400, "abcdefghij" * 3] * 1000
    codes = np.frombuffer("\n".join(texts).encode("utf-32-le"), dtype=np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    starts = ends - [len(t) for t in texts]
    names, keys, bits, n = described(codes, starts, ends, Lines())
    assert n.tolist() == [len({t[i : i + 5] for i in range(len(t) - 4)}) for t in texts]
    assert (signatures(codes, starts, ends, Lines())[1] == keys).all() and len(bits) == len(names) == len(texts)
