"""Exact top-k search by distributed histogram selection.

Every query is scored against every vector. A histogram of the scores per query, summed over
all tasks, tells which bin holds the k-th best score; that bin is divided again until it is one
score wide. A last pass keeps the scores above the k-th and, of those equal to it, the
smallest ids. A task reports only bins and ties that can still matter: its own k best bound
the k-th best of all from below, so what it sends grows with the queries and not with its rows.

Queries are dealt in blocks of bounded size, each of which is sent to all tasks.

Components are turned into floor(1024 * x), x as double. Vectors that are null or hold null or
non-finite components, or have no id, take no part. A shorter vector counts as padded with
zeros. A row is a candidate of every query but those with its own id; rows that repeat id and
vector are one query but stay separate candidates. Scores beyond 64 bits are clamped. Ties go
to the smaller id. Fewer candidates than k give fewer rows, empty tables none. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from series_lake.llm.staging import staging

BINS = 4096
BLOCK = 1024
CHUNK = 4096
EXACT = 2**53
LONGEST = 2**63 - 1


def usable(vector: Column) -> Column:
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & F.coalesce(good, F.lit(False))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows floor(1024 x) as float64, padded to ``width``; longer vectors keep what ``width`` covers."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    values = np.floor(1024.0 * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if len(sizes) and (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = at < width
    out[row[inside], at[inside]] = values[inside]
    return out


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact products [query, vector] as int64; floats where they are exact, else Python numbers."""
    if not queries.size or not vectors.size:
        return np.zeros((len(queries), len(vectors)), dtype=np.int64)
    if queries.shape[1] * np.abs(queries).max() * np.abs(vectors).max() < EXACT:
        return (queries @ vectors.T).astype(np.int64)
    big = np.vectorize(int, otypes=[object])
    return np.clip(big(queries) @ big(vectors).T, -LONGEST, LONGEST).astype(np.int64)


class _Scorer:
    """Scores of a block of queries against the batches of one task, own ids left out."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray):
        self.ids, self.queries = ids, queries

    def chunks(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, scores, mask of the pairs that count)."""
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                scores = _scores(self.queries, _matrix(part.column(1), self.queries.shape[1]))
                yield ids, scores, self.ids[:, None] != ids[None, :]


def _ordinal(scores: np.ndarray) -> np.ndarray:
    """64-bit numbers in the same order, from 0 on, so that differences do not overflow."""
    return scores.view(np.uint64) ^ np.uint64(1 << 63)


def _histogram(scorer: _Scorer, low: np.ndarray, step: np.ndarray, k: int):
    """Counts of the ordinals >= low per bin of ``step``; those beyond the last bin count there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(low)
        counts = np.zeros((n, BINS), dtype=np.int64)
        for _, scores, counted in scorer.chunks(batches):
            ordinals = _ordinal(scores)
            query, column = np.nonzero(counted & (ordinals >= low[:, None]))
            bins = np.minimum((ordinals[query, column] - low[query]) // step[query], BINS - 1).astype(np.int64)
            counts += np.bincount(query * BINS + bins, minlength=n * BINS).reshape(n, BINS)
        # From the best bin down to the one that completes this task's k best.
        above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
        query, bins = np.nonzero((counts > 0) & (above < k))
        yield pa.RecordBatch.from_arrays([pa.array(query.astype(np.int32)), pa.array(bins.astype(np.int32)), pa.array(counts[query, bins])], names=["q", "bin", "n"])

    return run


def _best(scorer: _Scorer, kth: np.ndarray, k: int):
    def trimmed(query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        first = np.searchsorted(query, query, side="left")
        keep = np.arange(len(query)) - first < k
        return query[keep], score[keep], ids[keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        for ids, scores, counted in scorer.chunks(batches):
            query, column = np.nonzero(counted & (scores >= kth[:, None]))
            more = (query, scores[query, column], ids[column])
            best = trimmed(*[np.concatenate(x) for x in zip(best, more, strict=True)])
        names = ["query_id", "score", "vec_id"]
        yield pa.RecordBatch.from_arrays([pa.array(scorer.ids[best[0]]), pa.array(best[1]), pa.array(best[2])], names=names)

    return run


def _kth_scores(vectors: DataFrame, scorer: _Scorer, bound: list[int], k: int) -> np.ndarray:
    """The k-th best score of every query, or a score below all where there are fewer."""
    n = len(bound)
    low = np.array([2**63 - b for b in bound], dtype=np.uint64)
    width = np.array([2 * b + 1 for b in bound], dtype=np.uint64)
    need = np.full(n, k, dtype=np.int64)  # how many of the scores from ``low`` on are still to be found
    while (width > 1).any():
        step = width // np.uint64(BINS) + (width % np.uint64(BINS) > 0)
        counted = vectors.mapInArrow(_histogram(scorer, low, step, k), "q int, bin int, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("q").orderBy(F.desc("bin")))
        limits = vectors.sparkSession.createDataFrame([(i, int(x)) for i, x in enumerate(need)], "q int, need long")
        found = counted.withColumn("upto", upto).join(F.broadcast(limits), "q").where("upto >= need").groupBy("q").agg(F.max("bin").alias("bin"))
        at = {r["q"]: r["bin"] for r in found.collect()}  # one row per query of the block
        bins = np.array([at.get(i, 0) for i in range(n)], dtype=np.uint64)
        enough = np.array([i in at for i in range(n)])
        low = low + bins * step
        width = np.where(enough, step, np.uint64(1))
    return _ordinal(low.view(np.int64)).view(np.int64)


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best of ``vectors`` per row of ``queries``."""
    spark = vectors.sparkSession

    def pairs(frame: DataFrame) -> DataFrame:
        both = frame.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
        return both.where(F.col("id").isNotNull() & usable(F.col("vector")))

    with staging(spark, "topk") as area:
        asked = area.write(pairs(queries).distinct())
        blocks = -(-asked.count() // block) or 1
        candidates = pairs(vectors)
        limits = candidates.agg(F.max(F.size("vector")), F.max(F.array_max(F.transform("vector", lambda x: F.abs(F.floor(1024 * x).cast("double")))))).first()
        parts = []
        for b in range(blocks):  # a block is a bounded set of queries
            rows = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()
            if not rows or limits[0] is None:
                continue
            lists = pa.array([r["vector"] for r in rows], pa.list_(pa.float64()))
            matrix = _matrix(lists, max(limits[0], max(len(r["vector"]) for r in rows)))
            scorer = _Scorer(np.array([r["id"] for r in rows], dtype=np.int64), matrix)
            bound = [min(LONGEST, int(b) + 1) for b in np.abs(matrix).sum(axis=1) * (limits[1] or 0.0)]
            kth = _kth_scores(candidates, scorer, bound, k)
            parts.append(area.write(candidates.mapInArrow(_best(scorer, kth, k), "query_id long, score long, vec_id long"), keep=True))
        if not parts:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
        best = parts[0]
        for p in parts[1:]:
            best = best.unionByName(p)
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        return ranked.select("query_id", "rank", "vec_id", "score")
