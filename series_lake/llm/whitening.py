"""Whitening of embeddings by their weighted covariance.

Equal vectors are grouped first; each distinct vector carries a weight, its number of rows or one.
Sums and the covariance are weighted over the distinct vectors, each is whitened once, and the
results are joined back to the rows.

A vector's entries c, as double, become integers x = floor(1024 * c) + 100000, so sums are exact. The
covariance is centred before multiplying: x - S / n is formed from integers and the fraction of
S / n, and only then multiplied, in blocks of a task; partial sums are added on Spark, and the driver
gets one matrix of dimensions x dimensions. Components are the unit eigenvectors by falling
eigenvalue, the entry of largest size positive; those whose eigenvalue is nothing but rounding
(vectors in a smaller space, one distinct vector) are left out, so there may be fewer than asked.

Vectors that are null or hold null or non-finite entries, or entries of 2^52 or more in size, which
have no exact x, take no part. A shorter vector counts as padded with zeros. Repeated rows and rows
with a null id are rows like others. Without vectors the result is empty. A deviation beyond 64
bits is null. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from series_lake.llm.staging import staging

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: Rows of a block that is multiplied at once.
BLOCK = 4096
#: Vectors that a larger share of all rows repeats than 1 / HEAVY go to the rows, others by a shuffle.
HEAVY = 4096
LARGEST = 2.0**52
KEY = ["k1", "k2"]


def usable(vector: Column) -> Column:
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(LARGEST / SCALE)))
    return vector.isNotNull() & F.coalesce(good, F.lit(False))


def whole(vector: Column, width: int) -> Column:
    """The x of a vector, padded to ``width``."""
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("bigint") + SHIFT)
    pad = F.array_repeat(F.lit(SHIFT).cast("bigint"), F.greatest(F.lit(width) - F.size(vector), F.lit(0)))
    return F.concat(x, pad)


def _rows(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), width)


def _sums(width: int):
    """(at, total): exact weighted sums of each dimension over a task, and of the weights at -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight = [0] * width, 0
        for batch in batches:
            x, w = _rows(batch.column("x"), width), batch.column("w").to_numpy()
            weight += int(w.sum())
            if len(x):
                safe = float(np.abs(x).max()) * float(w.sum()) < 2.0**62
                own = (w @ x if safe else w.astype(object) @ x.astype(object)).tolist()
                total = [t + o for t, o in zip(total, own, strict=True)]
        yield pa.RecordBatch.from_pydict({"at": list(range(-1, width)), "total": [str(t) for t in (weight, *total)]})

    return run


class Centre:
    """x - S / n without loss: S / n as an integer and a fraction."""

    def __init__(self, sums: list[int], n: int):
        self.sums, self.n = sums, n
        self.floor = np.array([s // n for s in sums], dtype=np.int64)
        self.rest = np.array([(s % n) / n for s in sums])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.floor) - self.rest

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2, exact."""
        off, over = x - self.floor, np.array([s % self.n for s in self.sums], dtype=object)
        most = (float(np.abs(off).max(initial=0)) + 1) * self.n
        if most * most * max(1, x.shape[1]) < 2.0**62:
            return ((off * self.n - over.astype(np.int64)) ** 2).sum(axis=1).tolist()
        return ((off.astype(object) * self.n - over) ** 2).sum(axis=1).tolist()


def _products(column: str, width: int, centre):
    """(cell, total): the weighted sum of centred outer products over a task, upper triangle."""
    upper = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            rows, w = _rows(batch.column(column), width), batch.column("w").to_numpy().astype(np.float64)
            for low in range(0, len(rows), BLOCK):
                c = centre(rows[low : low + BLOCK])
                total += (c * w[low : low + BLOCK, None]).T @ c
        yield pa.RecordBatch.from_pydict({"cell": (upper[0] * width + upper[1]).astype(np.int64), "total": total[upper]})

    return run


def covariance(frame: DataFrame, column: str, width: int, centre, n: int) -> np.ndarray:
    """The weighted covariance of the rows in ``column`` (weights ``w``), divisor ``n``."""
    cells = frame.select(column, "w").mapInArrow(_products(column, width, centre), "cell long, total double")
    out = np.zeros((width, width))
    for r in cells.groupBy("cell").agg(F.sum("total").alias("total")).collect():  # dimensions x dimensions
        out[r["cell"] // width, r["cell"] % width] = out[r["cell"] % width, r["cell"] // width] = r["total"]
    return out / n


def _whitened(width: int, centre: Centre, axes: np.ndarray, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows(batch.column("x"), width)
            z = (centre(x) @ axes).ravel()
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * size), pa.array(z))
            deviation = pa.array([d if d < 2**63 else None for d in centre.deviation(x)], pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in (*KEY, "w")], deviation, values], names=[*KEY, "w", "deviation", "z"])

    return run


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, weights: str = "counts", heavy: int = HEAVY) -> DataFrame:
    """A row per usable row and component: vec_id, component (from 1), n (sum of weights), deviation
    (sum over dimensions of (n x - S)^2), whitened, explained (share of the eigenvalue in the trace)
    and identity_error (largest entry of whitened's covariance minus the identity).

    ``weights``: "counts" fits on all rows, "one" on the distinct vectors.
    """
    if weights not in ("counts", "one"):
        raise ValueError(f"weights must be counts or one, not {weights!r}")
    spark = vectors.sparkSession
    read = vectors.where(usable(F.col(vector_col))).select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v"))
    with staging(spark, "whitening") as area:
        kind = read.schema["vec_id"].dataType.simpleString()
        empty = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        width = read.agg(F.max(F.size("v"))).first()[0]
        if not width:
            return spark.createDataFrame([], empty)
        x = whole(F.col("v"), width)
        # 128 bits name a vector in the join; grouping compares the vectors themselves.
        named = read.select("vec_id", x.alias("x")).select("vec_id", "x", F.xxhash64("x").alias("k1"), F.xxhash64(F.lit(1), "x").alias("k2"))
        grouped = named.groupBy(*KEY, "x").agg(F.count("*").alias("copies"))
        distinct = area.write(grouped.withColumn("w", F.col("copies") if weights == "counts" else F.lit(1).cast("bigint")))
        totals = distinct.select("x", "w").mapInArrow(_sums(width), "at long, total string").groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        sums = {r["at"]: int(r["total"]) for r in totals.collect()}  # a number per dimension
        n = sums[-1]
        centre = Centre([sums[d] for d in range(width)], n)
        v = covariance(distinct, "x", width, centre, n)
        values, axes = np.linalg.eigh(v)
        order = np.argsort(-values, kind="stable")[:components]
        order = order[values[order] > max(0.0, float(values.max())) * width * np.finfo(float).eps * 16]
        if not len(order):
            return spark.createDataFrame([], empty)
        values, axes = values[order], axes[:, order]
        axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(len(order))] < 0, -1.0, 1.0)
        size = len(order)
        shape = "k1 long, k2 long, w long, deviation long, z array<double>"
        once = area.write(distinct.select("x", *KEY, "w").mapInArrow(_whitened(width, centre, axes / np.sqrt(values), size), shape), keep=True)
        mean = np.array(once.agg(*[F.sum(F.col("w") * F.get("z", F.lit(k))) / n for k in range(size)]).first(), dtype=np.float64)
        error = float(np.abs(covariance(once, "z", size, lambda z: z - mean, n) - np.eye(size)).max())
        # Vectors that very many rows repeat are few: at most ``heavy`` of them reach the rows' tasks.
        copies = distinct.agg(F.sum("copies")).first()[0]
        often = area.write(distinct.where(F.col("copies") > F.lit(copies) / heavy).select(*KEY).join(once, KEY).select(*KEY, "deviation", "z"), keep=True)
        known = often.select(F.col("k1").alias("h1"), F.col("k2").alias("h2"), F.col("deviation").alias("h_deviation"), F.col("z").alias("h_z"))
        marked = named.drop("x").join(F.broadcast(known), (F.col("k1") == F.col("h1")) & (F.col("k2") == F.col("h2")), "left")
        common = marked.where(F.col("h1").isNotNull()).select("vec_id", F.col("h_deviation").alias("deviation"), F.col("h_z").alias("z"))
        rare = marked.where(F.col("h1").isNull()).select("vec_id", *KEY).join(once.select(*KEY, "deviation", "z"), KEY).select("vec_id", "deviation", "z")
        share = F.array(*[F.lit(float(e / np.trace(v))) for e in values])
        told = common.unionByName(rare).select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened"))
        return told.select(
            "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
            F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
        )
