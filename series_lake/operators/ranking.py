"""Top lists, pages and ranks by market cap."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: rows per page of the market listing.
PAGE_SIZE = 25
#: Most rows of a ranking that one task may hold.
HELD = 10_000


def _by_market_cap() -> list[Column]:
    return [F.desc_nulls_last("market_cap"), F.asc("id")]


def top_n(markets: DataFrame, n: int = PAGE_SIZE) -> DataFrame:
    """The ``n`` largest; each task keeps only its own ``n``."""
    return markets.orderBy(*_by_market_cap()).limit(n)


def page(markets: DataFrame, number: int, size: int = PAGE_SIZE, held: int = HELD) -> DataFrame:
    """Page ``number`` (from 1) of the ranking.

    Up to ``held`` rows, the page and those before it are the tops of the tasks. Further down
    ranks (see ``with_rank``) tell which rows can be on the page, so a deep page neither sorts nor
    holds the rows before it. Of rows with equal value that reach over the edge of the page,
    the ids are ranked the same way, so neither does a large tie.
    """
    low, high = (number - 1) * size, number * size
    if high <= held:
        return top_n(markets, high).orderBy(*_by_market_cap()).offset(low)
    ranked = with_rank(markets, "market_cap", "_rank")
    spans = ranked.groupBy("_rank").agg(F.count("*").alias("_ties"))
    on_page = spans.where((F.col("_rank") <= high) & (F.col("_rank") + F.col("_ties") > low + 1)).select("_rank", "_ties")
    near = ranked.join(on_page, "_rank")
    inside = near.where((F.col("_rank") > low) & (F.col("_rank") + F.col("_ties") - 1 <= high))
    parts = [inside.select(*markets.columns)]
    # At most two ties reach over an edge: the one that the page begins in, the one it ends in.
    begins = (F.col("_rank") <= low) & (F.col("_rank") + F.col("_ties") > low + 1)
    ends = (F.col("_rank") > low) & (F.col("_rank") + F.col("_ties") - 1 > high)
    for cut in (begins, ends):
        place = F.col("_rank") + F.col("_nth") - 1
        parts.append(with_rank(near.where(cut), "id", "_nth", ascending=True).where(place.between(low + 1, high)).select(*markets.columns))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).orderBy(*_by_market_cap()).limit(size)


def with_position(markets: DataFrame, n: int = PAGE_SIZE) -> DataFrame:
    """The ``n`` largest with their position from 1. The window sees those ``n`` rows only."""
    return top_n(markets, n).withColumn("position", F.row_number().over(Window.orderBy(*_by_market_cap())).cast("long"))


def _range_of(value: Column, bounds: list, low: int, high: int) -> Column:
    """Number of bounds below the value, as a balanced tree of comparisons: compiled, and
    as many comparisons per row as the tree is deep."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(value <= F.lit(bounds[middle]), _range_of(value, bounds, low, middle)).otherwise(
        _range_of(value, bounds, middle + 1, high)
    )


def _cut_points(counted: DataFrame, value: str, ranges: int | None, range_values: int) -> list:
    """Values that divide the distinct values into ranges of about ``range_values``.

    At least as many ranges as a shuffle has partitions, and no upper limit: a range must fit a
    task. Numbers are cut at approximate quantiles, other values at sampled ones; the cut points
    only balance the work, any of them give exact ranks.
    """
    spark = counted.sparkSession
    few = int(spark.conf.get("spark.sql.shuffle.partitions")) if ranges is None else ranges
    numeric = isinstance(counted.schema[value].dataType, T.NumericType)

    def quantiles(parts: int) -> Column:
        return F.percentile_approx(value, [i / parts for i in range(1, parts)] or [0.5], max(10_000, 10 * parts)).alias("cuts")

    # one look at the values gives their number and, unless there are very many, the cut points
    told = counted.agg(F.count("*").alias("n"), *([quantiles(few)] if numeric else [])).first() if numeric or ranges is None else None
    needed = few if ranges is not None else max(few, -(-told["n"] // range_values))
    if needed < 2:
        return []
    if numeric:
        cuts = told["cuts"] if needed == few else counted.agg(quantiles(needed)).first()["cuts"]
        return sorted(set(cuts or []))
    ranges = needed
    # A uniform sample by hash: the smallest hashes, a bounded number of them.
    sample = sorted(r[0] for r in counted.select(value).orderBy(F.xxhash64(value), value).limit(32 * ranges).collect())
    return sorted({sample[i * len(sample) // ranges] for i in range(1, ranges)}) if sample else []


def with_rank(frame: DataFrame, value: str = "market_cap", name: str = "market_cap_rank", ranges: int | None = None, range_values: int = 1_000_000, ascending: bool = False) -> DataFrame:
    """Adds the rank by ``value``, largest first, equal values sharing a rank, NULL last.

    A window over the whole table would be a single task. Instead the distinct values are
    cut into ranges; a rank is the number of rows in the ranges before plus the number of rows
    before within the range. Only the cut points are fetched while the plan is made; ranks, rows
    and the rank of NULL all come from one evaluation of it. Equal values are counted before
    they meet, rows without a value never enter the join.
    """
    frame = frame.drop(name)  # a rank that the rows carry is replaced
    valued = frame.where(F.col(value).isNotNull())
    counted = valued.groupBy(value).agg(F.count("*").alias("n"))
    bounds = _cut_points(counted, value, ranges, range_values)
    # Two levels of comparisons, so that neither expression grows with all the bounds.
    width = max(1, math.isqrt(len(bounds)))
    outer = bounds[width - 1 :: width]
    inner = F.lit(0)
    if len(bounds) > width:
        groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]
        field = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("within", T.ArrayType(frame.schema[value].dataType))])
        table = frame.sparkSession.createDataFrame(list(enumerate([*groups, []][: len(outer) + 1])), field)
        parted = counted.withColumn("part", _range_of(F.col(value), outer, 0, len(outer))).join(F.broadcast(table), "part")
        inner = F.size(F.filter("within", lambda b: b < F.col(value)))
    else:
        parted = counted.withColumn("part", _range_of(F.col(value), bounds, 0, len(bounds)))
    ranged = parted.withColumn("sub", inner)

    order = F.asc if ascending else F.desc
    earlier = Window.orderBy(order("part"), order("sub")).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("part", "sub").agg(F.sum("n").alias("rows"))
    offsets = totals.select("part", "sub", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("above"))

    within = Window.partitionBy("part", "sub").orderBy(order(value)).rowsBetween(Window.unboundedPreceding, -1)
    ranks = (
        ranged.withColumn("higher", F.coalesce(F.sum("n").over(within), F.lit(0)))
        .join(offsets, ["part", "sub"])
        .select(F.col(value).alias("_value"), (F.col("above") + F.col("higher") + 1).alias(name))
    )
    known = valued.join(ranks, valued[value] == F.col("_value")).select(*frame.columns, name)
    # rows without a value rank after all others, as NULLS LAST orders them
    after_all = F.coalesce(totals.agg(F.sum("rows")).scalar(), F.lit(0)) + 1
    unknown = frame.where(F.col(value).isNull()).select(*frame.columns, after_all.cast("long").alias(name))
    return known.unionByName(unknown)
