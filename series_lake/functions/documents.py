"""Nested documents and semi-structured rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from series_lake.functions.timeconv import DAY_MS, floor_div
from series_lake.schemas import DESCRIPTIVE, LEG_ARRAYS, LEGS


#: Points of an asset that are put into one document of a segmented landing, or twice as many.
SEGMENT_POINTS = 20_000
MINUTE_MS = 60_000


def build_envelope(points: DataFrame, element: str = "double", segmented: bool = False) -> DataFrame:
    """Long series back to documents: the inverse of exploding the legs.

    ``points`` has one row per asset and instant; a leg without a value at an instant gets
    no pair there. An asset becomes one document, whose size is the number of its instants; with
    ``segmented`` it becomes one per value of the column ``segment`` (see ``with_segments``), which
    bounds documents however many points an asset has. ``element="variant"`` keeps times integral
    in JSON output.
    """

    def pair(leg: str) -> Column:
        parts = [F.col("timestamp").cast("long"), F.col(leg).cast("double")]
        target = "variant" if element == "variant" else "double"
        return F.array(*[p.cast(target) for p in parts])

    def series(leg: str) -> Column:
        # variants have no order: sort on the plain time, then keep the pair
        entry = F.struct(F.col("timestamp").alias("t"), pair(leg).alias("p"))
        ordered = F.array_sort(
            F.collect_list(F.when(F.col(leg).isNotNull(), entry)),
            lambda a, b: F.when(a["t"] < b["t"], -1).when(a["t"] > b["t"], 1).otherwise(0),
        )
        return F.transform(ordered, lambda e: e["p"]).alias(leg)

    unit = ["segment"] if segmented else []
    grouped = points.groupBy("coin_id", *DESCRIPTIVE, *unit).agg(*[series(leg) for leg in LEGS])
    data = F.struct(*[F.col(leg).alias(name) for leg, name in LEG_ARRAYS.items()])
    return grouped.select("coin_id", *DESCRIPTIVE, *unit, data.alias("data"))


def with_segments(points: DataFrame, most: int = SEGMENT_POINTS) -> DataFrame:
    """Adds ``segment``, the first instant of a stretch of the asset's series that holds at most
    ``most`` points, or twice as many where a day or minute brings them.

    Bounds come from a histogram of each asset's instants: per day, for days with more than
    ``most`` points per minute, and for such minutes per millisecond. Blocks are put together in
    order until ``most`` is reached. So the running sums go over an asset's days, a day's minutes or
    a minute's instants, never over points; an instant is never divided, and points spread over
    as many groups as there are days. Points without asset or time are in segment 0.
    """
    within = "coin_id", "day"
    at = points.select("*", floor_div(F.col("timestamp"), DAY_MS).alias("day"), floor_div(F.col("timestamp"), MINUTE_MS).alias("minute"))
    keyed = at.where(F.col("coin_id").isNotNull() & F.col("timestamp").isNotNull())

    def bounds(counts: DataFrame, group: list[str], block: str, name: str) -> DataFrame:
        """Per block: its points, and the first instant of the stretch that it falls in."""
        order = Window.partitionBy(*group).orderBy(block)
        # a block that is divided itself ends the stretch before it
        size = F.when(F.col("n") > most, F.lit(most)).otherwise(F.col("n"))
        before = F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        placed = counts.select(*group, block, "n", "first", floor_div(before.cast("bigint"), most).alias("stretch"))
        stretch = Window.partitionBy(*group, "stretch")
        return placed.select(*group, block, F.col("n").alias(f"{name}_n"), F.min("first").over(stretch).alias(f"{name}_from"))

    told = [F.count("*").alias("n"), F.min("timestamp").alias("first")]
    days = bounds(keyed.groupBy(*within).agg(*told), ["coin_id"], "day", "day")
    joined = keyed.join(days, list(within))
    plain = joined.where(F.col("day_n") <= most).withColumn("segment", F.col("day_from"))
    dense = joined.where(F.col("day_n") > most).drop("day_n", "day_from")
    minutes = bounds(dense.groupBy(*within, "minute").agg(*told), list(within), "minute", "minute")
    joined = dense.join(minutes, [*within, "minute"])
    by_minute = joined.where(F.col("minute_n") <= most).withColumn("segment", F.col("minute_from"))
    denser = joined.where(F.col("minute_n") > most).drop("minute_n", "minute_from")
    instants = bounds(denser.groupBy("coin_id", "minute", "timestamp").agg(*told), ["coin_id", "minute"], "timestamp", "instant")
    by_instant = denser.join(instants, ["coin_id", "minute", "timestamp"]).withColumn("segment", F.col("instant_from"))
    unkeyed = at.where(F.col("coin_id").isNull() | F.col("timestamp").isNull()).withColumn("segment", F.lit(0).cast("bigint"))
    parts = [f.select(*points.columns, "segment") for f in (plain, by_minute, by_instant, unkeyed)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def to_document_text(frame: DataFrame, *columns: str) -> Column:
    """One JSON text per row."""
    return F.to_json(F.struct(*(columns or frame.columns)))


def from_document_text(text: Column, schema: T.StructType) -> Column:
    return F.from_json(text, schema)


def row_object(frame: DataFrame) -> Column:
    """The whole row as one semi-structured value."""
    return F.to_variant_object(F.struct(*frame.columns))


def path_value(row: Column, name: str, dtype: str) -> Column:
    """Typed value at a top-level, case-sensitive path; NULL when absent or not convertible."""
    return F.try_variant_get(row, f"$.{name}", dtype)
