"""Rolling 24-hour and all-time metrics of a price series.

A plain window per asset sorts each asset in one task, which fails as soon as one asset
holds a large part of all rows. Here time is cut into blocks (an hour by default) and a
frame is put together from three pieces:

* the part of the row's own block up to the row: a running window per (asset, block);
* the whole blocks in between: a window over one row per (asset, block);
* the cut-off oldest block, 24 hours back: its rows are sent along once more to the block
  24 hours later ("echo" rows) and read by a running window in descending order.

Every group is then one block of one asset plus its echo; rows travel twice whatever the
block width, so narrower blocks only cost more rows in the small per-block table. All
frames over rows are running ones, which take linear time, whereas a sliding 24-hour frame
looks at each row once for every row it covers.
Rows without a price never decide a result; rows without asset or time keep NULL metrics and
are not sorted with others. Keys must be unique (merge first) where the
earliest price matters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from series_lake.functions.timeconv import DAY_MS, HOUR_MS, floor_div

FRAME_MS = DAY_MS
ROLLING = ["high_24h", "low_24h", "price_change_24h", "price_change_percentage_24h"]


def block_table(flat: DataFrame, width: int) -> DataFrame:
    """One row per asset and block, combined before its exchange."""
    return flat.groupBy("coin_id", floor_div(F.col("timestamp"), width).alias("block")).agg(
        F.max("price").alias("b_high"),
        F.min("price").alias("b_low"),
        F.min_by("price", F.when(F.col("price").isNotNull(), F.col("timestamp"))).alias("b_first"),
    )


def _keyed(flat: DataFrame) -> DataFrame:
    return flat.where(F.col("coin_id").isNotNull() & F.col("timestamp").isNotNull())


def _with_unkeyed(measured: DataFrame, flat: DataFrame) -> DataFrame:
    """The rows without asset or time come back with NULL metrics."""
    unkeyed = flat.where(F.col("coin_id").isNull() | F.col("timestamp").isNull())
    added = [F.lit(None).cast(measured.schema[c].dataType).alias(c) for c in measured.columns if c not in flat.columns]
    return measured.unionByName(unkeyed.select("*", *added))


def rolling_24h(flat: DataFrame, block_ms: int = HOUR_MS) -> DataFrame:
    """Adds high, low, change and percentage change over the preceding 24 hours.

    The frame includes the row itself and a row exactly 24 hours older. The change is
    against the earliest price in the frame; the percentage is NULL when that is zero.
    """
    return price_metrics(flat, block_ms).select(*flat.columns, *ROLLING)


def price_metrics(flat: DataFrame, block_ms: int = HOUR_MS, blocks: DataFrame | None = None) -> DataFrame:
    """The rolling and the all-time metrics together, over one exchange of the rows.

    ``blocks``: the block table to use instead of that of ``flat``, where ``flat`` is only the last
    part of its series (see ``sinks.summaries``); it holds at least the blocks of ``flat``.
    """
    if FRAME_MS % block_ms:
        raise ValueError("a block must divide 24 hours")
    span = FRAME_MS // block_ms
    everything, flat = flat, _keyed(flat)

    by_block = Window.partitionBy("coin_id").orderBy("block")
    between, before = by_block.rangeBetween(-(span - 1), -1), by_block.rangeBetween(Window.unboundedPreceding, -1)
    table = block_table(flat, block_ms) if blocks is None else blocks
    blocks = table.select(
        "coin_id",
        "block",
        F.max("b_high").over(before).alias("p_high"),
        F.min("b_low").over(before).alias("p_low"),
        F.max("b_high").over(between).alias("m_high"),
        F.min("b_low").over(between).alias("m_low"),
        F.first("b_first", ignorenulls=True).over(between).alias("m_first"),
    )

    # position = the row's own time, or 24 hours after it for its echo; an echo carries
    # nothing but its price
    needed = ("coin_id", "timestamp", "price")
    echoed = flat.select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("echo"))
    placed = echoed.select(
        *[F.col(c) if c in needed else F.when(~F.col("echo"), F.col(c)).alias(c) for c in flat.columns], "echo"
    )
    position = F.col("timestamp") + F.when(F.col("echo"), F.lit(FRAME_MS)).otherwise(F.lit(0))
    placed = placed.withColumn("pos", position).withColumn("block", floor_div(F.col("pos"), block_ms))

    group = Window.partitionBy("coin_id", "block")
    up_to = group.orderBy("pos").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    down_to = group.orderBy(F.col("pos").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # one projection per window specification keeps its functions in one operator
    priced = placed.select(
        "*", F.when(~F.col("echo"), F.col("price")).alias("own"), F.when(F.col("echo"), F.col("price")).alias("old")
    )
    upward = priced.select(
        "*",
        F.max("own").over(up_to).alias("o_high"),
        F.min("own").over(up_to).alias("o_low"),
        F.first("own", ignorenulls=True).over(up_to).alias("o_first"),
    )
    downward = upward.select(
        "*",
        F.max("old").over(down_to).alias("e_high"),
        F.min("old").over(down_to).alias("e_low"),
        F.last("old", ignorenulls=True).over(down_to).alias("e_first"),
    )
    windowed = downward.where(~F.col("echo"))
    first = F.coalesce("e_first", "m_first", "o_first")
    joined = windowed.join(blocks, ["coin_id", "block"])
    measured = joined.select(
        *flat.columns,
        F.greatest("o_high", "m_high", "e_high").alias("high_24h"),
        F.least("o_low", "m_low", "e_low").alias("low_24h"),
        (F.col("price") - first).alias("price_change_24h"),
        F.try_divide((F.col("price") - first) * 100, first).alias("price_change_percentage_24h"),
        F.greatest("o_high", "p_high").alias("ath"),
        F.least("o_low", "p_low").alias("atl"),
    )
    return _with_unkeyed(measured, everything)


def all_time(flat: DataFrame, block_ms: int = HOUR_MS) -> DataFrame:
    """Adds the running all-time high and low of each asset up to the row; no echo rows."""
    everything, flat = flat, _keyed(flat)
    before = Window.partitionBy("coin_id").orderBy("block").rangeBetween(Window.unboundedPreceding, -1)
    blocks = block_table(flat, block_ms).select(
        "coin_id", "block", F.max("b_high").over(before).alias("m_high"), F.min("b_low").over(before).alias("m_low")
    )
    up_to = (
        Window.partitionBy("coin_id", "block").orderBy("timestamp").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    windowed = flat.withColumn("block", floor_div(F.col("timestamp"), block_ms)).select(
        "*", F.max("price").over(up_to).alias("o_high"), F.min("price").over(up_to).alias("o_low")
    )
    joined = windowed.join(blocks, ["coin_id", "block"])
    measured = joined.select(
        *flat.columns, F.greatest("o_high", "m_high").alias("ath"), F.least("o_low", "m_low").alias("atl")
    )
    return _with_unkeyed(measured, everything)


def circulating_supply(flat: DataFrame) -> DataFrame:
    """Adds market cap over price; NULL at price zero."""
    return flat.withColumn("circulating_supply", F.try_divide("market_cap", "price"))


def latest_snapshot(flat: DataFrame) -> DataFrame:
    """The newest row of each asset; the larger values win a tie."""
    rest = [c for c in flat.columns if c not in ("coin_id", "timestamp")]
    newest = flat.groupBy("coin_id").agg(F.max(F.struct("timestamp", *rest)).alias("w"))
    return newest.select(*[F.col(c) if c == "coin_id" else F.col(f"w.{c}").alias(c) for c in flat.columns])


def series_extremes(flat: DataFrame) -> DataFrame:
    """All-time high and low of each asset with the first instant each was reached."""
    priced = flat.where(F.col("price").isNotNull())
    # on equal prices the smaller (timestamp) key decides
    top = F.max(F.struct("price", (-F.col("timestamp")).alias("n"))).alias("top")
    low = F.min(F.struct("price", "timestamp")).alias("low")
    return (
        priced.groupBy("coin_id")
        .agg(top, low)
        .select(
            "coin_id",
            F.col("top.price").alias("ath"),
            (-F.col("top.n")).alias("ath_timestamp"),
            F.col("low.price").alias("atl"),
            F.col("low.timestamp").alias("atl_timestamp"),
        )
    )
