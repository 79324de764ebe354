"""Block summaries of a history: high, low and first price per asset and hour.

They are kept next to the history, by day, and rewritten only for the days that a run touches. A
run then measures its rows against all history without reading it: rolling frames from the rows of
its days and the day before each, everything older from the summaries.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from series_lake.functions.timeconv import DAY_MS, HOUR_MS, utc_date
from series_lake.operators.metrics import block_table, price_metrics
from series_lake.schemas import FLAT, KEY
from series_lake.sinks.publish import published_days
from series_lake.sources.files import PARQUET_FORMAT, scan_if_exists

SUMMARY = T.StructType(
    [
        T.StructField("coin_id", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("b_high", T.DoubleType()),
        T.StructField("b_low", T.DoubleType()),
        T.StructField("b_first", T.DoubleType()),
        T.StructField("date", T.DateType()),
    ]
)
BLOCKS_PER_DAY = DAY_MS // HOUR_MS
ONE_DAY = datetime.timedelta(days=1)
EPOCH = datetime.date(1970, 1, 1)


def update_summaries(spark: SparkSession, history: str, days: list[datetime.date | None], path: str) -> None:
    """Bring the summaries of the touched ``days`` up to the published history. Repeating it changes
    nothing; rows without a day have no block."""
    known = [d for d in days if d is not None]
    if not known:
        return
    rows = published_days(spark, history, known)
    blocks = block_table(rows.where(F.col("coin_id").isNotNull()), HOUR_MS)
    dated = blocks.withColumn("date", utc_date(F.col("block") * HOUR_MS)).select(*SUMMARY.names)
    (
        dated.hint("rebalance", F.col("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**PARQUET_FORMAT)
        .partitionBy("date")
        .parquet(path)
    )


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    return scan_if_exists(spark, path, SUMMARY)


def _around(days: list[datetime.date]) -> list[datetime.date]:
    return sorted({*days, *(d - ONE_DAY for d in days if d > datetime.date.min + ONE_DAY)})


def blocks_with_history(own: DataFrame, summaries: DataFrame, read: list[datetime.date]) -> DataFrame:
    """Blocks of the days in ``read`` from the rows ``own`` themselves, of later days that were not
    read from the summaries, and of all earlier days one row per asset, a day before the first."""
    first = read[0]
    before = (first - EPOCH).days * BLOCKS_PER_DAY - BLOCKS_PER_DAY
    older = summaries.where(F.col("date") < F.lit(first)).groupBy("coin_id").agg(F.max("b_high").alias("b_high"), F.min("b_low").alias("b_low"))
    columns = ["coin_id", "block", "b_high", "b_low", "b_first"]
    older = older.select("coin_id", F.lit(before).cast("bigint").alias("block"), "b_high", "b_low", F.lit(None).cast("double").alias("b_first"))
    gaps = summaries.where((F.col("date") > F.lit(first)) & ~F.col("date").isin(read)).select(*columns)
    return block_table(own, HOUR_MS).select(*columns).unionByName(gaps).unionByName(older)


def metrics_with_history(spark: SparkSession, flat: DataFrame, days: list[datetime.date | None], history: str, summaries: str) -> DataFrame:
    """The rows of ``flat`` with rolling and all-time metrics over themselves and the history.

    ``days`` are the UTC days of ``flat``. Of the history only these days and the day before each are
    read, and the summaries. A row of ``flat`` takes the place of the history's rows of its key.
    """
    known = [d for d in days if d is not None]
    if not known:
        return price_metrics(flat)
    read = _around(known)
    keys = flat.select(*[F.col(c).alias(f"_{c}") for c in KEY]).distinct()
    older = published_days(spark, history, read).select(*FLAT.names)
    older = older.join(keys, (F.col("coin_id") == F.col("_coin_id")) & (F.col("timestamp") == F.col("_timestamp")), "left_anti")
    both = flat.select(*FLAT.names, F.lit(True).alias("_own")).unionByName(older.withColumn("_own", F.lit(False)))
    usable = both.where(F.col("coin_id").isNotNull() & F.col("timestamp").isNotNull())
    blocks = blocks_with_history(usable, read_summaries(spark, summaries), read)
    return price_metrics(both, HOUR_MS, blocks).where("_own").drop("_own")
