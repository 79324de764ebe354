"""Fixed warehouse tables: declaration, column mapping, reload and incremental load."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from series_lake.functions import casts
from series_lake.functions.timeconv import ms_to_ntz
from series_lake.operators.filters import insert_columns
from series_lake.schemas import WH_HIST, WH_INTRA
from series_lake.sinks.publish import publish_version, published_days, qualified, touched_days
from series_lake.sources.files import PARQUET_FORMAT, scan_if_exists


# Columns that the tables declare and that a plain load leaves NULL.
HIST_METRICS = ("high_24h", "low_24h", "price_change_24h")
INTRA_METRICS = ("price_change_percentage_24h", "circulating_supply", "ath", "atl")


def _carried(flat: DataFrame, metrics: tuple[str, ...]) -> list[Column]:
    return [casts.as_float(F.col(name)).alias(name) for name in metrics if name in flat.columns]


def create_table(spark: SparkSession, table: str, schema: T.StructType, location: str) -> DataFrame:
    """Create or replace an empty external table in a new folder under ``location``.

    The folder is written before the table changes, so a failed call leaves the old table as it
    was. Files of a replaced table stay on disk.
    """
    return publish_version(spark, spark.createDataFrame([], schema), table, location, schema)


def map_hist(flat: DataFrame, full: bool = False) -> DataFrame:
    """Published rows as historical warehouse rows. ``last_updated`` is on the UTC clock.

    Market cap passes through an integer-scale number and is therefore whole. The volume
    is left out unless ``full``. Metrics that the rows carry are mapped, others are NULL.
    """
    mapped = flat.select(
        casts.as_string(F.col("coin_id")).alias("id"),
        casts.as_string(F.col("coin_symbol")).alias("symbol"),
        casts.as_string(F.col("coin_name")).alias("name"),
        casts.as_float(F.col("price")).alias("current_price"),
        casts.as_number(F.col("market_cap")).alias("market_cap"),
        casts.as_number(F.col("market_cap_rank")).alias("market_cap_rank"),
        *([casts.as_float(F.col("volume")).alias("total_volume")] if full else []),
        *_carried(flat, HIST_METRICS),
        ms_to_ntz("timestamp").alias("last_updated"),
    )
    return insert_columns(mapped, WH_HIST)


def map_intra(flat: DataFrame, utc: bool = False) -> DataFrame:
    """Published rows as intra-day warehouse rows.

    ``last_updated`` is on the local clock (``date_time``); ``utc`` puts it on the UTC
    clock like the historical table. Metrics that the rows carry are mapped, others are NULL.
    """
    mapped = flat.select(
        casts.as_string(F.col("coin_id")).alias("id"),
        casts.as_string(F.col("coin_symbol")).alias("symbol"),
        casts.as_string(F.col("coin_name")).alias("name"),
        casts.as_float(F.col("price")).alias("current_price"),
        casts.as_float(F.col("market_cap")).alias("market_cap"),
        casts.as_float(F.col("volume")).alias("total_volume"),
        *_carried(flat, INTRA_METRICS),
        (ms_to_ntz("timestamp") if utc else casts.as_timestamp(F.col("date_time"))).alias("last_updated"),
    )
    return insert_columns(mapped, WH_INTRA)


def full_reload(spark: SparkSession, mapped: DataFrame, table: str, root: str, schema: T.StructType, keep: int | None = None) -> DataFrame:
    """Replace all rows of a table. A failed load leaves the old rows in place."""
    return publish_version(spark, mapped, table, root, schema, keep)


#: Partition column of tables that are loaded by day: the UTC day of the published rows.
LOAD_DAY = "load_day"


def _write_days(mapped: DataFrame, path: str) -> None:
    """Replace the days that occur in the rows."""
    (
        mapped.hint("rebalance", F.col(LOAD_DAY))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**PARQUET_FORMAT)
        .partitionBy(LOAD_DAY)
        .parquet(path)
    )


def _mapped_days(published: DataFrame, mapping: Callable[[DataFrame], DataFrame], schema: T.StructType) -> DataFrame:
    """Mapped rows with the day of ``last_updated``. A mapping puts a published day's rows on one
    clock; on the UTC clock that day is the published one, so replacing the days of the rows
    replaces exactly the published days. Mappings to a local clock cannot be loaded by day."""
    return mapping(published).select(*schema.names, F.to_date("last_updated").alias(LOAD_DAY))


def load_days(spark: SparkSession, history: str, days: list[datetime.date | None] | None, mapping: Callable[[DataFrame], DataFrame], table: str, root: str, schema: T.StructType) -> DataFrame:
    """Replace the rows of some published days in a table partitioned by day; all days when the
    table is new or ``days`` is None. Gives the same rows as a full reload of the table."""
    qualified(table)
    new = not spark.catalog.tableExists(table)
    source = scan_if_exists(spark, history) if new or days is None else published_days(spark, history, days)
    if days or new or days is None:
        _write_days(_mapped_days(source, mapping, schema), root)
    if new:
        dated = T.StructType([*schema.fields, T.StructField(LOAD_DAY, T.DateType())])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dated)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({LOAD_DAY}) LOCATION '{root}'")
    spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)
    return spark.table(table).select(*schema.names)


def incremental_load(
    spark: SparkSession,
    published: str,
    source_schema: T.StructType,
    mapping: Callable[[DataFrame], DataFrame],
    target: str,
    target_schema: T.StructType,
    checkpoint: str,
    max_files: int | None = None,
) -> DataFrame:
    """Load the published days that changed since the last call with this checkpoint.

    A merge rewrites a day into new files, which must not be taken for new rows. New files only
    tell which days changed; these days are read whole and replaced in the target, which is
    partitioned by day. Loading a day again changes nothing, so repeated batches are harmless.
    """
    reader = spark.readStream.schema(source_schema).option("ignoreMissingFiles", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        days = touched_days(batch)
        if days:
            own = batch.sparkSession
            _write_days(_mapped_days(published_days(own, published, days), mapping, target_schema), target)

    load = reader.parquet(published).writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    load.awaitTermination()
    return spark.read.schema(target_schema).parquet(target).select(*target_schema.names)
