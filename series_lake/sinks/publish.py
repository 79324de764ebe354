"""Publishing Parquet and landing raw documents.

Two ways to replace data, neither of which clears anything before its own write succeeded:

* dynamic partition overwrite, where only part of a partitioned directory changes. The new
  files are staged next to the target and moved in when the job commits, so the same
  directory may also be read by the job;
* a new version directory plus a change of the table's location, where everything changes.
"""

from __future__ import annotations

import datetime
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from series_lake.functions.text import target_prefix
from series_lake.functions.timeconv import utc_date
from series_lake.operators.merge import merge_history
from series_lake.schemas import FLAT, FLAT_DATED, KEY
from series_lake.sources.files import PARQUET_FORMAT, scan_if_exists
from series_lake.workspace import staged


def _write_by_date(dated: DataFrame, path: str) -> None:
    """Write by UTC day. REBALANCE lets adaptive execution split large days into several
    files of the advisory size and put small days together, instead of one task per day."""
    (
        dated.hint("rebalance", F.col("date"))
        .sortWithinPartitions("date", *KEY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**PARQUET_FORMAT)
        .partitionBy("date")
        .parquet(path)
    )


def published_days(spark: SparkSession, path: str, days: list[datetime.date | None]) -> DataFrame:
    """The published rows of some UTC days; the partitions of other days are not listed."""
    known = [day for day in days if day is not None]
    wanted = F.col("date").isin(known)
    return scan_if_exists(spark, path).where(wanted | F.col("date").isNull() if None in days else wanted)


#: A run may touch this many days; more is taken for broken times, not for a run.
MAX_DAYS = 100_000


def touched_days(frame: DataFrame, most: int = MAX_DAYS) -> list[datetime.date | None]:
    """The distinct values of ``date``; None stands for rows without a valid time.

    Days are values of the calendar, so their number does not grow with the rows.
    """
    days = [row.date for row in frame.select("date").distinct().limit(most + 1).collect()]
    if len(days) > most:
        raise ValueError(f"the rows touch more than {most} days: check their times")
    return days


def merge_days(spark: SparkSession, incoming: DataFrame, path: str) -> list[datetime.date | None]:
    """Merge a run into the published history; returns the days it touched, which alone were
    rewritten.

    The run is staged first: it is read twice (its days, its rows) and must be the same
    both times, also when executors are lost in between. Equal keys have equal instants,
    hence the same day, so merging day by day is complete.

    The days are fetched as plain values. Only constants prune partitions for certain: a join
    with the distinct days has no selective filter that would make the planner prune by it, and
    reads all history.
    """
    with staged(spark, "staged") as staged_at:
        incoming.select(*FLAT.names).withColumn("date", utc_date(F.col("timestamp"))).write.options(**PARQUET_FORMAT).parquet(staged_at)
        run = spark.read.schema(FLAT_DATED).parquet(staged_at)
        days = touched_days(run)
        if days:
            current = published_days(spark, path, days).select(*FLAT_DATED.names)
            _write_by_date(merge_history(run, current, ["date", *KEY]).select(*FLAT_DATED.names), path)
    return days


def publish_history(spark: SparkSession, incoming: DataFrame, path: str) -> DataFrame:
    """Merge a run into the published history and read that (see ``merge_days``)."""
    merge_days(spark, incoming, path)
    return scan_if_exists(spark, path)


def publish_version(spark: SparkSession, frame: DataFrame, table: str, root: str, schema: T.StructType, keep: int | None = None) -> DataFrame:
    """Replace a table: write a new version directory, then point the table at it.

    Readers see the old version or the new one, never an empty table, and the load may
    read the table it replaces. A table of another schema is replaced as well: the new one is
    made under a name of its own first. ``keep``: how many versions stay on disk, the new one
    included (None: all); older ones are removed after the swap.
    """
    qualified(table)
    version = f"{root.rstrip('/')}/v={time.time_ns():020d}-{uuid.uuid4().hex}"
    frame.select(*schema.names).write.mode("errorifexists").options(**PARQUET_FORMAT).parquet(version)
    point_table(spark, table, version, schema)
    if keep is not None:
        _remove_versions(spark, root, max(1, keep))
    return spark.table(table)


def point_table(spark: SparkSession, table: str, location: str, schema: T.StructType) -> None:
    """Make a table read a written folder."""
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=location, source="parquet", schema=schema)
    elif [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in schema]:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
    else:
        new = f"{table}_{uuid.uuid4().hex[:8]}"
        spark.catalog.createTable(new, path=location, source="parquet", schema=schema)
        spark.sql(f"DROP TABLE {table}")
        spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    spark.catalog.refreshTable(table)


def _remove_versions(spark: SparkSession, root: str, keep: int) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    versions = sorted((s.getPath().getName(), s.getPath()) for s in files.listStatus(folder) if s.getPath().getName().startswith("v="))
    for _, old in versions[:-keep]:
        files.delete(old, True)


def publish_intra_day(spark: SparkSession, flat: DataFrame, table: str, root: str, keep: int | None = None) -> DataFrame:
    """Replace the intra-day output as a whole."""
    return publish_version(spark, flat, table, root, FLAT, keep)


def qualified(table: str) -> str:
    """Tables are always named with their schema, so no session state decides where they go."""
    if "." not in table:
        raise ValueError(f"table name needs its schema: {table!r}")
    return table


def _numbered(docs: DataFrame) -> DataFrame:
    """Documents with their segment, null where an asset is one document, and the landing's number,
    which grows from one landing to the next."""
    given = docs if "segment" in docs.columns else docs.withColumn("segment", F.lit(None).cast("bigint"))
    return given.withColumn("landed", F.lit(time.time_ns() // 1_000_000))


def land_per_asset(docs: DataFrame, path: str, run_type: str) -> None:
    """One folder of JSON documents per asset and run prefix, replacing that asset's previous one.

    For runs over a top list, whose length bounds the folders. An asset is one document, or one
    per segment, which are written by several tasks.
    """
    (
        _numbered(docs).withColumn("prefix", target_prefix(F.lit(run_type)))
        .withColumn("asset", F.col("coin_id"))
        .repartition("prefix", "asset", "segment")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("prefix", "asset")
        .json(path)
    )


#: Landed documents lie in this many folders per prefix, by a hash of the asset.
BUCKETS = 64


def asset_bucket(asset: Column, buckets: int = BUCKETS) -> Column:
    """The folder of an asset; documents without an asset share the first."""
    return F.coalesce(F.pmod(F.xxhash64(asset), F.lit(buckets)), F.lit(0)).cast("int")


def land_bulk(spark: SparkSession, docs: DataFrame, path: str, run_type: str, buckets: int = BUCKETS) -> None:
    """The same contract for any number of assets: many documents per file.

    Documents of assets that this run does not deliver stay, and so do the files of folders that
    hold none of its assets. Documents without an asset are replaced by those of the run.
    """
    prefix = target_prefix(F.lit(run_type))
    docs = _numbered(docs)
    landed = T.StructType([*docs.schema.fields, T.StructField("prefix", T.StringType()), T.StructField("bucket", T.IntegerType())])
    with staged(spark, "landing") as staged_at:
        docs.withColumn("prefix", prefix).withColumn("bucket", asset_bucket(F.col("coin_id"), buckets)).write.parquet(staged_at)
        run = spark.read.schema(landed).parquet(staged_at)
        touched = [r.bucket for r in run.select("bucket").distinct().collect()]  # at most ``buckets``
        if not touched:
            return
        delivered = run.select(F.col("coin_id").alias("_delivered")).distinct()
        earlier = scan_if_exists(spark, path, landed, "json").where((F.col("prefix") == prefix) & F.col("bucket").isin(touched))
        kept = earlier.join(delivered, F.col("coin_id").eqNullSafe(F.col("_delivered")), "left_anti")
        (
            run.unionByName(kept.select(*landed.names))
            .hint("rebalance", "bucket")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("prefix", "bucket")
            .json(path)
        )
