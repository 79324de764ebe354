"""A history whose days are swapped one by one in the catalog.

Every publish writes the days it touches into a version folder of its own and then points the
table's partitions at it, one day after the other. A day is wholly old or wholly new at any time,
also when a publish fails half-way, and the files that a reader has planned stay in place until
``remove_unused`` is called. Nothing is moved or overwritten, so the file system needs no renames.
"""

from __future__ import annotations

import datetime
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from series_lake.functions.timeconv import utc_date
from series_lake.operators.merge import merge_history
from series_lake.schemas import FLAT, FLAT_DATED, KEY
from series_lake.sinks.publish import qualified, touched_days
from series_lake.sources.files import PARQUET_FORMAT
from series_lake.workspace import staged

#: New days that are added to the catalog by one statement.
TOGETHER = 200
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def create_located(spark: SparkSession, table: str, root: str) -> None:
    """The empty table, unless it exists."""
    qualified(table)
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in FLAT_DATED)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (date) LOCATION '{root.rstrip('/')}/empty'")


def read_days(spark: SparkSession, table: str, days: list[datetime.date | None]) -> DataFrame:
    """The rows of some days; the catalog gives the folders of these days only."""
    wanted = F.col("date").isin([d for d in days if d is not None])
    return spark.table(table).where(wanted | F.col("date").isNull() if None in days else wanted)


def _spec(day: datetime.date | None) -> str:
    return "PARTITION (date = null)" if day is None else f"PARTITION (date = '{day.isoformat()}')"


def _folder(version: str, day: datetime.date | None) -> str:
    return f"{version}/date={NO_DAY if day is None else day.isoformat()}"


def _known_days(spark: SparkSession, table: str) -> set[str]:
    return {r.partition.removeprefix("date=") for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}  # a calendar's days


def point_day(spark: SparkSession, table: str, version: str, day: datetime.date | None) -> None:
    """Make one day of the table the version's."""
    spark.sql(f"ALTER TABLE {table} {_spec(day)} SET LOCATION '{_folder(version, day)}'")


def publish_located(spark: SparkSession, incoming: DataFrame, table: str, root: str) -> list[datetime.date | None]:
    """Merge a run into the table's history; returns the days that it touched.

    The run is staged, as it is read for its days and its rows. After a failure a repeated call
    finishes the work; merging a run again changes nothing.
    """
    create_located(spark, table, root)
    with staged(spark, "staged") as staged_at:
        incoming.select(*FLAT.names).withColumn("date", utc_date(F.col("timestamp"))).write.options(**PARQUET_FORMAT).parquet(staged_at)
        run = spark.read.schema(FLAT_DATED).parquet(staged_at)
        days = touched_days(run)
        if not days:
            return days
        version = f"{root.rstrip('/')}/v={time.time_ns():020d}-{uuid.uuid4().hex}"
        current = read_days(spark, table, days).select(*FLAT_DATED.names)
        merged = merge_history(run, current, ["date", *KEY]).select(*FLAT_DATED.names)
        merged.hint("rebalance", F.col("date")).sortWithinPartitions("date", *KEY).write.options(**PARQUET_FORMAT).partitionBy("date").parquet(version)
    known = _known_days(spark, table)
    ordered = sorted((d for d in days if d is not None)) + [None] * (None in days)
    old = [d for d in ordered if (NO_DAY if d is None else d.isoformat()) in known]
    new = [d for d in ordered if d not in old]
    for at in range(0, len(new), TOGETHER):
        added = " ".join(f"{_spec(d)} LOCATION '{_folder(version, d)}'" for d in new[at : at + TOGETHER])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {added}")
    for day in old:
        point_day(spark, table, version, day)
    spark.catalog.refreshTable(table)
    return days


def _locations(spark: SparkSession, table: str) -> list[str]:
    database, name = table.rsplit(".", 1)
    parts = spark._jsparkSession.sharedState().externalCatalog().listPartitions(database, name, getattr(spark._jvm, "scala.Option").empty())
    return [parts.apply(i).location().toString() for i in range(parts.size())]


def remove_unused(spark: SparkSession, table: str, root: str, older_than_ms: int) -> list[str]:
    """Delete version folders that no day points to and that were written more than
    ``older_than_ms`` ago, which must be longer than any reader or publish runs. Returns their names."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    used = {part for location in _locations(spark, table) for part in location.split("/") if part.startswith("v=")}
    cut = time.time_ns() - older_than_ms * 1_000_000
    gone = []
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("v=") and name not in used and int(name[2:22]) < cut:
            files.delete(status.getPath(), True)
            gone.append(name)
    return sorted(gone)
