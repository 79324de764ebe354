"""Tables bucketed by their key, which are joined and merged without an exchange.

Rows are dealt into buckets by (asset, instant) when they are written, so a hot asset lies in all
buckets. What is bucketed alike is then joined bucket by bucket: the legs of a series, or a run with the
history. The history is also partitioned by day, and a merge reads and replaces only the days of
the run.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from series_lake.functions.timeconv import utc_date
from series_lake.operators.merge import merge_history
from series_lake.schemas import FLAT, FLAT_DATED, KEY, LEGS
from series_lake.sinks.publish import qualified, touched_days
from series_lake.workspace import staged

#: Buckets of a table; tables that meet have the same number.
BUCKETS = 64


def create_bucketed(spark: SparkSession, table: str, root: str, schema: T.StructType = FLAT_DATED, buckets: int = BUCKETS) -> None:
    """The empty table, unless it exists; partitioned by ``date`` if the schema has it."""
    qualified(table)
    if spark.catalog.tableExists(table):
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by_day = "PARTITIONED BY (date)" if "date" in schema.names else ""
    keys = ", ".join(KEY)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {by_day} CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{root}'")


def write_bucketed(spark: SparkSession, rows: DataFrame, table: str, buckets: int = BUCKETS, dealt: bool = False) -> None:
    """Replace the days that occur in the rows, or all rows of a table without days. The rows are dealt
    into buckets by one exchange, unless the tasks that make them already hold a bucket each."""
    given = rows.select(*spark.table(table).schema.names)
    dealt_out = given if dealt else given.repartition(buckets, *KEY)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        dealt_out.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    spark.catalog.refreshTable(table)


def join_bucketed(spark: SparkSession, legs: dict[str, str]) -> DataFrame:
    """The legs of a series, one bucketed table each (leg name to table), joined on the key."""
    first, *others = [spark.table(legs[leg]) for leg in LEGS]
    for other in others:
        first = first.join(other.hint("merge"), KEY)
    return first


def merged_with(spark: SparkSession, run: DataFrame, table: str, days: list[datetime.date]) -> DataFrame:
    """A bucketed run with the rows of its days in the table: one row per key, the run's if it has one."""
    current = spark.table(table).where(F.col("date").isin(days))
    kept = F.col("r.coin_id").isNotNull()
    both = run.alias("r").hint("merge").join(current.alias("c"), (F.col("r.coin_id") == F.col("c.coin_id")) & (F.col("r.timestamp") == F.col("c.timestamp")), "full_outer")
    return both.select(*[F.when(kept, F.col(f"r.{c}")).otherwise(F.col(f"c.{c}")).alias(c) for c in FLAT_DATED.names])


def merge_bucketed(spark: SparkSession, incoming: DataFrame, table: str, root: str, buckets: int = BUCKETS) -> list[datetime.date]:
    """Merge a run into the bucketed history; returns the days it touched.

    The run is reduced to one row per key and written as a bucketed table of its own, the one exchange
    of the merge. Rows without asset or valid time have no place in the order of keys: a run with such
    rows is refused, drop them first or use ``publish_history``.
    """
    create_bucketed(spark, table, root, FLAT_DATED, buckets)
    name = f"{table}_run_{uuid.uuid4().hex[:12]}"
    with staged(spark, "run") as run_at:
        create_bucketed(spark, name, run_at, FLAT_DATED, buckets)
        try:
            dated = incoming.select(*FLAT.names).withColumn("date", utc_date(F.col("timestamp")))
            write_bucketed(spark, merge_history(dated, None, ["date", *KEY]), name, buckets)
            run = spark.table(name)
            days = touched_days(run)
            if None in days or run.where(F.col("coin_id").isNull()).limit(1).count():
                raise ValueError("rows without asset or valid time cannot be bucketed")
            if days:
                write_bucketed(spark, merged_with(spark, run, table, days), table, buckets, dealt=True)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return days
