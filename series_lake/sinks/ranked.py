"""A market listing laid out by rank, for pages at any depth.

The listing is divided into ranges of the order (market cap, largest first, NULL last, then id), each a
folder whose rows are sorted and numbered; a small index holds the rows of each folder. A page is then
the folders and numbers that the index names: constants that prune folders and row groups, so
a page reads the same however far down it is, and nothing is ranked or sorted for it.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from series_lake.operators.ranking import PAGE_SIZE
from series_lake.sources.files import PARQUET_FORMAT

#: Bytes of a row group. Pages are small, so row groups are as well.
ROW_GROUP = 1 << 20
INDEX = "part int, first long, rows long"


def publish_ranked(markets: DataFrame, root: str, parts: int | None = None, row_group: int = ROW_GROUP) -> str:
    """Write the listing into a version folder of its own; returns it. ``parts``: ranges, as many as a
    shuffle has partitions by default. Readers see a version once its index, the last thing
    written, is complete."""
    spark = markets.sparkSession
    order = [F.desc_nulls_last("market_cap"), F.asc("id")]
    count = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    version = f"{root.rstrip('/')}/v={time.time_ns():020d}-{uuid.uuid4().hex}"
    ranged = markets.repartitionByRange(count, *order).withColumn("part", F.spark_partition_id()).sortWithinPartitions("part", *order)
    # within a task these ids count up from the task's number shifted by 33 bits
    numbered = ranged.withColumn("nth", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    writer = numbered.write.options(**PARQUET_FORMAT).option("parquet.block.size", str(row_group))
    writer.partitionBy("part").parquet(f"{version}/rows")
    schema = T.StructType([*numbered.drop("part").schema.fields, T.StructField("part", T.IntegerType())])
    sizes = spark.read.schema(schema).parquet(f"{version}/rows").groupBy("part").agg(F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    index = sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).cast("bigint").alias("first"), "rows")
    index.coalesce(1).write.parquet(f"{version}/index")
    return version


def newest_version(spark: SparkSession, root: str) -> str | None:
    """The newest complete version."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    folder = path(root)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return None
    names = sorted((s.getPath().getName() for s in files.listStatus(folder)), reverse=True)
    return next((f"{root.rstrip('/')}/{n}" for n in names if n.startswith("v=") and files.exists(path(f"{root}/{n}/index/_SUCCESS"))), None)


def read_page(spark: SparkSession, version: str, schema: T.StructType, number: int, size: int = PAGE_SIZE) -> DataFrame:
    """Page ``number`` (from 1) with the rows' ``position``; empty beyond the end."""
    low, high = (number - 1) * size, number * size
    index = spark.read.schema(INDEX).parquet(f"{version}/index")
    found = index.where((F.col("first") < high) & (F.col("first") + F.col("rows") > low)).collect()  # at most ``size`` ranges
    laid = T.StructType([*schema.fields, T.StructField("nth", T.LongType()), T.StructField("part", T.IntegerType())])
    wanted, first = F.lit(False), F.lit(0)
    for r in found:
        inside = (F.col("part") == r["part"]) & F.col("nth").between(max(0, low - r["first"]), high - r["first"] - 1)
        wanted = wanted | inside
        first = F.when(F.col("part") == r["part"], F.lit(r["first"])).otherwise(first)
    rows = spark.read.schema(laid).parquet(f"{version}/rows").where(wanted)
    placed = rows.select(*schema.names, (first + F.col("nth") + 1).cast("bigint").alias("position"))
    return placed.orderBy("position").limit(size)
