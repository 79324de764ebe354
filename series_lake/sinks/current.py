"""The newest row of each asset, kept by the runs.

Rows lie in folders by a hash of the asset. A run is reduced to its newest row per asset first and then
meets the stored rows of the folders that hold one of its assets; only these are rewritten. What is
stored equals ``latest_snapshot`` of the merged history, without reading that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from series_lake.operators.metrics import latest_snapshot
from series_lake.schemas import FLAT
from series_lake.sinks.publish import BUCKETS, asset_bucket
from series_lake.sources.files import PARQUET_FORMAT, scan_if_exists
from series_lake.workspace import staged

_LAID = T.StructType([*FLAT.fields, T.StructField("bucket", T.IntegerType())])


def read_current(spark: SparkSession, path: str) -> DataFrame:
    return scan_if_exists(spark, path, _LAID).select(*FLAT.names)


def upsert_current(spark: SparkSession, run: DataFrame, path: str, buckets: int = BUCKETS) -> list[int]:
    """Bring the stored rows up to a run; returns the folders that were rewritten.

    As in the merge, a row of the run beats a stored one of the same instant; an older one never
    does, and of equal instants in a run the larger values win. Rows without time are older than
    any. Repeating a run changes nothing.
    """
    with staged(spark, "newest") as newest_at:
        newest = latest_snapshot(run.select(*FLAT.names))
        newest.withColumn("bucket", asset_bucket(F.col("coin_id"), buckets)).write.parquet(newest_at)
        arrived = spark.read.schema(_LAID).parquet(newest_at)
        touched = sorted(r.bucket for r in arrived.select("bucket").distinct().collect())  # at most ``buckets``
        if not touched:
            return []
        stored = scan_if_exists(spark, path, _LAID).where(F.col("bucket").isin(touched)).select(*_LAID.names)
        both = arrived.withColumn("_run", F.lit(1)).unionByName(stored.withColumn("_run", F.lit(0)))
        rest = [c for c in FLAT.names if c not in ("coin_id", "timestamp")]
        best = both.groupBy("bucket", "coin_id").agg(F.max(F.struct("timestamp", "_run", *rest)).alias("w"))
        rows = best.select(*[F.col(c) if c == "coin_id" else F.col(f"w.{c}").alias(c) for c in FLAT.names], "bucket")
        rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**PARQUET_FORMAT).partitionBy("bucket").parquet(path)
        return touched
