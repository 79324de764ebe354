"""Session settings the operators were planned for. Any session works; these suit scale."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.binaryAsString": "false",
    "spark.ui.enabled": "false",
    # no look at the Python stack for every expression that is built
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """Session for tests and the benchmark. A cluster job brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("series-lake")
    settings = SETTINGS | {"spark.sql.shuffle.partitions": str(shuffle_partitions)} | extra
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
