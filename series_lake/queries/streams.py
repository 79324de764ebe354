"""Streaming forms, each driven to completion over files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from series_lake.queries.registry import DAY_SQL, FLAT_SQL, MERGED_SQL, query, series_sql
from series_lake.schemas import FLAT
from series_lake.sinks.publish import land_bulk, publish_history
from series_lake.sources.files import scan_published
from series_lake.sources.tables import documents, existing_history, incoming_history, series
from series_lake.streaming import increments, stateful
from series_lake.workspace import scratch

HALF_MS = 1_705_276_800_000  # 2024-01-15 00:00:00 UTC


@query("stream_flatten", f"WITH {FLAT_SQL} SELECT * FROM flat")
def stream_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document is delivered twice, in new files; legs are matched inside the documents."""
    raw, target, checkpoint = (scratch(spark, label) for label in ("raw", "flat", "progress"))
    for landing in range(2):
        documents(spark, sf_dir, "variant").withColumn("landed", F.lit(landing).cast("bigint")).write.mode("append").json(raw)
        increments.stream_flatten_documents(increments.stream_delivered(spark, raw), target, checkpoint).awaitTermination()
    return increments.read_newest(spark, target)


@query("stream_flatten_join", f"WITH {FLAT_SQL} SELECT * FROM flat")
def stream_flatten_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the legs joined, as assets split over several documents need; three landings."""
    raw, target, checkpoint = (scratch(spark, label) for label in ("raw", "flat", "progress"))
    for _ in range(3):
        land_bulk(spark, documents(spark, sf_dir, "variant"), raw, "normal")
        increments.stream_flatten(increments.stream_raw(spark, f"{raw}/prefix=historical_data"), target, checkpoint).awaitTermination()
    return increments.read_flat(spark, target)


@query("stream_merge", f"WITH {MERGED_SQL} SELECT *, {DAY_SQL} FROM merged")
def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    arriving, history = scratch(spark, "arriving"), scratch(spark, "history")
    publish_history(spark, existing_history(spark, sf_dir), history)
    incoming_history(spark, sf_dir).write.parquet(arriving)
    for _ in range(2):  # a lost checkpoint delivers everything again
        flat = spark.readStream.schema(FLAT).parquet(arriving)
        increments.stream_merge(flat, history, scratch(spark, "progress")).awaitTermination()
    return scan_published(spark, history)


@query(
    "stream_dedupe",
    f"""WITH {series_sql("early", "value + 1", "ts < TIMESTAMP '2024-01-20 00:00:00'")},
{series_sql("late", "value", "ts >= TIMESTAMP '2024-01-20 00:00:00'")}
SELECT * FROM early UNION ALL SELECT * FROM late""",
)
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    arriving, target, checkpoint = (scratch(spark, label) for label in ("arriving", "once", "progress"))
    for run in (existing_history(spark, sf_dir), incoming_history(spark, sf_dir)):
        run.write.mode("append").parquet(arriving)
        flat = spark.readStream.schema(FLAT).option("maxFilesPerTrigger", 4).parquet(arriving)
        increments.stream_dedupe(flat, target, checkpoint).awaitTermination()
    return increments.read_flat(spark, target)


@query("stream_dedupe_stateful", f"WITH {series_sql('once')} SELECT * FROM once")
def stream_dedupe_stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later half of the days first, then all days, then the earlier half again: with a week of
    state per asset most of the last delivery is late and all of it a repeat."""
    arriving, target, checkpoint = (scratch(spark, label) for label in ("arriving", "once", "progress"))
    whole = series(spark, sf_dir)
    newer, older = whole.where(f"timestamp >= {HALF_MS}"), whole.where(f"timestamp < {HALF_MS}")
    for delivery in (newer, whole, older):
        delivery.write.mode("append").parquet(arriving)
        flat = spark.readStream.schema(FLAT).parquet(arriving)
        stateful.stream_dedupe_stateful(flat, target, checkpoint, slots=7, partitions=8).awaitTermination()
    return stateful.read_once(spark, target)
