"""Structured Streaming forms of flatten, merge and de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from series_lake.functions.timeconv import local_clock, utc_date
from series_lake.operators.flatten import document_rows, flatten_series
from series_lake.operators.merge import merge_history
from series_lake.schemas import FLAT, FLAT_DATED, KEY, RAW, RAW_LANDED
from series_lake.sinks.publish import BUCKETS, asset_bucket, publish_history, published_days, touched_days
from series_lake.sources.files import scan_if_exists, typed_copy
from series_lake.workspace import remove, staged


def stream_raw(spark: SparkSession, path: str, schema: T.StructType = RAW, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path).select(*schema.names)


#: Flat rows with the delivery that brought them; a document without rows leaves one without time.
FLAT_DELIVERED = T.StructType([*FLAT.fields, T.StructField("delivered", T.LongType())])


def stream_delivered(spark: SparkSession, path: str, schema: T.StructType = RAW_LANDED, max_files: int | None = None) -> DataFrame:
    """Arriving documents with ``delivered``: the number of their landing, or the time of their file
    where another hand put it there. Both are milliseconds."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path).select(*schema.names, F.coalesce("landed", F.unix_millis(F.col("_metadata.file_modification_time"))).alias("delivered"))


def stream_flatten_documents(docs: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """New documents to flat rows without state, join or exchange.

    ``docs`` come from ``stream_delivered``. Legs are matched inside each document, and the rows go to
    a plain file sink, which commits each batch once, together with the time of their delivery. An
    asset that is delivered again is told apart when reading: ``read_newest`` takes the rows of its
    newest delivery, in whatever order the files were read. An instant of an asset must be in one
    document of a landing, as the landing step sees to; others need ``stream_flatten``.
    """
    rows = document_rows(docs, carried=("delivered",), keep_empty=True)
    rows = rows.withColumn("date_time", local_clock(F.col("timestamp"))).select(*FLAT_DELIVERED.names)
    return rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_newest(spark: SparkSession, target: str) -> DataFrame:
    """The rows that ``stream_flatten_documents`` has written of each asset's newest delivery."""
    rows = scan_if_exists(spark, target, FLAT_DELIVERED)
    newest = rows.groupBy(F.col("coin_id").alias("_asset")).agg(F.max("delivered").alias("_newest"))
    current = rows.join(newest, (F.col("coin_id") == F.col("_asset")) & (F.col("delivered") == F.col("_newest")))
    return current.where(F.col("timestamp").isNotNull()).select(*FLAT.names)


def read_flat(spark: SparkSession, target: str) -> DataFrame:
    """The rows that ``stream_flatten`` or ``stream_dedupe`` have written."""
    return scan_if_exists(spark, target, FLAT).select(*FLAT.names)


def replace_assets(spark: SparkSession, flat: DataFrame, delivered: DataFrame, target: str, buckets: int = BUCKETS) -> None:
    """Put the rows of the ``delivered`` assets (coin_id) in the place of their earlier rows.

    Rows lie in folders by a hash of the asset; only folders with a delivered asset are rewritten.
    Doing it again changes nothing.
    """
    laid = T.StructType([*FLAT.fields, T.StructField("bucket", T.IntegerType())])
    with staged(spark, "delivered") as rows_at, staged(spark, "assets") as assets_at:
        delivered.select("coin_id", asset_bucket(F.col("coin_id"), buckets).alias("bucket")).distinct().write.parquet(assets_at)
        flat.select(*FLAT.names).withColumn("bucket", asset_bucket(F.col("coin_id"), buckets)).write.parquet(rows_at)
        assets, rows = spark.read.parquet(assets_at), spark.read.schema(laid).parquet(rows_at)
        touched = [r.bucket for r in assets.select("bucket").distinct().collect()]  # at most ``buckets``
        if not touched:
            return
        gone = assets.select(F.col("coin_id").alias("_delivered"))
        earlier = scan_if_exists(spark, target, laid).where(F.col("bucket").isin(touched))
        kept = earlier.join(gone, F.col("coin_id").eqNullSafe(F.col("_delivered")), "left_anti").select(*laid.names)
        after = rows.unionByName(kept)
        left = {r.bucket for r in after.select("bucket").distinct().collect()}
        after.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(target)
        for bucket in set(touched) - left:  # an overwrite leaves folders alone that get no rows
            remove(spark, f"{target}/bucket={bucket}")


def stream_flatten(docs: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """New documents to flat rows, one current set of rows per asset.

    A landing rewrites documents into new files and delivers an asset again with every run, so rows
    are keyed by asset: those of a batch replace the asset's earlier ones. Several documents of an
    asset in one batch give the rows of their join; of several batches the last counts, as in
    the landing zone. Read the result with ``read_flat``.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with staged(spark, "typed") as copy_at:
            typed = typed_copy(spark, batch, copy_at)
            replace_assets(spark, flatten_series(typed, strategy="join"), typed, target)

    return docs.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_merge(flat: DataFrame, history: str, checkpoint: str) -> StreamingQuery:
    """Each batch of flat rows merged into the published history.

    Merging a batch again changes nothing, so a batch repeated after a failure is harmless.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        publish_history(batch.sparkSession, batch, history)

    return (
        flat.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_dedupe(flat: DataFrame, target: str, checkpoint: str, repeats: str | None = None) -> StreamingQuery:
    """Adds the points that the target does not have yet; one row per key, first arrival wins.

    Every point is compared with the target's rows of its day, however old it is and however
    the files fall into batches: no state, no watermark, nothing is late. Within a batch the
    largest values win, so the order of rows does not matter. A NULL in a key is a value like others. A batch repeated after a failure adds nothing.
    ``repeats``: a folder for the keys of points that were not added and their number, per batch.
    Read the result with ``read_flat``.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with staged(spark, "batch") as batch_at, staged(spark, "fresh") as fresh_at:
            dated = batch.select(*FLAT.names).withColumn("date", utc_date(F.col("timestamp")))
            dated.write.parquet(batch_at)
            rows = spark.read.schema(FLAT_DATED).parquet(batch_at)
            days = touched_days(rows)
            if not days:
                return
            known = published_days(spark, target, days).select("date", *KEY).distinct()
            same = [rows[c].eqNullSafe(known[c]) for c in ("date", *KEY)]
            matched = same[0] & same[1] & same[2]
            merge_history(rows.join(known, matched, "left_anti"), None, ["date", *KEY]).select(*FLAT_DATED.names).write.parquet(fresh_at)
            fresh = spark.read.schema(FLAT_DATED).parquet(fresh_at)
            if repeats is not None:
                counted = rows.groupBy("date", *KEY).agg(F.count("*").alias("delivered"))
                ours = fresh.select("date", *KEY, F.lit(1).alias("added"))
                on = [counted[c].eqNullSafe(ours[c]) for c in ("date", *KEY)]
                dropped = counted.join(ours, on[0] & on[1] & on[2], "left").select(*[counted[c] for c in KEY], (F.col("delivered") - F.coalesce("added", F.lit(0))).alias("dropped"))
                dropped.where("dropped > 0").write.mode("overwrite").parquet(f"{repeats}/batch_id={batch_id}")
            fresh.hint("rebalance", "date").write.mode("append").partitionBy("date").parquet(target)

    return flat.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
