"""The three runs: prepare raw documents, refresh intra-day, extend history."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from series_lake.functions.casts import at_precision
from series_lake.functions.timeconv import utc_date
from series_lake.functions.documents import SEGMENT_POINTS, build_envelope, with_segments
from series_lake.operators.filters import lookback, quoted_in
from series_lake.operators.flatten import flatten_series
from series_lake.operators.metrics import circulating_supply, price_metrics, rolling_24h
from series_lake.operators.quality import reject_documents, reject_points
from series_lake.operators.ranking import PAGE_SIZE, page
from series_lake.schemas import LEGS, RAW, RAW_LANDED, WH_HIST, WH_INTRA
from series_lake.sinks.publish import land_bulk, land_per_asset, merge_days, publish_intra_day, published_days, touched_days
from series_lake.sinks.summaries import metrics_with_history, update_summaries
from series_lake.sinks.warehouse import full_reload, load_days, map_hist, map_intra
from series_lake.sources.files import CORRUPT, PARQUET_FORMAT, scan_corrupt_capture, scan_raw_table, typed_copy
from series_lake.workspace import staged

#: Longest list that is sent to every task, and that is landed in a folder per asset.
SHORT_LIST = 10_000


def prepare_raw(
    markets: DataFrame, points: DataFrame, path: str, run_type: str, as_of_ms: int, n: int = PAGE_SIZE,
    number: int = 1, currency: str | None = None, currency_col: str = "quote_currency", segment_points: int = SEGMENT_POINTS,
) -> None:
    """Land one document for each asset of a page of ``n`` assets, by market cap.

    ``points`` is the flat daily series of all assets, ``currency`` the one to keep of series
    quoted in several. An asset without points in the lookback gets a document with empty series,
    so that nothing older stays in its place. The list is staged and used twice: as a semi join,
    which the planner moves below an aggregate that makes the series, so that only the chosen
    assets are aggregated, and to describe the result. Where an asset has more than
    ``segment_points`` points, assets are landed as several documents, each a segment of the series.
    """
    spark = markets.sparkSession
    with staged(spark, "top") as top_at, staged(spark, "points") as points_at:
        page(markets, number, n).select(
            F.col("id").alias("coin_id"),
            F.col("name").alias("coin_name"),
            F.col("symbol").alias("coin_symbol"),
            F.col("image").alias("coin_image"),
            "market_cap_rank",
        ).write.parquet(top_at)
        chosen = spark.read.schema(T.StructType(RAW.fields[:-1])).parquet(top_at)
        listed = F.broadcast(chosen) if n <= SHORT_LIST else chosen
        quoted = points if currency is None else quoted_in(points, currency_col, currency)
        wanted = lookback(quoted, as_of_ms, run_type).join(listed, "coin_id", "left_semi")
        rounded = wanted.select("coin_id", "timestamp", *[at_precision(F.col(leg)).alias(leg) for leg in LEGS])
        rounded.write.options(**PARQUET_FORMAT).parquet(points_at)
        rounded = spark.read.schema(rounded.schema).parquet(points_at)
        longest = rounded.groupBy("coin_id").count().agg(F.max("count")).first()[0] or 0
        segmented = longest > segment_points
        if segmented:
            rounded = with_segments(rounded, segment_points)
        described = chosen.join(rounded, "coin_id", "left")
        documents = build_envelope(described, "variant", segmented)
        if n <= SHORT_LIST:
            land_per_asset(documents, path, run_type)
        else:
            land_bulk(spark, documents, path, run_type)


def read_documents(spark: SparkSession, raw: str, rejects: str | None = None, fail_fast: bool = False) -> DataFrame:
    """The readable documents at a path or in a catalog table.

    ``fail_fast`` stops at the first unreadable document. Otherwise ``rejects`` names a folder
    that gets a row (kind, coin_id, reason, detail) for every document that cannot be read
    or cannot give a row, and for every pair without time or value.
    """
    if "/" not in raw and spark.catalog.tableExists(raw):
        documents, unreadable = scan_raw_table(spark, raw), None
    elif fail_fast:
        documents, unreadable = scan_corrupt_capture(spark, raw, RAW_LANDED, fail_fast=True), None
    else:
        captured = scan_corrupt_capture(spark, raw, RAW_LANDED)
        documents = captured.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
        unreadable = captured.where(F.col(CORRUPT).isNotNull()).select("coin_id", F.col(CORRUPT).alias("detail"))
    if rejects is not None:
        none = F.lit(None).cast("string")
        found = reject_documents(documents).select(F.lit("document").alias("kind"), "coin_id", "reason", none.alias("detail"))
        odd = reject_points(documents)
        found = found.unionByName(odd.select(F.lit("point").alias("kind"), "coin_id", "reason", F.concat_ws(" ", "leg", "time", "value").alias("detail")))
        if unreadable is not None:
            found = found.unionByName(unreadable.select(F.lit("document").alias("kind"), "coin_id", F.lit("unreadable").alias("reason"), "detail"))
        found.write.mode("overwrite").parquet(rejects)
    return documents


def run_intra_day(
    spark: SparkSession, raw: str, table: str, table_root: str, wh_table: str, wh_root: str, strategy: str = "join",
    rejects: str | None = None, fail_fast: bool = False, metrics: bool = False, keep: int | None = None,
    history: str | None = None, summaries: str | None = None,
) -> DataFrame:
    """Raw documents to the intra-day output and its warehouse table, both replaced.

    The join reads the documents once per leg, so they are parsed once into a columnar
    copy. ``strategy="document"`` needs no exchange of points; it is exact when the documents
    come from the landing step, which keeps one per asset, and refuses others. ``metrics`` fills
    the declared metric columns, over the run's own rows or, with a ``history`` and its ``summaries``,
    over all that came before; ``keep`` is the number of table versions that stay.
    """
    if (history is None) != (summaries is None):
        raise ValueError("history and summaries go together")
    with staged(spark, "typed") as copy_at:
        documents = typed_copy(spark, read_documents(spark, raw, rejects, fail_fast), copy_at)
        flat = publish_intra_day(spark, flatten_series(documents, strategy=strategy), table, table_root, keep)
    measured = flat
    if metrics and history is None:
        measured = circulating_supply(price_metrics(flat))
    elif metrics:
        days = touched_days(flat.select(utc_date(F.col("timestamp")).alias("date")))
        measured = circulating_supply(metrics_with_history(spark, flat, days, history, summaries))
    return full_reload(spark, map_intra(measured), wh_table, wh_root, WH_INTRA, keep)


def run_historical(
    spark: SparkSession, raw: str, history: str, wh_table: str, wh_root: str, full: bool = False,
    rejects: str | None = None, fail_fast: bool = False, metrics: bool = False, summaries: str | None = None,
) -> DataFrame:
    """Raw documents merged into the history, then the touched days of the warehouse table.

    The merge keeps one row per key, so the legs are combined per key as well: one scan of
    the documents, and repeated keys never multiply. Days that the run does not touch are
    neither read nor written, in the history or in the table, which is partitioned by day.
    ``metrics`` fills the rolling columns; those of the day after a touched one change too.
    ``summaries`` names the block summaries to keep with the history.
    """
    days = merge_days(spark, flatten_series(read_documents(spark, raw, rejects, fail_fast), strategy="keyed"), history)
    if summaries is not None:
        update_summaries(spark, history, days, summaries)
    if not metrics:
        return load_days(spark, history, days, lambda flat: map_hist(flat, full), wh_table, wh_root, WH_HIST)
    # Before the first load every day is new; later the days that changed, read with the day before.
    if not spark.catalog.tableExists(wh_table):
        return load_days(spark, history, None, lambda flat: map_hist(rolling_24h(flat), full), wh_table, wh_root, WH_HIST)
    one, untimed = datetime.timedelta(days=1), [None] if None in days else []
    changed = {d for d in days if d is not None}
    changed |= {d + one for d in changed}
    around = published_days(spark, history, [*(changed | {d - one for d in changed}), *untimed])
    written = [*changed, *untimed]
    return load_days(spark, history, written, lambda _: map_hist(_only(rolling_24h(around), written), full), wh_table, wh_root, WH_HIST)


def _only(flat: DataFrame, days: list[datetime.date | None]) -> DataFrame:
    inside = F.col("date").isin([d for d in days if d is not None])
    return flat.where(inside | F.col("date").isNull() if None in days else inside)
