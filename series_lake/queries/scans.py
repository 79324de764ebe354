"""Sources: each query lands or publishes derived data, then reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from series_lake.functions import timeconv as tc
from series_lake.functions.documents import build_envelope
from series_lake.operators.filters import lookback
from series_lake.operators.flatten import tagged_points
from series_lake.operators.ranking import with_rank
from series_lake.queries.projections import AS_OF_MS
from series_lake.queries.registry import DAILY_SQL, DAY_SQL, MARKETS_SQL, query, series_sql
from series_lake.schemas import FLAT_DATED, MARKETS
from series_lake.sinks.publish import land_bulk, publish_history
from series_lake.sources import files
from series_lake.sources.tables import daily_points, documents, markets, series, table
from series_lake.workspace import scratch

_PUBLISHED = series_sql("published")


def leg_rows_sql(where: str = "TRUE") -> str:
    parts = [
        f"""SELECT coin_id, coin_name, coin_symbol, coin_image, market_cap_rank, '{leg}' AS leg, "timestamp", {leg} AS value
FROM daily WHERE {leg} IS NOT NULL AND {where}"""
        for leg in ("price", "market_cap", "volume")
    ]
    return " UNION ALL ".join(parts)


@query("scan_raw_historical", f"WITH {DAILY_SQL} {leg_rows_sql()}")
def scan_raw_historical(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "raw")
    land_bulk(spark, documents(spark, sf_dir, "variant"), path, "normal")
    return tagged_points(files.scan_raw(spark, f"{path}/prefix=historical_data"))


@query("scan_raw_intra_day", f"""WITH {DAILY_SQL} {leg_rows_sql(f'"timestamp" BETWEEN {AS_OF_MS} - 86400000 AND {AS_OF_MS}')}""")
def scan_raw_intra_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "raw")
    land_bulk(spark, intra_day_documents(spark, sf_dir), path, "intra_day")
    return tagged_points(files.scan_raw(spark, f"{path}/prefix=intra_day_data"))


def intra_day_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a run that looks back one day."""
    return build_envelope(lookback(daily_points(spark, sf_dir), AS_OF_MS, "intra_day"), "variant")


@query("scan_published", f"WITH {_PUBLISHED} SELECT *, {DAY_SQL} FROM published")
def scan_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "published")
    publish_history(spark, series(spark, sf_dir), path)
    return files.scan_published(spark, path)


@query("scan_if_exists", f"WITH {_PUBLISHED} SELECT *, {DAY_SQL} FROM published")
def scan_if_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "published")
    absent = files.scan_if_exists(spark, path)
    publish_history(spark, series(spark, sf_dir), path)
    return absent.unionByName(files.scan_if_exists(spark, path)).select(*FLAT_DATED.names)


@query("scan_stage", f'WITH {_PUBLISHED} SELECT coin_id, "timestamp", price, {DAY_SQL} FROM published')
def scan_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "stage")
    publish_history(spark, series(spark, sf_dir), path)
    return files.scan_stage(spark, path).select("coin_id", "timestamp", "price", "date")


@query("file_format_options", "SELECT event_id, event_type, 'binary' AS raw_type FROM events")
def file_format_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "format")
    events = table(spark, sf_dir, "events").select("event_id", F.col("event_type").cast("binary").alias("raw"))
    events.write.options(**files.PARQUET_FORMAT).parquet(path)
    back = files.scan_stage(spark, path)
    return back.select("event_id", F.decode("raw", "UTF-8").alias("event_type"), F.typeof("raw").alias("raw_type"))


@query(
    "markets_snapshot",
    f"""WITH {MARKETS_SQL}
SELECT id, name, symbol, image, rank() OVER (ORDER BY market_cap DESC NULLS LAST) AS market_cap_rank, market_cap
FROM markets""",
)
def markets_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "markets")
    with_rank(markets(spark, sf_dir)).select(*MARKETS.names).write.json(path)
    return files.markets_snapshot(spark, path)


_LINE = """'{"coin_id":"u' || user_id || '","coin_name":"' || event_id || '","data":{"prices":[[' ||
  (epoch_us(ts) // 1000) || ',' || CAST(value AS DECIMAL(18,2)) || ']]}}'"""


@query(
    "scan_corrupt_capture",
    f"""SELECT CASE WHEN event_type <> 'error' THEN 'u' || user_id END AS coin_id,
  CASE WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR) END AS coin_name,
  CASE WHEN event_type = 'error' THEN left({_LINE}, length({_LINE}) - 4) END AS corrupt FROM events""",
)
def scan_corrupt_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "corrupt")
    line = F.format_string(
        '{"coin_id":"u%d","coin_name":"%d","data":{"prices":[[%d,%s]]}}',
        "user_id",
        "event_id",
        tc.ntz_to_ms("ts"),
        F.col("value").cast("decimal(18,2)").cast("string"),
    )
    cut = F.when(F.col("event_type") == "error", F.left("line", F.length("line") - 4)).otherwise(F.col("line"))
    table(spark, sf_dir, "events").withColumn("line", line).select(cut.alias("value")).write.text(path)
    return files.scan_corrupt_capture(spark, path).select("coin_id", "coin_name", F.col(files.CORRUPT).alias("corrupt"))
