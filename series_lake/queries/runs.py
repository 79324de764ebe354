"""Whole runs from derived raw documents to warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from series_lake.functions import timeconv as tc
from series_lake.functions.documents import build_envelope, with_segments
from series_lake.operators.filters import lookback
from series_lake.operators.flatten import flatten_series, tagged_points
from series_lake.operators.ranking import with_rank
from series_lake.plans import runs
from series_lake.queries.projections import AS_OF_MS, new_table
from series_lake.queries.registry import DAILY_SQL, FLAT_SQL, LOCAL_SQL, MARKETS_SQL, WH_HIST_SELECT, WH_INTRA_SELECT, query
from series_lake.queries.scans import intra_day_documents
from series_lake.schemas import RAW_LANDED
from series_lake.sinks.publish import land_bulk
from series_lake.sources.files import scan_raw
from series_lake.sources.tables import daily_points, markets, table
from series_lake.workspace import scratch

_EARLY_END_MS = 1_705_708_800_000  # 2024-01-20 00:00:00 UTC
_LATE_START_MS = 1_705_276_800_000  # 2024-01-15 00:00:00 UTC
_ORDERS_AS_OF_MS = 978_307_200_000  # 2001-01-01 00:00:00 UTC


@query(
    "run_intra_day",
    f"""WITH {FLAT_SQL}
SELECT {WH_INTRA_SELECT} FROM flat WHERE "timestamp" BETWEEN {AS_OF_MS} - 86400000 AND {AS_OF_MS}""",
)
def run_intra_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = scratch(spark, "raw")
    land_bulk(spark, intra_day_documents(spark, sf_dir), raw, "intra_day")
    flat_table, flat_root = new_table(spark, "flat")
    wh_table, wh_root = new_table(spark, "intra")
    return runs.run_intra_day(spark, f"{raw}/prefix=intra_day_data", flat_table, flat_root, wh_table, wh_root)


@query(
    "run_historical",
    f"""WITH {DAILY_SQL}, flat AS (
  SELECT coin_id, "timestamp", coin_name, coin_symbol, coin_image, market_cap_rank, market_cap, volume,
         CASE WHEN "timestamp" < {_LATE_START_MS} THEN price + 1 ELSE price END AS price, {LOCAL_SQL} AS date_time
  FROM daily WHERE price IS NOT NULL AND market_cap IS NOT NULL AND volume IS NOT NULL)
SELECT {WH_HIST_SELECT} FROM flat""",
)
def run_historical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs that overlap by five days; the earlier one's prices are off by one."""
    history = scratch(spark, "history")
    wh_table, wh_root = new_table(spark, "hist")
    points = daily_points(spark, sf_dir)
    early = points.where(F.col("timestamp") < _EARLY_END_MS).withColumn("price", F.col("price") + 1)
    late = points.where(F.col("timestamp") >= _LATE_START_MS)
    for delivered in (early, late):
        raw = scratch(spark, "raw")
        land_bulk(spark, build_envelope(delivered, "variant"), raw, "normal")
        loaded = runs.run_historical(spark, f"{raw}/prefix=historical_data", history, wh_table, wh_root)
    return loaded


_INTRA_WITH_METRICS = WH_INTRA_SELECT
for _name, _sql in {
    "price_change_percentage_24h": """CASE WHEN first_value(price) OVER day <> 0
    THEN (price - first_value(price) OVER day) * 100 / first_value(price) OVER day END""",
    "circulating_supply": "CASE WHEN price <> 0 THEN market_cap / price END",
    "ath": "max(price) OVER so_far",
    "atl": "min(price) OVER so_far",
}.items():
    _INTRA_WITH_METRICS = _INTRA_WITH_METRICS.replace(f"CAST(NULL AS DOUBLE) AS {_name}", f"{_sql} AS {_name}")


@query(
    "run_intra_day_all_time",
    f"""WITH {DAILY_SQL}, flat AS (
  SELECT coin_id, "timestamp", coin_name, coin_symbol, coin_image, market_cap_rank, market_cap, volume,
         CASE WHEN "timestamp" < {_LATE_START_MS} THEN price + 1 ELSE price END AS price, {LOCAL_SQL} AS date_time
  FROM daily WHERE price IS NOT NULL AND market_cap IS NOT NULL AND volume IS NOT NULL),
measured AS (
  SELECT "timestamp", {_INTRA_WITH_METRICS} FROM flat
  WINDOW day AS (PARTITION BY coin_id ORDER BY "timestamp" RANGE BETWEEN 86400000 PRECEDING AND CURRENT ROW),
    so_far AS (PARTITION BY coin_id ORDER BY "timestamp" RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT * EXCLUDE ("timestamp") FROM measured WHERE "timestamp" BETWEEN {AS_OF_MS} - 86400000 AND {AS_OF_MS}""",
)
def run_intra_day_all_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two historical runs that overlap, then an intra-day run of the last day: its metrics are over all
    history, of which it reads three days and the block summaries."""
    history, summaries = scratch(spark, "history"), scratch(spark, "summaries")
    points = daily_points(spark, sf_dir)
    early = points.where(F.col("timestamp") < _EARLY_END_MS).withColumn("price", F.col("price") + 1)
    late = points.where(F.col("timestamp") >= _LATE_START_MS)
    for delivered in (early, late):
        raw = scratch(spark, "raw")
        land_bulk(spark, build_envelope(delivered, "variant"), raw, "normal")
        runs.run_historical(spark, f"{raw}/prefix=historical_data", history, *new_table(spark, "hist"), summaries=summaries)
    raw = scratch(spark, "raw")
    land_bulk(spark, intra_day_documents(spark, sf_dir), raw, "intra_day")
    return runs.run_intra_day(
        spark, f"{raw}/prefix=intra_day_data", *new_table(spark, "flat"), *new_table(spark, "intra"), metrics=True, history=history, summaries=summaries
    )


_ORDER_LEGS = "\nUNION ALL ".join(
    f"""SELECT id AS coin_id, name AS coin_name, symbol AS coin_symbol, image AS coin_image, market_cap_rank,
  '{leg}' AS leg, "timestamp", {leg} AS value FROM top JOIN points USING (id)"""
    for leg in ("price", "market_cap", "volume")
)


@query(
    "prepare_raw",
    f"""WITH {MARKETS_SQL}, top AS (
  SELECT id, name, symbol, image, rank() OVER (ORDER BY market_cap DESC NULLS LAST) AS market_cap_rank
  FROM markets ORDER BY market_cap DESC NULLS LAST, id LIMIT 25),
points AS (
  SELECT 'c' || o_custkey AS id, epoch_us(o_orderdate) // 1000 AS "timestamp",
    CAST(max(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS price,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS market_cap, CAST(count(*) AS DOUBLE) AS volume
  FROM orders WHERE epoch_us(o_orderdate) // 1000 BETWEEN {_ORDERS_AS_OF_MS} - 365 * CAST(86400000 AS BIGINT) AND {_ORDERS_AS_OF_MS}
  GROUP BY o_custkey, o_orderdate)
{_ORDER_LEGS}""",
)
def prepare_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 largest customers with a year of their daily orders, landed and read back."""
    path = scratch(spark, "landing")
    total = F.col("o_totalprice").cast("decimal(18,2)")
    # the lookback on the orders themselves reaches the scan
    points = (
        lookback(table(spark, sf_dir, "orders"), _ORDERS_AS_OF_MS, "normal", "o_orderdate")
        .groupBy(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("coin_id"), tc.day_start_ms("o_orderdate").alias("timestamp"))
        .agg(
            F.max(total).cast("double").alias("price"),
            F.sum(total).cast("double").alias("market_cap"),
            F.count("*").cast("double").alias("volume"),
        )
    )
    runs.prepare_raw(with_rank(markets(spark, sf_dir)), points, path, "normal", _ORDERS_AS_OF_MS)
    return tagged_points(scan_raw(spark, f"{path}/prefix=historical_data"))


_HOT_SQL = """hot AS (
  SELECT CASE WHEN user_id % 3 = 0 THEN 'hot' ELSE 'u' || user_id END AS coin_id, epoch_us(ts) // 1000 AS "timestamp",
         max(value) AS price, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS market_cap, CAST(count(*) AS DOUBLE) AS volume
  FROM events GROUP BY 1, 2)"""


@query(
    "segmented_landing",
    f"""WITH {_HOT_SQL}
SELECT coin_id, "timestamp", coin_id AS coin_name, coin_id AS coin_symbol, coin_id AS coin_image, CAST(1 AS BIGINT) AS market_cap_rank,
       price, market_cap, volume, {LOCAL_SQL} AS date_time FROM hot""",
)
def segmented_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of at most a few hundred points, of an asset that holds a third of all events and of the
    others, landed and flattened inside the documents."""
    raw, points_at = scratch(spark, "raw"), scratch(spark, "points")
    value = F.col("value")
    user = F.col("user_id")
    table(spark, sf_dir, "events").groupBy(
        F.when(user % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), user.cast("string"))).alias("coin_id"), tc.ntz_to_ms("ts").alias("timestamp")
    ).agg(F.max(value).alias("price"), F.sum(value.cast("decimal(18,2)")).cast("double").alias("market_cap"), F.count("*").cast("double").alias("volume")).write.parquet(points_at)
    points = with_segments(spark.read.parquet(points_at), 200)
    name = F.col("coin_id")
    described = points.withColumns({"coin_name": name, "coin_symbol": name, "coin_image": name, "market_cap_rank": F.lit(1).cast("bigint")})
    land_bulk(spark, build_envelope(described, "variant", segmented=True), raw, "normal")
    return flatten_series(scan_raw(spark, f"{raw}/prefix=historical_data", RAW_LANDED), strategy="document")
