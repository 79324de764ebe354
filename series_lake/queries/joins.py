"""Legs, their joins and the flattened fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from series_lake.operators.flatten import flatten_series, join_legs, leg_points
from series_lake.queries.registry import ASSET_SQL, DAILY_SQL, FLAT_SQL, LOCAL_SQL, query
from series_lake.sources.tables import landed_documents, repeated_documents

PRICE_COLUMNS = 'coin_id, coin_name, coin_symbol, coin_image, market_cap_rank, "timestamp", price'


@query("project_price_leg", f"WITH {DAILY_SQL} SELECT {PRICE_COLUMNS} FROM daily WHERE price IS NOT NULL")
def project_price_leg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leg_points(landed_documents(spark, sf_dir), "price")


@query(
    "project_market_cap_leg",
    f'WITH {DAILY_SQL} SELECT coin_id, "timestamp", market_cap FROM daily WHERE market_cap IS NOT NULL',
)
def project_market_cap_leg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leg_points(landed_documents(spark, sf_dir), "market_cap")


@query(
    "project_volume_leg", f'WITH {DAILY_SQL} SELECT coin_id, "timestamp", volume FROM daily WHERE volume IS NOT NULL'
)
def project_volume_leg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leg_points(landed_documents(spark, sf_dir), "volume")


@query(
    "join_price_cap",
    f"WITH {DAILY_SQL} SELECT {PRICE_COLUMNS}, market_cap FROM daily WHERE price IS NOT NULL AND market_cap IS NOT NULL",
)
def join_price_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_legs(landed_documents(spark, sf_dir), ("price", "market_cap"))


@query("join_price_cap_volume", f"WITH {FLAT_SQL} SELECT * EXCLUDE (date_time) FROM flat")
def join_price_cap_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_legs(landed_documents(spark, sf_dir))


@query("flatten_series", f"WITH {FLAT_SQL} SELECT * FROM flat")
def flatten_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_series(landed_documents(spark, sf_dir))


@query("flatten_series_keyed", f"WITH {FLAT_SQL} SELECT * FROM flat")
def flatten_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_series(landed_documents(spark, sf_dir), strategy="keyed")


@query("flatten_series_document", f"WITH {FLAT_SQL} SELECT * FROM flat")
def flatten_by_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_series(landed_documents(spark, sf_dir), strategy="document")


_REPEATED_SQL = f"""ends AS (
  SELECT {ASSET_SQL}, epoch_us(CAST(CAST(ts AS DATE) AS TIMESTAMP)) // 1000 AS "timestamp",
    [min(value) FILTER (event_type = 'view'), max(value) FILTER (event_type = 'view')] AS p,
    [min(value) FILTER (event_type = 'click'), max(value) FILTER (event_type = 'click')] AS c,
    [min(value) FILTER (event_type = 'purchase'), max(value) FILTER (event_type = 'purchase')] AS v
  FROM events GROUP BY user_id, CAST(ts AS DATE)),
i AS (SELECT unnest([1, 2]) AS n),
repeated AS (
  SELECT coin_id, "timestamp", coin_name, coin_symbol, coin_image, market_cap_rank,
         p[a.n] AS price, c[b.n] AS market_cap, v[d.n] AS volume, {LOCAL_SQL} AS date_time
  FROM ends, i a, i b, i d WHERE p[1] IS NOT NULL AND c[1] IS NOT NULL AND v[1] IS NOT NULL)"""
_MOST_SQL = """SELECT coin_id, "timestamp", coin_name, coin_symbol, coin_image, market_cap_rank,
  max(price) AS price, max(market_cap) AS market_cap, max(volume) AS volume, date_time FROM repeated GROUP BY ALL"""


@query("flatten_repeated", f"WITH {_REPEATED_SQL} SELECT * FROM repeated")
def flatten_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every instant is listed twice in each leg, so the join gives eight rows for it."""
    return flatten_series(repeated_documents(spark, sf_dir))


@query("flatten_repeated_document", f"WITH {_REPEATED_SQL} SELECT * FROM repeated")
def flatten_repeated_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_series(repeated_documents(spark, sf_dir), strategy="document")


@query("flatten_repeated_keyed", f"WITH {_REPEATED_SQL} {_MOST_SQL}")
def flatten_repeated_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_series(repeated_documents(spark, sf_dir), strategy="keyed")
