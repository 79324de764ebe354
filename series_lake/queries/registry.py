"""Name -> query and, where SQL can say the same, name -> SQL over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


# SQL counterparts of sources/tables.py.
ASSET_SQL = """'u' || user_id AS coin_id, 'User ' || user_id AS coin_name, 'u' || user_id AS coin_symbol,
       'img/' || user_id AS coin_image, user_id + 1 AS market_cap_rank"""

LOCAL_SQL = """timezone('America/Chicago', timezone('UTC', date_trunc('second', make_timestamp("timestamp" * 1000))))"""

DAILY_SQL = f"""daily AS (
  SELECT {ASSET_SQL}, epoch_us(CAST(CAST(ts AS DATE) AS TIMESTAMP)) // 1000 AS "timestamp",
         max(CASE WHEN event_type = 'view' THEN value END) AS price,
         CAST(sum(CASE WHEN event_type = 'click' THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE) AS market_cap,
         CAST(sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE) AS volume
  FROM events GROUP BY user_id, CAST(ts AS DATE))"""

FLAT_SQL = f"""{DAILY_SQL},
flat AS (
  SELECT coin_id, "timestamp", coin_name, coin_symbol, coin_image, market_cap_rank, price, market_cap, volume,
         {LOCAL_SQL} AS date_time
  FROM daily WHERE price IS NOT NULL AND market_cap IS NOT NULL AND volume IS NOT NULL)"""


def series_sql(name: str, price: str = "value", where: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT coin_id, "timestamp", coin_name, coin_symbol, coin_image, market_cap_rank, price, market_cap, volume,
         {LOCAL_SQL} AS date_time
  FROM (SELECT {ASSET_SQL}, epoch_us(ts) // 1000 AS "timestamp", {price} AS price, value * 100 AS market_cap,
               value * 10 AS volume
        FROM events WHERE {where}))"""


SERIES_SQL = series_sql("series")
HISTORY_SQL = (
    series_sql("existing", "value + 1", "ts < TIMESTAMP '2024-01-20 00:00:00'")
    + ",\n"
    + series_sql("incoming", "value", "ts >= TIMESTAMP '2024-01-15 00:00:00'")
)
MERGED_SQL = f"""{HISTORY_SQL},
merged AS (
  SELECT * EXCLUDE (priority, pick) FROM (
    SELECT *, row_number() OVER (PARTITION BY coin_id, "timestamp" ORDER BY priority DESC, price DESC) AS pick
    FROM (SELECT *, 1 AS priority FROM incoming UNION ALL SELECT *, 0 AS priority FROM existing))
  WHERE pick = 1)"""
DAY_SQL = """CAST(make_timestamp("timestamp" * 1000) AS DATE) AS "date\""""
UTC_SQL = """make_timestamp("timestamp" * 1000)"""

MARKETS_SQL = """markets AS (
  SELECT 'c' || c_custkey AS id, c_name AS name, c_mktsegment AS symbol, 'img/' || c_custkey AS image,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS market_cap
  FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name, c_mktsegment)"""

WH_HIST_SELECT = f"""coin_id AS id, coin_symbol AS symbol, coin_name AS name, price AS current_price,
  CAST(CAST(market_cap AS DECIMAL(38,0)) AS DOUBLE) AS market_cap, market_cap_rank,
  CAST(NULL AS DOUBLE) AS total_volume, CAST(NULL AS DOUBLE) AS high_24h, CAST(NULL AS DOUBLE) AS low_24h,
  CAST(NULL AS DOUBLE) AS price_change_24h, {UTC_SQL} AS last_updated"""
WH_INTRA_SELECT = """coin_id AS id, coin_symbol AS symbol, coin_name AS name, price AS current_price, market_cap,
  volume AS total_volume, CAST(NULL AS DOUBLE) AS price_change_percentage_24h,
  CAST(NULL AS DOUBLE) AS circulating_supply, CAST(NULL AS DOUBLE) AS total_supply, CAST(NULL AS DOUBLE) AS ath,
  CAST(NULL AS DOUBLE) AS atl, date_time AS last_updated"""
