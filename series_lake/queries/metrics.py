"""Rolling and all-time metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from series_lake.operators import metrics as m
from series_lake.queries.registry import FLAT_SQL, SERIES_SQL, query
from series_lake.schemas import KEY
from series_lake.sources.tables import landed_documents, series
from series_lake.operators.flatten import flatten_series

_FRAME = """(PARTITION BY coin_id ORDER BY "timestamp" RANGE BETWEEN 86400000 PRECEDING AND CURRENT ROW)"""
_ALL = """(PARTITION BY coin_id ORDER BY "timestamp" RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


def _sql(expression: str, name: str) -> str:
    return f'WITH {SERIES_SQL} SELECT coin_id, "timestamp", price, {expression} AS {name} FROM series'


def _one(frame: DataFrame, name: str) -> DataFrame:
    return frame.select(*KEY, "price", name)


@query("high_24h", _sql(f"max(price) OVER {_FRAME}", "high_24h"))
def high_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one(m.rolling_24h(series(spark, sf_dir)), "high_24h")


@query("low_24h", _sql(f"min(price) OVER {_FRAME}", "low_24h"))
def low_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one(m.rolling_24h(series(spark, sf_dir)), "low_24h")


@query("price_change_24h", _sql(f"price - first_value(price) OVER {_FRAME}", "price_change_24h"))
def price_change_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one(m.rolling_24h(series(spark, sf_dir)), "price_change_24h")


@query(
    "price_change_percentage_24h",
    _sql(
        f"""CASE WHEN first_value(price) OVER {_FRAME} <> 0
       THEN (price - first_value(price) OVER {_FRAME}) * 100 / first_value(price) OVER {_FRAME} END""",
        "price_change_percentage_24h",
    ),
)
def price_change_percentage_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one(m.rolling_24h(series(spark, sf_dir)), "price_change_percentage_24h")


@query("ath", _sql(f"max(price) OVER {_ALL}", "ath"))
def ath(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one(m.all_time(series(spark, sf_dir)), "ath")


@query("atl", _sql(f"min(price) OVER {_ALL}", "atl"))
def atl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one(m.all_time(series(spark, sf_dir)), "atl")


@query(
    "circulating_supply",
    f"""WITH {FLAT_SQL}
SELECT coin_id, "timestamp", CASE WHEN price <> 0 THEN market_cap / price END AS circulating_supply FROM flat""",
)
def circulating_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten_series(landed_documents(spark, sf_dir))
    return m.circulating_supply(flat).select(*KEY, "circulating_supply")


@query(
    "latest_snapshot",
    f"""WITH {SERIES_SQL}
SELECT coin_id, price AS current_price, make_timestamp("timestamp" * 1000) AS last_updated
FROM series QUALIFY row_number() OVER (PARTITION BY coin_id ORDER BY "timestamp" DESC, price DESC) = 1""",
)
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    from series_lake.functions.timeconv import ms_to_ntz

    newest = m.latest_snapshot(series(spark, sf_dir))
    return newest.select("coin_id", newest.price.alias("current_price"), ms_to_ntz("timestamp").alias("last_updated"))


@query(
    "series_extremes",
    f"""WITH {SERIES_SQL},
total AS (SELECT coin_id, max(price) AS ath, min(price) AS atl FROM series GROUP BY coin_id)
SELECT t.coin_id, ath, min("timestamp") FILTER (price = ath) AS ath_timestamp,
       atl, min("timestamp") FILTER (price = atl) AS atl_timestamp
FROM total t JOIN series s ON t.coin_id = s.coin_id GROUP BY t.coin_id, ath, atl""",
)
def series_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.series_extremes(series(spark, sf_dir))
