"""Projections, filters, semi-structured rows and column-list inserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from series_lake.functions import timeconv as tc
from series_lake.functions.documents import path_value, row_object
from series_lake.operators.filters import insert_columns, lookback, quoted_in
from series_lake.operators.flatten import tagged_points
from series_lake.operators.merge import union_by_name
from series_lake.queries.registry import DAILY_SQL, LOCAL_SQL, SERIES_SQL, WH_HIST_SELECT, query
from series_lake.schemas import KEY, LEG_ARRAYS, WH_HIST
from series_lake.sinks.warehouse import full_reload, map_hist
from series_lake.sources.tables import daily_documents, flat_points, landed_documents, series, table
from series_lake.workspace import scratch

# The run's "now": a fixed parameter, so results repeat.
AS_OF_MS = 1_706_659_200_000  # 2024-01-31 00:00:00 UTC


@query(
    "nested_field_access",
    f"""WITH {DAILY_SQL}
SELECT coin_id, CAST(count(price) AS INT) AS n_prices, CAST(count(market_cap) AS INT) AS n_market_caps,
       CAST(count(volume) AS INT) AS n_total_volumes FROM daily GROUP BY coin_id""",
)
def nested_field_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = [F.size(F.col(f"data.{a}")).alias(f"n_{a}") for a in LEG_ARRAYS.values()]
    return landed_documents(spark, sf_dir).select("coin_id", *sizes)


@query("derived_column", f'WITH {SERIES_SQL} SELECT coin_id, "timestamp", {LOCAL_SQL} AS date_time FROM series')
def derived_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = series(spark, sf_dir).select(*KEY)
    return points.withColumn("date_time", tc.local_clock(F.col("timestamp")))


@query("rename_alias", "SELECT event_id, user_id AS coin_id, value AS price FROM events")
def rename_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("coin_id"), F.col("value").alias("price"))


@query(
    "variant_path_extract",
    f"""WITH {SERIES_SQL}
SELECT coin_id AS id, coin_symbol AS symbol, coin_name AS name, price AS current_price,
       CAST(CAST(market_cap AS DECIMAL(38,0)) AS DOUBLE) AS market_cap, market_cap_rank, "timestamp" FROM series""",
)
def variant_path_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = series(spark, sf_dir)
    rows = flat.select(row_object(flat).alias("row"))
    paths = [
        ("coin_id", "string", "id"),
        ("coin_symbol", "string", "symbol"),
        ("coin_name", "string", "name"),
        ("price", "double", "current_price"),
        ("market_cap", "decimal(38,0)", "market_cap"),
        ("market_cap_rank", "bigint", "market_cap_rank"),
        ("timestamp", "bigint", "timestamp"),
    ]
    extracted = rows.select(*[path_value(F.col("row"), path, dtype).alias(name) for path, dtype, name in paths])
    return extracted.withColumn("market_cap", F.col("market_cap").cast("double"))


@query(
    "variant_path_case",
    f'WITH {SERIES_SQL} SELECT coin_id, "timestamp", market_cap AS lower_case, CAST(NULL AS DOUBLE) AS upper_case FROM series',
)
def variant_path_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = series(spark, sf_dir)
    row = row_object(flat)
    return flat.select(
        *KEY, path_value(row, "market_cap", "double").alias("lower_case"), path_value(row, "MARKET_CAP", "double").alias("upper_case")
    )


@query(
    "raw_row_object",
    """SELECT to_json({'event_id': event_id, 'event_type': event_type, 'props': props, 'user_id': user_id})::VARCHAR
  AS row_object FROM events""",
)
def raw_row_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "props", "user_id")
    return events.select(F.to_json(row_object(events)).alias("row_object"))


@query("select_star", f"WITH {SERIES_SQL} SELECT {WH_HIST_SELECT} FROM series")
def select_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, root = new_table(spark, "star")
    full_reload(spark, map_hist(series(spark, sf_dir)), name, root, WH_HIST)
    return spark.sql(f"SELECT * FROM {name}")


def new_table(spark: SparkSession, label: str) -> tuple[str, str]:
    """A table name no other run uses, and a folder for its versions."""
    root = scratch(spark, label)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS series_lake LOCATION '{scratch(spark, 'database')}'")
    return f"series_lake.{label}_{root.rsplit('-', 1)[1]}", root


@query(
    "derived_table",
    f"""WITH {SERIES_SQL}
SELECT id, symbol, name, current_price FROM
  (SELECT coin_id AS id, coin_symbol AS symbol, coin_name AS name, price AS current_price FROM series)""",
)
def derived_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        """SELECT id, symbol, name, current_price FROM
             (SELECT coin_id AS id, coin_symbol AS symbol, coin_name AS name, price AS current_price FROM {flat})""",
        flat=series(spark, sf_dir),
    )


@query(
    "column_list_insert",
    f"""WITH {SERIES_SQL}
SELECT coin_id AS id, CAST(NULL AS VARCHAR) AS symbol, CAST(NULL AS VARCHAR) AS name, price AS current_price,
  CAST(NULL AS DOUBLE) AS market_cap, CAST(NULL AS BIGINT) AS market_cap_rank, CAST(NULL AS DOUBLE) AS total_volume,
  CAST(NULL AS DOUBLE) AS high_24h, CAST(NULL AS DOUBLE) AS low_24h, CAST(NULL AS DOUBLE) AS price_change_24h,
  make_timestamp("timestamp" * 1000) AS last_updated FROM series""",
)
def column_list_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = series(spark, sf_dir).select(
        F.col("coin_id").alias("id"), F.col("price").alias("current_price"), tc.ms_to_ntz("timestamp").alias("last_updated")
    )
    return insert_columns(listed, WH_HIST)


@query(
    "drop_null_legs",
    f"""WITH {DAILY_SQL}
SELECT coin_id, 'price' AS leg, "timestamp", price AS value FROM daily WHERE price IS NOT NULL
UNION ALL SELECT coin_id, 'market_cap', "timestamp", market_cap FROM daily WHERE market_cap IS NOT NULL
UNION ALL SELECT coin_id, 'volume', "timestamp", volume FROM daily WHERE volume IS NOT NULL""",
)
def drop_null_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagged_points(daily_documents(spark, sf_dir)).select("coin_id", "leg", "timestamp", "value")


@query(
    "lookback_filter",
    f"""WITH {SERIES_SQL}
SELECT coin_id, "timestamp", price, 'intra_day' AS run_type FROM series
WHERE "timestamp" BETWEEN {AS_OF_MS} - 86400000 AND {AS_OF_MS}
UNION ALL
SELECT coin_id, "timestamp", price, 'normal' FROM series
WHERE "timestamp" BETWEEN {AS_OF_MS} - 365 * CAST(86400000 AS BIGINT) AND {AS_OF_MS}""",
)
def lookback_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    def kept(run_type: str) -> DataFrame:
        recent = lookback(table(spark, sf_dir, "events"), AS_OF_MS, run_type, "ts")
        return flat_points(recent, F.col("value")).select(*KEY, "price", F.lit(run_type).alias("run_type"))

    return union_by_name(kept("intra_day"), kept("normal"))


@query("quote_currency_filter", "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'")
def quote_currency_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return quoted_in(customers, "c_mktsegment", "BUILDING")
