"""What was dropped, and the load summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from series_lake.functions.timeconv import MAX_MS
from series_lake.operators import quality as q
from series_lake.operators.merge import union_by_name
from series_lake.queries.registry import DAILY_SQL, HISTORY_SQL, MERGED_SQL, query
from series_lake.operators.merge import merge_history
from series_lake.sources.tables import daily_documents, existing_history, incoming_history, landed_documents, odd_documents


@query(
    "reject_documents",
    f"""WITH {DAILY_SQL}
SELECT coin_id, "timestamp",
       CASE WHEN coalesce(price, market_cap, volume) IS NULL THEN 'no data'
            ELSE concat_ws(',', CASE WHEN price IS NULL THEN 'prices' END,
                                CASE WHEN market_cap IS NULL THEN 'market_caps' END,
                                CASE WHEN volume IS NULL THEN 'total_volumes' END) END AS reason
FROM daily WHERE price IS NULL OR market_cap IS NULL OR volume IS NULL""",
)
def reject_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.reject_documents(daily_documents(spark, sf_dir)).select("coin_id", "timestamp", "reason")


_ODD_ROWS = """odd AS (
  SELECT coin_id, 'price' AS leg, "timestamp" AS time, price AS value FROM daily
  UNION ALL SELECT coin_id, 'market_cap', CASE WHEN market_cap IS NOT NULL THEN "timestamp" END, coalesce(market_cap, 1) FROM daily
  UNION ALL SELECT coin_id, 'volume', CASE WHEN volume IS NULL THEN "timestamp" * 1000 ELSE "timestamp" END, coalesce(volume, 1) FROM daily)"""


@query(
    "null_value_audit",
    f"""WITH {DAILY_SQL}, {_ODD_ROWS}
SELECT coin_id, leg, count(*) AS points, count(*) FILTER (time IS NULL OR time > {MAX_MS}) AS null_times,
       count(*) FILTER (value IS NULL) AS null_values
FROM odd GROUP BY coin_id, leg""",
)
def null_value_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.null_value_audit(odd_documents(spark, sf_dir))


@query(
    "reject_points",
    f"""WITH {DAILY_SQL}, {_ODD_ROWS}
SELECT coin_id, leg, CAST(time AS VARCHAR) AS time,
       CASE WHEN time IS NULL THEN 'no time' WHEN time > {MAX_MS} THEN 'time out of range' ELSE 'no value' END AS reason
FROM odd WHERE time IS NULL OR time > {MAX_MS} OR value IS NULL""",
)
def reject_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.reject_points(odd_documents(spark, sf_dir)).select("coin_id", "leg", "time", "reason")


@query(
    "unmatched_keys",
    f"""WITH {DAILY_SQL}
SELECT coin_id, "timestamp", CAST(price IS NOT NULL AS BIGINT) AS price_points,
       CAST(market_cap IS NOT NULL AS BIGINT) AS market_cap_points, CAST(volume IS NOT NULL AS BIGINT) AS volume_points,
       concat_ws(',', CASE WHEN price IS NULL THEN 'price' END, CASE WHEN market_cap IS NULL THEN 'market_cap' END,
                      CASE WHEN volume IS NULL THEN 'volume' END) AS missing
FROM daily
WHERE coalesce(price, market_cap, volume) IS NOT NULL AND (price IS NULL OR market_cap IS NULL OR volume IS NULL)""",
)
def unmatched_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.unmatched_keys(landed_documents(spark, sf_dir))


@query(
    "duplicate_keys",
    f"""WITH {HISTORY_SQL}
SELECT coin_id, "timestamp", count(*) AS copies
FROM (SELECT * FROM incoming UNION ALL SELECT * FROM existing) GROUP BY coin_id, "timestamp" HAVING count(*) > 1""",
)
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.duplicate_keys(union_by_name(incoming_history(spark, sf_dir), existing_history(spark, sf_dir)))


@query(
    "load_summary",
    f"""WITH {MERGED_SQL}
SELECT count(*) AS "rows", count(DISTINCT coin_id) AS assets, make_timestamp(min("timestamp") * 1000) AS first_time,
       make_timestamp(max("timestamp") * 1000) AS last_time FROM merged""",
)
def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = merge_history(incoming_history(spark, sf_dir), existing_history(spark, sf_dir))
    return q.load_summary(merged)
