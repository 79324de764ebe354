"""Union, de-duplication and merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from series_lake.operators import merge
from series_lake.queries.registry import HISTORY_SQL, MERGED_SQL, query, series_sql
from series_lake.schemas import KEY
from series_lake.sources.tables import existing_history, flat_points, incoming_history, table


@query("union_by_name", f"WITH {HISTORY_SQL} SELECT * FROM incoming UNION ALL SELECT * FROM existing")
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.union_by_name(incoming_history(spark, sf_dir), existing_history(spark, sf_dir))


@query(
    "dedupe_keys",
    f"""WITH {HISTORY_SQL}
SELECT DISTINCT coin_id, "timestamp" FROM (SELECT * FROM incoming UNION ALL SELECT * FROM existing)""",
)
def dedupe_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = merge.union_by_name(incoming_history(spark, sf_dir), existing_history(spark, sf_dir))
    return merge.dedupe_keys(both).select(*KEY)


@query("merge_history", f"WITH {MERGED_SQL} SELECT * FROM merged")
def merge_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_history(incoming_history(spark, sf_dir), existing_history(spark, sf_dir))


@query("merge_first_run", f"""WITH {series_sql("revised", "value + CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END")} SELECT * FROM revised""")
def merge_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run that holds every point twice, every second one with a lower and a higher price:
    the higher wins."""
    events = table(spark, sf_dir, "events")
    revised = flat_points(events, F.col("value") + F.when(F.col("event_id") % 2 == 0, 1).otherwise(0))
    return merge.merge_history(merge.union_by_name(revised, flat_points(events, F.col("value"))))
