"""Top lists, pages, positions and ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from series_lake.operators import ranking as r
from series_lake.operators.filters import peek
from series_lake.queries.registry import MARKETS_SQL, query
from series_lake.sources.tables import markets, table

_COLUMNS = "id, name, symbol, image, market_cap"
_ORDER = "ORDER BY market_cap DESC NULLS LAST, id"


@query("top_n_by_market_cap", f"WITH {MARKETS_SQL} SELECT {_COLUMNS} FROM markets {_ORDER} LIMIT 25")
def top_n_by_market_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.top_n(markets(spark, sf_dir))


@query("page_of_ranking", f"WITH {MARKETS_SQL} SELECT {_COLUMNS} FROM markets {_ORDER} LIMIT 25 OFFSET 25")
def page_of_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.page(markets(spark, sf_dir), 2)


@query(
    "fetch_position",
    f"""WITH {MARKETS_SQL}
SELECT {_COLUMNS}, row_number() OVER ({_ORDER}) AS position FROM markets {_ORDER} LIMIT 25""",
)
def fetch_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.with_position(markets(spark, sf_dir))


@query(
    "market_cap_rank",
    f"WITH {MARKETS_SQL} SELECT {_COLUMNS}, rank() OVER (ORDER BY market_cap DESC NULLS LAST) AS market_cap_rank FROM markets",
)
def market_cap_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.with_rank(markets(spark, sf_dir))


@query("limit_peek", "SELECT event_id, user_id, event_type, value FROM events ORDER BY event_id LIMIT 10")
def limit_peek(spark: SparkSession, sf_dir: str) -> DataFrame:
    return peek(table(spark, sf_dir, "events"), "event_id", "user_id", "event_type", "value", by="event_id")
