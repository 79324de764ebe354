"""Scalar, array and JSON functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from series_lake.functions import casts, choice, documents, text
from series_lake.functions import timeconv as tc
from series_lake.operators.flatten import tagged_points
from series_lake.queries.registry import DAILY_SQL, query
from series_lake.schemas import LEG_ARRAYS
from series_lake.sources.tables import daily_points, landed_documents, table

_MS = "(epoch_us(ts) // 1000)"


def _event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", tc.ntz_to_ms("ts").alias("ms"))


@query("ms_to_seconds", f"SELECT event_id, {_MS} / 1000 AS seconds FROM events")
def ms_to_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_times(spark, sf_dir).select("event_id", tc.ms_to_seconds(F.col("ms")).alias("seconds"))


@query("epoch_to_string", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS clock FROM events")
def epoch_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_times(spark, sf_dir).select("event_id", tc.clock_text(F.col("ms")).alias("clock"))


@query(
    "utc_to_local",
    "SELECT event_id, timezone('America/Chicago', timezone('UTC', date_trunc('second', ts))) AS date_time FROM events",
)
def utc_to_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_times(spark, sf_dir).select("event_id", tc.local_clock(F.col("ms")).alias("date_time"))


@query("epoch_to_timestamp", f"SELECT event_id, make_timestamp({_MS} * 1000) AS last_updated FROM events")
def epoch_to_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_times(spark, sf_dir).select("event_id", tc.ms_to_ntz("ms").alias("last_updated"))


@query(
    "explode_series",
    f"""WITH {DAILY_SQL}
SELECT coin_id, 'price' AS leg, "timestamp", price AS value FROM daily WHERE price IS NOT NULL
UNION ALL SELECT coin_id, 'market_cap', "timestamp", market_cap FROM daily WHERE market_cap IS NOT NULL
UNION ALL SELECT coin_id, 'volume', "timestamp", volume FROM daily WHERE volume IS NOT NULL""",
)
def explode_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagged_points(landed_documents(spark, sf_dir)).select("coin_id", "leg", "timestamp", "value")


@query(
    "pair_element",
    f"""WITH {DAILY_SQL}
SELECT coin_id, CAST("timestamp" AS DOUBLE) AS first, price AS second, CAST(NULL AS DOUBLE) AS third
FROM daily WHERE price IS NOT NULL""",
)
def pair_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = landed_documents(spark, sf_dir).select("coin_id", F.explode(f"data.{LEG_ARRAYS['price']}").alias("pair"))
    parts = [choice.element(F.col("pair"), i).alias(n) for i, n in enumerate(("first", "second", "third"))]
    return pairs.select("coin_id", *parts)


def _mixed_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pair per event whose value literal is integral, fractional, a string or null."""
    kind = F.col("event_type")
    literal = (
        F.when(kind == "purchase", F.round("value").cast("bigint").cast("string"))
        .when(kind == "error", "null")
        .when(kind == "signup", '"n/a"')
        .otherwise(F.col("value").cast("decimal(18,2)").cast("string"))
    )
    pair = F.concat(F.lit("["), tc.ntz_to_ms("ts").cast("string"), F.lit(", "), literal, F.lit("]"))
    parsed = F.from_json(pair, T.ArrayType(T.VariantType()))
    return table(spark, sf_dir, "events").select("event_id", parsed.alias("pair"))


@query(
    "choice_long",
    f"""SELECT event_id, {_MS} AS time_strict, {_MS} AS time_coalesced,
  CASE WHEN event_type = 'purchase' THEN CAST(round(value) AS BIGINT) END AS value_strict,
  CASE WHEN event_type = 'purchase' THEN CAST(round(value) AS BIGINT)
       WHEN event_type IN ('view', 'click') THEN CAST(trunc(value) AS BIGINT) END AS value_coalesced
FROM events""",
)
def choice_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _branches(_mixed_literals(spark, sf_dir), choice.choice_long)


@query(
    "choice_double",
    f"""SELECT event_id, CAST(NULL AS DOUBLE) AS time_strict, CAST({_MS} AS DOUBLE) AS time_coalesced,
  CASE WHEN event_type IN ('view', 'click') THEN value END AS value_strict,
  CASE WHEN event_type = 'purchase' THEN round(value) WHEN event_type IN ('view', 'click') THEN value
       END AS value_coalesced
FROM events""",
)
def choice_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _branches(_mixed_literals(spark, sf_dir), choice.choice_double)


def _branches(pairs: DataFrame, read) -> DataFrame:
    read_as = {
        f"{part}_{mode}": read(choice.element(F.col("pair"), i), T.VariantType(), mode)
        for mode in choice.MODES
        for i, part in enumerate(("time", "value"))
    }
    return pairs.select("event_id", *[c.alias(n) for n, c in read_as.items()])


@query("cast_string", "SELECT event_id, CAST(user_id AS VARCHAR) AS id FROM events")
def cast_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", casts.as_string(F.col("user_id")).alias("id"))


@query(
    "cast_float",
    """SELECT event_id, TRY_CAST(CASE WHEN event_type = 'error' THEN event_type ELSE CAST(value AS VARCHAR) END AS DOUBLE)
  AS current_price FROM events""",
)
def cast_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    untyped = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(F.col("value").cast("string"))
    return table(spark, sf_dir, "events").select("event_id", casts.as_float(untyped).alias("current_price"))


@query(
    "cast_number",
    """SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(38,0)) AS DOUBLE) AS market_cap
FROM lineitem""",
)
def cast_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = casts.as_number(F.col("l_extendedprice")).cast("double")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", number.alias("market_cap"))


@query("cast_timestamp", "SELECT event_id, TRY_CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) AS last_updated FROM events")
def cast_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = F.col("ts").cast("string")
    return table(spark, sf_dir, "events").select("event_id", casts.as_timestamp(written).alias("last_updated"))


@query(
    "round_precision",
    """SELECT l_orderkey, l_linenumber,
  CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS discount
FROM lineitem""",
)
def round_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    exact = F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_discount").cast("decimal(4,2)")
    rounded = casts.at_precision(exact).cast("decimal(18,2)")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", rounded.alias("discount"))


@query(
    "build_envelope",
    f"""WITH {DAILY_SQL}
SELECT coin_id, coin_name, coin_symbol, coin_image, market_cap_rank,
  coalesce(string_agg("timestamp" || ':' || CAST(price AS DECIMAL(18,2)), ',' ORDER BY "timestamp")
    FILTER (price IS NOT NULL), '') AS prices,
  coalesce(string_agg("timestamp" || ':' || CAST(market_cap AS DECIMAL(18,2)), ',' ORDER BY "timestamp")
    FILTER (market_cap IS NOT NULL), '') AS market_caps,
  coalesce(string_agg("timestamp" || ':' || CAST(volume AS DECIMAL(18,2)), ',' ORDER BY "timestamp")
    FILTER (volume IS NOT NULL), '') AS total_volumes
FROM daily GROUP BY ALL""",
)
def build_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents.build_envelope(daily_points(spark, sf_dir))

    def written(array: str):
        pair = lambda p: F.concat(p[0].cast("bigint").cast("string"), F.lit(":"), p[1].cast("decimal(18,2)").cast("string"))
        return F.array_join(F.transform(F.col(f"data.{array}"), pair), ",").alias(array)

    return docs.select(*[c for c in docs.columns if c != "data"], *[written(a) for a in LEG_ARRAYS.values()])


@query(
    "to_json",
    "SELECT to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type})::VARCHAR AS document FROM events",
)
def to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(documents.to_document_text(events, "event_id", "user_id", "event_type").alias("document"))


@query("from_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType([T.StructField("k", T.LongType())])
    parsed = documents.from_document_text(F.col("props"), schema)
    return table(spark, sf_dir, "events").select("event_id", parsed["k"].alias("k"))


@query("string_upper", "SELECT c_custkey, upper(c_name) AS symbol FROM customer")
def string_upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", text.upper_symbol(F.col("c_name")).alias("symbol"))


@query(
    "string_title",
    r"""SELECT o_orderkey, array_to_string(list_transform(
    regexp_extract_all(replace(lower(o_orderpriority) || '_run', '_', ' '), '[A-Za-z]+|[^A-Za-z]+'),
    lambda r: upper(r[1]) || lower(r[2:])), '') AS title FROM orders""",
)
def string_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lower("o_orderpriority"), F.lit("_run"))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.title_text(name).alias("title"))


_ROUTED = "CASE WHEN event_type = 'view' THEN 'intra_day' WHEN event_type = 'signup' THEN NULL ELSE event_type END"


def _run_type():
    kind = F.col("event_type")
    return F.when(kind == "view", "intra_day").when(kind == "signup", F.lit(None)).otherwise(kind)


@query(
    "object_key",
    f"""SELECT event_id, CASE WHEN {_ROUTED} = 'intra_day' THEN 'intra_day_data' ELSE 'historical_data' END
  || '/u' || user_id || '.json' AS object_key FROM events""",
)
def object_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    coin = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    return table(spark, sf_dir, "events").select("event_id", text.object_key(_run_type(), coin).alias("object_key"))


@query(
    "path_prefix",
    f"""SELECT event_id, CASE WHEN {_ROUTED} = 'intra_day' THEN 'intra_day_data' ELSE 'historical_data' END AS prefix
FROM events""",
)
def path_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = object_key(spark, sf_dir)
    return keys.select("event_id", text.path_prefix(F.col("object_key")).alias("prefix"))


@query(
    "route_by_run_type",
    f"""SELECT event_id, {_ROUTED} AS run_type,
  CASE WHEN {_ROUTED} = 'intra_day' THEN 'intra_day_data' ELSE 'historical_data' END AS prefix,
  CASE WHEN {_ROUTED} = 'intra_day' THEN 1 ELSE 365 END AS days FROM events""",
)
def route_by_run_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = table(spark, sf_dir, "events").select("event_id", _run_type().alias("run_type"))
    run_type = F.col("run_type")
    return routed.select(
        "event_id", "run_type", text.target_prefix(run_type).alias("prefix"), text.lookback_days(run_type).alias("days")
    )


@query(
    "uri_parse",
    r"""SELECT page_id, split_part(split_part(split_part(url, '/', 3), '?', 1), '#', 1) AS bucket,
  ltrim(regexp_extract(split_part(split_part(url, '#', 1), '?', 1), '^[a-z]+://[^/]*(.*)$', 1), '/') AS key FROM pages""",
)
def uri_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", text.uri_bucket(url).alias("bucket"), text.uri_key(url).alias("key")
    )
