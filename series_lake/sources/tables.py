"""The given tables, and the documents and series that Spark derives from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from series_lake.functions import timeconv as tc
from series_lake.functions.documents import build_envelope
from series_lake.schemas import DESCRIPTIVE, FLAT_COLUMNS, LEG_ARRAYS, RAW_TYPED
from series_lake.workspace import scratch

# Which event type plays which leg.
LEG_EVENTS = {"price": "view", "market_cap": "click", "volume": "purchase"}

_DESCRIBED = ["coin_id", *DESCRIPTIVE]

EXISTING_BEFORE = "2024-01-20 00:00:00"
INCOMING_FROM = "2024-01-15 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _asset_columns() -> list:
    user = F.col("user_id").cast("string")
    return [
        F.concat(F.lit("u"), user).alias("coin_id"),
        F.concat(F.lit("User "), user).alias("coin_name"),
        F.concat(F.lit("u"), user).alias("coin_symbol"),
        F.concat(F.lit("img/"), user).alias("coin_image"),
        (F.col("user_id") + 1).alias("market_cap_rank"),
    ]


def daily_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user and day with a value per leg; NULL where the day has none.

    Aggregating to the day first keeps every later group bounded by the calendar, however
    many events a single user has, and combines on the map side.
    """
    value = F.col("value")
    money = value.cast("decimal(18,2)")
    kind = F.col("event_type")
    daily = (
        table(spark, sf_dir, "events")
        .groupBy("user_id", tc.day_start_ms("ts").alias("timestamp"))
        .agg(
            F.max(F.when(kind == LEG_EVENTS["price"], value)).alias("price"),
            F.sum(F.when(kind == LEG_EVENTS["market_cap"], money)).cast("double").alias("market_cap"),
            F.sum(F.when(kind == LEG_EVENTS["volume"], money)).cast("double").alias("volume"),
        )
    )
    return daily.select(*_asset_columns(), "timestamp", "price", "market_cap", "volume")


def documents(spark: SparkSession, sf_dir: str, element: str = "double") -> DataFrame:
    """One raw document per user; at most one pair per leg and calendar day."""
    return build_envelope(daily_points(spark, sf_dir), element)


def daily_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw document per user and day, as a one-day run delivers them.

    Days without any leg value stand for failed requests: they have no ``data``.
    """
    pair = lambda leg: F.when(
        F.col(leg).isNotNull(), F.array(F.array(F.col("timestamp").cast("double"), F.col(leg)))
    ).otherwise(F.expr("CAST(array() AS array<array<double>>)"))
    data = F.struct(pair("price").alias("prices"), pair("market_cap").alias("market_caps"), pair("volume").alias("total_volumes"))
    return daily_points(spark, sf_dir).select(
        "coin_id", "coin_name", "coin_symbol", "coin_image", "market_cap_rank",
        F.when(F.coalesce("price", "market_cap", "volume").isNotNull(), data).alias("data"),
        "timestamp",
    )


def odd_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per user whose pairs are faulty where the day lacks a value.

    A day without price has a price pair without value, a day without market cap a pair without
    time, a day without volume a pair whose time is in microseconds and so out of range.
    """
    day, missing = F.col("timestamp").cast("string"), F.lit(None).cast("string")
    text = lambda leg: F.col(leg).cast("string")
    pairs = daily_points(spark, sf_dir).select(
        *_DESCRIBED,
        F.array(day, text("price")).alias("prices"),
        F.array(F.when(F.col("market_cap").isNull(), missing).otherwise(day), F.coalesce(text("market_cap"), F.lit("1"))).alias("market_caps"),
        F.array(F.when(F.col("volume").isNull(), (F.col("timestamp") * 1000).cast("string")).otherwise(day), F.coalesce(text("volume"), F.lit("1"))).alias("total_volumes"),
    )
    grouped = pairs.groupBy(*_DESCRIBED).agg(*[F.collect_list(a).alias(a) for a in LEG_ARRAYS.values()])
    return grouped.select(*_DESCRIBED, F.struct(*LEG_ARRAYS.values()).alias("data"))


def repeated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per user with two pairs per leg and day, the smallest and the largest value, so
    that every instant is repeated and the join of the legs multiplies."""
    value, kind = F.col("value"), F.col("event_type")
    own = {leg: F.when(kind == event, value) for leg, event in LEG_EVENTS.items()}
    ends = [f(own[leg]).alias(f"{leg}_{f.__name__}") for leg in LEG_ARRAYS for f in (F.min, F.max)]
    daily = table(spark, sf_dir, "events").groupBy("user_id", tc.day_start_ms("ts").alias("timestamp")).agg(*ends)
    pair = lambda end: F.array(F.col("timestamp").cast("double"), F.col(end))
    both = [F.when(F.col(f"{leg}_min").isNotNull(), F.array(pair(f"{leg}_min"), pair(f"{leg}_max"))).alias(leg) for leg in LEG_ARRAYS]
    described = daily.select(*_asset_columns(), *both)
    grouped = described.groupBy(*_DESCRIBED).agg(*[F.flatten(F.collect_list(leg)).alias(name) for leg, name in LEG_ARRAYS.items()])
    return grouped.select(*_DESCRIBED, F.struct(*LEG_ARRAYS.values()).alias("data"))


_landed: dict[tuple[str, str], str] = {}


def landed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a columnar copy, written once per application.

    Queries then start at files, as a real run does, and every leg reads only its own
    array because nested columns are pruned in Parquet.
    """
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _landed:
        path = scratch(spark, "documents")
        documents(spark, sf_dir).write.parquet(path)
        _landed[at] = path
    return spark.read.schema(RAW_TYPED).parquet(_landed[at])


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one point of its user's flat series. ``(coin_id, timestamp)`` is unique."""
    return flat_points(table(spark, sf_dir, "events"), F.col("value"))


def existing_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an earlier run published: older points, prices off by one."""
    before = table(spark, sf_dir, "events").where(F.col("ts") < F.expr(f"TIMESTAMP_NTZ'{EXISTING_BEFORE}'"))
    return flat_points(before, F.col("value") + 1)


def incoming_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the next run delivers: overlaps the existing history by five days."""
    after = table(spark, sf_dir, "events").where(F.col("ts") >= F.expr(f"TIMESTAMP_NTZ'{INCOMING_FROM}'"))
    return flat_points(after, F.col("value"))


def flat_points(events: DataFrame, price: Column) -> DataFrame:
    """Events as flat rows, no aggregation."""
    points = events.select(
        *_asset_columns(),
        tc.ntz_to_ms("ts").alias("timestamp"),
        price.alias("price"),
        (F.col("value") * 100).alias("market_cap"),
        (F.col("value") * 10).alias("volume"),
    )
    return points.withColumn("date_time", tc.local_clock(F.col("timestamp"))).select(*FLAT_COLUMNS)


def markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as assets, their order total as market cap.

    Orders are summed per customer before the join, so a customer with very many orders
    reaches the join as one row per map task.
    """
    caps = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("market_cap"))
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return customers.join(caps, F.col("c_custkey") == F.col("o_custkey")).select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("symbol"),
        F.concat(F.lit("img/"), F.col("c_custkey").cast("string")).alias("image"),
        F.col("market_cap").cast("double").alias("market_cap"),
    )


