"""Explicit schemas of every layer. Only ``scan_stage`` takes the schema of its files."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and column order of the external formats.
LEG_ARRAYS = {"price": "prices", "market_cap": "market_caps", "volume": "total_volumes"}
LEGS = tuple(LEG_ARRAYS)
KEY = ["coin_id", "timestamp"]
DESCRIPTIVE = ["coin_name", "coin_symbol", "coin_image", "market_cap_rank"]
FLAT_COLUMNS = [*KEY, *DESCRIPTIVE, *LEGS, "date_time"]


def raw_schema(element: T.DataType) -> T.StructType:
    """Document schema whose ``[epoch_ms, value]`` pairs hold ``element``."""
    pairs = T.ArrayType(T.ArrayType(element))
    return T.StructType(
        [
            T.StructField("coin_id", T.StringType()),
            T.StructField("coin_name", T.StringType()),
            T.StructField("coin_symbol", T.StringType()),
            T.StructField("coin_image", T.StringType()),
            T.StructField("market_cap_rank", T.LongType()),
            T.StructField("data", T.StructType([T.StructField(a, pairs) for a in LEG_ARRAYS.values()])),
        ]
    )


# JSON read as literal text: one odd literal ("n/a" among numbers) costs one value,
# whereas a double-typed array would lose the whole leg of that document.
RAW = raw_schema(T.StringType())
# JSON read as variants: keeps integral, decimal and string literals apart.
RAW_STRICT = raw_schema(T.VariantType())
# Already typed pairs, as held in columnar copies of the raw layer.
RAW_TYPED = raw_schema(T.DoubleType())

# What a landing adds to a document: the part of its asset's series, and the landing's number.
LANDED = [T.StructField("segment", T.LongType()), T.StructField("landed", T.LongType())]
RAW_LANDED = T.StructType([*RAW.fields, *LANDED])

FLAT = T.StructType(
    [
        T.StructField("coin_id", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("coin_name", T.StringType()),
        T.StructField("coin_symbol", T.StringType()),
        T.StructField("coin_image", T.StringType()),
        T.StructField("market_cap_rank", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("market_cap", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("date_time", T.TimestampNTZType()),
    ]
)
# As published: partitioned by the UTC day of ``timestamp``.
FLAT_DATED = T.StructType([*FLAT.fields, T.StructField("date", T.DateType())])

MARKETS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("image", T.StringType()),
        T.StructField("market_cap_rank", T.LongType()),
        T.StructField("market_cap", T.DoubleType()),
    ]
)

WH_HIST = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("current_price", T.DoubleType()),
        T.StructField("market_cap", T.DoubleType()),
        T.StructField("market_cap_rank", T.LongType()),
        T.StructField("total_volume", T.DoubleType()),
        T.StructField("high_24h", T.DoubleType()),
        T.StructField("low_24h", T.DoubleType()),
        T.StructField("price_change_24h", T.DoubleType()),
        T.StructField("last_updated", T.TimestampNTZType()),
    ]
)
WH_INTRA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("current_price", T.DoubleType()),
        T.StructField("market_cap", T.DoubleType()),
        T.StructField("total_volume", T.DoubleType()),
        T.StructField("price_change_percentage_24h", T.DoubleType()),
        T.StructField("circulating_supply", T.DoubleType()),
        T.StructField("total_supply", T.DoubleType()),
        T.StructField("ath", T.DoubleType()),
        T.StructField("atl", T.DoubleType()),
        T.StructField("last_updated", T.TimestampNTZType()),
    ]
)
