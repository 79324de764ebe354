"""What was dropped on the way, and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from series_lake.functions.timeconv import ms_to_ntz, valid_ms
from series_lake.functions.choice import choice_double, choice_long, element, element_type
from series_lake.operators.flatten import tagged_points
from series_lake.schemas import KEY, LEG_ARRAYS, LEGS


def _no_points(array: str) -> Column:
    return F.coalesce(F.size(f"data.{array}"), F.lit(0)) <= 0


def reject_documents(raw: DataFrame) -> DataFrame:
    """Documents that cannot give a row, with the reason: no data at all, or the empty legs."""
    empty = [F.when(_no_points(a), F.lit(a)) for a in LEG_ARRAYS.values()]
    reason = F.when(F.col("data").isNull(), "no data").otherwise(F.concat_ws(",", *empty))
    return raw.withColumn("reason", reason).where(F.col("reason") != "")


def reject_points(raw: DataFrame, mode: str = "coalesced") -> DataFrame:
    """Pairs that give no point or a point without value: asset, leg, the literals, the reason.

    Reasons: ``no time`` (absent or not a number), ``time out of range`` (see timeconv), ``no value``.
    """
    dtype = element_type(raw)
    arrays = F.array(*[F.struct(F.lit(leg).alias("leg"), F.col(f"data.{name}").alias("pairs")) for leg, name in LEG_ARRAYS.items()])
    pairs = raw.select("coin_id", F.inline(arrays)).select("coin_id", "leg", F.explode("pairs").alias("pair"))
    time = choice_long(element(F.col("pair"), 0), dtype, mode)
    reason = (
        F.when(time.isNull(), "no time")
        .when(valid_ms(time).isNull(), "time out of range")
        .when(choice_double(element(F.col("pair"), 1), dtype, mode).isNull(), "no value")
    )
    literals = [element(F.col("pair"), i).cast("string").alias(name) for i, name in enumerate(("time", "value"))]
    return pairs.select("coin_id", "leg", *literals, reason.alias("reason")).where(F.col("reason").isNotNull())


def null_value_audit(raw: DataFrame, mode: str = "coalesced") -> DataFrame:
    """Per asset and leg: pairs, and how many lack their time or their value after reading."""
    return (
        tagged_points(raw, mode)
        .groupBy("coin_id", "leg")
        .agg(
            F.count("*").alias("points"),
            F.count_if(F.col("timestamp").isNull()).alias("null_times"),
            F.count_if(F.col("value").isNull()).alias("null_values"),
        )
    )


def unmatched_keys(raw: DataFrame, mode: str = "coalesced") -> DataFrame:
    """Keys some legs have and others lack, with the number of points that the join drops.

    One scan and one aggregate instead of an anti join per pair of legs.
    """
    counts = [F.count_if(F.col("leg") == leg).alias(f"{leg}_points") for leg in LEGS]
    per_key = (
        tagged_points(raw, mode)
        .where(F.col("coin_id").isNotNull() & F.col("timestamp").isNotNull())
        .groupBy(*KEY)
        .agg(*counts)
    )
    missing = F.concat_ws(",", *[F.when(F.col(f"{leg}_points") == 0, F.lit(leg)) for leg in LEGS])
    return per_key.withColumn("missing", missing).where(F.col("missing") != "")


def duplicate_keys(frame: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Keys with more than one row."""
    return frame.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def load_summary(flat: DataFrame) -> DataFrame:
    """Rows, assets and covered time, in one pass."""
    assets = flat.groupBy("coin_id").agg(
        F.count("*").alias("n"), F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")
    )
    return assets.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count("coin_id").alias("assets"),
        ms_to_ntz(F.min("lo")).alias("first_time"),
        ms_to_ntz(F.max("hi")).alias("last_time"),
    )
