"""Union, de-duplication and the merge of a run into its history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from series_lake.schemas import KEY


def union_by_name(left: DataFrame, right: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Bag union by column name; columns that differ are an error unless allowed."""
    return left.unionByName(right, allowMissingColumns=allow_missing)


def dedupe_keys(frame: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """One arbitrary row per key."""
    return frame.dropDuplicates(keys)


def merge_history(incoming: DataFrame, existing: DataFrame | None = None, keys: list[str] = KEY) -> DataFrame:
    """One row per key of both inputs; a row of ``incoming`` beats one of ``existing``.

    Among rows of the same input the one with the largest values wins, compared column by
    column with NULL smallest, so the result does not depend on how rows are distributed.
    The winner is a plain aggregate: it is combined before the exchange, so a key that is
    repeated very often arrives as one row per map task.
    """
    values = [c for c in incoming.columns if c not in keys]
    ranked = incoming.withColumn("_incoming", F.lit(1))
    if existing is not None:
        ranked = ranked.unionByName(existing.withColumn("_incoming", F.lit(0)))
    winner = ranked.groupBy(*keys).agg(F.max(F.struct("_incoming", *values)).alias("w"))
    return winner.select(*[F.col(c) if c in keys else F.col(f"w.{c}").alias(c) for c in incoming.columns])
