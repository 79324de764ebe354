"""Warehouse casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_string(value: Column) -> Column:
    return value.cast("string")


def as_float(value: Column) -> Column:
    return value.try_cast("double")


def as_number(value: Column) -> Column:
    """Integer-scale number, half away from zero."""
    return value.try_cast(T.DecimalType(38, 0))


def as_timestamp(value: Column) -> Column:
    return value.try_cast("timestamp_ntz")


def at_precision(value: Column, digits: int = 2) -> Column:
    """Value rounded to ``digits`` decimals."""
    return F.round(value, digits)
