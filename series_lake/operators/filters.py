"""Row selection and alignment to a target schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from series_lake.functions.text import INTRA_DAY, LOOKBACK_DAYS_HISTORICAL, LOOKBACK_DAYS_INTRA_DAY
from series_lake.functions.timeconv import DAY_MS, ms_to_ntz, utc_date


def lookback(frame: DataFrame, as_of_ms: int, run_type: str | None, time: str = "timestamp") -> DataFrame:
    """Points of the last day (intra-day runs) or the last 365 days (all other runs).

    ``time`` holds epoch milliseconds or zone-free timestamps. The bare column is compared
    with a constant, so the filter reaches the Parquet scan; where the frame has the UTC
    ``date`` of its points, that is compared too and prunes partitions.
    """
    days = LOOKBACK_DAYS_INTRA_DAY if run_type == INTRA_DAY else LOOKBACK_DAYS_HISTORICAL
    start, end = F.lit(as_of_ms - days * DAY_MS), F.lit(as_of_ms)
    if isinstance(frame.schema[time].dataType, T.TimestampNTZType):
        kept = frame.where(F.col(time).between(ms_to_ntz(start), ms_to_ntz(end)))
    else:
        kept = frame.where(F.col(time).between(start, end))
    return kept.where(F.col("date").between(utc_date(start), utc_date(end))) if "date" in frame.columns else kept


def quoted_in(frame: DataFrame, column: str, currency: str) -> DataFrame:
    """Rows quoted in one currency."""
    return frame.where(F.col(column) == F.lit(currency))


def insert_columns(frame: DataFrame, target: T.StructType) -> DataFrame:
    """Shape a frame like a table: unlisted columns are NULL, order and types are the table's."""
    unknown = set(frame.columns) - set(target.names)
    if unknown:
        raise ValueError(f"not columns of the target: {sorted(unknown)}")
    given = set(frame.columns)
    return frame.select(
        *[(F.col(f.name) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.fields]
    )


def peek(frame: DataFrame, *columns: str, n: int = 10, by: str | None = None) -> DataFrame:
    """The first ``n`` rows in no order, or in the order of a key."""
    shown = frame.select(*columns) if columns else frame
    return (shown.orderBy(by) if by else shown).limit(n)
