"""Epoch milliseconds, UTC and local wall clocks, independent of the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
LOCAL_ZONE = "America/Chicago"
DAY_MS = 86_400_000
HOUR_MS = 3_600_000
# The valid times: 0001-01-02 to 9999-12-30 UTC, so that every zone's clock stays in years 1 to 9999.
MIN_MS = -62_135_510_400_000
MAX_MS = 253_402_214_399_999


def valid_ms(ms: Column) -> Column:
    """Epoch milliseconds in the valid range, NULL outside: one absurd time costs one value."""
    return F.when(ms.between(MIN_MS, MAX_MS), ms)


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def floor_div(number: Column, width: int) -> Column:
    """Integer quotient rounded down, also below zero."""
    return F.call_function("div", number - F.pmod(number, F.lit(width)), F.lit(width))


def ntz_to_ms(ts: Column | str) -> Column:
    """Zone-free timestamp to epoch milliseconds.

    Put together from the fields of the clock: ``timestampdiff`` and ``unix_millis`` would
    pass through an instant in the session zone, where hours skipped by a clock change move.
    """
    within_day = F.hour(ts).cast("long") * HOUR_MS + F.minute(ts) * 60_000
    return day_start_ms(ts) + within_day + (F.extract(F.lit("SECOND"), ts) * 1000).cast("long")


def ms_to_ntz(ms: Column | str) -> Column:
    """Epoch milliseconds to the UTC wall clock; NULL outside the valid range."""
    return F.timestamp_add("MILLISECOND", valid_ms(F.col(ms) if isinstance(ms, str) else ms), _epoch())


def ms_to_seconds(ms: Column) -> Column:
    """Epoch milliseconds to fractional seconds."""
    return ms / F.lit(1000)


def whole_seconds(ms: Column) -> Column:
    """Milliseconds to whole seconds, cut toward zero also before 1970."""
    return F.call_function("div", ms, F.lit(1000))


def utc_seconds_clock(ms: Column) -> Column:
    """Epoch milliseconds to the UTC wall clock without its sub-second part."""
    return F.timestamp_add("SECOND", whole_seconds(valid_ms(ms)), _epoch())


def clock_text(ms: Column) -> Column:
    """Epoch milliseconds to ``yyyy-MM-dd HH:mm:ss`` text on the UTC clock."""
    return utc_seconds_clock(ms).cast("string")


def local_clock(ms: Column, zone: str = LOCAL_ZONE) -> Column:
    """Epoch milliseconds to the wall clock of ``zone``, to the second.

    Display only: around a clock change two instants share one wall clock, so this
    value must never be a key, a join column or a sort column.

    ``from_utc_timestamp`` shifts the instant by the zone's offset and resolves the zone once
    per task. Read back as microseconds the shifted instant is the wall clock, whatever the
    session zone. (``convert_timezone`` gives the same and looks both zones up for every row.)
    """
    shifted = F.from_utc_timestamp(F.timestamp_seconds(whole_seconds(valid_ms(ms))), zone)
    return F.timestamp_add("MICROSECOND", F.unix_micros(shifted), _epoch())


def utc_date(ms: Column) -> Column:
    """Epoch milliseconds to the UTC day, also before 1970; NULL outside the valid range."""
    return F.date_from_unix_date(floor_div(valid_ms(ms), DAY_MS).cast("int"))


def day_start_ms(ts: Column | str) -> Column:
    """Zone-free timestamp to the epoch milliseconds of its midnight."""
    return F.unix_date(F.to_date(ts)).cast("long") * F.lit(DAY_MS)
