"""Names, object keys and URIs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The run type with its own prefix and lookback, and those of all others.
INTRA_DAY = "intra_day"
PREFIX_INTRA_DAY = "intra_day_data"
PREFIX_HISTORICAL = "historical_data"
LOOKBACK_DAYS_INTRA_DAY = 1
LOOKBACK_DAYS_HISTORICAL = 365


def is_intra_day(run_type: Column) -> Column:
    """False for every other run type, a missing one included."""
    return run_type.eqNullSafe(F.lit(INTRA_DAY))


def target_prefix(run_type: Column) -> Column:
    return F.when(is_intra_day(run_type), PREFIX_INTRA_DAY).otherwise(PREFIX_HISTORICAL)


def lookback_days(run_type: Column) -> Column:
    return F.when(is_intra_day(run_type), LOOKBACK_DAYS_INTRA_DAY).otherwise(LOOKBACK_DAYS_HISTORICAL)


def object_key(run_type: Column, coin_id: Column) -> Column:
    return F.concat(target_prefix(run_type), F.lit("/"), coin_id, F.lit(".json"))


def path_prefix(key: Column) -> Column:
    """First segment of a slash-separated key."""
    return F.split_part(key, F.lit("/"), F.lit(1))


def upper_symbol(symbol: Column) -> Column:
    return F.upper(symbol)


def title_text(name: Column) -> Column:
    """Underscores to spaces, then each run of letters capitalised."""
    runs = F.regexp_extract_all(F.replace(name, F.lit("_"), F.lit(" ")), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.left(r, F.lit(1))), F.lower(F.substr(r, F.lit(2))))), "")


def uri_bucket(uri: Column) -> Column:
    """Authority part of a URI; empty when there is none."""
    return F.regexp_extract(uri, r"^(?:[^:/?#]+:)?//([^/?#]*)", 1)


def uri_key(uri: Column) -> Column:
    """Path of a URI without its leading slashes."""
    return F.regexp_extract(uri, r"^(?:[^:/?#]+:)?(?://[^/?#]*)?/*([^?#]*)", 1)
