"""Reading ``[epoch_ms, value]`` pairs whose elements may be stored as different types.

``coalesced`` turns any numeric element into the wanted type. ``strict`` yields a value
only when the literal was written in the matching form: an integral literal for times, a
fractional or exponent literal for values. Strict reading needs variant elements.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODES = ("coalesced", "strict")


def element_type(raw: DataFrame) -> T.DataType:
    """Type of the pair elements of a document frame."""
    return raw.schema["data"].dataType["prices"].dataType.elementType.elementType


def element(pair: Column, index: int) -> Column:
    """Positional element; NULL when the pair is too short."""
    return F.get(pair, F.lit(index))


def choice_long(value: Column, dtype: T.DataType, mode: str = "coalesced") -> Column:
    """The integral reading of an element."""
    if _strict(dtype, mode):
        return F.when(F.schema_of_variant(value) == "BIGINT", F.try_variant_get(value, "$", "bigint"))
    if isinstance(dtype, T.VariantType):
        return F.try_variant_get(value, "$", "double").try_cast("bigint")
    if isinstance(dtype, T.StringType):
        return F.coalesce(value.try_cast("bigint"), value.try_cast("double").try_cast("bigint"))
    return value.try_cast("bigint")


def choice_double(value: Column, dtype: T.DataType, mode: str = "coalesced") -> Column:
    """The floating-point reading of an element."""
    if _strict(dtype, mode):
        form = F.schema_of_variant(value)
        fractional = (form == "DOUBLE") | form.startswith("DECIMAL")
        return F.when(fractional, F.try_variant_get(value, "$", "double"))
    if isinstance(dtype, T.VariantType):
        return F.try_variant_get(value, "$", "double")
    return value.try_cast("double")


def _strict(dtype: T.DataType, mode: str) -> bool:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if mode == "strict" and not isinstance(dtype, T.VariantType):
        raise TypeError("strict reading needs variant elements (schemas.RAW_STRICT)")
    return mode == "strict"
