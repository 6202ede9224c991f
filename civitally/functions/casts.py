"""Text to typed values: dates strictly, numbers leniently."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strict_timestamp(x: Column, kind: T.DataType) -> Column:
    """Naive timestamp; text that is not a date stops the job."""
    if not isinstance(kind, T.StringType):
        return x.cast("timestamp_ntz")
    parsed = x.try_cast("timestamp_ntz")
    bad = F.raise_error(F.concat(F.lit("not a timestamp: "), x))
    return F.when(x.isNotNull(), F.coalesce(parsed, bad.cast("timestamp_ntz")))


# A failed cast costs an exception per row, so the shape of the text is checked first.
WHOLE = r"^\s*[+-]?\d{1,18}\s*$"
NUMBER = r"^\s*[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|(?i:inf(inity)?))\s*$"


def _number(x: Column) -> Column:
    return F.when(x.rlike(NUMBER), F.trim(x).try_cast("double"))


def lenient_double(x: Column, kind: T.DataType) -> Column:
    """Number or null; NaN counts as null."""
    if isinstance(kind, T.StringType):
        return _number(x)
    value = x.cast("double")
    return F.when(~F.isnan(value), value)


def lenient_long(x: Column, kind: T.DataType) -> Column:
    """Whole number or null; '10001.0' is whole, '10001-1234' and '10001.5' are null."""
    if isinstance(kind, T.IntegralType):
        return x.cast("bigint")
    text = x if isinstance(kind, T.StringType) else x.cast("string")
    value = _number(text)
    via_double = F.when(value == F.floor(value), value.try_cast("bigint"))
    # digits are cast directly, exact for keys beyond 2**53
    return F.when(text.rlike(WHOLE), F.trim(text).cast("bigint")).otherwise(via_double)


def norm_text(x: Column, default: str = "") -> Column:
    return F.coalesce(x.cast("string"), F.lit(default))


def norm_int(x: Column, default: int = -1) -> Column:
    return F.coalesce(x.cast("int"), F.lit(default))
