"""Forgiving casts: a value that does not parse becomes null.

Each helper looks at the column's type first, so a typed column is not turned
into text and parsed again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# A day, alone or with a time of day and a zone after it.
_DAY = (
    r"^\s*(\d{1,7}-\d{1,2}-\d{1,2})"
    r"(?:[ T](?:[01]?\d|2[0-3]):[0-5]?\d(?::[0-5]?\d(?:\.\d{1,9})?)?\s*(?:Z|UTC|[+-]\d{2}(?::?\d{2})?)?)?\s*$"
)


def text_of(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    return c if isinstance(df.schema[name].dataType, T.StringType) else c.cast("string")


def int_of(df: DataFrame, name: str) -> Column:
    """Integer value; text is rounded half away from zero, floating point half to even."""
    c, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.IntegerType):
        return c
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.rint(c).try_cast("int")
    if isinstance(kind, T.StringType):
        c = c.try_cast("decimal(38,18)")  # wide enough not to round before the half is judged
    if isinstance(kind, (T.StringType, T.DecimalType)):
        c = F.round(c, 0)
    return c.try_cast("int")


def decimal_of(df: DataFrame, name: str, precision: int = 10, scale: int = 2) -> Column:
    """Decimal value, rounded half away from zero."""
    c, kind = F.col(name), df.schema[name].dataType
    target = T.DecimalType(precision, scale)
    if kind == target:
        return c
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        # Scale in binary first: 1.005 is stored just below the half and rounds down.
        unit = F.lit(f"1e-{scale}").cast(T.DecimalType(scale + 1, scale))
        whole = F.round(c * (10**scale), 0).try_cast(T.DecimalType(18, 0))
        return (whole * unit).try_cast(target)
    return c.try_cast(target)


def date_of(df: DataFrame, name: str) -> Column:
    """Date value; text needs year, month and day, a bare year is not a date."""
    c, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return c
    if isinstance(kind, T.StringType):
        dashed = F.translate(c, "/", "-")
        return F.when(dashed.rlike(_DAY), F.regexp_extract(dashed, _DAY, 1).try_cast("date"))
    return c.try_cast("date")
