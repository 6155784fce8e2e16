"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def key_text(*columns: str | Column) -> Column:
    """The values joined by ``|``; a null counts as empty text."""
    parts = []
    for c in columns:
        value = F.col(c) if isinstance(c, str) else c
        parts.append(F.coalesce(value.cast("string"), F.lit("")))
    return parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)


def hash_key(*columns: str | Column) -> Column:
    """MD5 hex of the key text."""
    return F.md5(key_text(*columns))


def is_blank(c: Column) -> Column:
    """True for null and for text of spaces only."""
    return c.isNull() | (F.trim(c.cast("string")) == "")


def set_aside(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``df`` without the text ``key`` where that is the hash of ``columns``, for a shuffle.

    Hashes do not compress, so a moved row is shorter without them. ``put_back`` restores
    the key from the same columns; a key that is no such hash is carried as it is.
    """
    if key not in df.columns or not isinstance(df.schema[key].dataType, T.StringType):
        return df
    own = F.col(key).eqNullSafe(hash_key(*columns))
    return df.withColumns({f"_own_{key}": own, f"_odd_{key}": F.when(~own, F.col(key))}).drop(key)


def put_back(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``df`` with the ``key`` that ``set_aside`` took; null where a left join found no row."""
    if f"_own_{key}" not in df.columns:
        return df
    value = F.when(F.col(f"_own_{key}"), hash_key(*columns)).otherwise(F.col(f"_odd_{key}"))
    return df.withColumn(key, value).drop(f"_own_{key}", f"_odd_{key}")


@dataclass(frozen=True)
class Derived:
    """Columns that usually are what the SQL expressions ``texts`` make of the columns ``inputs`` of their row."""

    texts: Mapping[str, str]
    inputs: Sequence[str]

    def values(self) -> dict[str, Column]:
        return {name: F.expr(text) for name, text in self.texts.items()}


def set_aside_values(df: DataFrame, derived: Derived) -> DataFrame:
    """``df`` without the derived columns of rows where they are as derived, for a shuffle or a stage.

    ``put_back_values`` makes them again from their inputs; a row in which one differs
    carries them all. A frame that lacks a column, or has one of another type, stays as it is.
    """
    values = derived.values()
    if not {*values, *derived.inputs} <= set(df.columns):
        return df
    made = df.select(*[c.alias(name) for name, c in values.items()]).schema
    if any(df.schema[f.name].dataType != f.dataType for f in made):
        return df
    own = reduce(and_, [F.col(name).eqNullSafe(c) for name, c in values.items()])
    return df.withColumns({"_own_values": own, "_odd_values": F.when(~own, F.struct(*values))}).drop(*values)


def as_derived(df: DataFrame, derived: Derived) -> DataFrame:
    """What ``set_aside_values`` makes of ``df`` with the derived columns added to it; they are not computed for that."""
    kind = df.select(*[c.alias(name) for name, c in derived.values().items()]).schema
    return df.withColumns({"_own_values": F.lit(True), "_odd_values": F.lit(None).cast(kind)})


def put_back_values(df: DataFrame, derived: Derived) -> DataFrame:
    """``df`` with the columns that ``set_aside_values`` took."""
    if "_own_values" not in df.columns:
        return df
    back = {n: F.when(F.col("_own_values"), c).otherwise(F.col(f"_odd_values.{n}")) for n, c in derived.values().items()}
    return df.withColumns(back).drop("_own_values", "_odd_values")


def held_key(df: DataFrame, key: str, columns: Sequence[str]) -> list[str]:
    """The columns of ``df`` that tell ``key``: itself, or what ``set_aside`` has left and made it of."""
    return [key] if key in df.columns else [*columns, f"_own_{key}", f"_odd_{key}"]


def packed_key(df: DataFrame, key: str, columns: Sequence[str]) -> Column:
    """``packed`` of the text ``key``, also where ``set_aside`` took it from ``df``; it is then hashed once and not looked at again."""
    if key in df.columns:
        return packed(F.col(key))
    hashed = F.concat(F.lit(bytearray(b"\x01")), F.unhex(hash_key(*columns)))
    return F.when(F.col(f"_own_{key}"), hashed).otherwise(packed(F.col(f"_odd_{key}")))


def packed(c: Column) -> Column:
    """Text as bytes that are equal where the texts are; an MD5 in hex takes 17 of them."""
    raw = F.unhex(c)
    is_hash = (F.length(c) == 32) & F.lower(F.hex(raw)).eqNullSafe(c)
    text = F.concat(F.lit(bytearray(b"\x00")), c.cast("binary"))
    return F.when(is_hash, F.concat(F.lit(bytearray(b"\x01")), raw)).when(c.isNotNull(), text)
