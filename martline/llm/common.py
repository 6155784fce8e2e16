"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: a word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def free_name(df: DataFrame, name: str, *others: DataFrame) -> str:
    """``name``, with underscores added until no column of the frames has it."""
    taken = {c.lower() for d in (df, *others) for c in d.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """The column of that very name, dots and all."""
    return F.col(quoted(name))


def two_hashes(*columns: Column) -> tuple[Column, Column]:
    """128 bits from two differently seeded 64-bit hashes."""
    return F.xxhash64(*columns), F.xxhash64(F.lit(0x5EED), *columns)


def whole(text: Column) -> Column:
    """A null text is an empty one."""
    return F.coalesce(text, F.lit(""))
