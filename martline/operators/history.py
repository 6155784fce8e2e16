"""Slowly changing history, type 2."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martline.functions.keys import hash_key

META = ["valid_from", "valid_to", "version_id", "updated_at"]


def _moment(run_ts: datetime) -> Column:
    # As text, so the session time zone applies and not the driver machine's.
    return F.lit(run_ts.isoformat(" ")).cast("timestamp")


def first_versions(current: DataFrame, key: str, run_ts: datetime) -> DataFrame:
    """Every row of ``current`` as an open version starting at ``run_ts``."""
    ts = _moment(run_ts)
    return current.where(F.col(key).isNotNull()).select(
        "*",
        ts.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        hash_key(F.col(key), ts).alias("version_id"),
        ts.alias("updated_at"),
    )


def scd2_merge(
    history: DataFrame | None,
    current: DataFrame,
    key: str,
    tracked: Sequence[str],
    run_ts: datetime,
    *,
    invalidate_deletes: bool = False,
) -> DataFrame:
    """History after comparing ``current`` with its open versions.

    A change in any ``tracked`` column (null-safe) closes the open version at
    ``run_ts`` and opens a new one; a change elsewhere is ignored. Closing sets
    ``valid_to`` alone. Keys missing from ``current`` stay open unless
    ``invalidate_deletes``. Columns that only one side has are kept and filled with
    null. A key that ``current`` holds more than once raises an error when the
    result is read: which of its rows is the newest cannot be told. One full join
    of open versions with current rows yields both the closed and the new rows;
    closed versions pass through untouched.
    """
    fresh = first_versions(_one_per_key(current, key), key, run_ts)
    if history is None:
        return fresh
    history = _with_columns(history, fresh.drop(*META))
    columns = history.columns
    fresh = _with_columns(fresh, history)
    is_open = F.col("valid_to").isNull()
    old = history.where(is_open).select(F.col(key).alias("_key"), F.struct(*columns).alias("old"))
    new = fresh.select(F.col(key).alias("_key"), F.struct(*columns).alias("new"))
    pairs = old.join(new, "_key", "full")

    same = F.lit(True)
    for name in tracked:
        same = same & F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}"))
    known, seen = F.col("old").isNotNull(), F.col("new").isNotNull()
    ends = known & seen & ~same
    if invalidate_deletes:
        ends = ends | (known & ~seen)
    run = _moment(run_ts)
    closed = F.col("old").withField("valid_to", run)
    versions = F.array_compact(
        F.array(
            F.when(known, F.when(ends, closed).otherwise(F.col("old"))),
            F.when(seen & (~known | ~same), F.col("new")),
        )
    )
    merged = pairs.select(F.explode(versions).alias("v")).select("v.*")
    return history.where(~is_open).unionByName(merged)


def _with_columns(df: DataFrame, other: DataFrame) -> DataFrame:
    """``df`` with the columns it lacks of ``other``, null, before its own META columns."""
    lacking = [F.lit(None).cast(f.dataType).alias(f.name) for f in other.schema if f.name not in df.columns]
    own = [c for c in df.columns if c not in META]
    return df.select(*own, *lacking, *[c for c in META if c in df.columns]) if lacking else df


def _one_per_key(current: DataFrame, key: str) -> DataFrame:
    """``current``, with an error instead of a row that repeats a key."""
    nth = F.row_number().over(Window.partitionBy(key).orderBy(key))
    message = F.concat(F.lit(f"{key} is not unique: "), F.col(key).cast("string"))
    once = F.when(F.col("_nth") > 1, F.raise_error(message).cast("boolean")).otherwise(True)
    return current.where(F.col(key).isNotNull()).withColumn("_nth", nth).where(once).drop("_nth")


def current_rows(history: DataFrame) -> DataFrame:
    """The open version of each key."""
    return history.where(F.col("valid_to").isNull())


def scd2_overlaps(history: DataFrame, key: str, *, strict: bool = False) -> DataFrame:
    """Versions that begin before the previous one.

    Sorted by start this never happens, so the default check always passes.
    ``strict=True`` finds versions that begin before the previous one *ends*,
    a previous version without an end included.
    """
    w = Window.partitionBy(key).orderBy(
        F.col("valid_from").asc_nulls_last(), F.col("valid_to").asc_nulls_last()
    )
    checked = history.select(
        key,
        "valid_from",
        "valid_to",
        F.lag("valid_from").over(w).alias("prev_valid_from"),
        F.lag("valid_to").over(w).alias("prev_valid_to"),
    )
    follows = F.col("prev_valid_from").isNotNull()
    if strict:
        open_end = F.col("prev_valid_to").isNull()
        return checked.where(follows & (open_end | (F.col("valid_from") < F.col("prev_valid_to"))))
    return checked.where(follows & (F.col("valid_from") < F.col("prev_valid_from"))).drop(
        "prev_valid_to"
    )
