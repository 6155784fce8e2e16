"""Stored history that takes changes only.

A run appends one part: the versions it opens and, for each version it closes, a row
with that version's id and end. Versions that stay as they are, open or closed, are not
written again. Reading joins ends to versions by id; merges of parts do the same for
what they hold, so few ends stay apart. A run that is repeated replaces its own part.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.operators.history import META, first_versions
from martline.sources import parts

_HASH, _ENDS = "_row_hash", "_ends"


def row_hash(tracked: Sequence[str]) -> Column:
    """128 bits of the tracked columns; nulls differ from every text."""
    return F.md5(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in tracked]), {"ignoreNullFields": "false"}))


def _settled(rows: DataFrame) -> DataFrame:
    """Versions with the ends that ``rows`` hold for them; ends of other versions are kept as rows."""
    columns = rows.columns
    ends = rows.where(_ENDS).select(F.col("version_id").alias("_id"), F.col("valid_to").alias("_end"))
    met = rows.where(~F.col(_ENDS)).join(ends, F.col("version_id") == F.col("_id"), "left")
    versions = met.withColumn("valid_to", F.coalesce("_end", "valid_to")).select(*columns)
    known = rows.where(~F.col(_ENDS)).select(F.col("version_id").alias("_id"))
    others = rows.where(_ENDS).join(known, F.col("version_id") == F.col("_id"), "left_anti")
    return versions.unionByName(others.select(*columns))


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All versions, the last columns being ``META``."""
    rows = _settled(parts.read_parts(spark, path)).where(~F.col(_ENDS)).drop(_HASH, _ENDS)
    return rows.select(*[c for c in rows.columns if c not in META], *META)


def _check_unique(current: DataFrame, key: str) -> None:
    again = current.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1").first()
    if again:
        raise ValueError(f"{key} is not unique: {again[0]}")


def changes(
    stored: DataFrame, current: DataFrame, key: str, tracked: Sequence[str], run_ts: datetime, *, invalidate_deletes: bool = False
) -> DataFrame:
    """Rows to append: new versions of ``current``, and ends of the open versions they replace.

    ``stored`` is read for keys, ids, ends and hashes only. One full join of these
    narrow rows with the current ones finds what has changed.
    """
    narrow = _settled(stored.select(key, "version_id", "valid_to", _HASH, _ENDS))
    still_open = narrow.where(~F.col(_ENDS) & F.col("valid_to").isNull()).select(
        F.col(key).alias("_key"), F.col("version_id").alias("_old_id"), F.col(_HASH).alias("_old_hash"))
    fresh = first_versions(current, key, run_ts).withColumn(_HASH, row_hash(tracked))
    pairs = fresh.join(still_open, F.col(key) == F.col("_key"), "full")
    seen, known = F.col(key).isNotNull(), F.col("_key").isNotNull()
    changed = ~F.col(_HASH).eqNullSafe(F.col("_old_hash"))
    opens = seen & (~known | changed)
    ends = known & (seen & changed | (~seen if invalidate_deletes else F.lit(False)))
    columns = fresh.columns
    new = F.struct(*[F.col(c) for c in columns], F.lit(False).alias(_ENDS))
    empty = {f.name: F.lit(None).cast(f.dataType) for f in fresh.schema}
    moment = F.lit(run_ts.isoformat(" ")).cast("timestamp")
    end_row = empty | {key: F.col("_key"), "version_id": F.col("_old_id"), "valid_to": moment}
    end = F.struct(*[end_row[c].alias(c) for c in columns], F.lit(True).alias(_ENDS))
    rows = F.array_compact(F.array(F.when(opens, new), F.when(ends, end)))
    return pairs.where(opens | ends).select(F.explode(rows).alias("v")).select("v.*")


def snapshot(
    current: DataFrame, key: str, tracked: Sequence[str], path: str, run_ts: datetime, *, invalidate_deletes: bool = False
) -> DataFrame:
    """Bring the history at ``path`` up to ``current`` and return it.

    A change in any ``tracked`` column ends the open version at ``run_ts`` and opens a
    new one. Keys missing from ``current`` stay open unless ``invalidate_deletes``.
    Columns that only one side has are kept and filled with null. A key that
    ``current`` holds twice raises an error before anything is written.
    """
    spark = current.sparkSession
    _check_unique(current, key)
    name = run_ts.strftime("%Y%m%dT%H%M%S%f")
    fresh = first_versions(current, key, run_ts).schema
    parts.create(spark, path, T.StructType([*fresh.fields, T.StructField(_HASH, T.StringType()), T.StructField(_ENDS, T.BooleanType())]))
    parts.widen(spark, path, fresh)
    parts.merge_parts(spark, path, skip=[name], combine=_settled)
    stored = parts.read_parts(spark, path, skip=[name])
    parts.write_part(changes(stored, current, key, tracked, run_ts, invalidate_deletes=invalidate_deletes), path, name)
    return read_history(spark, path)
