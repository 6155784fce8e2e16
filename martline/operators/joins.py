"""Joins that hold when one key has much of the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.sources.staging import stage

_SIZE_UNITS = {"b": 1, "k": 2**10, "kb": 2**10, "m": 2**20, "mb": 2**20, "g": 2**30, "gb": 2**30}


def broadcast_limit(df: DataFrame) -> int:
    """The session's automatic broadcast limit in bytes (0 when switched off)."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    digits = text.rstrip("bkmg")
    return max(0, int(digits) * _SIZE_UNITS.get(text[len(digits):] or "b", 1))


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimised plan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


#: Buckets of keys per task, for counting which keys may be hot.
_BUCKETS = 64


def input_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of what the plan reads, which no join multiplies."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def hot_keys(df: DataFrame, key: str, pieces: int | None = None) -> DataFrame:
    """Keys with more rows than one average task holds, and how many tasks they need.

    With N rows over P tasks a key is hot above N/P rows, so there are at most P
    hot keys and their ``_salts`` add up to at most 2P.
    """
    p = pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.where(F.col(key).isNotNull()).select(key)
    counts = keyed.groupBy(key).agg(F.count("*").alias("_n"))
    per_task = F.greatest(keyed.agg(F.count("*")).scalar() / F.lit(p), F.lit(1.0))
    return counts.where(F.col("_n") > per_task).select(
        key, F.ceil(F.col("_n") / per_task).cast("int").alias("_salts")
    )


def staged_hot_keys(df: DataFrame, keys: Sequence[str], pieces: int | None = None) -> dict[str, DataFrame]:
    """``hot_keys`` of several columns, written so that joins read a small table.

    Both sides of a salted join, and both joins of a step, read what was counted
    once; at most P rows per column are stored. Buckets of keys are counted first, of which
    each task sends one row; only keys of buckets above the limit, at most P per column, are
    counted by key, in a second scan of ``df`` that is left out where there are none.
    """
    p = pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = F.explode(F.array(*[F.struct(F.lit(k).alias("_of"), F.col(k).cast("string").alias("_key")) for k in keys]))
    bucket = F.pmod(F.xxhash64("_key"), F.lit(_BUCKETS * p)).alias("_bucket")
    held = df.select(named.alias("_x")).select("_x.*").where("_key IS NOT NULL").select("*", bucket)
    sums = stage(held.groupBy("_of", "_bucket").agg(F.count("*").alias("_n")), "key-buckets")
    totals = sums.groupBy(F.col("_of").alias("_total_of")).agg(F.greatest(F.sum("_n") / p, F.lit(1.0)).alias("_per_task"))
    # One row per column name.
    limit = F.broadcast(totals)
    full = sums.join(limit, F.col("_of") == F.col("_total_of")).where(F.col("_n") > F.col("_per_task"))
    found = {(r["_of"], r["_bucket"]): r["_per_task"] for r in full.collect()}  # at most P rows per column
    if found:
        suspects = df.sparkSession.createDataFrame([(*at, n) for at, n in found.items()], "_of string, _bucket bigint, _per_task double")
        counts = held.join(F.broadcast(suspects), ["_of", "_bucket"]).groupBy("_of", "_key", "_per_task").agg(F.count("*").alias("_n"))
        met = counts.where(F.col("_n") > F.col("_per_task"))
        hot = stage(met.select("_of", "_key", F.ceil(F.col("_n") / F.col("_per_task")).cast("int").alias("_salts")), "hot-keys")
    else:
        hot = df.sparkSession.createDataFrame([], "_of string, _key string, _salts int")
    return {k: hot.where(F.col("_of") == k).select(F.col("_key").cast(df.schema[k].dataType).alias(k), "_salts") for k in keys}


def hot_keys_for(df: DataFrame, dimensions: Mapping[str, DataFrame]) -> dict[str, DataFrame | None]:
    """``staged_hot_keys`` for the keys whose dimension is too large to be broadcast; None, and no scan, for the others."""
    limit = broadcast_limit(df)
    large = [key for key, dimension in dimensions.items() if estimated_bytes(dimension) > limit]
    counted = staged_hot_keys(df, large) if large else {}
    return {key: counted.get(key) for key in dimensions}


def left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: str | Sequence[str],
    *,
    hot: DataFrame | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Left equi-join that splits the ``hot`` keys of ``left`` (see ``hot_keys``).

    A right side whose estimated size is within the broadcast limit is left to
    Catalyst, which broadcasts it. Otherwise each hot key is cut into as many
    parts as it needs: left rows take a part by the hash of ``spread_by`` and
    only the right rows of hot keys are repeated per part. Left rows without a
    key match nothing and are spread the same way. Count ``hot`` on a written
    table: the join reads it for both sides. Without it the join is a plain one
    and relies on the adaptive skew split.
    """
    small = estimated_bytes(right) <= (broadcast_limit(left) if limit is None else limit)
    if small or hot is None:
        return left.join(right, key, "left")
    pieces = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot)
    salts = F.when(F.col(key).isNull(), pieces).otherwise(F.coalesce("_salts", F.lit(1)))
    salted_left = left.join(hot, key, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*([spread_by] if isinstance(spread_by, str) else spread_by)), salts).cast("int")
    )
    salted_right = right.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    )
    joined = salted_left.drop("_salts").join(salted_right.drop("_salts"), [key, "_salt"], "left")
    return joined.drop("_salt")


def as_often_as_joined(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left`` with each row as often as a left join with ``right`` returns it, without the columns of ``right``.

    Only the keys that ``right`` repeats are joined; they are written first, so that the
    join knows how few there are and the rows of ``left`` need not be moved.
    """
    counts = right.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_times"))
    met = left.join(stage(counts.where("_times > 1"), "repeated-keys"), key, "left")
    copies = met.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.coalesce("_times", F.lit(1)))))
    return copies.select(*left.columns)


def orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Distinct values of ``key`` in ``fact`` without a match in ``dim``; null counts as one."""
    parents = dim.select(F.col(dim_key or key).alias(key))
    return fact.select(key).distinct().join(parents, key, "left_anti")


def orphan_rows(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Rows of ``fact`` whose ``key`` has no match in ``dim``, null keys included.

    Keys are made distinct first, so the wide fact rows only meet the few keys
    that failed.
    """
    missing = orphans(fact, dim, key).where(F.col(key).isNotNull())
    unmatched = fact.join(missing, key, "left_semi")
    return unmatched.unionByName(fact.where(F.col(key).isNull()))


def missing_days(
    fact: DataFrame, dim_date: DataFrame, day: str = "order_date"
) -> DataFrame:
    """Calendar days between the first and last day of ``fact`` that have no row."""
    days = fact.where(F.col(day).isNotNull()).groupBy(day).agg(F.count("*").alias("_n"))
    span = dim_date.where(
        F.col("date_actual").between(days.agg(F.min(day)).scalar(), days.agg(F.max(day)).scalar())
    )
    return span.join(days, span["date_actual"] == days[day], "left_anti").select(
        "date_actual", F.lit(0).cast("bigint").alias("sale_count")
    )
