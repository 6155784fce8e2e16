"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedupe_latest(
    df: DataFrame, keys: Sequence[str], latest: str, tie_breakers: Sequence[str] = ()
) -> DataFrame:
    """Row with the greatest ``latest`` per key; ties go to the smallest tie-breakers.

    Spark pushes the rank limit below the shuffle, so each task sends at most one
    row per key: a key that holds much of the data is cut down before it moves.
    """
    order = [F.col(latest).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_breakers]]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
