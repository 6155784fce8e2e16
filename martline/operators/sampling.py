"""Repeatable assignment and planted defects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS = 1_000_000


def _pick(position: Column, weights: Mapping[str, float]) -> Column:
    total, passed, choice = sum(weights.values()), 0.0, None
    for name, weight in weights.items():
        passed += weight
        below = position < round(passed / total * STEPS)
        choice = F.when(below, name) if choice is None else choice.when(below, name)
    return choice


def assign_weighted(
    df: DataFrame,
    key: str,
    weights: Mapping,
    *,
    name: str,
    by: str | None = None,
    position: Column | None = None,
) -> DataFrame:
    """Give each row a category so that shares follow ``weights``.

    The choice depends on ``key`` alone, so it is the same in every run and for
    every row of a key. With ``by``, ``weights`` maps each value of that column to
    its own weights. ``position`` replaces the hash of the key, the first eight hex
    digits of its MD5, by another number in [0, 1,000,000).
    """
    if position is None:
        # The name goes into the hash: two assignments by one key are independent.
        digits = F.substring(F.md5(F.concat_ws("|", F.lit(name), F.col(key).cast("string"))), 1, 8)
        position = F.conv(digits, 16, 10).cast("bigint") % STEPS
    if by is None:
        return df.withColumn(name, _pick(position, weights))
    choice = F.lit(None).cast("string")
    for group, group_weights in weights.items():
        choice = F.when(F.col(by) == group, _pick(position, group_weights)).otherwise(choice)
    return df.withColumn(name, choice)


def inject_defects(sales: DataFrame, keys: Sequence[str], far_future: date = date(2099, 1, 1)) -> DataFrame:
    """``sales`` plus five copies of picked rows with one planted defect each.

    Missing customer, quantity -3, an order date far ahead, an exact duplicate,
    and price and discount zero. The rows picked are the first five by the hash
    of ``keys``, so the pick does not depend on how the data is partitioned.
    """
    rest = [c for c in sales.columns if c not in keys]
    order = [F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))]
    order += [F.col(c).asc_nulls_last() for c in [*keys, *rest]]
    kind = {f.name: f.dataType for f in sales.schema}
    columns = sales.columns
    # Five rows: one array holds them, numbered by their place.
    picked = sales.orderBy(*order).limit(5).agg(
        F.array_sort(F.collect_list(F.struct(order[0].alias("_h"), F.struct(*columns).alias("row")))).alias("rows")
    ).select(F.posexplode("rows").alias("n", "p")).select("n", "p.row.*")
    planted = {
        "customer_id": (0, F.lit(None)),
        "quantity": (1, F.lit(-3)),
        "order_date": (2, F.lit(far_future)),
        "unit_price": (4, F.lit(0)),
        "discount_amount": (4, F.lit(0)),
    }
    for column, (n, value) in planted.items():
        bad = F.when(F.col("n") == n, value.cast(kind[column]))
        picked = picked.withColumn(column, bad.otherwise(F.col(column)))
    return sales.unionByName(picked.select(*columns))
