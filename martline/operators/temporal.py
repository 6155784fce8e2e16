"""Which products can be sold on which day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def is_sellable(day: Column, launch: str = "launch_date", gone: str = "discontinued_date") -> Column:
    """Launched on or before ``day`` and not yet discontinued on it."""
    return (F.col(launch) <= day) & (F.col(gone).isNull() | (F.col(gone) > day))


def _sellable_span(products: DataFrame, first: Column, last: Column) -> DataFrame:
    start = F.greatest(F.col("launch_date"), first)
    end = F.least(F.date_sub("discontinued_date", 1), last)
    return products.where(F.col("launch_date").isNotNull()).select(
        "*", start.alias("_start"), end.alias("_end")
    ).where("_start <= _end")


def available_on(products: DataFrame, days: DataFrame, day: str = "date_actual") -> DataFrame:
    """One row per product and day of ``days`` on which it is sellable.

    Each product lists its own days between its launch and its end, clipped to
    the span of ``days``, so no products are paired with days that do not match
    and nothing but the day list itself is joined.
    """
    first, last = days.agg(F.min(day)).scalar(), days.agg(F.max(day)).scalar()
    listed = (
        _sellable_span(products, first, last)
        .withColumn(day, F.explode(F.sequence("_start", "_end")))
        .drop("_start", "_end")
    )
    return listed.join(days.select(day).distinct(), day, "left_semi")


def availability_per_product(products: DataFrame, days: DataFrame, key: str = "product_id", day: str = "date_actual") -> DataFrame:
    """Rows that ``available_on`` has per ``key``, and their first and last day, without listing them.

    The days are numbered on a calendar from the first to the last of them, so each
    product looks up two dates, its first and its last sellable one, however many days
    lie between. The calendar has one row per date.
    """
    listed = days.where(F.col(day).isNotNull()).select(F.col(day).alias("_day")).distinct()
    span = listed.agg(F.min("_day").alias("_from"), F.max("_day").alias("_to"))
    calendar = span.where("_from IS NOT NULL").select(F.explode(F.sequence("_from", "_to")).alias("_date"))
    # One task: at most one row per calendar date.
    until = Window.orderBy("_date").rowsBetween(Window.unboundedPreceding, 0)
    onward = Window.orderBy("_date").rowsBetween(0, Window.unboundedFollowing)
    numbered = calendar.join(listed, F.col("_date") == F.col("_day"), "left").select(
        "_date", F.count("_day").over(until).alias("_upto"), F.count("_day").over(onward).alias("_onward"),
        F.min("_day").over(onward).alias("_next"), F.max("_day").over(until).alias("_previous"),
    )
    starts = numbered.select(F.col("_date").alias("_start"), "_onward", "_next")
    ends = numbered.select(F.col("_date").alias("_end"), "_upto", "_previous")
    first, last = days.agg(F.min(day)).scalar(), days.agg(F.max(day)).scalar()
    spans = _sellable_span(products, first, last).select(key, "_start", "_end")
    met = spans.join(F.broadcast(starts), "_start").join(F.broadcast(ends), "_end").crossJoin(F.broadcast(listed.agg(F.count("*").alias("_all"))))
    here = F.col("_upto") + F.col("_onward") - F.col("_all")  # days up to the end and days from the start on overlap in these
    return met.withColumn("_n", here).where("_n > 0").groupBy(key).agg(
        F.sum("_n").alias("days"), F.min("_next").alias("first_day"), F.max("_previous").alias("last_day")
    )


def availability_counts(products: DataFrame, first: date | Column, last: date | Column) -> DataFrame:
    """Number of sellable products per day on which that number changes.

    Every product adds one at its first day and takes one off after its last;
    summing these per day leaves at most one row per calendar day to accumulate.
    """
    first, last = (F.lit(d) if isinstance(d, date) else d for d in (first, last))
    changes = _sellable_span(products, first, last).select(
        F.explode(
            F.array(
                F.struct(F.col("_start").alias("date_actual"), F.lit(1).alias("change")),
                F.struct(F.date_add("_end", 1).alias("date_actual"), F.lit(-1).alias("change")),
            )
        ).alias("c")
    )
    per_day = changes.groupBy("c.date_actual").agg(F.sum("c.change").alias("change"))
    running = Window.orderBy("date_actual").rowsBetween(Window.unboundedPreceding, 0)
    return per_day.select("date_actual", F.sum("change").over(running).alias("products"))
