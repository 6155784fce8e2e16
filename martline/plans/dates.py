"""Date dimension, retail events and seasonality (H1-H5)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.functions import calendar as cal

SPINE_START = date(2022, 1, 1)
SPINE_END = date(2026, 12, 31)


def date_spine(spark: SparkSession, start: date = SPINE_START, end: date = SPINE_END) -> DataFrame:
    """One row per day from ``start`` to ``end``."""
    days = spark.range((end - start).days + 1)
    return days.select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date_actual"))


def spine_of(rows: DataFrame, *columns: str) -> DataFrame:
    """One row per day from the first to the last date found in ``columns``."""
    span = rows.agg(
        F.least(*[F.min(c) for c in columns], F.lit(None).cast("date")).alias("first"),
        F.greatest(*[F.max(c) for c in columns], F.lit(None).cast("date")).alias("last"),
    ).where(F.col("first").isNotNull())
    return span.select(F.explode(F.sequence("first", "last")).alias("date_actual"))


def dim_date(spine: DataFrame) -> DataFrame:
    """Calendar attributes per day; the fiscal year is the calendar year."""
    d = F.col("date_actual")
    weekday = F.dayofweek(d) - 1
    holiday = cal.holiday_name(d)
    return spine.select(
        cal.date_key(d).alias("date_sk"),
        "date_actual",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_label"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_name_short"),
        F.month(d).alias("month_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "EEE").alias("day_name_short"),
        weekday.isin(0, 6).cast("int").alias("is_weekend"),
        F.year(d).alias("fiscal_year"),
        F.quarter(d).alias("fiscal_quarter"),
        F.trunc(d, "MM").alias("month_start_date"),
        F.trunc(d, "yyyy").alias("year_start_date"),
        F.trunc(d, "MM").alias("first_day_of_month"),
        F.last_day(d).alias("last_day_of_month"),
        cal.season(d).alias("season"),
        holiday.alias("holiday_name"),
        holiday.isNotNull().cast("int").alias("is_holiday"),
    )


def retail_events(spine: DataFrame) -> DataFrame:
    """Black Friday and Cyber Monday of each year in the spine."""
    years = spine.select(F.make_date(F.year("date_actual"), F.lit(1), F.lit(1)).alias("d")).distinct()
    friday, monday = cal.fourth_friday(F.col("d")), cal.cyber_monday(F.col("d"))
    events = F.array(
        F.struct(F.lit("Black Friday").alias("event_name"), friday.alias("event_date")),
        F.struct(F.lit("Cyber Monday").alias("event_name"), monday.alias("event_date")),
    )
    return years.select(F.year("d").alias("year"), F.explode(events).alias("e")).select("year", "e.*")


def seasonality_index(df: DataFrame, date_col: str) -> DataFrame:
    """Add ``seasonality_index`` for the date in ``date_col``."""
    return df.withColumn("seasonality_index", cal.seasonality_index(F.col(date_col)))
