"""Reporting queries over the wide table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.sources.files import MONTH


@dataclass(frozen=True)
class Filter:
    """Optional limits; one that is not set leaves no trace in the plan."""

    date_from: date | None = None
    date_to: date | None = None  # inclusive
    channels: Sequence[str] | None = None
    categories: Sequence[str] | None = None

    def apply(self, obt: DataFrame) -> DataFrame:
        tests = []
        if self.date_from is not None:
            tests.append(F.col("order_date") >= F.lit(self.date_from))
        if self.date_to is not None:
            tests.append(F.col("order_date") <= F.lit(self.date_to))
        if self.channels is not None:
            tests.append(F.col("channel").isin(list(self.channels)))
        if self.categories is not None:
            tests.append(F.col("category").isin(list(self.categories)))
        if MONTH in obt.columns:
            # The table is kept by month: name the months so that others are not opened.
            if self.date_from is not None:
                tests.append(F.col(MONTH) >= f"{self.date_from:%Y-%m}")
            if self.date_to is not None:
                tests.append(F.col(MONTH) <= f"{self.date_to:%Y-%m}")
        return obt.where(reduce(and_, tests)) if tests else obt


EVERYTHING = Filter()


def last_days(as_of: date, days: int = 30, **limits) -> Filter:
    """The ``days`` days before ``as_of``, that day excluded."""
    return Filter(as_of - timedelta(days=days), as_of - timedelta(days=1), **limits)


def _sum(name: str) -> Column:
    return F.round(F.sum(name), 2).cast("decimal(38,2)")


def _revenue_by(obt: DataFrame, f: Filter, *keys: str) -> DataFrame:
    return f.apply(obt).groupBy(*keys).agg(_sum("net_revenue").alias("revenue"))


def kpi_revenue(obt: DataFrame, f: Filter = EVERYTHING) -> DataFrame:
    return f.apply(obt).agg(_sum("net_revenue").alias("total_revenue"))


def kpi_orders(obt: DataFrame, f: Filter = EVERYTHING) -> DataFrame:
    return f.apply(obt).agg(F.countDistinct("order_id").alias("total_orders"))


def kpi_aov(obt: DataFrame, f: Filter = EVERYTHING) -> DataFrame:
    """Revenue per distinct order; null when there is none."""
    per_order = F.sum("net_revenue").cast("double") / F.nullif(
        F.countDistinct("order_id"), F.lit(0)
    )
    return f.apply(obt).agg(F.round(per_order, 2).alias("average_order_value"))


def daily_revenue(obt: DataFrame, f: Filter = EVERYTHING) -> DataFrame:
    return _revenue_by(obt, f, "order_date").orderBy(F.col("order_date").asc_nulls_last())


def revenue_by_channel(obt: DataFrame, f: Filter = EVERYTHING) -> DataFrame:
    return _revenue_by(obt, f, "channel").orderBy(F.desc("revenue"), "channel")


def revenue_by_category(obt: DataFrame, f: Filter = EVERYTHING) -> DataFrame:
    return _revenue_by(obt, f, "category").orderBy(F.desc("revenue"), "category")


def top_products(obt: DataFrame, f: Filter = EVERYTHING, n: int = 10) -> DataFrame:
    return _revenue_by(obt, f, "product_name").orderBy(F.desc("revenue"), "product_name").limit(n)


def margin_by_product(obt: DataFrame, f: Filter = EVERYTHING, n: int = 15) -> DataFrame:
    """Products by profit, with the unweighted mean margin of their lines."""
    return (
        f.apply(obt)
        .groupBy("product_name", "category")
        .agg(
            F.round(F.avg("profit_margin_pct"), 2).alias("avg_margin_pct"),
            _sum("gross_profit").alias("total_profit"),
        )
        .orderBy(F.desc("total_profit"), "product_name", "category")
        .limit(n)
    )


def revenue_by_cohort(obt: DataFrame, f: Filter = EVERYTHING) -> DataFrame:
    return _revenue_by(obt.where(F.col("cohort").isNotNull()), f, "cohort").orderBy("cohort")


def _customers_by(obt: DataFrame, f: Filter, *keys: str) -> DataFrame:
    known = f.apply(obt).where(F.col(keys[0]).isNotNull())
    counts = known.groupBy(*keys).agg(F.countDistinct("customer_id").alias("customers"))
    return counts.orderBy(F.desc("customers"), *keys)


def value_segments(obt: DataFrame, f: Filter = EVERYTHING) -> DataFrame:
    return _customers_by(obt, f, "value_segment")


def recency_frequency(obt: DataFrame, f: Filter = EVERYTHING) -> DataFrame:
    return _customers_by(obt, f, "recency_segment", "frequency_segment")


def top_customers(obt: DataFrame, f: Filter = EVERYTHING, n: int = 10) -> DataFrame:
    """Customers by lifetime value. A missing name part leaves the whole name null."""
    name = F.concat("first_name", F.lit(" "), "last_name").alias("customer_name")
    return (
        f.apply(obt)
        .groupBy("customer_id", name, "email")
        .agg(_sum("net_revenue").alias("lifetime_value"))
        .orderBy(F.col("lifetime_value").desc_nulls_last(), F.col("customer_id").asc_nulls_last())
        .limit(n)
    )
