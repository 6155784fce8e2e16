"""Live figures of the event table or stream.

The ingest writes partial figures per store with every batch. Merging them on read
gives the figures of the whole table without reading its events, so a refresh costs
the same however long the table gets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.sources import parts

STORE = ["store_id", "store_name", "ship_city"]
FIGURES = T.StructType(
    [
        *[T.StructField(c, T.StringType()) for c in STORE],
        T.StructField("events", T.LongType()),
        T.StructField("valued", T.LongType()),
        T.StructField("revenue", T.DecimalType(38, 12)),
        T.StructField("last_event", T.TimestampType()),
    ]
)


def _net() -> Column:
    """The live figures take the discount once per line, as the stream states it."""
    return F.col("quantity") * F.col("unit_price") - F.col("discount_amount")


def figures_of(path: str) -> str:
    """Where the partial figures of the event table at ``path`` are kept."""
    return f"{path.rstrip('/')}-figures"


def partial_figures(events: DataFrame) -> DataFrame:
    """Mergeable figures per store. Sums are exact decimals: the order of rows and merges cannot matter."""
    return events.groupBy(*STORE).agg(
        F.count("*").alias("events"), F.count(_net()).alias("valued"),
        F.sum(_net().cast("decimal(28,12)")).alias("revenue"), F.max("created_at").alias("last_event"),
    )


def merge_figures(figures: DataFrame) -> DataFrame:
    """One row per store."""
    return figures.groupBy(*STORE).agg(
        F.sum("events").alias("events"), F.sum("valued").alias("valued"),
        F.sum("revenue").cast("decimal(38,12)").alias("revenue"), F.max("last_event").alias("last_event"),
    )


def read_figures(spark: SparkSession, path: str) -> DataFrame:
    """Figures per store of the event table at ``path``, from what its batches have left."""
    return merge_figures(parts.read_parts(spark, figures_of(path)))


def totals_of(figures: DataFrame) -> DataFrame:
    """Events, revenue and mean value; zeros when there are no events."""
    revenue = F.sum("revenue").cast("double")
    return figures.agg(
        F.coalesce(F.sum("events"), F.lit(0)).alias("total_events"),
        F.coalesce(revenue, F.lit(0.0)).alias("total_revenue"),
        F.coalesce(revenue / F.sum("valued"), F.lit(0.0)).alias("avg_order_value"),
    )


def breakdown_of(figures: DataFrame) -> DataFrame:
    revenue = F.col("revenue").cast("double")
    mean = F.when(F.col("valued") > 0, revenue / F.col("valued"))
    return figures.select(*STORE, "events", revenue.alias("revenue"), mean.alias("aov"), "last_event")


def stream_totals(events: DataFrame) -> DataFrame:
    """Events, revenue and mean value; zeros when there are no events."""
    return totals_of(partial_figures(events))


def store_breakdown(events: DataFrame) -> DataFrame:
    """Figures per store; works on a stream in complete mode."""
    return breakdown_of(partial_figures(events))


def by_revenue(stores: DataFrame) -> DataFrame:
    return stores.orderBy(F.col("revenue").desc_nulls_last(), "store_id")


def recent_events(events: DataFrame, n: int = 8) -> DataFrame:
    """The latest ``n`` events."""
    newest = events.orderBy(F.col("created_at").desc_nulls_last(), "event_id").limit(n)
    return newest.select(
        "event_id", "store_name", "pos_terminal_id", "order_id", "product_id", "quantity",
        _net().alias("net_amount"), "channel", "payment_method", "created_at",
    )


def newest_events(spark: SparkSession, path: str, n: int = 8, *, day: str = "event_day") -> DataFrame:
    """The latest ``n`` events of the event table at ``path``: only its newest days are read, as many as hold ``n``."""
    every = parts.values(spark, path, day)
    days = [None] * (None in every) + sorted(d for d in every if d is not None)
    chosen: list[str | None] = []
    rows = parts.read_parts(spark, path, only=[])
    while days and rows.count() < n:  # at most n turns: a day that is listed has an event
        chosen.append(days.pop())
        rows = parts.read_parts(spark, path, where={day: chosen})
    return recent_events(rows, n)
