"""Customer and product aggregates, segments and ranks."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.functions.keys import put_back, set_aside
from martline.operators.ranking import global_rank


@dataclass(frozen=True)
class Thresholds:
    """Segment limits (fixed default values)."""

    high_value: Decimal = Decimal(5000)
    mid_value: Decimal = Decimal(2000)
    silver_value: Decimal = Decimal(500)
    frequent_orders: int = 20
    gold_orders: int = 10
    regular_orders: int = 5
    occasional_orders: int = 1
    active_days: int = 30
    recent_days: int = 90
    lapsed_days: int = 180


def _total(name: str) -> Column:
    return F.sum(name).cast("decimal(38,2)")


def _exact_mean(name: str) -> Column:
    # Sum in decimal, then divide: the order in which rows arrive cannot matter.
    return F.sum(name).cast("double") / F.count(name)


def _stable_mean(name: str) -> Column:
    # Doubles as decimals with twelve digits after the point; see _exact_mean.
    return F.sum(F.col(name).cast("decimal(30,12)")).cast("double") / F.count(name)


def _line_totals(units: str) -> list[Column]:
    return [
        F.count("*").alias("total_line_items"),
        F.sum("quantity").alias(units),
        _total("net_revenue").alias("total_revenue"),
        _total("gross_revenue").alias("total_gross_revenue"),
        _total("total_cost").alias("total_cost"),
        _total("net_profit").alias("total_profit"),
        _stable_mean("profit_margin_pct").alias("avg_profit_margin_pct"),
    ]


def _totals(details: DataFrame, keys: Sequence[str], totals: Sequence[Column], distinct: Mapping[str, Column]) -> DataFrame:
    """``totals`` per key, and the number of distinct values of each column of ``distinct``.

    Values are made distinct as narrow rows of key and value, spread over the cluster also
    for a key with many, and the totals never travel with them. The surrogate key, second of
    ``keys``, is left out of the shuffles. With ``distinct`` the details are read twice, so
    they should be a written table.
    """
    known, sk = keys
    narrow = set_aside(details, sk, [known])
    groups = [c for c in narrow.columns if c in (known, sk, f"_own_{sk}", f"_odd_{sk}")]
    rows = narrow.groupBy(*groups).agg(*totals)
    if distinct:
        pairs = F.explode(F.array(*[
            F.struct(F.lit(i).alias("_kind"), c.cast("string").alias("_value")) for i, c in enumerate(distinct.values())
        ]))
        values = narrow.select(*groups, pairs.alias("_p")).select(*groups, "_p.*").where("_value IS NOT NULL").distinct()
        counts = values.groupBy(*groups).agg(*[F.count_if(F.col("_kind") == i).alias(c) for i, c in enumerate(distinct)])
        # Two rows per key at most: of each column one of them has the value.
        measured = [c for c in rows.columns if c not in groups]
        both = rows.unionByName(counts, allowMissingColumns=True).groupBy(*groups).agg(
            *[F.max(c).alias(c) for c in measured], *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in distinct]
        )
        rows = both.select(*groups, *distinct, *measured)
    rows = put_back(rows, sk, [known])
    return rows.select(*keys, *[c for c in rows.columns if c not in keys])


def _chosen(distinct: Mapping[str, Column], counts: Collection[str] | None) -> dict[str, Column]:
    return {name: c for name, c in distinct.items() if counts is None or name in counts}


# --- totals that can be merged over months -----------------------------------------

_SUMS = {"net_revenue": "decimal(38,2)", "gross_revenue": "decimal(38,2)", "total_cost": "decimal(38,2)", "net_profit": "decimal(38,2)"}


def metric_state(lines: DataFrame, keys: Sequence[str], sets: Sequence[str], month: str = "sale_month") -> DataFrame:
    """Totals per month and key, and the distinct values of ``sets`` per month and key.

    A row without ``kind`` holds sums, counts and dates. Other rows are a key with one
    value of the column that ``kind`` names: sets as rows merge exactly, spread over
    the cluster, and stay small for keys with few values, which bitmaps would not.
    """
    known, sk = keys
    narrow = set_aside(lines, sk, [known])
    held = [c for c in narrow.columns if c in (known, sk, f"_own_{sk}", f"_odd_{sk}")]
    totals = narrow.groupBy(month, *held).agg(
        F.count("*").alias("lines"), F.sum("quantity").alias("units"),
        *[F.sum(c).cast(kind).alias(c) for c, kind in _SUMS.items()], F.count("net_revenue").alias("priced"),
        F.sum(F.col("profit_margin_pct").cast("decimal(30,12)")).cast("decimal(38,12)").alias("margin"),
        F.count("profit_margin_pct").alias("with_margin"),
        F.min("order_date").alias("first_date"), F.max("order_date").alias("last_date"),
    )
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("value")) for c in sets]))
    values = narrow.select(month, *held, pairs.alias("p")).select(month, *held, "p.*").where("value IS NOT NULL").distinct()
    both = put_back(totals.unionByName(values, allowMissingColumns=True), sk, [known])
    return both.select(month, *keys, *[c for c in both.columns if c not in (month, *keys)])


def _merged(state: DataFrame, keys: Sequence[str], units: str, mean: str, distinct: Mapping[str, str], dates: tuple[str, str]) -> DataFrame:
    """Totals of all months: sums added up, values counted once however many months have them."""
    known, sk = keys
    state = set_aside(state, sk, [known])
    held = [c for c in state.columns if c in (known, sk, f"_own_{sk}", f"_odd_{sk}")]
    totals = state.where("kind IS NULL").drop("kind", "value")
    values = state.where("kind IS NOT NULL").select(*held, "kind", "value").distinct()
    both = totals.unionByName(values, allowMissingColumns=True)
    counts = {c: F.count_if(F.col("kind").eqNullSafe(c)) for c in distinct}
    merged = both.groupBy(*held).agg(
        counts["order_id"].alias("total_orders"), F.sum("lines").alias("total_line_items"), F.sum("units").alias(units),
        *[F.sum(c).cast("decimal(38,2)").alias(name) for c, name in zip(_SUMS, ("total_revenue", "total_gross_revenue", "total_cost", "total_profit"))],
        (F.sum("margin").cast("double") / F.sum("with_margin")).alias("avg_profit_margin_pct"),
        (F.sum("net_revenue").cast("double") / F.sum("priced")).alias(mean),
        F.min("first_date").alias(dates[0]), F.max("last_date").alias(dates[1]),
        *[counts[c].alias(name) for c, name in distinct.items() if c != "order_id"],
        F.count_if(F.col("lines").isNotNull() & F.col("sale_month").isNotNull()).alias("active_months"),
    )
    merged = put_back(merged, sk, [known])
    return merged.select(*keys, *[c for c in merged.columns if c not in keys])


CUSTOMER_KEYS, PRODUCT_KEYS = ["customer_id", "customer_sk"], ["product_id", "product_sk"]


def customer_state(lines: DataFrame) -> DataFrame:
    return metric_state(lines, CUSTOMER_KEYS, ["order_id", "product_id"])


def product_state(lines: DataFrame) -> DataFrame:
    return metric_state(lines, PRODUCT_KEYS, ["order_id", "customer_id"])


def merged_customer_metrics(state: DataFrame, *, as_of: date, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """``customer_metrics`` from the states of all months."""
    found = {"order_id": "total_orders", "product_id": "distinct_products_purchased"}
    dates = ("first_order_date", "last_order_date")
    totals = _merged(state, CUSTOMER_KEYS, "total_units_purchased", "avg_order_value", found, dates)
    return segment_customers(totals, as_of=as_of, thresholds=thresholds)


def merged_product_metrics(state: DataFrame) -> DataFrame:
    """``product_metrics`` from the states of all months."""
    found = {"order_id": "total_orders", "customer_id": "unique_customers"}
    dates = ("first_sale_date", "last_sale_date")
    totals = _merged(state, PRODUCT_KEYS, "total_units_sold", "avg_revenue_per_order", found, dates)
    return rank_products(totals.drop("active_months"))


def customer_metrics(
    details: DataFrame, *, as_of: date, thresholds: Thresholds = Thresholds(), counts: Collection[str] | None = None
) -> DataFrame:
    """One row per customer with totals and segments.

    ``counts`` names the distinct counts to make, all by default; segments need ``total_orders``.
    """
    measures = [
        *_line_totals("total_units_purchased"),
        _exact_mean("net_revenue").alias("avg_order_value"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    ]
    distinct = {
        "total_orders": F.col("order_id"),
        "distinct_products_purchased": F.col("product_id"),
        "active_months": F.trunc("order_date", "MM"),
    }
    totals = _totals(details, CUSTOMER_KEYS, measures, _chosen(distinct, counts))
    late = [c for c in ("distinct_products_purchased", "active_months") if c in totals.columns]
    return segment_customers(totals.select(*[c for c in totals.columns if c not in late], *late), as_of=as_of, thresholds=thresholds)


def segment_customers(
    totals: DataFrame, *, as_of: date, thresholds: Thresholds = Thresholds()
) -> DataFrame:
    """Value, frequency, recency and tier from the totals of a customer."""
    t = thresholds
    revenue, orders = F.col("total_revenue"), F.col("total_orders")
    days = F.datediff(F.lit(as_of), F.col("last_order_date"))
    high, mid, silver = (F.lit(v) for v in (t.high_value, t.mid_value, t.silver_value))
    return totals.select(
        "*",
        F.when(revenue >= high, "HIGH_VALUE")
        .when(revenue >= mid, "MID_VALUE")
        .otherwise("LOW_VALUE")
        .alias("value_segment"),
        F.when(orders >= t.frequent_orders, "FREQUENT_BUYER")
        .when(orders >= t.regular_orders, "REGULAR_BUYER")
        .when(orders >= t.occasional_orders, "OCCASIONAL_BUYER")
        .otherwise("NEW_BUYER")
        .alias("frequency_segment"),
        days.alias("days_since_last_order"),
        F.when(days.isNull(), "NEW")
        .when(days <= t.active_days, "ACTIVE")
        .when(days <= t.recent_days, "RECENT")
        .when(days <= t.lapsed_days, "LAPSED")
        .otherwise("CHURNED")
        .alias("recency_segment"),
        F.when((revenue >= high) & (orders >= t.frequent_orders), "PLATINUM")
        .when((revenue >= mid) & (orders >= t.gold_orders), "GOLD")
        .when(revenue >= silver, "SILVER")
        .otherwise("BRONZE")
        .alias("customer_tier"),
    )


def product_totals(details: DataFrame, counts: Collection[str] | None = None) -> DataFrame:
    """One row per product with totals; ``counts`` names the distinct counts to make, all by default."""
    measures = [
        *_line_totals("total_units_sold"),
        _exact_mean("net_revenue").alias("avg_revenue_per_order"),
        F.min("order_date").alias("first_sale_date"),
        F.max("order_date").alias("last_sale_date"),
    ]
    distinct = {"total_orders": F.col("order_id"), "unique_customers": F.col("customer_id")}
    totals = _totals(details, PRODUCT_KEYS, measures, _chosen(distinct, counts))
    late = [c for c in ("unique_customers", "first_sale_date", "last_sale_date") if c in totals.columns]
    return totals.select(*[c for c in totals.columns if c not in late], *late)


RANKS = {
    "revenue_rank": "total_revenue",
    "volume_rank": "total_units_sold",
    "profit_rank": "total_profit",
    "margin_rank": "avg_profit_margin_pct",
}


def rank_products(totals: DataFrame) -> DataFrame:
    """Add the four global ranks; ties go to the smaller product id."""
    return global_rank(totals, RANKS, "product_id")


def product_metrics(details: DataFrame, counts: Collection[str] | None = None) -> DataFrame:
    """Totals and ranks per product; ``counts`` as in ``product_totals``."""
    return rank_products(product_totals(details, counts))
