"""Dimensions, fact and the wide table."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.functions.keys import hash_key, packed, packed_key, put_back, put_back_values, set_aside, set_aside_values
from martline.operators.details import HASHED, MEASURES
from martline.operators.joins import left_join


def with_audit(df: DataFrame, as_of: date) -> DataFrame:
    """Validity placeholders and load time of a rebuilt dimension."""
    return df.select(
        "*",
        F.lit(as_of).alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(1).alias("is_current"),
        F.current_timestamp().alias("loaded_at"),
    )


# Metric columns each dimension carries.
CUSTOMER_METRICS = ["total_orders", "total_revenue", "total_profit", "avg_order_value",
                    "first_order_date", "last_order_date", "days_since_last_order",
                    "value_segment", "frequency_segment", "recency_segment",
                    "customer_tier"]
PRODUCT_METRICS = ["total_units_sold", "total_revenue", "total_profit",
                   "avg_profit_margin_pct", "revenue_rank", "volume_rank",
                   "profit_rank"]


def dim_customer(customers: DataFrame, metrics: DataFrame, *, as_of: date) -> DataFrame:
    """Customers with their metrics; customers without sales keep null metrics."""
    age = F.year(F.lit(as_of)) - F.year("birth_date")
    enriched = customers.drop("loaded_at").withColumn("age", age).join(
        metrics.select("customer_id", *CUSTOMER_METRICS), "customer_id", "left"
    )
    return with_audit(enriched, as_of)


def dim_product(products: DataFrame, metrics: DataFrame, *, as_of: date) -> DataFrame:
    """Products with markup, status and metrics."""
    price = F.col("list_price")
    markup = price - F.col("standard_cost")
    enriched = (
        products.drop("loaded_at")
        .withColumns(
            {
                "product_category": F.col("category"),
                "product_subcategory": F.col("subcategory"),
                "product_brand": F.col("brand"),
                "markup_amount": markup.cast("decimal(11,2)"),
                "markup_pct": F.when(
                    price > 0, markup.cast("double") / price.cast("double") * 100
                ),
                "product_status": F.when(
                    F.col("discontinued_date").isNotNull(), "DISCONTINUED"
                ).otherwise("ACTIVE"),
            }
        )
        .join(metrics.select("product_id", *PRODUCT_METRICS), "product_id", "left")
    )
    return with_audit(enriched, as_of)


def fact_sales(details: DataFrame, dates: DataFrame) -> DataFrame:
    """Order lines with the keys of the customer, product and two date dimensions.

    ``order_details`` has found the customer and product keys already: the
    dimensions hold the same customers and products as the staging tables.
    """
    fact = details.drop("loaded_at")
    for role in ("order", "ship"):
        days = dates.select(
            F.col("date_actual").alias(f"{role}_date"), F.col("date_sk").alias(f"{role}_date_sk")
        )
        fact = fact.join(days, f"{role}_date", "left")
    return fact.withColumn("loaded_at", F.current_timestamp())


def hot_sks(hot: Mapping[str, DataFrame | None]) -> dict[str, DataFrame | None]:
    """Hot customer and product ids as the surrogate keys that the wide table joins by."""
    found = {k: hot[f"{k}_id"] for k in ("customer", "product")}
    return {
        f"hot_{k}s": None if ids is None else ids.select(hash_key(f"{k}_id").alias(f"{k}_sk"), "_salts") for k, ids in found.items()
    }


FACT_COLUMNS = ["order_line_sk", "order_id", "line_item_id", "order_date", "ship_date",
                "quantity", "unit_price", "discount_amount", "list_price", "standard_cost",
                "gross_revenue", "net_revenue", "total_cost", "gross_profit", "net_profit",
                "profit_margin_pct", "channel", "store_id", "store_name", "pos_terminal_id",
                "payment_method", "is_streaming"]

# Wide-table name -> dimension column.
CUSTOMER_COLUMNS = {
    "customer_id": "customer_id",
    "first_name": "first_name",
    "last_name": "last_name",
    "email": "email",
    "customer_city": "city",
    "customer_state": "state",
    "customer_postal_code": "postal_code",
    "customer_country": "country",
    "gender": "gender",
    "income_bracket": "income_bracket",
    "cohort": "cohort",
    "age": "age",
    "signup_date": "signup_date",
    "value_segment": "value_segment",
    "frequency_segment": "frequency_segment",
    "recency_segment": "recency_segment",
    "customer_tier": "customer_tier",
    "customer_total_orders": "total_orders",
    "customer_total_revenue": "total_revenue",
}
PRODUCT_COLUMNS = {
    "product_id": "product_id",
    "product_name": "product_name",
    "category": "category",
    "subcategory": "subcategory",
    "brand": "brand",
    "product_category": "product_category",
    "product_subcategory": "product_subcategory",
    "product_brand": "product_brand",
    "color": "color",
    "size": "size",
    "product_list_price": "list_price",
    "product_standard_cost": "standard_cost",
    "product_status": "product_status",
    "revenue_rank": "revenue_rank",
    "volume_rank": "volume_rank",
}
DATE_COLUMNS = {
    "order": ["year", "quarter", "quarter_label", "month", "month_name", "week_of_year",
              "day_of_month", "day_of_week", "day_name", "is_weekend", "season", "is_holiday",
              "holiday_name"],
    "ship": ["year", "month", "month_name", "day_of_week", "day_name"],
}


def obt_sales(
    fact: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    dates: DataFrame,
    *,
    hot_customers: DataFrame | None = None,
    hot_products: DataFrame | None = None,
    gather: Mapping[str, Column] | None = None,
    short: bool = False,
) -> DataFrame:
    """One wide table: the fact with the attributes of its dimensions.

    The narrower products come first, as the second join moves what the first has added.
    Keys are joined as bytes; the line key and the measures stay out of the shuffles. ``gather`` names
    columns to add, by whose values rows are gathered for a writer, before the date
    attributes make them longer. The fact may come with keys and measures set aside; ``short`` leaves
    the line key and the measures so, for a writer that stores neither.
    """
    fact = set_aside_values(set_aside(fact, "order_line_sk", HASHED["order_line_sk"]), MEASURES)
    aside = [c for c in ("_own_order_line_sk", "_odd_order_line_sk", "_own_values", "_odd_values") if c in fact.columns]
    held = [*[c for c in FACT_COLUMNS if c in fact.columns], *aside]
    keys = [packed_key(fact, key, HASHED[key]).alias(key) for key in ("customer_sk", "product_sk")]
    wide = fact.select(*held, *keys, "order_date_sk", "ship_date_sk")
    for key, dim, columns, hot in (
        ("product_sk", products, PRODUCT_COLUMNS, hot_products),
        ("customer_sk", customers, CUSTOMER_COLUMNS, hot_customers),
    ):
        attributes = dim.select(packed(F.col(key)).alias(key), *[F.col(c).alias(name) for name, c in columns.items()])
        if hot is not None:
            hot = hot.withColumn(key, packed(F.col(key)))
        wide = left_join(wide, attributes, key, HASHED["order_line_sk"], hot=hot).drop(key)
    if gather:
        wide = wide.withColumns(gather).hint("rebalance", *[F.col(c) for c in gather])
    for role, columns in DATE_COLUMNS.items():
        days = dates.select(
            F.col("date_sk").alias(f"{role}_date_sk"),
            *[F.col(c).alias(f"{role}_{c}") for c in columns],
        )
        wide = wide.join(days, f"{role}_date_sk", "left")
    dated = [f"{role}_{c}" for role, columns in DATE_COLUMNS.items() for c in columns]
    if not short:
        wide, held = put_back_values(put_back(wide, "order_line_sk", HASHED["order_line_sk"]), MEASURES), FACT_COLUMNS
    return wide.select(*held, *CUSTOMER_COLUMNS, *PRODUCT_COLUMNS, *dated, *(gather or {}))
