"""Input schemas and value domains."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Columns of the bronze files, read as text; staging gives them their types.
RAW_CUSTOMERS = _strings(
    [
        "customer_id", "first_name", "last_name", "email", "phone", "address_line1", "address_line2",
        "city", "state", "postal_code", "country", "birth_date", "gender", "income_bracket", "cohort",
        "signup_date", "last_update_date",
    ]
)
RAW_PRODUCTS = _strings(
    [
        "product_id", "product_name", "category", "subcategory", "brand", "list_price", "standard_cost",
        "color", "size", "weight_kg", "launch_date", "discontinued_date",
    ]
)
RAW_SALES = _strings(
    [
        "order_id", "line_item_id", "order_date", "customer_id", "product_id", "quantity", "unit_price",
        "discount_amount", "ship_date", "ship_city", "ship_state", "ship_country", "channel",
    ]
)

# Fields of a point-of-sale event.
POS_EVENT = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("line_item_id", T.LongType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("store_name", T.StringType()),
        T.StructField("pos_terminal_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("discount_amount", T.DoubleType()),
        T.StructField("ship_date", T.DateType()),
        T.StructField("ship_city", T.StringType()),
        T.StructField("ship_state", T.StringType()),
        T.StructField("ship_country", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

# Columns only the point-of-sale stream has.
POS_ONLY = ["store_id", "store_name", "pos_terminal_id", "payment_method"]

# Accepted domains.
COHORTS = ["LOYAL_HEAVY", "LOYAL_LIGHT", "GROWING", "DECLINING", "ONE_SHOT", "CHURN_RISK"]
INCOME_BRACKETS = ["LOW", "MEDIUM", "HIGH", "VERY_HIGH"]
CHANNELS = ["Online", "Retail", "Catalog", "B2B", "POS_Retail", "Online_Realtime"]
FACT_QUANTITIES = list(range(1, 11))

# Share of customers per cohort.
COHORT_WEIGHTS = {
    "LOYAL_HEAVY": 0.15,
    "LOYAL_LIGHT": 0.20,
    "GROWING": 0.20,
    "DECLINING": 0.15,
    "ONE_SHOT": 0.15,
    "CHURN_RISK": 0.15,
}

# Income bracket shares given the cohort, in INCOME_BRACKETS order.
INCOME_WEIGHTS = {
    "LOYAL_HEAVY": [0.10, 0.30, 0.40, 0.20],
    "LOYAL_LIGHT": [0.15, 0.40, 0.30, 0.15],
    "GROWING": [0.20, 0.40, 0.30, 0.10],
    "DECLINING": [0.35, 0.40, 0.20, 0.05],
    "ONE_SHOT": [0.40, 0.35, 0.20, 0.05],
    "CHURN_RISK": [0.50, 0.30, 0.15, 0.05],
}

# Columns whose change opens a new history version.
CUSTOMER_TRACKED = [
    "first_name",
    "last_name",
    "email",
    "phone",
    "address_line1",
    "address_line2",
    "city",
    "state",
    "postal_code",
    "country",
    "income_bracket",
    "cohort",
]
CUSTOMER_HISTORY = [
    "customer_id",
    *CUSTOMER_TRACKED,
    "birth_date",
    "gender",
    "signup_date",
    "last_update_date",
]
PRODUCT_TRACKED = [
    "product_name",
    "category",
    "subcategory",
    "list_price",
    "standard_cost",
    "color",
    "discontinued_date",
]
PRODUCT_HISTORY = ["product_id", *PRODUCT_TRACKED, "brand", "size", "weight_kg", "launch_date"]
