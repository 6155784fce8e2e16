"""Raw retail frames read from an order-processing schema.

Maps the tables customer, nation, region, part, orders, lineitem and events to
the bronze shapes of ``martline.schemas``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(10,2)"
STORES = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer; the address comes from its nation and region."""
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    rows = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"], "left").join(
        region, F.col("n_regionkey") == region["r_regionkey"], "left"
    )
    key = F.col("c_custkey")
    balance = F.col("c_acctbal")
    signup = F.date_add(F.lit("1995-01-01").cast("date"), (key % 2000).cast("int"))
    return rows.select(
        key.cast("string").alias("customer_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.concat(F.split_part("c_name", F.lit("#"), F.lit(2)), F.lit(" ")).alias("last_name"),
        F.concat(F.lit(" "), "c_name", F.lit("@Example.com")).alias("email"),
        F.concat(F.lit("555-"), key.cast("string")).alias("phone"),
        F.concat(key.cast("string"), F.lit(" Main Street")).alias("address_line1"),
        F.lit("").alias("address_line2"),
        F.col("n_name").alias("city"),
        F.lower("r_name").alias("state"),
        F.col("c_nationkey").cast("string").alias("postal_code"),
        F.concat(F.lit(" "), F.lower("n_name")).alias("country"),
        F.date_add(F.lit("1950-01-01").cast("date"), (key % 19000).cast("int")).alias("birth_date"),
        F.when(key % 2 == 0, "f").otherwise("m").alias("gender"),
        F.when(balance < 0, "low").when(balance < 4000, "medium").when(balance < 8000, "high")
        .otherwise("very_high").alias("income_bracket"),
        F.col("c_mktsegment").alias("cohort"),
        signup.alias("signup_date"),
        signup.alias("last_update_date"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part; cost is 60 % of the price, every tenth part is discontinued."""
    key = F.col("p_partkey")
    price = F.col("p_retailprice").cast(MONEY)
    launch = F.date_add(F.lit("1995-01-01").cast("date"), (key % 1000).cast("int"))
    return table(spark, sf_dir, "part").select(
        key.cast("string").alias("product_id"),
        F.concat(F.lit(" "), "p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_name").alias("subcategory"),
        F.concat("p_brand", F.lit(" ")).alias("brand"),
        price.alias("list_price"),
        (price * F.lit("0.60").cast("decimal(3,2)")).cast(MONEY).alias("standard_cost"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("color"),
        F.col("p_size").cast("string").alias("size"),
        F.col("p_size").cast("decimal(8,2)").alias("weight_kg"),
        launch.alias("launch_date"),
        F.when(key % 10 == 0, F.date_add(launch, 1000)).alias("discontinued_date"),
    )


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with the date, customer and channel of its order, null without one."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    price = F.col("l_extendedprice").cast(MONEY)
    discount = F.col("l_discount").cast("decimal(3,2)")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"], "left").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("line_item_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        price.alias("unit_price"),
        (price * discount).cast(MONEY).alias("discount_amount"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.concat(F.lit("City "), F.col("l_suppkey").cast("string")).alias("ship_city"),
        F.lower("o_orderstatus").alias("ship_state"),
        F.lower("l_linestatus").alias("ship_country"),
        F.concat("o_orderpriority", F.lit(" ")).alias("channel"),
    )


def sold_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product key of each line item, without its order."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("product_id"))


def raw_sales_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point-of-sale event per purchase."""
    purchases = table(spark, sf_dir, "events").where("event_type = 'purchase'")
    event, number = F.col("event_id"), (F.col("user_id") % STORES + 101).cast("string")
    day = F.col("ts").cast("date")
    store = F.concat(F.lit("STORE-"), number)
    quantity = event % 5 + 1
    return purchases.select(
        F.concat(F.lit("evt_"), event.cast("string")).alias("event_id"),
        F.concat_ws("-", F.lit("STREAM"), store, F.date_format(day, "yyyyMMdd"),
                    event.cast("string")).alias("order_id"),
        F.lit(1).cast("bigint").alias("line_item_id"),
        day.alias("order_date"),
        store.alias("store_id"),
        F.concat(F.lit("Store "), number).alias("store_name"),
        F.concat(F.lit("POS-"), number, F.lit("-A")).alias("pos_terminal_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.get_json_object("props", "$.k").alias("product_id"),
        quantity.alias("quantity"),
        F.col("value").alias("unit_price"),
        F.when(event % 4 == 0, quantity * 0.25).otherwise(0.0).alias("discount_amount"),
        day.alias("ship_date"),
        F.concat(F.lit("City "), number).alias("ship_city"),
        F.lit("ny").alias("ship_state"),
        F.lit("usa").alias("ship_country"),
        F.when(F.col("user_id") % STORES == 4, "Online_Realtime").otherwise("POS_Retail").alias("channel"),
        F.when(event % 2 == 0, "Card").otherwise("Cash").alias("payment_method"),
        F.col("ts").cast("timestamp").alias("created_at"),
    )


def planted_defects(sales: DataFrame, *, unknown_products: bool = True) -> DataFrame:
    """Break about one line in sixteen, by its order number; no line is dropped.

    The source tables are clean; this gives every rejection rule, and the checks
    for unknown products, lines to find.
    """
    kind = F.col("order_id").cast("bigint") % 97
    broken = {
        "customer_id": F.when(kind == 1, F.lit(None)).when(kind == 2, F.lit("  ")),
        "quantity": F.when(kind == 3, -F.col("quantity")),
        "order_date": F.when(kind == 4, F.lit("2099-01-01").cast("date")),
        "unit_price": F.when(kind == 5, F.lit(0).cast(MONEY)),
        "product_id": F.when(kind == 6, F.concat(F.lit("X"), "product_id")),
    }
    if not unknown_products:
        del broken["product_id"]
    fixed = {"customer_id": ~kind.isin(1, 2), "quantity": kind != 3, "order_date": kind != 4,
             "unit_price": kind != 5, "product_id": kind != 6}
    return sales.select(
        *[F.when(fixed[c], F.col(c)).otherwise(broken[c]).alias(c) if c in broken else F.col(c)
          for c in sales.columns]
    )
