"""Staging: trim, type, key and flag raw rows."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.functions.casts import date_of, decimal_of, int_of, text_of
from martline.functions.keys import hash_key, is_blank, key_text
from martline.operators.dedupe import dedupe_latest
from martline.schemas import POS_ONLY
from martline.sources.staging import stage

SALES_KEYS = ["order_id", "line_item_id"]


def _trimmed(df: DataFrame, *names: str, case=lambda c: c) -> list[Column]:
    return [case(F.trim(text_of(df, n))).alias(n) for n in names]


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.where(~is_blank(F.col("customer_id"))).select(
        hash_key("customer_id").alias("customer_sk"),
        text_of(raw, "customer_id").alias("customer_id"),
        *_trimmed(raw, "first_name", "last_name"),
        *_trimmed(raw, "email", case=F.lower),
        "phone",
        *_trimmed(raw, "address_line1", "address_line2", "city", "postal_code"),
        *_trimmed(raw, "state", "country", "gender", "income_bracket", "cohort", case=F.upper),
        *[date_of(raw, n).alias(n) for n in ("birth_date", "signup_date", "last_update_date")],
        F.current_timestamp().alias("loaded_at"),
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.where(~is_blank(F.col("product_id"))).select(
        hash_key("product_id").alias("product_sk"),
        text_of(raw, "product_id").alias("product_id"),
        *_trimmed(raw, "product_name", "category", "subcategory", "brand", "color", "size"),
        decimal_of(raw, "list_price").alias("list_price"),
        decimal_of(raw, "standard_cost").alias("standard_cost"),
        decimal_of(raw, "weight_kg", 8, 2).alias("weight_kg"),
        *[date_of(raw, n).alias(n) for n in ("launch_date", "discontinued_date")],
        F.current_timestamp().alias("loaded_at"),
    )


def _typed(raw: DataFrame) -> DataFrame:
    """Trim and type sales lines; missing stream-only columns become null.

    ``_key_text`` is what the line key hashes: the key columns as they came in.
    It is shorter than the hash, so steps that move or sort lines carry it and
    hash what is left.
    """
    absent = {name: F.lit(None).cast("string") for name in POS_ONLY if name not in raw.columns}
    if "is_streaming" not in raw.columns:
        absent["is_streaming"] = F.lit(0)
    if absent:
        raw = raw.withColumns(absent)
    return raw.select(
        *_trimmed(raw, "order_id"),
        int_of(raw, "line_item_id").alias("line_item_id"),
        key_text(*SALES_KEYS).alias("_key_text"),
        *_trimmed(raw, "customer_id", "product_id"),
        date_of(raw, "order_date").alias("order_date"),
        date_of(raw, "ship_date").alias("ship_date"),
        int_of(raw, "quantity").alias("quantity"),
        decimal_of(raw, "unit_price").alias("unit_price"),
        decimal_of(raw, "discount_amount").alias("discount_amount"),
        *_trimmed(raw, "ship_city"),
        *_trimmed(raw, "ship_state", "ship_country", case=F.upper),
        *_trimmed(raw, "channel", *POS_ONLY),
        "is_streaming",
        F.col("line_item_id").isNull().alias("_line_missing"),
    )


def _typed_union(batch: DataFrame, stream: DataFrame | None) -> DataFrame:
    # Each side is typed before the union, so neither is widened to text.
    rows = _typed(batch.withColumn("is_streaming", F.lit(0)))
    if stream is None:
        return rows
    return rows.unionByName(_typed(stream.withColumn("is_streaming", F.lit(1))))


def _keyed(typed: DataFrame, *extra: Column) -> DataFrame:
    columns = [
        F.md5(c).alias("order_line_sk") if c == "_key_text" else F.col(c)
        for c in typed.columns
        if c != "_line_missing"
    ]
    return typed.select(*columns, *extra)


def normalise_sales(raw: DataFrame) -> DataFrame:
    """Sales lines trimmed and typed, with the line key."""
    return _keyed(_typed(raw))


def union_sales(batch: DataFrame, stream: DataFrame | None = None) -> DataFrame:
    """Batch and stream lines under one schema, with an origin flag."""
    return _keyed(_typed_union(batch, stream))


# Reasons to reject a line. A null measure breaks no rule: only keys must be present.
def _rules(as_of: date) -> dict[str, Column]:
    return {
        "is_null_customer": is_blank(F.col("customer_id")),
        "is_null_order_key": is_blank(F.col("order_id")) | F.col("_line_missing"),
        "is_negative_quantity": F.col("quantity") < 0,
        "is_future_date": F.col("order_date") > F.lit(as_of),
        "is_zero_price": F.col("unit_price") <= 0,
    }


def _broken(rules: Iterable[Column]) -> Column:
    return F.coalesce(reduce(or_, rules), F.lit(False))


def _flags(as_of: date) -> list[Column]:
    rules = _rules(as_of)
    flags = [F.when(rule, 1).otherwise(0).alias(name) for name, rule in rules.items()]
    return [*flags, F.when(_broken(rules.values()), 1).otherwise(0).alias("is_bad_data_record")]


def flag_sales(batch: DataFrame, stream: DataFrame | None = None, *, as_of: date) -> DataFrame:
    """All lines with one 0/1 flag per rule and their OR, ``is_bad_data_record``."""
    return _keyed(_typed_union(batch, stream), *_flags(as_of))


def _clean(typed: DataFrame, as_of: date) -> DataFrame:
    return typed.where(~_broken(_rules(as_of).values()))


def stg_sales(batch: DataFrame, stream: DataFrame | None = None, *, as_of: date) -> DataFrame:
    """Clean sales lines: one row, the latest, per order and line.

    The flags of a clean line are all 0, so they are added to the result instead
    of being carried through the shuffle.
    """
    clean = _clean(_typed_union(batch, stream), as_of)
    latest = dedupe_latest(clean, SALES_KEYS, "order_date", SALES_TIES)
    zeros = [F.lit(0).alias(name) for name in [*_rules(as_of), "is_bad_data_record"]]
    return _keyed(latest, *zeros, F.current_timestamp().alias("loaded_at"))


# Order among lines with one key and date: the batch line first, then by value.
SALES_TIES = ["is_streaming", "product_id", "ship_date", "quantity", "unit_price",
              "discount_amount", "customer_id", "channel", "ship_city", "ship_state",
              "ship_country", "store_id", "store_name", "pos_terminal_id", "payment_method",
              "_key_text"]

REJECT_FLAGS = ["is_null_customer", "is_negative_quantity", "is_future_date", "is_zero_price"]


def rejected_sales(
    batch: DataFrame, stream: DataFrame | None = None, *, as_of: date, complete: bool = False
) -> DataFrame:
    """Rejected lines with their reasons.

    By default batch lines only and without the missing-key rule, so missing
    keys and stream lines are recorded nowhere. ``complete=True`` covers the
    stream, the missing-key rule and the lines that lose the duplicate contest.
    """
    reasons = REJECT_FLAGS
    if not complete:
        tests = [rule for name, rule in _rules(as_of).items() if name in reasons]
        typed = _typed(batch)
        rejected = _keyed(typed.where(_broken(tests)), *_flags(as_of))
    else:
        reasons = [*REJECT_FLAGS, "is_null_order_key", "is_duplicate"]
        # Written once with a row number, so that of equal copies exactly one is the winner and
        # the others are found by that number, however many copies a line has.
        typed = stage(
            _typed_union(batch, stream).withColumn("_row", F.monotonically_increasing_id()), "typed-lines", "zstd"
        )
        bad = typed.where(_broken(_rules(as_of).values())).drop("_row")
        clean = _clean(typed, as_of)
        winners = dedupe_latest(clean, SALES_KEYS, "order_date", [*SALES_TIES, "_row"])
        surplus = clean.join(winners.select("_row"), "_row", "left_anti").drop("_row")
        rejected = _keyed(bad, *_flags(as_of), F.lit(0).alias("is_duplicate")).unionByName(
            _keyed(surplus, *_flags(as_of), F.lit(1).alias("is_duplicate"))
        )
    return rejected.select(
        "order_id", "line_item_id", "order_line_sk", "customer_id", "product_id",
        "order_date", "ship_date", "quantity", "unit_price", "discount_amount", *reasons,
        F.current_timestamp().alias("rejected_at"),
    )
