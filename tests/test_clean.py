from datetime import date

import duckdb
import pytest
from conftest import TODAY, rows
from pyspark.sql import functions as F

from martline.functions.casts import date_of, decimal_of, int_of
from martline.functions.keys import hash_key
from martline.operators import clean
from martline.operators.sampling import inject_defects

TEXTS = ["5", "5.4", "5.5", "2.5", "-2.5", "1e1", " 7 ", "", "x", "+5", "1.005", "12.345", "2024",
         "2024-1-5", " 2024-01-05 ", "2024/01/05", "2024-02-30", "2024-01-05 10:00:00", "20240105",
         "NaN", "99999999999", "2024-01-15 garbage", "2024-01-15Tx", "2024-01-15T10:00:00Z", "2024-01-15 10", "2024-1-5 1:2:3",
         "2024-01-15 25:00:00", "2024-01-15 10:00:00.5+02", "2.4999999", "0.4999999999999", "2.5000001"]
FLOATS = [2.5, 3.5, -2.5, 0.125, 1.005, 2.675, 0.135, 10.0, 99.99, 1e7]


@pytest.mark.parametrize(
    ("kind", "cast", "sql", "values"),
    [
        ("string", int_of, "try_cast(v as integer)", TEXTS),
        ("string", decimal_of, "try_cast(v as decimal(10,2))", TEXTS),
        ("string", date_of, "try_cast(v as date)", TEXTS),
        ("double", int_of, "try_cast(v as integer)", FLOATS),
        ("double", decimal_of, "try_cast(v as decimal(10,2))", FLOATS),
    ],
)
def test_casts_agree_with_sql(spark, kind, cast, sql, values):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    ours = [r[0] for r in df.select(cast(df, "v")).collect()]
    db = duckdb.connect()
    typed = {"string": "varchar", "double": "double"}[kind]
    theirs = [db.execute(f"select {sql} from (select ?::{typed} as v)", [v]).fetchone()[0] for v in values]
    assert dict(zip(values, ours)) == dict(zip(values, theirs))


def test_hash_key_counts_null_as_empty_text(spark):
    df = spark.createDataFrame([("A", "1"), ("A", None), (None, "1")], "a string, b string")
    keys = [r[0] for r in df.select(hash_key("a", "b")).collect()]
    expected = [r[0] for r in df.select(F.md5(F.concat(F.coalesce("a", F.lit("")), F.lit("|"),
                                                       F.coalesce("b", F.lit(""))))).collect()]
    assert keys == expected
    assert len(set(keys)) == 3


def test_staging_trims_types_and_drops_blank_keys(raw_customers, raw_products):
    customers = clean.stg_customers(
        raw_customers({}, {"customer_id": None}, {"customer_id": "  "}, {"customer_id": " C2"})
    )
    assert rows(customers, "customer_id", "first_name", "email", "state", "gender", "birth_date") == [
        (" C2", "Ada", "a@b.c", "LA", "F", date(1990, 12, 31)),
        ("C1", "Ada", "a@b.c", "LA", "F", date(1990, 12, 31)),
    ]
    products = clean.stg_products(raw_products({"list_price": "x", "discontinued_date": "2024"}))
    assert rows(products, "list_price", "standard_cost", "discontinued_date") == [(None, 4.0, None)]


DEFECTS = [
    {"order_id": "N1", "customer_id": None},
    {"order_id": "N2", "customer_id": "  "},
    {"order_id": None},
    {"order_id": " "},
    {"order_id": "K", "line_item_id": None},
    {"order_id": "Q", "quantity": "-3"},
    {"order_id": "F", "order_date": "2099-01-01"},
    {"order_id": "Z", "unit_price": "0"},
]
HARMLESS = [
    {"order_id": "h1", "quantity": "many"},
    {"order_id": "h2", "unit_price": None},
    {"order_id": "h3", "order_date": "soon"},
    {"order_id": "h4", "quantity": "0"},
    {"order_id": "h5", "line_item_id": "x"},
    {"order_id": "h6", "product_id": "unknown"},
]


def test_each_rule_rejects_its_lines_and_null_measures_pass(raw_sales):
    raw = raw_sales({}, *DEFECTS, *HARMLESS)
    flagged = clean.flag_sales(raw, as_of=TODAY)
    bad = flagged.where("is_bad_data_record = 1").count()
    assert bad == len(DEFECTS)
    stg = clean.stg_sales(raw, as_of=TODAY)
    assert {r.order_id for r in stg.collect()} == {"A", *(h["order_id"] for h in HARMLESS)}
    assert stg.where("is_bad_data_record <> 0").count() == 0
    assert stg.where("order_id = 'A'").select("ship_city", "ship_state", "ship_country").first() == (
        "Rome", "LA", "ITA")


def test_default_rejects_miss_lines_without_an_order_key(raw_sales):
    rejected = clean.rejected_sales(raw_sales({}, *DEFECTS), as_of=TODAY)
    assert {r.order_id for r in rejected.collect()} == {"N1", "N2", "Q", "F", "Z"}


def test_complete_rejects_and_clean_lines_add_up_to_the_input(spark, raw_sales):
    raw = raw_sales({}, {}, {"quantity": "9"}, {"order_id": " A"}, *DEFECTS)
    stream = raw.limit(0).withColumns(
        {c: F.lit("s") for c in ("store_id", "store_name", "pos_terminal_id", "payment_method")}
    )
    stream = stream.union(raw_sales({"order_id": "S", "quantity": "-1"}, {"order_id": "S"}).selectExpr(
        "*", "'s'", "'s'", "'s'", "'s'"))
    kept = clean.stg_sales(raw, stream, as_of=TODAY)
    lost = clean.rejected_sales(raw, stream, as_of=TODAY, complete=True)
    assert kept.count() + lost.count() == raw.count() + stream.count()
    assert lost.where("is_duplicate = 1").count() == 3


def test_dedupe_keeps_the_latest_and_trims_before_comparing(raw_sales):
    raw = raw_sales(
        {"order_date": "2024-06-01", "quantity": "1"},
        {"order_date": "2024-06-02", "quantity": "2"},
        {"order_id": " A", "order_date": "2024-06-02", "quantity": "3"},
        {"order_date": None, "quantity": "4"},
    )
    kept = clean.stg_sales(raw, as_of=TODAY)
    assert rows(kept, "order_id", "quantity", "order_date") == [("A", 2, date(2024, 6, 2))]
    assert kept.first().order_line_sk == raw.select(hash_key("order_id", "line_item_id")).first()[0]


def test_dedupe_limits_rows_before_the_shuffle(raw_sales):
    plan = clean.stg_sales(raw_sales({}), as_of=TODAY)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning(order_id"):]
    assert "WindowGroupLimit" in below


def test_injected_defects_are_caught(raw_sales):
    raw = raw_sales(*[{"order_id": f"o{i}"} for i in range(50)])
    dirty = inject_defects(raw, clean.SALES_KEYS)
    assert dirty.count() == 55
    flagged = clean.flag_sales(dirty, as_of=TODAY)
    names = ["is_null_customer", "is_negative_quantity", "is_future_date", "is_zero_price"]
    assert flagged.agg(*[F.sum(n) for n in names]).first() == (1, 1, 1, 1)
    assert clean.rejected_sales(dirty, as_of=TODAY).count() == 4
    assert clean.stg_sales(dirty, as_of=TODAY).count() == 50


def test_complete_rejects_read_their_source_once(spark, raw_sales, tmp_path):
    lines = raw_sales({}, {}, {"line_item_id": "2", "quantity": "-1"}, {"customer_id": " "}, {"line_item_id": None})
    lines.write.parquet(str(tmp_path / "raw"))
    stored = spark.read.schema(lines.schema).parquet(str(tmp_path / "raw"))
    rejected = clean.rejected_sales(stored, as_of=TODAY, complete=True)
    assert not [f for f in rejected.inputFiles() if str(tmp_path) in f]
    assert sorted(rows(rejected, "is_duplicate", "is_negative_quantity", "is_null_customer", "is_null_order_key")) == [
        (0, 0, 0, 1), (0, 0, 1, 0), (0, 1, 0, 0), (1, 0, 0, 0)]
