from __future__ import annotations

import sys
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from martline.schemas import RAW_CUSTOMERS, RAW_PRODUCTS, RAW_SALES  # noqa: E402
from martline.session import spark_session  # noqa: E402

TESTDATA = Path("/root/testdata/sf0.001")
TODAY = date(2024, 6, 30)


@pytest.fixture(scope="session")
def spark():
    session = spark_session(
        "local[4]", 4, **{"spark.ui.enabled": "false", "spark.driver.memory": "4g",
                          "spark.ui.showConsoleProgress": "false"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as a sorted list of tuples; decimals as plain numbers."""
    picked = df.select(*columns) if columns else df
    plain = [tuple(float(v) if isinstance(v, Decimal) else v for v in r) for r in picked.collect()]
    return sorted(plain, key=repr)


def _text_frame(spark, schema, records):
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], schema)


@pytest.fixture
def raw_sales(spark):
    def make(*records):
        base = {"order_id": "A", "line_item_id": "1", "order_date": "2024-06-01", "customer_id": "C1",
                "product_id": "P1", "quantity": "2", "unit_price": "10.00", "discount_amount": "1.00",
                "ship_date": "2024-06-03", "ship_city": " Rome ", "ship_state": "la",
                "ship_country": " ita", "channel": "Online"}
        return _text_frame(spark, RAW_SALES, [{**base, **r} for r in records])

    return make


@pytest.fixture
def raw_customers(spark):
    def make(*records):
        base = {"customer_id": "C1", "first_name": " Ada ", "last_name": "Low", "email": " A@B.C ",
                "city": "Rome", "state": "la", "country": "ita", "birth_date": "1990-12-31",
                "gender": "f", "income_bracket": "low", "cohort": "growing",
                "signup_date": "2024-06-02", "last_update_date": "2024-06-02"}
        return _text_frame(spark, RAW_CUSTOMERS, [{**base, **r} for r in records])

    return make


@pytest.fixture
def raw_products(spark):
    def make(*records):
        base = {"product_id": "P1", "product_name": "Pen", "category": "Office", "subcategory": "Ink",
                "brand": "B", "list_price": "12.00", "standard_cost": "4.00", "color": "red",
                "size": "N/A", "weight_kg": "0.1", "launch_date": "2024-06-05"}
        return _text_frame(spark, RAW_PRODUCTS, [{**base, **r} for r in records])

    return make
