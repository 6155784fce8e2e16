from datetime import date
from decimal import Decimal

import pytest
from conftest import TODAY, rows

from martline.functions import calendar as cal
from martline.operators import clean
from martline.operators.details import order_details
from martline.operators.metrics import customer_metrics, product_metrics, segment_customers
from martline.operators.sampling import assign_weighted
from martline.plans import cards, dates, marts
from martline.schemas import COHORT_WEIGHTS, INCOME_BRACKETS, INCOME_WEIGHTS


def test_money_measures(raw_sales, raw_customers, raw_products):
    sales = clean.stg_sales(
        raw_sales({}, {"line_item_id": "2", "product_id": "?"},
                  {"line_item_id": "3", "quantity": "0"}), as_of=TODAY
    )
    details = order_details(sales, clean.stg_products(raw_products({})),
                            clean.stg_customers(raw_customers({})))
    assert rows(details, "line_item_id", "gross_revenue", "net_revenue", "total_cost", "gross_profit",
                "net_profit", "profit_margin_pct") == [
        (1, 20.0, 18.0, 8.0, 12.0, 10.0, 50.0),
        (2, 20.0, 18.0, None, None, None, None),
        (3, 0.0, 0.0, 0.0, 0.0, 0.0, None),
    ]


@pytest.mark.parametrize(
    ("revenue", "orders", "last", "expected"),
    [
        (5000, 20, date(2024, 5, 31), ("HIGH_VALUE", "FREQUENT_BUYER", 30, "ACTIVE", "PLATINUM")),
        (4999, 10, date(2024, 5, 30), ("MID_VALUE", "REGULAR_BUYER", 31, "RECENT", "GOLD")),
        (5000, 9, date(2024, 4, 1), ("HIGH_VALUE", "REGULAR_BUYER", 90, "RECENT", "SILVER")),
        (1999, 4, date(2024, 1, 2), ("LOW_VALUE", "OCCASIONAL_BUYER", 180, "LAPSED", "SILVER")),
        (499, 1, date(2023, 1, 1), ("LOW_VALUE", "OCCASIONAL_BUYER", 546, "CHURNED", "BRONZE")),
        (0, 0, None, ("LOW_VALUE", "NEW_BUYER", None, "NEW", "BRONZE")),
    ],
)
def test_default_segment_limits(spark, revenue, orders, last, expected):
    totals = spark.createDataFrame([(Decimal(revenue), orders, last)],
                                   "total_revenue decimal(38,2), total_orders bigint, last_order_date date")
    row = segment_customers(totals, as_of=TODAY).first()
    assert tuple(row[3:]) == expected


def test_star_and_wide_table(spark, raw_sales, raw_customers, raw_products):
    customers = clean.stg_customers(raw_customers({}, {"customer_id": "C2"}))
    products = clean.stg_products(raw_products({}, {"product_id": "P2", "discontinued_date": "2024-06-20",
                                                    "list_price": "0"}))
    sales = clean.stg_sales(raw_sales({}, {"order_id": "B", "product_id": "nope", "ship_date": "2031-01-01"}),
                            as_of=TODAY)
    details = order_details(sales, products, customers)
    by_customer = customer_metrics(details, as_of=TODAY)
    customer_dim = marts.dim_customer(customers, by_customer, as_of=TODAY)
    product_dim = marts.dim_product(products, product_metrics(details), as_of=TODAY)
    assert rows(customer_dim, "customer_id", "age", "total_orders", "value_segment", "is_current") == [
        ("C1", 34, 2, "LOW_VALUE", 1), ("C2", 34, None, None, 1),
    ]
    assert rows(product_dim, "product_id", "markup_amount", "markup_pct", "product_status",
                "revenue_rank") == [
        ("P1", 8.0, pytest.approx(200 / 3), "ACTIVE", 1), ("P2", -4.0, None, "DISCONTINUED", None),
    ]
    days = dates.dim_date(dates.date_spine(spark))
    fact = marts.fact_sales(details, days)
    assert rows(fact, "order_id", "order_date_sk", "ship_date_sk") == [
        ("A", 20240601, 20240603), ("B", 20240601, None)]
    obt = marts.obt_sales(fact, customer_dim, product_dim, days)
    assert len(obt.columns) == 74
    assert obt.count() == 2
    assert rows(obt, "order_id", "product_name", "order_day_name", "ship_year") == [
        ("A", "Pen", "Saturday", 2024), ("B", None, "Saturday", None)]


def test_date_dimension_defaults(spark):
    days = dates.dim_date(dates.date_spine(spark))
    assert days.count() == 1826
    leap = days.where("date_actual = date'2024-02-29'").first().asDict()
    assert leap["date_sk"] == 20240229
    assert (leap["quarter_label"], leap["day_of_week"], leap["is_weekend"]) == ("Q1", 4, 0)
    assert leap["last_day_of_month"] == date(2024, 2, 29)
    assert days.where("is_holiday = 1").count() == 20


def test_retail_events_follow_the_fourth_friday(spark):
    spine = dates.date_spine(spark, date(2024, 1, 1), date(2025, 12, 31))
    assert rows(dates.retail_events(spine)) == [
        (2024, "Black Friday", date(2024, 11, 22)), (2024, "Cyber Monday", date(2024, 11, 25)),
        (2025, "Black Friday", date(2025, 11, 28)), (2025, "Cyber Monday", date(2025, 12, 1)),
    ]


def test_seasonality(spark):
    assert all(0.5 <= f <= 2.0 for f in cal.MONTH_FACTORS + cal.WEEKDAY_FACTORS)
    spine = dates.date_spine(spark, date(2025, 1, 1), date(2025, 12, 31))
    index = {r.date_actual: r.seasonality_index for r in
             dates.seasonality_index(spine, "date_actual").collect()}
    assert index[date(2025, 12, 25)] == pytest.approx(2.48)
    assert index[date(2025, 11, 28)] == 2.5
    assert all(0.3 <= v <= 2.5 for v in index.values())


def test_filters_leave_no_trace_when_unset(spark):
    obt = spark.createDataFrame(
        [(date(2024, 6, 1), "a", "x", 1.5), (date(2024, 6, 29), "b", "y", 2.0), (TODAY, "a", "y", 4.0)],
        "order_date date, channel string, category string, net_revenue double",
    )
    assert cards.EVERYTHING.apply(obt) is obt
    assert rows(cards.revenue_by_channel(obt, cards.last_days(TODAY))) == [("a", 1.5), ("b", 2.0)]
    chosen = cards.Filter(date_from=date(2024, 6, 2), channels=["a"], categories=["y"])
    assert rows(cards.kpi_revenue(obt, chosen)) == [(4.0,)]
    nothing = cards.Filter(date_from=date(2030, 1, 1))
    empty = obt.withColumn("order_id", obt["channel"])
    assert rows(cards.kpi_aov(empty, nothing)) == [(None,)]


def test_weighted_assignment_follows_the_weights(spark):
    ids = spark.range(20_000)
    cohorts = assign_weighted(ids, "id", COHORT_WEIGHTS, name="cohort")
    again = assign_weighted(ids.repartition(7), "id", COHORT_WEIGHTS, name="cohort")
    assert cohorts.exceptAll(again).count() == 0
    shares = {r.cohort: r["count"] / 20_000 for r in cohorts.groupBy("cohort").count().collect()}
    assert shares == {c: pytest.approx(w, abs=0.015) for c, w in COHORT_WEIGHTS.items()}
    table = {c: dict(zip(INCOME_BRACKETS, w)) for c, w in INCOME_WEIGHTS.items()}
    income = assign_weighted(cohorts, "id", table, name="income", by="cohort")
    heavy = income.where("cohort = 'LOYAL_HEAVY'").groupBy("income").count().collect()
    total = sum(r["count"] for r in heavy)
    assert {r.income: r["count"] / total for r in heavy} == {
        b: pytest.approx(w, abs=0.03) for b, w in zip(INCOME_BRACKETS, INCOME_WEIGHTS["LOYAL_HEAVY"])
    }
