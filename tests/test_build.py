from dataclasses import replace
from datetime import date, datetime

import pytest
from conftest import TODAY, rows
from pyspark.sql import functions as F

from martline.operators import quality
from martline.operators.details import stage_details
from martline.operators.quality import GateError
from martline.plans.build import Raw, Settings, build
from martline.sources import files


def _settings(tmp_path, **changes):
    return replace(Settings(str(tmp_path / "w"), TODAY, datetime(2024, 6, 30, 2)), **changes)


@pytest.fixture
def raw(raw_customers, raw_products, raw_sales):
    return Raw(
        raw_customers({}, {"customer_id": "C2", "city": "Oslo"}),
        raw_products({}, {"product_id": "P2"}),
        raw_sales({}, {"order_id": "B", "customer_id": "C2"}, {"order_id": "B", "customer_id": "C2"},
                  {"order_id": "Q", "quantity": "-1"}),
    )


def test_build_writes_all_layers_and_a_second_run_adds_to_them(spark, tmp_path, raw, raw_sales, raw_customers):
    tables = build(spark, raw, _settings(tmp_path))
    assert set(tables) == {
        "stg_customers", "stg_products", "stg_sales", "stg_sales_rejected", "dim_customer", "dim_product",
        "dim_date", "fact_sales", "obt_sales", "snap_customers", "snap_products", "gate_report",
    }
    assert rows(tables["obt_sales"], "order_id", "customer_city", "net_revenue") == [
        ("A", "Rome", 18.0), ("B", "Oslo", 18.0)]
    assert rows(tables["stg_sales_rejected"], "order_id") == [("Q",)]
    assert not rows(tables["gate_report"].where("violations > 0 AND check NOT LIKE 'sources%'"))

    later = replace(
        raw,
        customers=raw_customers({"city": "Bonn"}, {"customer_id": "C2", "city": "Oslo"}),
        sales=raw_sales({"quantity": "3"}, {"order_id": "late", "order_date": "2024-05-01"},
                        {"order_id": "N", "order_date": "2024-06-29"}),
    )
    run = datetime(2024, 7, 1, 2)
    tables = build(spark, later, _settings(tmp_path, as_of=date(2024, 7, 1), run_ts=run))
    assert rows(tables["fact_sales"], "order_id", "quantity") == [("A", 3), ("B", 2), ("N", 2)]
    history = tables["snap_customers"]
    assert rows(history.where("customer_id = 'C1'"), "city", "valid_to") == [("Bonn", None), ("Rome", run)]
    assert history.count() == 3


def test_failed_staging_gate_stops_before_the_marts(spark, tmp_path, raw, raw_sales, raw_customers):
    broken = replace(raw, sales=raw_sales({"product_id": "unknown"}),
                     customers=raw_customers({"email": None, "cohort": "other"}))
    with pytest.raises(GateError) as stop:
        build(spark, broken, _settings(tmp_path))
    assert stop.value.failed == {
        "stg_sales.product_id.relationship": 1,
        "stg_customers.email.not_null": 1,
        "stg_customers.cohort.accepted": 1,
    }
    assert files.exists(spark, str(tmp_path / "w" / "stg_sales"))
    assert not files.exists(spark, str(tmp_path / "w" / "dim_customer"))


def test_a_failed_gate_moves_no_pointer(spark, tmp_path, raw, raw_customers):
    tables = build(spark, raw, _settings(tmp_path))
    before = rows(files.load_table(spark, str(tmp_path / "w" / "stg_customers")), "customer_id", "email")
    broken = replace(raw, customers=raw_customers({"email": None}, {"customer_id": "C2"}))
    with pytest.raises(GateError):
        build(spark, broken, _settings(tmp_path, run_ts=datetime(2024, 7, 1, 2)))
    assert rows(files.load_table(spark, str(tmp_path / "w" / "stg_customers")), "customer_id", "email") == before
    assert rows(tables["dim_customer"], "customer_id") == rows(files.load_table(spark, str(tmp_path / "w" / "dim_customer")), "customer_id")


def test_fact_rules_are_counted_by_the_write(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    kind = "order_line_sk string, order_date date, quantity int, price int"

    def lines(*values):
        return spark.createDataFrame([(k, date(2024, m, 3), q, p) for k, m, q, p in values], kind)

    watch = quality.Watch("fact", not_null=["quantity"], accepted={"quantity": [1, 2]}, warnings={"cheap": F.col("price") < 5})
    files.upsert_increment(lines(("a", 1, 1, 1), ("b", 1, 2, 9), ("c", 2, 1, 3)), path, watch=watch)
    assert files.rule_counts(spark, path) == {"fact.quantity.not_null": 0, "fact.quantity.accepted": 0, "fact.cheap": 2}
    files.upsert_increment(lines(("c", 2, 2, 7), ("d", 3, 1, 2)), path, watch=watch)
    assert files.rule_counts(spark, path) == rows_of(watch.scan(files.read_table(spark, path)))
    with pytest.raises(GateError) as stop:
        files.upsert_increment(lines(("e", 3, None, 7), ("f", 3, 8, 7)), path, watch=watch)
    assert stop.value.failed == {"fact.quantity.not_null": 1, "fact.quantity.accepted": 1}
    assert rows(files.read_table(spark, path), "order_line_sk") == [("a",), ("b",), ("c",), ("d",)]


def rows_of(check):
    return {r["check"]: r["violations"] for r in check.counts.collect()}


def test_the_gate_reads_what_writes_have_counted(spark, tmp_path, raw, monkeypatch):
    def no_scan(self, rows):
        raise AssertionError(f"{self.table} is scanned")

    monkeypatch.setattr(quality.Watch, "scan", no_scan)
    monkeypatch.setattr(quality, "rules", lambda table, df, **c: quality.Check(quality.count_where(df, quality.Watch(table, **c).conditions).selectExpr("check", "'error' severity", "violations")))
    tables = build(spark, raw, _settings(tmp_path))
    assert tables["gate_report"].where("check = 'fact_sales.quantity.accepted'").first()["violations"] == 0


def test_a_fact_written_anew_is_what_the_dimensions_are_measured_on(spark, tmp_path, raw, monkeypatch):
    from martline.plans import build as building

    staged = []
    monkeypatch.setattr(building, "PART_BYTES", 1)
    monkeypatch.setattr(building, "stage_details", lambda *a, **k: staged.append(a) or stage_details(*a, **k))
    tables = build(spark, raw, _settings(tmp_path))
    assert not staged
    assert rows(tables["dim_customer"], "customer_id", "total_revenue") == [("C1", 18.0), ("C2", 18.0)]
    assert rows(tables["dim_product"], "product_id", "total_units_sold") == [("P1", 4), ("P2", None)]
    # An increment does not hold the lines of before, which the dimensions are measured on as well.
    later = build(spark, raw, _settings(tmp_path, run_ts=datetime(2024, 7, 1, 2)))
    assert len(staged) == 1
    for name in ("dim_customer", "dim_product", "fact_sales", "obt_sales"):
        columns = [c for c in tables[name].columns if c != "loaded_at"]
        assert rows(later[name], *columns) == rows(tables[name], *columns)


def test_rejects_and_gates_run_beside_the_writes_but_still_stop_the_build(spark, tmp_path, raw, monkeypatch):
    from martline.plans import build as building

    failed = quality.GateError({"made_up": 1})

    def broken(*args, **kwargs):
        raise failed

    monkeypatch.setattr(building, "anomaly_checks", broken)
    with pytest.raises(GateError):
        build(spark, raw, _settings(tmp_path))
    assert files.exists(spark, str(tmp_path / "w" / "obt_sales"))
    for name in ("dim_customer", "dim_product", "obt_sales"):
        assert not files.exists(spark, str(tmp_path / "w" / name / "_CURRENT"))
