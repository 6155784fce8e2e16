"""The ways taken for large or skewed data give the same results as the plain ones."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from martline.operators.joins import estimated_bytes, hot_keys, left_join, orphan_rows, orphans, staged_hot_keys
from martline.operators.ranking import global_rank
from martline.operators.temporal import availability_counts, availability_per_product, available_on
from martline.plans.dates import date_spine


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    keys = ["hot"] * 400 + [None] * 100 + [f"k{rng.randrange(60)}" for _ in range(500)]
    return spark.createDataFrame([(f"line{i}", k, i % 7) for i, k in enumerate(keys)],
                                 "line string, key string, n int")


@pytest.fixture(scope="module")
def dimension(spark):
    return spark.createDataFrame(
        [("hot", 1), *[(f"k{i}", i) for i in range(50)], ("k3", 333), ("unused", 0)], "key string, v int"
    )


def test_salted_join_equals_plain_join(skewed, dimension):
    salted = left_join(skewed, dimension, "key", "line", hot=hot_keys(skewed, "key"), limit=0)
    assert rows(salted, "line", "key", "n", "v") == rows(
        skewed.join(dimension, "key", "left"), "line", "key", "n", "v"
    )


def test_salted_join_spreads_the_hot_key(spark, skewed, dimension):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left_join(skewed, dimension, "key", "line", hot=hot_keys(skewed, "key"), limit=0)
        parts = joined.where("key = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_keys_are_few(skewed):
    hot = hot_keys(skewed, "key", pieces=8).collect()
    assert [r["key"] for r in hot] == ["hot"]
    assert sum(r["_salts"] for r in hot) <= 16


def test_hot_keys_of_several_columns_are_counted_at_once(skewed):
    both = staged_hot_keys(skewed, ["key", "n"], pieces=8)
    assert rows(both["key"]) == rows(hot_keys(skewed, "key", pieces=8))
    assert rows(both["n"]) == rows(hot_keys(skewed, "n", pieces=8))
    assert both["n"].schema["n"].dataType == skewed.schema["n"].dataType


def test_small_written_dimension_is_left_to_catalyst(spark, tmp_path, skewed, dimension):
    dimension.write.parquet(str(tmp_path / "dim"))
    small = spark.read.parquet(str(tmp_path / "dim"))
    assert estimated_bytes(small) < 10 * 2**20
    plan = left_join(skewed, small, "key", "line", hot=hot_keys(skewed, "key"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "_salt" not in plan


def test_orphans_match_brute_force(skewed, dimension):
    known = {r.key for r in dimension.collect()}
    values = [r.key for r in skewed.collect()]
    missing = {v for v in values if v not in known}
    assert {r.key for r in orphans(skewed, dimension, "key").collect()} == missing
    assert orphan_rows(skewed, dimension, "key").count() == sum(v in missing for v in values)


def test_ranks_equal_brute_force(spark):
    rng = random.Random(3)
    # Half of the rows share one value, some have none.
    values = [0] * 500 + [None] * 50 + [rng.randrange(1000) for _ in range(450)]
    df = spark.createDataFrame([(f"id{i:04}", v, float(i % 10)) for i, v in enumerate(values)],
                               "id string, a int, b double")
    ranks = {"rank_a": "a", "rank_b": "b"}
    ranked = global_rank(df, ranks, "id")
    assert dict(ranked.dtypes)["rank_a"] == dict(ranked.dtypes)["rank_b"] == "bigint"
    wide = rows(ranked, "id", "rank_a", "rank_b")
    assert wide == rows(global_rank(df.repartition(13), ranks, "id"), "id", "rank_a", "rank_b")
    data = sorted(range(1000), key=lambda i: (values[i] is None, -(values[i] or 0), f"id{i:04}"))
    expected = {f"id{i:04}": n for n, i in enumerate(data, 1)}
    assert {r[0]: r[1] for r in wide} == expected


def test_availability_equals_brute_force(spark):
    from datetime import date, timedelta

    rng = random.Random(5)
    start = date(2024, 1, 1)
    spans = []
    for i in range(40):
        launch = start + timedelta(rng.randrange(-30, 60))
        gone = None if rng.random() < 0.5 else launch + timedelta(rng.randrange(0, 40))
        spans.append((f"p{i}", launch, gone))
    products = spark.createDataFrame(spans, "product_id string, launch_date date, discontinued_date date")
    days = date_spine(spark, start, start + timedelta(44)).where("dayofweek(date_actual) <> 1")
    listed = sorted(r["date_actual"] for r in days.collect())
    expected = [(p, d) for p, a, z in spans for d in listed if a <= d and (z is None or z > d)]
    assert rows(available_on(products, days), "product_id", "date_actual") == sorted(
        expected, key=repr
    )

    counts = {r["date_actual"]: r["products"] for r in
              availability_counts(products, listed[0], listed[-1]).collect()}
    running = 0
    for offset in range((listed[-1] - listed[0]).days + 1):
        day = listed[0] + timedelta(offset)
        running = counts.get(day, running)
        assert running == sum(a <= day and (z is None or z > day) for _, a, z in spans)


def test_availability_per_product_lists_no_days(spark):
    from datetime import date, timedelta

    rng = random.Random(6)
    start = date(2024, 1, 1)
    spans = [("p0", None, None), (None, start, None), ("p1", start, None), ("p1", start + timedelta(20), start + timedelta(22))]
    for i in range(60):
        launch = start + timedelta(rng.randrange(-30, 60))
        spans.append((f"p{i}", launch, None if i % 2 else launch + timedelta(rng.randrange(0, 6))))
    products = spark.createDataFrame(spans, "product_id string, launch_date date, discontinued_date date")
    spine = date_spine(spark, start, start + timedelta(44)).where("day(date_actual) % 4 <> 1")
    days = spine.unionAll(spine).unionAll(spark.createDataFrame([(None,)], "date_actual date"))
    found = availability_per_product(products, days)
    listed = available_on(products, days).groupBy("product_id").agg(
        F.count("*"), F.min("date_actual"), F.max("date_actual"))
    assert rows(found) == rows(listed)
    assert "sequence(_start" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert rows(availability_per_product(products, days.limit(0))) == []


def test_hashed_keys_are_set_aside_and_put_back(spark):
    from martline.functions.keys import hash_key, packed, put_back, set_aside

    df = spark.createDataFrame([("a", 1), (None, 2), ("", None)], "k string, n int")
    known = df.select("*", hash_key("k", "n").alias("sk"))
    odd = df.select("*", F.lit("other").alias("sk")).union(df.select("*", F.lit(None).cast("string")))
    both = known.union(odd)
    short = set_aside(both, "sk", ["k", "n"])
    assert "sk" not in short.columns
    assert short.where("_odd_sk IS NOT NULL").count() == 3
    assert rows(put_back(short, "sk", ["k", "n"]), "k", "n", "sk") == rows(both)
    texts = ["", "0" * 32, "AB" * 16, "ab" * 16, "zz" * 16, "ab" * 8, "\x01" + "a" * 16, "0" * 31, "é", None]
    shown = spark.createDataFrame([(t,) for t in texts], "t string").select("t", packed(F.col("t")).alias("p")).collect()
    assert len({bytes(r.p) for r in shown if r.t is not None}) == len(texts) - 1
    assert {r.t: r.p and len(r.p) for r in shown}["ab" * 16] == 17
    assert [r.t for r in shown if r.p is None] == [None]


def test_joins_move_no_hashes_and_keep_odd_keys(spark):
    from martline.operators.details import order_details

    sales = spark.createDataFrame(
        [("s1", "o1", 1, "c1", "p1"), (None, "o2", 2, "c2", "p2"), ("s3", None, None, "c9", None)],
        "order_line_sk string, order_id string, line_item_id int, customer_id string, product_id string",
    ).selectExpr("*", "2 AS quantity", "10.0BD AS unit_price", "1.0BD AS discount_amount", "current_timestamp() AS loaded_at")
    more = sales.where("order_id = 'o1'").withColumn("order_line_sk", F.expr("md5('o1|1')"))
    products = spark.createDataFrame([("p1", "odd"), ("p2", None)], "product_id string, product_sk string").selectExpr(
        "*", "3.0BD AS list_price", "1.0BD AS standard_cost")
    customers = spark.createDataFrame([("c1",), ("c2",), ("c2",)], "customer_id string").selectExpr("*", "md5(customer_id) AS customer_sk")
    joined = order_details(sales.union(more), products, customers)
    plain = sales.union(more).join(products, "product_id", "left").join(customers, "customer_id", "left")
    keys = ["order_line_sk", "order_id", "customer_id", "product_id", "product_sk", "customer_sk", "list_price"]
    assert rows(joined, *keys) == rows(plain, *keys)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = order_details(sales, products, customers)._jdf.queryExecution().optimizedPlan().toString()
        below = plan[plan.index("Join LeftOuter"):].split("\n")[0:2]
        assert not any("order_line_sk" in line and "_odd_" not in line for line in below)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_metrics_count_distinct_values_apart_from_the_totals(spark):
    from datetime import date
    from decimal import Decimal

    from martline.operators.metrics import customer_metrics, product_totals

    rng = random.Random(8)
    data = [(rng.choice(["c1", "c2", None]), rng.choice([None, "x"]), rng.choice(["p1", "p2", "p3"]), "sk", rng.choice(["o1", "o2", None]),
             rng.choice([None, date(2024, 1, 5), date(2024, 2, 5)]), rng.randrange(9), *[Decimal(rng.randrange(99))] * 4, rng.random()) for _ in range(300)]
    money = ", ".join(f"{c} decimal(18,2)" for c in ("net_revenue", "gross_revenue", "total_cost", "net_profit"))
    details = spark.createDataFrame(data, "customer_id string, customer_sk string, product_id string, product_sk string, "
                                    f"order_id string, order_date date, quantity int, {money}, profit_margin_pct double")  # fmt: skip
    found = customer_metrics(details, as_of=date(2024, 6, 1))
    direct = details.groupBy("customer_id", "customer_sk").agg(
        F.countDistinct("order_id").alias("total_orders"), F.count("*").alias("total_line_items"), F.sum("net_revenue").alias("total_revenue"),
        F.countDistinct("product_id").alias("products"), F.countDistinct(F.trunc("order_date", "MM")).alias("months"))
    assert rows(found, "customer_id", "customer_sk", "total_orders", "total_line_items", "total_revenue", "distinct_products_purchased",
                "active_months") == rows(direct)
    assert "Expand" not in found._jdf.queryExecution().optimizedPlan().toString()
    plain = details.groupBy("product_id", "product_sk").agg(F.countDistinct("order_id"), F.countDistinct("customer_id"))
    assert rows(product_totals(details), "product_id", "product_sk", "total_orders", "unique_customers") == rows(plain)
    assert "total_orders" not in product_totals(details, counts=[]).columns


def test_rank_tables_are_written_with_zstd(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "id string, a int")
    files = global_rank(df, {"rank_a": "a"}, "id").inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def _lines(spark):
    """Details as the library makes them, and some whose keys and measures are other ones."""
    from martline.operators.details import with_measures

    data = [(f"o{i}", i % 3, f"c{i % 5}", f"p{i % 4}", f"2024-0{i % 4 + 1}-05", i, i * 3, 1, None if i % 7 == 0 else i) for i in range(1, 40)]
    names = "order_id string, line_item_id int, customer_id string, product_id string, day string, quantity int, p int, d int, c int"
    money = {"unit_price": "p", "discount_amount": "d", "standard_cost": "c"}
    lines = spark.createDataFrame(data, names).selectExpr(
        "order_id", "line_item_id", "customer_id", "product_id", "CAST(nullif(day, '2024-04-05') AS date) AS order_date",
        "CAST(day AS date) AS ship_date", "quantity", *[f"CAST({c} AS decimal(10,2)) AS {n}" for n, c in money.items()],
        "md5(concat_ws('|', order_id, CAST(line_item_id AS string))) AS order_line_sk", "md5(customer_id) AS customer_sk",
        "IF(product_id = 'p2', NULL, md5(product_id)) AS product_sk")
    lines = with_measures(lines)
    odd = F.col("quantity") % 5 == 0
    return lines.withColumns({"net_revenue": F.when(~odd, F.col("net_revenue")),
                              "customer_sk": F.when(odd, F.lit("odd")).otherwise(F.col("customer_sk"))})


def test_measures_are_set_aside_and_put_back(spark):
    from martline.functions.keys import put_back_values, set_aside_values
    from martline.operators.details import MEASURES

    lines = _lines(spark)
    short = set_aside_values(lines, MEASURES)
    assert not {*MEASURES.values()} & set(short.columns)
    assert 0 < short.where("_odd_values IS NOT NULL").count() < short.count()
    assert rows(put_back_values(short, MEASURES), *lines.columns) == rows(lines)
    other = lines.withColumn("net_revenue", F.lit("text"))
    assert set_aside_values(other, MEASURES).columns == other.columns
    assert set_aside_values(lines.drop("standard_cost"), MEASURES).columns == lines.drop("standard_cost").columns


def test_staged_details_hold_no_hashes_or_measures_and_read_as_they_were(spark):
    from martline.operators.details import stage_details

    lines = _lines(spark)
    staged = stage_details(lines)
    assert staged.columns == lines.columns and rows(staged) == rows(lines)
    stored = spark.read.parquet(*staged.inputFiles()).columns
    assert not {"order_line_sk", "customer_sk", "gross_profit", "profit_margin_pct"} & set(stored)
    some = ["customer_id", "customer_sk", "net_revenue", "order_date"]
    narrow = stage_details(lines, some)
    assert rows(narrow) == rows(lines.select(*some))
    assert not {"ship_date", "line_item_id", "product_id"} & set(spark.read.parquet(*narrow.inputFiles()).columns)


def test_states_are_stored_without_hashes(spark, tmp_path):
    import json

    from martline.operators.details import HASHED, MEASURES
    from martline.operators.metrics import customer_state
    from martline.sources import files

    lines, path = _lines(spark), str(tmp_path / "fact")
    files.upsert_increment(lines, path, states={"customer": customer_state}, hashed=HASHED, derived=MEASURES)
    stored = files.read_table(spark, path)
    assert rows(stored, *lines.columns) == rows(lines)
    plain = customer_state(stored)
    assert rows(files.read_state(spark, path, "customer"), *plain.columns) == rows(plain)
    manifest = json.loads((tmp_path / "fact" / "_MANIFEST").read_text())
    for entry in manifest["months"].values():
        assert "customer_sk" not in [f["name"] for f in entry["states"]["customer"]["fields"]]


def test_shuffle_files_go_when_a_query_ends(spark, tmp_path):
    from pathlib import Path

    from martline.sources.staging import shuffles_freed

    folder = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")

    def shuffled(name):
        found = set(folder.parent.rglob("shuffle_*.data"))
        spark.range(5000).groupBy((F.col("id") % 1000).alias("k")).count().write.parquet(str(tmp_path / name))
        return set(folder.parent.rglob("shuffle_*.data")) - found

    assert shuffled("kept")
    with shuffles_freed(spark):
        assert not shuffled("freed")
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == before


def test_wide_table_is_written_in_parts_of_whole_months(spark, tmp_path):
    from martline.sources import files

    lines, path = _lines(spark), str(tmp_path / "fact")
    files.upsert_increment(lines, path)
    fact = files.read_table(spark, path)
    parts = files.in_parts(fact, 3)
    assert len(parts) == 3 and len(files.in_parts(fact, 99)) == 4 and files.in_parts(fact, 1) == [fact]
    months = [{r[0] for r in p.select("sale_month").distinct().collect()} for p in parts]
    assert sum(map(len, months)) == len(set().union(*months)) == 4
    written, version = files.write_version_in_parts(iter(parts), str(tmp_path / "wide"), files.MONTH)
    assert rows(written, *fact.columns) == rows(fact)
    assert rows(files.commit_version(written, str(tmp_path / "wide"), version)) == rows(files.load_table(spark, str(tmp_path / "wide")))


def test_a_table_written_in_parts_is_the_one_written_whole(spark, tmp_path):
    from martline.sources import files

    lines = _lines(spark)
    files.upsert_increment(lines, str(tmp_path / "whole"))
    files.upsert_increment(lines, str(tmp_path / "parts"), parts=3)
    whole, parts = (files.read_table(spark, str(tmp_path / name)) for name in ("whole", "parts"))
    assert rows(parts) == rows(whole)
    months = (files._read_manifest(spark, str(tmp_path / name))["months"] for name in ("whole", "parts"))
    assert len({tuple(sorted((m, e["newest"], e["words"]) for m, e in found.items())) for found in months}) == 1


def test_details_are_gone_before_the_wide_table_and_checks_run_one_by_one(spark, tmp_path, monkeypatch, raw_sales, raw_customers, raw_products):
    from datetime import date, datetime

    from martline.operators import quality
    from martline.plans import build as building
    from martline.plans import marts
    from martline.sources import staging

    raw = building.Raw(raw_customers({}), raw_products({}), raw_sales({}))
    settings = building.Settings(root=str(tmp_path / "w"), as_of=date(2024, 6, 30), run_ts=datetime(2024, 6, 30, 2))
    staged, there, asked = [], [], []
    path_of, wide, gate = staging.new_path, marts.obt_sales, quality.run_gate
    monkeypatch.setattr(staging, "new_path", lambda s, name: staged.append(path_of(s, name)) or staged[-1])
    monkeypatch.setattr(marts, "obt_sales", lambda *a, **k: there.extend(p for p in staged if "/details-" in p and staging_exists(spark, p)) or wide(*a, **k))
    monkeypatch.setattr(quality, "run_gate", lambda checks: asked.append(len(checks)) or gate(checks))
    assert building.build(spark, raw, settings)["obt_sales"].count() == 1
    assert any("/details-" in p for p in staged) and not there
    assert set(asked) == {1}


def staging_exists(spark, path):
    from martline.sources.fs import exists

    return exists(spark, path)


def test_rows_are_as_often_as_a_join_returns_them(skewed, dimension):
    from martline.operators.joins import as_often_as_joined

    again = dimension.unionByName(dimension.where("key = 'hot' or key = 'k7'"))
    assert rows(as_often_as_joined(skewed, again, "key"), *skewed.columns) == rows(skewed.join(again, "key", "left").select(*skewed.columns))


def test_tables_are_stored_without_hashes_and_measures(spark, tmp_path):
    from martline.operators.details import HASHED, MEASURES
    from martline.sources import files

    lines, made = _lines(spark), {*HASHED, *MEASURES.texts}
    fact, version = str(tmp_path / "fact"), str(tmp_path / "version")
    files.upsert_increment(lines, fact, hashed=HASHED, derived=MEASURES, parts=2)
    written, name = files.write_version_in_parts([lines], version, None, hashed=HASHED, derived=MEASURES)
    files.commit_version(written, version, name)
    for stored in (files.read_table(spark, fact), written, files.load_table(spark, version)):
        assert rows(stored, *lines.columns) == rows(lines)
        assert [stored.schema[c].dataType for c in lines.columns] == [f.dataType for f in lines.schema]
        assert not made & set(spark.read.option("recursiveFileLookup", "true").parquet(*stored.inputFiles()).columns)


def test_details_written_in_parts_are_the_ones_written_whole(spark):
    from martline.operators.details import stage_details
    from martline.plans.build import _shares

    lines = _lines(spark)
    shares = _shares(lines, 3)
    orders = [{r[0] for r in part.select("order_id").distinct().collect()} for part in shares]
    assert sum(map(len, orders)) == len(set().union(*orders))
    assert rows(stage_details(shares), *lines.columns) == rows(lines)


def test_row_rules_add_up_over_the_parts_of_a_table(spark, tmp_path):
    from martline.operators.quality import Watch
    from martline.sources import files

    watch = Watch("t", not_null=["x"])
    part = spark.createDataFrame([(1, None), (2, "a")], "id int, x string")
    files.write_version_in_parts([part, part], str(tmp_path / "t"), None, watch)
    assert watch.seen() == {"t.x.not_null": 2}


def test_keys_are_counted_one_by_one_only_in_full_buckets(spark, skewed, monkeypatch):
    from martline.operators import joins

    written, stage = [], joins.stage
    monkeypatch.setattr(joins, "stage", lambda df, name: written.append(name) or stage(df, name))
    even = spark.range(6400).select(F.col("id").cast("string").alias("key"))
    assert not rows(staged_hot_keys(even, ["key"], pieces=8)["key"]) and written == ["key-buckets"]
    assert rows(staged_hot_keys(skewed, ["key"], pieces=8)["key"]) == rows(hot_keys(skewed, "key", pieces=8))
    assert written[1:] == ["key-buckets", "hot-keys"]


def test_short_details_are_the_details_once_they_are_put_back(spark):
    from martline.functions.keys import put_back, put_back_values
    from martline.operators.details import HASHED, MEASURES, order_details, short_details

    kind = "order_id string, line_item_id int, order_line_sk string, customer_id string, product_id string, quantity int, "
    kind += "unit_price decimal(10,2), discount_amount decimal(10,2), loaded_at timestamp"
    sales = spark.createDataFrame([("a", 1, "own", "c1", "p1", 2, None, None, None), ("b", None, None, None, "p2", 3, None, None, None),
                                   ("c", 2, "x", "c9", None, None, None, None, None)], kind)
    priced = {"unit_price": F.lit("7.50").cast("decimal(10,2)"), "discount_amount": F.lit("0.25").cast("decimal(10,2)")}
    sales = sales.withColumns(priced).withColumn("order_line_sk", F.when(F.col("order_line_sk") == "own", F.md5(F.lit("a|1"))).otherwise(F.col("order_line_sk")))
    products = spark.createDataFrame([("p1", "odd"), ("p2", None)], "product_id string, product_sk string").withColumns(
        {"list_price": F.lit(9).cast("decimal(10,2)"), "standard_cost": F.lit(3).cast("decimal(10,2)")})
    customers = spark.createDataFrame([("c1",)], "customer_id string").withColumn("customer_sk", F.md5("customer_id"))
    short = short_details(sales, products, customers)
    assert not {*HASHED, *MEASURES.texts} & set(short.columns)
    whole = order_details(sales, products, customers)
    for key, columns in HASHED.items():
        short = put_back(short, key, columns)
    assert rows(put_back_values(short, MEASURES), *whole.columns) == rows(whole)


def test_keys_set_aside_are_checked_as_whole_ones(spark):
    from martline.functions.keys import packed, packed_key, set_aside
    from martline.operators import quality

    dim = spark.createDataFrame([("c1",), ("c2",), ("c4",)], "customer_id string").select(F.md5("customer_id").alias("customer_sk"))
    made = F.when(F.col("n") == 0, F.md5("customer_id")).when(F.col("n") == 1, F.md5(F.lit("c4"))).when(F.col("n") == 2, F.lit("none"))
    records = [("c1", 0), ("c1", 0), ("c3", 0), ("c2", 1), ("c2", 2), ("c5", 3), (None, 0)]
    fact = spark.createDataFrame(records, "customer_id string, n int").withColumn("customer_sk", made)
    short = set_aside(fact, "customer_sk", ["customer_id"])
    names = {"broken": "b", "orphan_keys": "k", "orphan_rows": "r", "made_of": ["customer_id"]}
    counts = [rows(quality.foreign_key(df, "customer_sk", dim, "customer_sk", **names).counts) for df in (fact, short)]
    assert counts[0] == counts[1] == [("b", quality.ERROR, 2), ("k", quality.WARN, 3), ("r", quality.WARN, 4)]
    packed_rows = [rows(df.select(key.alias("key"))) for df, key in ((fact, packed(F.col("customer_sk"))), (short, packed_key(short, "customer_sk", ["customer_id"])))]
    assert packed_rows[0] == packed_rows[1]


def test_a_table_by_month_is_read_as_it_is_stored(spark, tmp_path):
    from martline.functions.keys import put_back, put_back_values
    from martline.operators.details import HASHED, MEASURES
    from martline.sources import files

    lines, stored, plain = _lines(spark), str(tmp_path / "stored"), str(tmp_path / "plain")
    files.upsert_increment(lines, plain)
    shares = [lines.where("quantity % 2 = 0"), lines.where("quantity % 2 <> 0 OR quantity IS NULL")]
    files.upsert_increment(shares, stored, hashed=HASHED, derived=MEASURES)
    assert rows(files.read_table(spark, stored), *lines.columns) == rows(lines)
    for path in (stored, plain):  # a table that was stored whole is shortened when it is read
        short = files.read_short(spark, path, HASHED, MEASURES)
        assert not set(MEASURES.texts) & set(short.columns) and "order_line_sk" not in short.columns
        for key, columns in HASHED.items():
            short = put_back(short, key, columns)
        assert rows(put_back_values(short, MEASURES), *lines.columns) == rows(lines)


def test_queries_on_details_give_the_same_rows_in_shares(spark, monkeypatch):
    from conftest import TESTDATA

    import workload
    from martline.plans import build as building

    cleanup = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    whole = {name: workload.QUERIES[name](spark, str(TESTDATA)) for name in ("order_details", "obt_sales")}
    found = {name: rows(df, *sorted(df.columns)) for name, df in whole.items()}
    monkeypatch.setattr(building, "SHARE_BYTES", 1)
    monkeypatch.setattr(building, "MOST_QUERY_SHARES", 2)
    assert len(workload._detail_shares(spark, str(TESTDATA), workload.BATCH_DAY, False)) == 2
    for name, expected in found.items():
        shared = workload.QUERIES[name](spark, str(TESTDATA))
        assert rows(shared, *sorted(shared.columns)) == expected
        # What is returned reads written rows, so no shuffle of lines stays on disk while it is read.
        assert "Exchange" not in shared._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == cleanup
