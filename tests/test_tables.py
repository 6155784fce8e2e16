import random
from datetime import date, datetime
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F

from martline.operators import metrics
from martline.operators.history import current_rows, scd2_merge, scd2_overlaps
from martline.schemas import POS_EVENT, RAW_SALES
from martline.sources import files, parts
from martline.sources.snapshots import snapshot
from martline.sources.staging import stage, temporary_stages

D = date(2024, 3, 31)


def test_month_tables_are_gathered_before_writing(spark, tmp_path):
    rows_ = spark.range(0, 1000, 1, 8).selectExpr(
        "cast(id as string) as order_line_sk", "date_add(date'2024-01-01', int(id % 90)) as order_date")
    files.upsert_increment(rows_, str(tmp_path / "fact"))
    per_month = [len(list(m.glob("*.parquet"))) for m in (tmp_path / "fact").glob("data-*/sale_month=*")]
    assert per_month == [1, 1, 1]

FACT = "order_line_sk string, order_date date, unit_price double"


def _load(spark, path, records, schema=FACT, **options):
    files.upsert_increment(spark.createDataFrame(records, schema), str(path), **options)


def _files(spark, path, month):
    return {f for f in files.read_table(spark, str(path)).inputFiles() if f"sale_month={month}" in f}


def _fact(spark, path):
    return rows(files.read_table(spark, str(path)), "order_line_sk", "order_date", "unit_price")


def test_upsert_replaces_inserts_and_skips_late_rows(spark, tmp_path):
    path = tmp_path / "fact"
    _load(spark, path, [("a", D, 1.0), ("b", date(2024, 1, 5), 1.0), ("c", date(2024, 3, 1), 1.0)])
    update = [("a", D, 2.0), ("new", D, 3.0), ("next", date(2024, 4, 1), 4.0), ("late", date(2024, 3, 30), 5.0),
              ("c", date(2024, 4, 2), 6.0)]
    expected = [("a", D, 2.0), ("b", date(2024, 1, 5), 1.0), ("c", date(2024, 4, 2), 6.0), ("new", D, 3.0),
                ("next", date(2024, 4, 1), 4.0)]
    _load(spark, path, update)
    assert _fact(spark, path) == expected
    untouched = _files(spark, path, "2024-01")
    again = [r for r in update if r[0] != "late"]
    _load(spark, path, again)
    assert _fact(spark, path) == expected
    assert _files(spark, path, "2024-01") == untouched != set()


def test_upsert_empties_a_month_and_looks_back(spark, tmp_path):
    path = tmp_path / "fact"
    _load(spark, path, [("b", date(2024, 1, 5), 1.0), ("a", D, 1.0)])
    _load(spark, path, [("b", date(2024, 4, 2), 2.0)])
    assert _fact(spark, path) == [("a", D, 1.0), ("b", date(2024, 4, 2), 2.0)]
    assert not _files(spark, path, "2024-01")
    _load(spark, path, [("late", D, 7.0)], lookback_days=2)
    assert ("late", D, 7.0) in _fact(spark, path)


def test_upsert_adds_new_columns_and_refreshes(spark, tmp_path):
    path = tmp_path / "fact"
    _load(spark, path, [("a", D, 1.0)])
    _load(spark, path, [("b", D, 2.0, "x")], FACT + ", note string")
    assert rows(files.read_table(spark, str(path)), "order_line_sk", "note") == [("a", None), ("b", "x")]
    _load(spark, path, [("z", date(2020, 1, 1), 9.0)], full_refresh=True)
    assert _fact(spark, path) == [("z", date(2020, 1, 1), 9.0)]


@pytest.mark.parametrize("step", ["write", "swap", "clean"])
def test_a_broken_upsert_changes_nothing_or_all(spark, tmp_path, monkeypatch, step):
    """The run ends at a step of the commit; readers see old or new, and a rerun ends as an unbroken run."""
    first = [("a", D, 1.0), ("b", date(2024, 1, 5), 1.0)]
    update = [("b", D, 2.0), ("c", D, 3.0), ("d", date(2024, 4, 1), 4.0)]
    path, plain = tmp_path / "fact", tmp_path / "plain"
    for p in (path, plain):
        _load(spark, p, first)
    _load(spark, plain, update)
    old, new = _fact(spark, path), _fact(spark, plain)

    def stop(*args, **kwargs):
        raise RuntimeError("stopped")

    with monkeypatch.context() as broken, pytest.raises(RuntimeError):
        if step == "write":
            broken.setattr(files, "_writer", stop)
        elif step == "swap":
            broken.setattr(files, "_write_text", stop)
        else:
            broken.setattr(files, "names_in", stop)
        _load(spark, path, update)
    assert _fact(spark, path) == (new if step == "clean" else old)
    _load(spark, path, update)
    assert _fact(spark, path) == new
    _load(spark, path, update)
    assert len(list(path.glob("data-*"))) <= 4


def test_small_files_are_replaced_in_one_step(spark, tmp_path):
    path = str(tmp_path / "pointer")
    for text in ("one", "two\nlines"):
        files._write_text(spark, path, text)
        assert files._read_text(spark, path) == text
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["pointer"]


def test_saved_table_is_replaced_whole_and_keeps_one_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    first = files.save_table(spark.range(3), path)
    files.save_table(spark.range(5).union(files.load_table(spark, path)), path)
    assert first.count() == 3
    assert files.load_table(spark, path).count() == 8
    files.save_table(spark.range(1), path)
    assert len(list((tmp_path / "t").glob("version-*"))) == 2
    with pytest.raises(Exception, match="(?s).*"):
        files.save_table(spark.range(1).select(F.raise_error(F.lit("broken")).alias("id")), path)
    assert files.load_table(spark, path).count() == 1


def test_csv_is_read_as_text_and_bad_rows_are_kept(spark, tmp_path):
    path = str(tmp_path / "in.csv")
    header = ",".join(RAW_SALES.fieldNames())
    good = "A,1,2024-01-01,C,P,2,9.99,0,2024-01-02,x,y,z,Online"
    (tmp_path / "in.csv").write_text(f"{header}\n{good}\n{good},extra\nB,many\n")
    loaded = files.load_csv(spark, path, RAW_SALES, rejects=True).cache()
    assert rows(loaded, "order_id", "quantity", "channel") == [
        ("A", "2", "Online"), ("A", "2", "Online"), ("B", None, None)]
    assert loaded.where("_corrupt_record IS NOT NULL").count() == 2
    out = str(tmp_path / "out")
    files.write_csv(files.load_csv(spark, path, RAW_SALES), out)
    assert files.load_csv(spark, out, RAW_SALES).count() == 3


def test_csv_keeps_text_as_it_is(spark, tmp_path):
    texts = ['He said "hi", ok', "line\nbreak", "  lead", "tr  ", "", None, "back\\slash", '"', ",", "é🙂"]
    df = spark.createDataFrame([(str(i), t, "x") for i, t in enumerate(texts)], "id string, text string, last string")
    files.write_csv(df, str(tmp_path / "out"))
    assert rows(files.load_csv(spark, str(tmp_path / "out"), df.schema)) == rows(df)
    (tmp_path / "pandas.csv").write_text('id,text,last\n1,"He said ""hi"", ok",x\n2,"two\nlines",y\n')
    loaded = files.load_csv(spark, str(tmp_path / "pandas.csv"), df.schema)
    assert rows(loaded) == [("1", 'He said "hi", ok', "x"), ("2", "two\nlines", "y")]


def test_a_csv_file_without_line_breaks_in_fields_is_shared_by_tasks(spark, tmp_path):
    path, schema = tmp_path / "wide.csv", "id string, text string, last string"
    texts = ['plain', 'He said ""hi"", ok', " blank ", "é🙂", ""]
    path.write_text("id,text,last\n" + "".join(f'{i},"{texts[i % 5]}",\n' for i in range(60_000)))
    schema = spark.createDataFrame([], schema).schema
    one = files.load_csv(spark, str(path), schema)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(path.stat().st_size // 6))
    try:
        many = files.load_csv(spark, str(path), schema, multi_line=False)
        tasks = many.select(F.spark_partition_id().alias("task"), "id").groupBy("task").count().collect()
        assert len(tasks) > 4
        assert many.exceptAll(one).count() == one.exceptAll(many).count() == 0 and many.count() == 60_000
        stored = files.load_bronze(spark, {"wide": (str(path), schema)}, str(tmp_path / "bronze"), multi_line=False)
        assert stored["wide"].exceptAll(one).count() == 0 and stored["wide"].count() == 60_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_growing_table_is_created_once_and_missing_reads_empty(spark, tmp_path):
    path = str(tmp_path / "events")
    assert files.read_or_empty(spark, path, POS_EVENT).count() == 0
    files.ensure_table(spark, path, POS_EVENT)
    spark.createDataFrame([("e1",)], "event_id string").write.mode("append").parquet(path)
    files.ensure_table(spark, path, POS_EVENT)
    stored = files.read_or_empty(spark, path, POS_EVENT)
    assert stored.schema == POS_EVENT
    assert stored.count() == 1
    assert rows(files.table_counts({"b": stored, "a": stored.limit(0)})) == [("a", 0), ("b", 1)]


def test_temporary_stages_are_dropped(spark, tmp_path):
    with temporary_stages(spark):
        staged = stage(spark.range(3))
        path = staged.inputFiles()[0]
        assert files.exists(spark, path)
    assert not files.exists(spark, path)
    assert files.exists(spark, stage(spark.range(3)).inputFiles()[0])


RUNS = [datetime(2024, 1, day) for day in (1, 2, 3)]
PEOPLE = "id int, city string, gender string"


def _history(spark, *batches, **options):
    out = None
    for run, batch in zip(RUNS, batches):
        out = scd2_merge(out, spark.createDataFrame(batch, PEOPLE), "id", ["city"], run, **options)
    return out


def test_history_over_three_batches(spark):
    first = [(1, "Rome", "f"), (2, "Oslo", "m")]
    second = [(1, "Bonn", "f"), (2, "Oslo", "x"), (3, None, "f")]
    third = [(1, "Bonn", "f"), (3, "Lyon", "f")]
    out = _history(spark, first, second, third)
    assert rows(out, "id", "city", "gender", "valid_from", "valid_to") == [
        (1, "Bonn", "f", RUNS[1], None),
        (1, "Rome", "f", RUNS[0], RUNS[1]),
        (2, "Oslo", "m", RUNS[0], None),
        (3, "Lyon", "f", RUNS[2], None),
        (3, None, "f", RUNS[1], RUNS[2]),
    ]
    assert current_rows(out).count() == 3
    assert out.select("version_id").distinct().count() == 5
    again = scd2_merge(out, spark.createDataFrame(third, PEOPLE), "id", ["city"], datetime(2024, 1, 4))
    assert out.exceptAll(again).count() == 0
    assert again.count() == 5
    closed = _history(spark, first, second, third, invalidate_deletes=True)
    assert rows(closed.where("id = 2"), "valid_to") == [(RUNS[2],)]


def test_history_refuses_repeated_keys_and_carries_new_columns(spark):
    twice = spark.createDataFrame([(1, "Rome", "f"), (1, "Oslo", "f")], PEOPLE)
    for history in (None, _history(spark, [(1, "Rome", "f")])):
        with pytest.raises(Exception, match="id is not unique: 1"):
            scd2_merge(history, twice, "id", ["city"], RUNS[1]).collect()
    wider = spark.createDataFrame([(1, "Bonn", "f", "x"), (2, "Oslo", "m", "y")], PEOPLE + ", note string")
    out = scd2_merge(_history(spark, [(1, "Rome", "f")]), wider, "id", ["city"], RUNS[1])
    assert rows(out, "id", "city", "note", "valid_to", "updated_at") == [
        (1, "Bonn", "x", None, RUNS[1]), (1, "Rome", None, RUNS[1], RUNS[0]), (2, "Oslo", "y", None, RUNS[1])]
    narrow = scd2_merge(out, spark.createDataFrame([(2, "Oslo", "m")], PEOPLE), "id", ["city"], RUNS[2])
    assert rows(narrow) == rows(out)


def test_overlaps_are_found_only_by_the_strict_check(spark):
    out = _history(spark, [(1, "Rome", "f")], [(1, "Bonn", "f")])
    assert scd2_overlaps(out, "id").count() == scd2_overlaps(out, "id", strict=True).count() == 0
    two_open = out.withColumn("valid_to", F.lit(None).cast("timestamp"))
    assert scd2_overlaps(two_open, "id").count() == 0
    assert scd2_overlaps(two_open, "id", strict=True).count() == 1


def test_an_increment_opens_only_months_that_may_hold_its_keys(spark, tmp_path, monkeypatch):
    path = tmp_path / "fact"
    first = [(f"k{m}-{i}", date(2023 + m // 12, m % 12 + 1, 1 + i % 28), 1.0) for m in range(24) for i in range(60)]
    _load(spark, path, first)
    read, real = [], files._read_months

    def watched(spark, path, manifest, months=None):
        read.append(set(manifest["months"]) if months is None else set(months))
        return real(spark, path, manifest, months)

    monkeypatch.setattr(files, "_read_months", watched)
    _load(spark, path, [("k3-5", date(2025, 1, 2), 2.0), ("k17-0", date(2025, 1, 3), 2.0), ("new", date(2025, 1, 2), 3.0)])
    opened = set.union(*read)
    assert {"2023-04", "2024-06"} <= opened and len(opened) <= 5
    monkeypatch.undo()
    changed = {"k3-5": (date(2025, 1, 2), 2.0), "k17-0": (date(2025, 1, 3), 2.0)}
    expected = [(k, *changed.get(k, (d, p))) for k, d, p in first] + [("new", date(2025, 1, 2), 3.0)]
    assert _fact(spark, path) == sorted(expected, key=repr)


def test_filters_pass_every_key_and_few_others(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows_ = spark.range(40_000).selectExpr("concat('k', id) as order_line_sk", "date_add(date'2024-01-01', int(id % 60)) as order_date")
    files.upsert_increment(rows_, path)
    manifest = files._read_manifest(spark, path)

    def passing(keys):
        return files.months_that_may_hold(spark, path, manifest, keys.selectExpr("concat('k', id) as key"), "key")

    assert passing(spark.range(7, 8)) == {"2024-01"} and passing(spark.range(40, 41)) == {"2024-02"}
    hashed, mask = files._word_and_mask(F.concat(F.lit("k"), "id"))
    words = spark.read.parquet(f"{path}/{manifest['months']['2024-01']['folder']}/_filters").where("month = '2024-01'")
    n = manifest["months"]["2024-01"]["words"]
    asked = spark.range(1_000_000, 1_050_000).select(hashed.bitwiseAND(n - 1).alias("word"), mask.alias("mask"))
    assert asked.join(words, "word").where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")).count() < 1000


# stored history

RESIDENTS = "id string, city string, note string"


def _residents(spark, n=300, **moved):
    data = [(f"p{i}", moved.get(f"p{i}", f"city{i % 7}"), "x") for i in range(n)]
    return spark.createDataFrame(data, RESIDENTS)


def _stored_rows(path):
    return {p.name: sum(pq.read_table(f).num_rows for f in p.glob("*.parquet")) for p in path.glob("part=*")}


def test_a_snapshot_run_writes_its_changes_only(spark, tmp_path):
    path = tmp_path / "history"
    runs = [datetime(2024, 1, d) for d in (1, 2, 3)]
    states = [_residents(spark), _residents(spark, p7="Rome", p8="Oslo"), _residents(spark, 299, p7="Rome", p8="Bonn").withColumn("note", F.lit("y"))]
    merged = None
    for run, state in zip(runs, states):
        stored = snapshot(state, "id", ["city"], str(path), run, invalidate_deletes=True)
        merged = stage(scd2_merge(merged, state, "id", ["city"], run, invalidate_deletes=True))
        assert rows(stored, *merged.columns) == rows(merged)
    assert sorted(_stored_rows(path).values()) == [3, 4, 300]
    assert rows(snapshot(states[2], "id", ["city"], str(path), runs[2], invalidate_deletes=True), *merged.columns) == rows(merged)
    assert sorted(_stored_rows(path).values()) == [3, 4, 300]


def test_snapshots_merge_their_parts_and_take_new_columns(spark, tmp_path):
    path, merged = str(tmp_path / "history"), None
    for n in range(20):
        state = _residents(spark, 10, p1=f"c{n}", p2=None)
        if n > 15:
            state = state.withColumn("added", F.lit(n)).drop("note")
        run = datetime(2024, 1, 1 + n)
        stored = snapshot(state, "id", ["city"], path, run)
        if n in (0, 15, 16, 17):
            assert len(rows(stored.where("valid_to IS NULL"))) == 10
    versions = stored.where("id = 'p1'").orderBy("valid_from").collect()
    assert [v.city for v in versions] == [f"c{n}" for n in range(20)]
    assert [v.valid_to for v in versions] == [datetime(2024, 1, 2 + n) for n in range(19)] + [None]
    assert [v.added for v in versions] == [None] * 16 + [16, 17, 18, 19] and versions[-1].note is None
    assert stored.where("id = 'p2'").count() == 1
    assert len(parts.part_names(spark, path)) < parts.FAN


def test_a_snapshot_refuses_repeated_keys(spark, tmp_path):
    twice = _residents(spark, 2).union(_residents(spark, 1))
    with pytest.raises(ValueError, match="id is not unique: p0"):
        snapshot(twice, "id", ["city"], str(tmp_path / "history"), datetime(2024, 1, 1))
    assert not files.exists(spark, str(tmp_path / "history"))


# states of months


def _lines(spark, n, seed=0, months=6):
    """Lines of orders, some of which have lines in two months; keys and amounts may be null."""
    kind = ("order_line_sk string, order_id string, order_date date, customer_id string, customer_sk string, product_id string, "
            "product_sk string, quantity int, net_revenue decimal(12,2), gross_revenue decimal(12,2), total_cost decimal(12,2), "
            "net_profit decimal(12,2), profit_margin_pct double")  # fmt: skip
    rng, data = random.Random(seed), []
    for i in range(n):
        c, p = rng.choice([None, "c1", "c2", "c3"]), rng.choice(["p1", "p2", "p3", "p4"])
        price = Decimal(rng.randrange(10_000)) / 100
        day = date(2024, 1 + rng.randrange(months), 1 + rng.randrange(28))
        amounts = [rng.choice([None, price, price + 1]) for _ in range(4)]
        data.append((f"l{i}", f"o{rng.randrange(n // 3)}", day, c, c and f"s{c}", p, f"s{p}", rng.randrange(9), *amounts, rng.random() * 100))
    return spark.createDataFrame(data, kind)


def test_merged_metrics_equal_the_full_run(spark, tmp_path):
    path, states = str(tmp_path / "fact"), {"customer": metrics.customer_state, "product": metrics.product_state}
    lines = _lines(spark, 400)
    files.upsert_increment(lines.where("order_date < '2024-05-20'"), path, states=states)
    before = files._read_manifest(spark, path)["months"]
    files.upsert_increment(lines.where("order_date >= '2024-05-10'"), path, states=states)
    after = files._read_manifest(spark, path)["months"]
    assert sorted(m for m in before if before[m]["folder"] == after[m]["folder"]) == ["2024-01", "2024-02", "2024-03", "2024-04"]

    fact = files.read_table(spark, path)
    assert fact.count() == 400
    states = {name: files.read_state(spark, path, name) for name in states}
    assert all("_state_" in f for s in states.values() for f in s.inputFiles())
    by_customer = metrics.customer_metrics(fact, as_of=D)
    assert rows(metrics.merged_customer_metrics(states["customer"], as_of=D), *by_customer.columns) == rows(by_customer)
    by_product = metrics.product_metrics(fact)
    assert rows(metrics.merged_product_metrics(states["product"]), *by_product.columns) == rows(by_product)
    assert {f.name: f.dataType for f in metrics.merged_product_metrics(states["product"]).schema} == {f.name: f.dataType for f in by_product.schema}
