import json
import os
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from martline.schemas import POS_EVENT
from martline.sources import files, parts
from martline.streaming import ingest as streams
from martline.streaming import live


def _event(n, **changes):
    event = {
        "event_id": f"e{n}", "order_id": f"o{n}", "line_item_id": 1, "order_date": "2024-06-01",
        "store_id": f"S{n % 2}", "store_name": "Shop", "pos_terminal_id": "T", "customer_id": "C1",
        "product_id": "P1", "quantity": 2, "unit_price": 50.0, "discount_amount": 5.0,
        "ship_date": "2024-06-01", "ship_city": "Rome", "ship_state": "LA", "ship_country": "ITA",
        "channel": "POS_Retail", "payment_method": "Card",
        "created_at": f"2024-06-01T10:00:{n:02}.250000+00:00",
    }
    event.update(changes)
    return {k: v for k, v in event.items() if v is not ...}


def _send(folder, name, *messages):
    folder.mkdir(exist_ok=True)
    lines = [m if isinstance(m, str) else json.dumps(m) for m in messages]
    (folder / f"{name}.txt").write_text("\n".join(lines) + "\n")


def _drain(spark, tmp_path, state="state", **options):
    messages = streams.read_pos_stream(spark, "files", path=str(tmp_path / "inbox"))
    query = streams.ingest(messages, str(tmp_path / "events"), str(tmp_path / state), **options)
    query.awaitTermination()
    return query


def _stored(spark, tmp_path):
    return files.read_table(spark, str(tmp_path / "events"))


def test_each_event_is_stored_once(spark, tmp_path):
    inbox = tmp_path / "inbox"
    _send(inbox, "1", _event(1), _event(2), _event(1))
    _drain(spark, tmp_path)
    assert rows(streams.ingest_summary(spark, str(tmp_path / "events")), "batches", "messages", "rejected") == [(1, 3, 0)]
    assert _stored(spark, tmp_path).count() == 2
    _send(inbox, "2", _event(2, unit_price=9.0), _event(3))
    _drain(spark, tmp_path)
    assert rows(_stored(spark, tmp_path), "event_id", "unit_price") == [
        ("e1", 50.0), ("e2", 50.0), ("e3", 50.0)]
    _drain(spark, tmp_path)
    _drain(spark, tmp_path, state="lost-checkpoint")
    assert _stored(spark, tmp_path).count() == 3


def test_bad_messages_are_set_aside_and_gaps_get_defaults(spark, tmp_path):
    bad = ["{broken", json.dumps([_event(7)]), "5", json.dumps(_event(8, event_id=...))]
    _send(tmp_path / "inbox", "1", *bad, _event(1, line_item_id=..., discount_amount=...))
    _drain(spark, tmp_path)
    row = _stored(spark, tmp_path).first()
    assert (row.event_id, row.line_item_id, row.discount_amount) == ("e1", 1, 0.0)
    assert row.order_date == date(2024, 6, 1)
    assert row.created_at == datetime(2024, 6, 1, 10, 0, 1, 250000)
    rejects = streams.ingest_rejects(spark, str(tmp_path / "events"))
    assert sorted(r.value for r in rejects.collect()) == sorted(bad)


def test_explicit_nulls_stay_and_loose_types_are_cast(spark, tmp_path):
    nulls = _event(1, line_item_id=None, discount_amount=None, quantity="2", unit_price="1.5")
    _send(tmp_path / "inbox", "1", nulls, _event(2, quantity=2.0, unit_price=3, order_date="soon"), {"event_id": "e3"})
    _drain(spark, tmp_path)
    assert rows(_stored(spark, tmp_path), "event_id", "line_item_id", "discount_amount", "quantity", "unit_price", "order_date") == [
        ("e1", None, None, 2, 1.5, date(2024, 6, 1)), ("e2", 1, 5.0, 2, 3.0, None), ("e3", 1, 0.0, None, None, None)]


def test_the_first_arrival_of_an_event_is_stored(spark, tmp_path):
    _send(tmp_path / "inbox", "1", *[_event(1, quantity=n) for n in range(1, 9)])
    _drain(spark, tmp_path)
    assert rows(_stored(spark, tmp_path), "event_id", "quantity") == [("e1", 1)]
    batch = spark.createDataFrame([("a", 2, 7), ("a", 1, 9), ("a", 1, 8)], "event_id string, partition int, offset int")
    kept = streams.unseen(batch.repartition(3), batch.limit(0), "event_id", ["partition", "offset"])
    assert rows(kept) == [("a", 1, 8)]


def test_the_summary_counts_the_whole_run(spark, tmp_path):
    """Spark keeps the progress of the last 100 batches only."""
    for n in range(105):
        _send(tmp_path / "inbox", f"{n:03}", _event(n % 60), "{broken")
    messages = streams.read_pos_stream(spark, "files", path=str(tmp_path / "inbox"), maxFilesPerTrigger="1")
    streams.ingest(messages, str(tmp_path / "events"), str(tmp_path / "state")).awaitTermination()
    summary = streams.ingest_summary(spark, str(tmp_path / "events")).first()
    assert (summary.batches, summary.messages, summary.rejected) == (105, 210, 105)
    assert summary.seconds > 0
    assert streams.ingest_summary(spark, str(tmp_path / "none")).first().batches == 0


def test_live_figures_of_table_and_stream_agree(spark, tmp_path):
    _send(tmp_path / "inbox", "1", *[_event(n, quantity=n) for n in range(1, 7)])
    _send(tmp_path / "inbox", "2", *[_event(n, quantity=n) for n in range(7, 12)])
    _drain(spark, tmp_path)
    events = _stored(spark, tmp_path)
    assert live.stream_totals(events).first()[:2] == (11, 50.0 * 66 - 55)
    assert live.stream_totals(events.limit(0)).first()[:3] == (0, 0.0, 0.0)
    assert [r.event_id for r in live.recent_events(events, 3).collect()] == ["e11", "e10", "e9"]

    messages = streams.read_pos_stream(spark, "files", path=str(tmp_path / "inbox"), maxFilesPerTrigger="1")
    decoded = streams.decode_messages(messages).where("is_valid").drop("value", "fields", "is_valid")
    query = (
        live.store_breakdown(decoded).writeStream.outputMode("complete").format("memory")
        .queryName("stores").trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "live")).start()
    )
    query.awaitTermination()
    assert rows(spark.table("stores")) == rows(live.store_breakdown(events))


def test_bounded_dedupe(spark, tmp_path):
    _send(tmp_path / "inbox", "1", _event(1), _event(2), _event(1))
    _send(tmp_path / "inbox", "2", _event(2))
    messages = streams.read_pos_stream(spark, "files", path=str(tmp_path / "inbox"), maxFilesPerTrigger="1")
    events = streams.dedupe_within(streams.decode_messages(messages), "event_id", "created_at", "1 hour")
    query = (
        events.select("event_id").writeStream.outputMode("append").format("memory").queryName("once")
        .trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "once")).start()
    )
    query.awaitTermination()
    assert rows(spark.table("once")) == [("e1",), ("e2",)]


def test_messages_round_trip(spark):
    events = spark.createDataFrame([json.dumps(_event(4))], "string").select(
        F.from_json("value", POS_EVENT).alias("e")).select("e.*")
    messages = files.to_messages(events, "store_id")
    assert messages.first()["key"] == "S0"
    back = streams.decode_messages(messages.select("value"))
    assert back.first()["is_valid"]
    assert rows(back.select(events.columns)) == rows(events)


def test_consumers_replace_nothing_of_each_other(spark, tmp_path):
    """Two checkpoints on one table: batches of both start at 0."""
    path = str(tmp_path / "events")
    _send(tmp_path / "inbox", "1", _event(1), "bad 1")
    _drain(spark, tmp_path, state="first")
    _drain(spark, tmp_path, state="second")
    _send(tmp_path / "inbox", "2", "bad 2")
    _drain(spark, tmp_path, state="first")
    assert sorted(r.value for r in streams.ingest_rejects(spark, path).collect()) == ["bad 1", "bad 1", "bad 2"]
    assert rows(streams.ingest_summary(spark, path), "batches", "messages", "rejected") == [(3, 5, 3)]
    assert streams.ingest_progress(spark, path).select("query").distinct().count() == 2
    assert rows(_stored(spark, tmp_path), "event_id") == [("e1",)]


def test_a_replayed_batch_replaces_what_it_left(spark, tmp_path):
    """The last batch was written, but its commit is missing."""
    path = str(tmp_path / "events")
    _send(tmp_path / "inbox", "1", _event(1), _event(2), "bad")
    _drain(spark, tmp_path)
    before = rows(live.read_figures(spark, path))
    (tmp_path / "state" / "commits" / "0").unlink()
    (tmp_path / "state" / "commits" / ".0.crc").unlink(missing_ok=True)
    _drain(spark, tmp_path)
    assert rows(live.read_figures(spark, path)) == before
    assert rows(_stored(spark, tmp_path), "event_id") == [("e1",), ("e2",)]
    assert rows(streams.ingest_summary(spark, path), "batches", "messages", "rejected") == [(1, 3, 1)]


def _events_frame(spark, *events):
    kind = "event_id string, created_at timestamp, note string"
    return spark.createDataFrame([(k, datetime(2024, 6, day, 9), note) for k, day, note in events], kind)


def test_a_batch_opens_only_its_buckets_and_days(spark, tmp_path):
    path = str(tmp_path / "sink")
    for third in range(2):
        streams.append_new(_events_frame(spark, *[(f"k{n}", 1 + n % 5, "first") for n in range(400) if n % 2 == third]), path)
    parts.merge_parts(spark, path, fan=2)
    batch = streams._divided(_events_frame(spark, ("k7", 3, "again"), ("k8", 4, "again")), "event_id", "created_at")
    buckets = {r[0] for r in batch.select(streams.BUCKET).collect()}

    def opened(found):
        return {tuple(part.split("=")[1] for part in f.split("/")[-3:-1]) for f in found.inputFiles()}

    by_bucket = opened(streams.stored_candidates(batch, path))
    assert {int(b) for _, b in by_bucket} == buckets and {d for d, _ in by_bucket} == {f"2024-06-0{d}" for d in range(1, 6)}
    assert opened(streams.stored_candidates(batch, path, same_day=True)) <= {(d, str(b)) for d in ("2024-06-03", "2024-06-04") for b in buckets}
    streams.append_new(batch.drop(streams.BUCKET, streams.DAY), path, same_day=True)
    stored = files.read_table(spark, path)
    assert stored.columns == ["event_id", "created_at", "note"]
    assert stored.count() == 400 and stored.where("note = 'again'").isEmpty()


def test_late_batches_cost_what_early_ones_do(spark, tmp_path):
    path = str(tmp_path / "sink")
    opened = []
    for n in range(40):
        batch = _events_frame(spark, *[(f"k{n}-{i}", 1 + n // 2, "") for i in range(3)], ("k0-0", 1, "again"))
        divided = streams._divided(batch.where("note = ''"), "event_id", "created_at")
        if parts.is_table(spark, path):
            opened.append(len(streams.stored_candidates(divided, path, same_day=True).inputFiles()))
        streams.append_new(batch, path)
    assert max(opened[20:]) <= max(opened[:20]) + 3
    assert len(parts.part_names(spark, path)) < 2 * parts.FAN
    assert files.read_table(spark, path).count() == 120


def test_merges_survive_broken_ones(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    parts.create(spark, path, spark.range(1).schema)
    for n in range(5):
        parts.write_part(spark.range(n, n + 1), path, f"b{n}")
    (tmp_path / "table" / "part=L0-half").mkdir()  # a write that has not ended

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(parts, "write_text", broken)
        with pytest.raises(OSError):
            parts.merge_parts(spark, path, fan=4)
    assert rows(parts.read_parts(spark, path)) == [(n,) for n in range(5)]
    with monkeypatch.context() as m:
        m.setattr(parts, "delete", broken)
        with pytest.raises(OSError):
            parts.merge_parts(spark, path, fan=4, skip=["b4"])
    assert rows(parts.read_parts(spark, path)) == [(n,) for n in range(5)]
    for n in range(5, 9):
        parts.write_part(spark.range(n, n + 1), path, f"b{n}")
    parts.merge_parts(spark, path, fan=4)
    assert rows(parts.read_parts(spark, path)) == [(n,) for n in range(9)]
    assert sorted(n[:2] for n in parts.part_names(spark, path)) == ["L1", "L1"]
    left = {p.name for p in (tmp_path / "table").iterdir() if p.name.startswith("part=")}
    assert left == {f"part={n}" for n in parts.part_names(spark, path)} | {"part=L0-half"}


def test_live_figures_from_batches_equal_a_scan(spark, tmp_path):
    path = str(tmp_path / "events")
    for n in range(20):
        _send(tmp_path / "inbox", f"{n:02}", _event(n, quantity=n, unit_price=0.1 * n), _event(n // 2), _event(n + 30, quantity=None))
    messages = streams.read_pos_stream(spark, "files", path=str(tmp_path / "inbox"), maxFilesPerTrigger="1")
    streams.ingest(messages, path, str(tmp_path / "state")).awaitTermination()
    events, figures = _stored(spark, tmp_path), live.read_figures(spark, path)
    assert rows(live.totals_of(figures)) == rows(live.stream_totals(events))
    assert rows(live.breakdown_of(figures)) == rows(live.store_breakdown(events))
    assert parts.read_parts(spark, live.figures_of(path)).count() < 20 * 2
    assert rows(live.newest_events(spark, path, 3)) == rows(live.recent_events(events, 3))
    assert live.newest_events(spark, path, 100).count() == events.count()


def test_the_ticker_reads_the_newest_days_only(spark, tmp_path):
    path = str(tmp_path / "events")
    for n in range(4):
        _send(tmp_path / "inbox", str(n), *[_event(10 * n + i, created_at=f"2024-06-0{n + 1}T10:00:0{i}+00:00") for i in range(3)], _event(90 + n, created_at=None))
    _drain(spark, tmp_path)
    assert [r.event_id for r in live.newest_events(spark, path, 4).collect()] == ["e32", "e31", "e30", "e22"]
    _drain(spark, tmp_path, state="again")
    parts.merge_parts(spark, path, fan=2)
    newest = live.newest_events(spark, path, 4)
    assert [r.event_id for r in newest.collect()] == ["e32", "e31", "e30", "e22"]
    assert {f.split("event_day=")[1][:10] for f in newest.inputFiles()} == {"2024-06-04", "2024-06-03"}
    assert rows(live.newest_events(spark, path, 99), "event_id") == rows(_stored(spark, tmp_path), "event_id")


def test_first_arrival_does_not_depend_on_splits(spark, tmp_path):
    """Three files; the order of files decides, then the line."""
    for n, name in enumerate(("b", "a", "c")):
        _send(tmp_path / "inbox", name, *[_event(i, quantity=100 * n + i) for i in range(60)])
        os.utime(tmp_path / "inbox" / f"{name}.txt", (1_700_000_000 + n, 1_700_000_000 + n))
    kept = []
    for size in ("900", "1000000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            messages = streams.read_pos_stream(spark, "files", path=str(tmp_path / "inbox"))
            streams.ingest(messages, str(tmp_path / f"events-{size}"), str(tmp_path / f"state-{size}")).awaitTermination()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        kept.append(rows(files.read_table(spark, str(tmp_path / f"events-{size}")), "event_id", "quantity"))
    assert kept[0] == kept[1] == sorted((f"e{i}", i) for i in range(60))


def test_bad_messages_are_not_gathered_in_one_task(spark, tmp_path, monkeypatch):
    plans, write = {}, parts.write_part

    def noted(rows, path, name):
        plans[path] = rows._jdf.queryExecution().optimizedPlan().toString()
        write(rows, path, name)

    monkeypatch.setattr(parts, "write_part", noted)
    _send(tmp_path / "inbox", "1", _event(1), "bad 1")
    _send(tmp_path / "inbox", "2", "bad 2")
    _drain(spark, tmp_path)
    path = str(tmp_path / "events")
    assert "Repartition 1," not in plans[streams.rejects_of(path)]
    assert sorted(r.value for r in streams.ingest_rejects(spark, path).collect()) == ["bad 1", "bad 2"]
