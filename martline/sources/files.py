"""Table and file access."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Collection, Iterable, Mapping, Sequence
from datetime import date
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.functions.keys import Derived, put_back, put_back_values, set_aside, set_aside_values
from martline.sources import parts
from martline.sources.fs import delete as _delete
from martline.sources.fs import exists, names_in
from martline.sources.fs import read_text as _read_text
from martline.sources.fs import write_text as _write_text
from martline.sources.staging import stage_all

#: Hashes and texts of tables take about half the bytes that they take in the default codec.
CODEC = "zstd"
Hashed = Mapping[str, Sequence[str]]
States = Mapping[str, Callable[[DataFrame], DataFrame]]
CORRUPT = "_corrupt_record"
_POINTER = "_CURRENT"
_SCHEMA = "_SCHEMA"
_MANIFEST = "_MANIFEST"
_FORM = "_FORM"


_CSV = {
    "header": "true", "quote": '"', "escape": '"', "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def load_csv(spark: SparkSession, path: str, schema: T.StructType, *, rejects: bool = False, multi_line: bool = True) -> DataFrame:
    """CSV with header, every column as text.

    Quotes inside quoted fields are doubled; quoted fields may hold commas and line
    breaks. An empty field is null, a quoted empty one is empty text. Because of the
    line breaks a file is read by one task; ``multi_line=False``, for files without
    line breaks in fields, lets tasks share a file. Rows with too many or too few fields are kept, padded or cut to the schema;
    ``rejects=True`` adds their original text in ``_corrupt_record``.
    """
    if rejects:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    # A mark that no text holds stands for null, so that quoted empty text is not taken for one.
    reader = spark.read.schema(schema).options(**_CSV).option("nullValue", "\x01").option("mode", "PERMISSIVE")
    return reader.option("multiLine", multi_line).option("columnNameOfCorruptRecord", CORRUPT).csv(path)


def load_bronze(
    spark: SparkSession, inputs: Mapping[str, tuple[str, T.StructType]], root: str, *, multi_line: bool = True
) -> dict[str, DataFrame]:
    """Replace one stored table under ``root`` per CSV input (path, schema), as text; ``multi_line`` as in ``load_csv``."""
    loaded = {name: load_csv(spark, path, schema, multi_line=multi_line) for name, (path, schema) in inputs.items()}
    return {name: save_table(df, f"{root}/{name}") for name, df in loaded.items()}


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header that ``load_csv`` reads back as it was: blanks, quotes, nulls and empty text."""
    df.write.mode("overwrite").options(**_CSV).csv(path)


def to_messages(df: DataFrame, key: str) -> DataFrame:
    """Keyed messages: the row as JSON, nulls included, under ``key`` as text, ready for a Kafka sink."""
    value = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"))


def write_messages(messages: DataFrame, servers: str, topic: str) -> None:
    """Send keyed messages to a topic; needs the Kafka connector on the class path."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all"}
    messages.write.format("kafka").options(**options).save()


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table, by table name."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")


class RowWatch(Protocol):
    """What counts rows while they are written, as ``operators.quality.Watch`` does."""

    def attach(self, rows: DataFrame) -> DataFrame: ...
    def counters(self) -> list[Column]: ...
    def named(self, row: Mapping[str, int]) -> dict[str, int]: ...
    def refuse(self, counts: Mapping[str, int]) -> None: ...


def _writer(
    df: DataFrame, partition_by: str | None, watch: RowWatch | None = None, *, gathered: bool = False, hashed: Hashed | None = None,
    derived: Derived | None = None, order: Sequence[str] = (),
) -> DataFrameWriter:
    """Writer that gathers the rows of each partition value before writing, unless they are ``gathered``.

    Without that every task would write a file per value. Rebalancing merges small
    values into one task and splits a value that is too much for one. Keys that are the
    hash of columns, named in ``hashed``, and ``derived`` columns are neither moved nor written (see ``_read_folder``).
    Each task writes its rows by ``order``, so that like ones take less.
    """
    rows = df
    if partition_by is not None and not gathered:
        rows = _shortened(rows, hashed, derived).hint("rebalance", F.col(partition_by))
        rows = _restored(rows, hashed, derived).select(*df.columns) if watch else rows
    rows = watch.attach(rows) if watch else rows
    rows = _shortened(rows, hashed, derived)
    if order:  # the writer sorts by the partition value in any case
        rows = rows.sortWithinPartitions(*([partition_by] if partition_by else []), *order)
    writer = rows.write.option("compression", CODEC)
    return writer.partitionBy(partition_by) if partition_by else writer


# --- the form in which rows are stored --------------------------------------------


def _shortened(rows: DataFrame, hashed: Hashed | None, derived: Derived | None) -> DataFrame:
    """``rows`` without ``hashed`` keys and ``derived`` columns whose sources they hold."""
    for key, columns in (hashed or {}).items():
        rows = set_aside(rows, key, columns) if set(columns) <= set(rows.columns) else rows
    return set_aside_values(rows, derived) if derived else rows


def _restored(rows: DataFrame, hashed: Hashed | None, derived: Derived | None) -> DataFrame:
    for key, columns in (hashed or {}).items():
        rows = put_back(rows, key, columns)
    return put_back_values(rows, derived) if derived else rows


def _note_form(df: DataFrame, folder: str, hashed: Hashed | None, derived: Derived | None) -> None:
    """Note beside the rows of ``df`` how they are stored; without a note they are stored as they are."""
    if not hashed and not derived:
        return
    form = {
        "schema": json.loads(_shortened(df, hashed, derived).schema.json()),
        "hashed": {key: list(columns) for key, columns in (hashed or {}).items()},
        "derived": {"texts": dict(derived.texts), "inputs": list(derived.inputs)} if derived else None,
    }
    _write_text(df.sparkSession, f"{folder}/{_FORM}", json.dumps(form))


def _read_folder(
    spark: SparkSession, folder: str, schema: T.StructType, *paths: str, hashed: Hashed | None = None, derived: Derived | None = None
) -> DataFrame:
    """Rows of a folder, or of ``paths`` in it, with the columns of ``schema``: null where the folder lacks one.

    Keys and derived columns that were not written are made again from the note that the writer has left,
    but for those that the caller names to be set aside.
    """
    if hashed or derived:
        short = _stored_rows(spark, folder, schema, paths, hashed, derived)
        return _shortened(_read_folder(spark, folder, schema, *paths), hashed, derived) if short is None else short
    reader = spark.read.option("basePath", folder)
    if not exists(spark, f"{folder}/{_FORM}"):
        return reader.schema(schema).parquet(*paths or [folder])
    form = json.loads(_read_text(spark, f"{folder}/{_FORM}"))
    stored = T.StructType.fromJson(form["schema"])
    rows = _restored(reader.schema(stored).parquet(*paths or [folder]), form["hashed"], Derived(**form["derived"]) if form["derived"] else None)
    there = set(rows.columns)
    return rows.select(*[F.col(f.name) if f.name in there else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def _stored_rows(
    spark: SparkSession, folder: str, schema: T.StructType, paths: Sequence[str], hashed: Hashed | None, derived: Derived | None
) -> DataFrame | None:
    """The rows as they are in the files, if these have all columns of ``schema`` but what is to be set aside, and that set aside."""
    if not exists(spark, f"{folder}/{_FORM}"):
        return None
    form = json.loads(_read_text(spark, f"{folder}/{_FORM}"))
    noted = Derived(**form["derived"]) if form["derived"] else None
    if form["hashed"] != {key: list(columns) for key, columns in (hashed or {}).items()} or noted != derived:
        return None
    rows = spark.read.option("basePath", folder).schema(T.StructType.fromJson(form["schema"])).parquet(*paths or [folder])
    return rows if set(schema.fieldNames()) <= set(_restored(rows, hashed, derived).columns) else None


# --- tables replaced as a whole -------------------------------------------------


def write_version(
    df: DataFrame, path: str, partition_by: str | None = None, watch: RowWatch | None = None, *, gathered: bool = False,
    hashed: Hashed | None = None, derived: Derived | None = None,
) -> tuple[DataFrame, str]:
    """Write ``df`` beside the table at ``path``; its rows and the version to give to ``commit_version``.

    Keys named in ``hashed`` and ``derived`` columns are not written but made again when rows are read.
    """
    version = f"version-{uuid.uuid4().hex}"
    _writer(df, partition_by, watch, gathered=gathered, hashed=hashed, derived=derived).parquet(f"{path}/{version}")
    _note_form(df, f"{path}/{version}", hashed, derived)
    return _read_folder(df.sparkSession, f"{path}/{version}", df.schema), version


def write_version_in_parts(
    frames: Iterable[DataFrame], path: str, partition_by: str | None, watch: RowWatch | None = None, *,
    hashed: Hashed | None = None, derived: Derived | None = None, order: Sequence[str] = (),
) -> tuple[DataFrame, str]:
    """``write_version`` of rows gathered by ``partition_by``, one frame after the other, which share no value of it.

    The frames may lack what is not stored, as ``set_aside`` and ``set_aside_values`` leave them.
    """
    version = f"version-{uuid.uuid4().hex}"
    for df in frames:
        writer = _writer(df, partition_by, watch, gathered=True, hashed=hashed, derived=derived, order=order)
        writer.mode("append").parquet(f"{path}/{version}")
    _note_form(df, f"{path}/{version}", hashed, derived)
    return _read_folder(df.sparkSession, f"{path}/{version}", _restored(df, hashed, derived).schema), version


def read_version(
    spark: SparkSession, path: str, version: str, schema: T.StructType, *, hashed: Hashed | None = None, derived: Derived | None = None
) -> DataFrame:
    """The rows of a written version, with ``hashed`` keys and ``derived`` columns set aside."""
    return _read_folder(spark, f"{path}/{version}", schema, hashed=hashed, derived=derived)


def commit_version(rows: DataFrame, path: str, version: str) -> DataFrame:
    """Make a written version the table.

    The pointer file moves to it in one step, so a reader sees the old or the new
    table. The previous version stays for readers that are still on it; older ones go.
    """
    spark = rows.sparkSession
    pointer = f"{path}/{_POINTER}"
    previous = _read_text(spark, pointer).split("\n")[0] if exists(spark, pointer) else None
    _write_text(spark, pointer, f"{version}\n{rows.schema.json()}")
    for name in names_in(spark, path):
        if name.startswith("version-") and name not in (version, previous):
            _delete(spark, f"{path}/{name}")
    return rows


def save_table(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Replace the table at ``path`` and return the written rows. A failed write changes nothing."""
    _, version = write_version(df, path, partition_by)
    commit_version(df, path, version)
    return load_table(df.sparkSession, path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    version, schema = _read_text(spark, f"{path}/{_POINTER}").split("\n", 1)
    return _read_folder(spark, f"{path}/{version}", _struct(schema))


def _struct(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


# --- tables that grow ------------------------------------------------------------


def ensure_table(
    spark: SparkSession, path: str, schema: T.StructType, partition_by: str | None = None
) -> None:
    """Create an empty table with a fixed schema unless one is there."""
    if exists(spark, f"{path}/{_SCHEMA}"):
        return
    empty = spark.createDataFrame([], schema).write.mode("ignore")
    (empty.partitionBy(partition_by) if partition_by else empty).parquet(path)
    _write_text(spark, f"{path}/{_SCHEMA}", schema.json())


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A growing table under its recorded schema, without reading file footers."""
    if parts.is_table(spark, path):
        return parts.read_parts(spark, path).select(*parts.schema_of(spark, path).fieldNames())
    if exists(spark, f"{path}/{_MANIFEST}"):
        return _read_months(spark, path, _read_manifest(spark, path))
    return spark.read.schema(_struct(_read_text(spark, f"{path}/{_SCHEMA}"))).parquet(path)


def has_months(spark: SparkSession, path: str) -> bool:
    """True where ``upsert_increment`` has stored a table."""
    return exists(spark, f"{path}/{_MANIFEST}")


def read_short(spark: SparkSession, path: str, hashed: Hashed, derived: Derived) -> DataFrame:
    """The rows of a table kept by month with ``hashed`` keys and ``derived`` columns set aside.

    Where they were not stored they are not made, so steps that need few of them do not compute the others.
    """
    return _read_months(spark, path, _read_manifest(spark, path), hashed=hashed, derived=derived)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, or an empty one with ``schema`` if there is none yet."""
    if parts.is_table(spark, path) or exists(spark, f"{path}/{_SCHEMA}") or exists(spark, f"{path}/{_MANIFEST}"):
        return read_table(spark, path)
    return spark.createDataFrame([], schema)


def new_rows(
    rows: DataFrame, target: DataFrame, watermark: str = "order_date", lookback_days: int = 0
) -> DataFrame:
    """Rows at or after the newest ``watermark`` of ``target``; all rows if it is empty.

    Older rows are skipped even when ``target`` lacks them; ``lookback_days`` moves
    the limit back.
    """
    newest = F.coalesce(target.agg(F.max(watermark)).scalar(), F.lit(date(1900, 1, 1)))
    return rows.where(F.col(watermark) >= F.date_sub(newest, lookback_days))


def merge_rows(target: DataFrame, increment: DataFrame, key: str) -> DataFrame:
    """``target`` with the rows of ``increment`` replacing or joining it by ``key``.

    Columns only one side has are kept and filled with null.
    """
    kept = target.join(increment.select(key), key, "left_anti")
    return kept.unionByName(increment, allowMissingColumns=True)


MONTH = "sale_month"
_NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


def _read_manifest(spark: SparkSession, path: str) -> dict:
    """``schema``, and per month its ``folder`` and ``newest`` day; the null month is named as in paths."""
    return json.loads(_read_text(spark, f"{path}/{_MANIFEST}"))


def _read_months(
    spark: SparkSession, path: str, manifest: dict, months: Collection[str] | None = None, hashed: Hashed | None = None, derived: Derived | None = None
) -> DataFrame:
    """The rows of all months, or of some: one scan per folder, there are no more of them than months."""
    schema = T.StructType.fromJson(manifest["schema"])
    by_folder: dict[str, list[str]] = {}
    for month, entry in sorted(manifest["months"].items()):
        if months is None or month in months:
            by_folder.setdefault(entry["folder"], []).append(f"{path}/{entry['folder']}/{MONTH}={month}")
    scans = [
        _read_folder(spark, f"{path}/{folder}", schema, *paths, hashed=hashed, derived=derived) for folder, paths in by_folder.items()
    ]
    return reduce(DataFrame.unionByName, scans) if scans else spark.createDataFrame([], schema)


def _month_name(column: Column) -> Column:
    return F.coalesce(column, F.lit(_NO_MONTH))


def in_parts(rows: DataFrame, parts: int) -> list[DataFrame]:
    """``rows`` of a table kept by month, in at most ``parts`` frames of whole months with about as many rows each."""
    if parts <= 1:
        return [rows]
    month = _month_name(F.col(MONTH))
    counts = rows.groupBy(month.alias("month")).agg(F.count("*").alias("n")).collect()  # one row per month
    groups: list[tuple[int, list[str]]] = [(0, []) for _ in range(min(parts, len(counts)))]
    for r in sorted(counts, key=lambda r: (-r["n"], r["month"])):
        n, months = min(groups, key=lambda group: group[0])
        groups[groups.index((n, months))] = (n + r["n"], [*months, r["month"]])
    return [rows.where(month.isin(months)) for _, months in groups] or [rows]


#: Keys per 64-bit word of a month's filter, and bits that a key sets in its word.
_PER_WORD, _BITS = 4, 5


def _word_and_mask(key: Column) -> tuple[Column, Column]:
    """A hash that picks the word (by its last bits) and the bits of a key in it."""
    drawn = F.xxhash64(F.lit(17), key)
    places = [F.shiftrightunsigned(drawn, 6 * i).bitwiseAND(63).cast("int") for i in range(_BITS)]
    ones = [F.call_function("shiftleft", F.lit(1).cast("bigint"), place) for place in places]
    return F.xxhash64(key), reduce(Column.bitwiseOR, ones)


def _write_filters(written: DataFrame, key: str, folder: str) -> dict[str, int]:
    """One Bloom filter of the keys of each month, as rows of a word each; the number of words by month.

    A word takes about ``_PER_WORD`` keys, so a filter has 2 to 4 bytes per key, and
    one in some hundred foreign keys passes.
    """
    months = written.groupBy(_month_name(F.col(MONTH)).alias("month")).agg(F.count("*").alias("n"))
    words = F.pow(2, F.ceil(F.log2(F.greatest(F.col("n") / _PER_WORD, F.lit(1.0))))).cast("bigint")
    sizes = {r["month"]: r["words"] for r in months.select("month", words.alias("words")).collect()}  # one row per month
    by_month = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair]) if sizes else F.lit(None).cast("map<string,bigint>")
    hashed, mask = _word_and_mask(F.col(key))
    keyed = written.select(_month_name(F.col(MONTH)).alias("month"), hashed.alias("h"), mask.alias("mask"))
    words_of = keyed.select("month", F.col("h").bitwiseAND(by_month[F.col("month")] - 1).alias("word"), "mask")
    words_of.groupBy("month", "word").agg(F.bit_or("mask").alias("bits")).write.parquet(f"{folder}/_filters")
    return sizes


def months_that_may_hold(spark: SparkSession, path: str, manifest: dict, keys: DataFrame, key: str) -> set[str]:
    """Months whose filter lets a key of ``keys`` pass; months without a filter always do. Reads filters only.

    A key is looked up once per filter size; there are few, as sizes are powers of two.
    """
    months = manifest["months"]
    open_months = {m for m, e in months.items() if not e.get("words")}
    with_filter = {m: e for m, e in months.items() if e.get("words")}
    if not with_filter:
        return open_months
    kind = "month string, word bigint, bits bigint"
    scans = []
    for folder in sorted({e["folder"] for e in with_filter.values()}):
        mine = {m: e["words"] for m, e in with_filter.items() if e["folder"] == folder}
        words = F.create_map(*[F.lit(x) for pair in mine.items() for x in pair])
        rows = spark.read.schema(kind).parquet(f"{path}/{folder}/_filters").where(F.col("month").isin(list(mine)))
        scans.append(rows.withColumn("words", words[F.col("month")]))
    filters = reduce(DataFrame.unionByName, scans)
    hashed, mask = _word_and_mask(F.col(key))
    sizes = F.explode(F.array(*[F.lit(w).cast("bigint") for w in sorted({e["words"] for e in with_filter.values()})]))
    asked = keys.select(hashed.alias("h"), mask.alias("mask")).select("h", "mask", sizes.alias("words"))
    asked = asked.select("words", F.col("h").bitwiseAND(F.col("words") - 1).alias("word"), "mask")
    passed = filters.join(asked, ["words", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
    return open_months | {r["month"] for r in passed.select("month").distinct().collect()}  # one row per month


def read_state(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Rows of the state ``name`` of all months (see ``upsert_increment``), without reading the table's rows.

    Empty, without columns, if no month has it.
    """
    manifest = _read_manifest(spark, path)
    scans = []
    for folder in sorted({e["folder"] for e in manifest["months"].values() if name in e.get("states", {})}):
        of_folder = [m for m, e in manifest["months"].items() if e["folder"] == folder]
        schema = T.StructType.fromJson(manifest["months"][of_folder[0]]["states"][name])
        rows = spark.read.schema(schema).parquet(f"{path}/{folder}/_state_{name}")
        for key, columns in manifest["months"][of_folder[0]].get("hashed", {}).items():
            rows = put_back(rows, key, columns)
        scans.append(rows.where(_month_name(F.col(MONTH)).isin(of_folder)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans) if scans else spark.createDataFrame([], T.StructType())


def rule_counts(spark: SparkSession, path: str) -> dict[str, int]:
    """Violations by rule over all months, as counted when they were written; the rows are not read."""
    counts: dict[str, int] = {}
    for entry in _read_manifest(spark, path)["months"].values():
        for name, n in entry.get("rules", {}).items():
            counts[name] = counts.get(name, 0) + n
    return counts


def _write_states(written: DataFrame, states: States, folder: str, hashed: Hashed) -> dict:
    """Write the states of the months in ``folder``, without ``hashed`` keys; their schemas by name."""
    schemas = {}
    for name, make in states.items():
        state = make(written)
        for key, columns in hashed.items():
            state = set_aside(state, key, columns) if {key, *columns} <= set(state.columns) else state
        state.write.parquet(f"{folder}/_state_{name}", compression=CODEC)
        schemas[name] = json.loads(state.schema.json())
    return schemas


def _commit_months(
    spark: SparkSession, path: str, frames: Sequence[DataFrame], key: str, kept: dict, watermark: str, previous: dict, states: States,
    watch: RowWatch | None, hashed: Hashed | None, derived: Derived | None, parts: int,
) -> None:
    """Write the rows of ``frames`` to a new folder and swap the manifest to them and the months ``kept``.

    The swap is one rename. Until then the table is as it was; a folder that a
    broken run leaves behind is in no manifest, and goes with the next commit. The
    folders of the previous manifest stay for readers that are still on it.
    """
    folder = f"data-{uuid.uuid4().hex}"
    for rows in frames:
        by_key = [c for c in (hashed or {}).get(key, ()) if c in rows.columns]
        for part in in_parts(rows, parts):
            _writer(part, MONTH, hashed=hashed, derived=derived, order=by_key).mode("append").parquet(f"{path}/{folder}")
    _note_form(rows, f"{path}/{folder}", hashed, derived)
    schema = _restored(rows, hashed, derived).schema
    written = _read_folder(spark, f"{path}/{folder}", schema)
    counters = watch.counters() if watch else []
    newest = written.groupBy(_month_name(F.col(MONTH)).alias("month")).agg(F.max(watermark).cast("string").alias("newest"), *counters)
    found = newest.collect()  # one row per month
    rules = {r["month"]: watch.named(r.asDict()) if watch else {} for r in found}
    for counts in rules.values():
        if watch:
            watch.refuse(counts)
    words = _write_filters(written, key, f"{path}/{folder}")
    made = _write_states(written, states, f"{path}/{folder}", hashed or {})
    by_hash = {key: list(columns) for key, columns in (hashed or {}).items()}
    months = {
        r["month"]: {"folder": folder, "newest": r["newest"], "words": words[r["month"]], "states": made, "hashed": by_hash,
                     "rules": rules[r["month"]]}
        for r in found
    }
    manifest = {"schema": json.loads(schema.json()), "months": {**kept, **months}}
    _write_text(spark, f"{path}/{_MANIFEST}", json.dumps(manifest))
    used = {e["folder"] for m in (manifest, previous) for e in m["months"].values()}
    for name in names_in(spark, path):
        if name.startswith("data-") and name not in used:
            _delete(spark, f"{path}/{name}")


def upsert_increment(
    rows: DataFrame | Sequence[DataFrame],
    path: str,
    key: str = "order_line_sk",
    watermark: str = "order_date",
    *,
    lookback_days: int = 0,
    full_refresh: bool = False,
    states: States | None = None,
    watch: RowWatch | None = None,
    hashed: Hashed | None = None,
    derived: Derived | None = None,
    parts: int = 1,
) -> None:
    """Bring the table at ``path``, kept by month of ``watermark``, up to date.

    Only months that receive rows or hold a row being replaced are rewritten. A
    key can sit in any month: Bloom filters beside the data tell which months may hold
    one of the increment, and only of these the key column is read. Rows, schema and the newest
    day, from which the next increment starts, change in one step: a failed run
    changes nothing and can be run again. ``full_refresh`` replaces all rows.

    ``states`` are small frames made of the rows of the months that are written, with
    the column ``sale_month``: aggregates that can be merged over months. They are stored
    and replaced with their months; ``read_state`` gives those of the whole table. Give
    the same ones to every increment.

    ``watch`` holds row rules: they are counted per month when it is written, an error
    stops the increment before it takes effect, and ``rule_counts`` adds the months up.
    ``hashed`` names keys that are hashes, with the columns that they are made of: rows and
    states are moved and stored without them. ``derived`` columns are neither moved nor stored
    as well; ``read_table`` makes both again. A table written for the first time or anew is moved in up to
    ``parts`` parts of whole months, one after the other; ``rows`` are read for each, so they should be a written table.

    ``rows`` given as several frames of one form are read once each, one after the other, with ``parts`` 1.
    They may lack what is not stored, as ``set_aside`` and ``set_aside_values`` leave them.
    """
    frames = [rows] if isinstance(rows, DataFrame) else list(rows)
    spark = frames[0].sparkSession
    frames = [f.withColumn(MONTH, F.date_format(F.col(watermark), "yyyy-MM")) for f in frames]
    known = exists(spark, f"{path}/{_MANIFEST}")
    manifest = _read_manifest(spark, path) if known else {"schema": None, "months": {}}
    if full_refresh or not known:
        _commit_months(spark, path, frames, key, {}, watermark, manifest, states or {}, watch, hashed, derived, parts)
        return
    newest = max((e["newest"] for e in manifest["months"].values() if e["newest"]), default="1900-01-01")
    due = F.col(watermark) >= F.date_sub(F.lit(newest).cast("date"), lookback_days)
    increment = stage_all((_restored(f, hashed, derived).where(due) for f in frames), "increment", CODEC)
    candidates = months_that_may_hold(spark, path, manifest, increment, key)
    target = _read_months(spark, path, manifest, candidates)
    replaced = target.select(key, MONTH).join(increment.select(key), key, "left_semi")
    found = increment.select(MONTH).union(replaced.select(MONTH)).select(_month_name(F.col(MONTH)).alias("month"))
    # One row per month.
    touched = {r["month"] for r in found.distinct().collect()}
    if not touched:
        return
    merged = merge_rows(_read_months(spark, path, manifest, touched), increment, key)
    kept = {m: e for m, e in manifest["months"].items() if m not in touched}
    _commit_months(spark, path, [merged], key, kept, watermark, manifest, states or {}, watch, hashed, derived, 1)
