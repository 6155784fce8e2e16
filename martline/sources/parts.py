"""Tables written batch by batch.

A batch is a folder of its own, named by whoever wrote it, so that writing it again
replaces it. Folders are merged: ``FAN`` batches become one part of level 1, ``FAN`` of
these one of level 2, and so on. A table therefore has few parts however many batches
it took, and every row is written again once per level.

One text file names the merged parts that count and the ones they replaced; renaming it is
the commit of a merge, so a broken one changes nothing. Batch folders count once their write
has ended. Merged parts may be divided by columns; a read can be limited to some of their
values and then opens no other folder of these. Batches are one folder each, there are
fewer than ``FAN`` of them, and a limited read filters their rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.sources.fs import delete, exists, matching, names_in, read_text, write_text

FAN = 16
_TABLE = "_PARTS"
_NULL = "__HIVE_DEFAULT_PARTITION__"


def is_table(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/{_TABLE}")


def create(spark: SparkSession, path: str, schema: T.StructType, by: Mapping[str, str] | None = None) -> None:
    """An empty table unless one is there; ``by`` names the dividing columns and their types."""
    if not is_table(spark, path):
        _save(spark, path, {"schema": json.loads(schema.json()), "by": dict(by or {}), "merged": [], "gone": []})


def _save(spark: SparkSession, path: str, table: dict) -> None:
    write_text(spark, f"{path}/{_TABLE}", json.dumps(table))


def _load(spark: SparkSession, path: str) -> dict:
    return json.loads(read_text(spark, f"{path}/{_TABLE}"))


def schema_of(spark: SparkSession, path: str) -> T.StructType:
    return T.StructType.fromJson(_load(spark, path)["schema"])


def widen(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Add the columns of ``schema`` that the table lacks; rows written before have null there."""
    table = _load(spark, path)
    known = T.StructType.fromJson(table["schema"])
    lacking = [f for f in schema.fields if f.name not in known.fieldNames()]
    if lacking:
        _save(spark, path, table | {"schema": json.loads(T.StructType([*known.fields, *lacking]).json())})


def write_part(rows: DataFrame, path: str, name: str) -> None:
    """Write or replace the batch ``name`` (without slashes or commas)."""
    rows.write.mode("overwrite").parquet(f"{path}/part={_batch(name)}")


def _write(rows: DataFrame, folder: str, by: Collection[str]) -> None:
    if by:  # one task per value, so one file; a value too large for a task is split
        rows = rows.hint("rebalance", *[F.col(c) for c in by])
    rows.write.mode("overwrite").partitionBy(*by).parquet(folder)


def part_names(spark: SparkSession, path: str) -> list[str]:
    """The parts that count: merged ones, and batches whose write has ended and that are not merged yet."""
    return _names(spark, path, _load(spark, path))


def _names(spark: SparkSession, path: str, table: dict) -> list[str]:
    written = {p.rsplit("/", 2)[1].removeprefix("part=") for p in matching(spark, f"{path}/part=L0-*/_SUCCESS")}
    return sorted(table["merged"]) + sorted(written - set(table["gone"]))


def _batch(name: str) -> str:
    return f"L0-{name}"


def _level(name: str) -> int:
    return int(name.split("-")[0][1:])


def read_parts(
    spark: SparkSession, path: str, *, only: Collection[str] | None = None, skip: Collection[str] = (),
    where: Mapping[str, Collection] | None = None,
) -> DataFrame:
    """Rows with the dividing columns. ``only`` and ``skip`` name batches, ``where`` gives the values to open."""
    table = _load(spark, path)
    names = _names(spark, path, table)
    if only is not None:
        names = [n for n in names if n in {_batch(x) for x in only}]
    names = [n for n in names if n not in {_batch(x) for x in skip}]
    return _read(spark, path, table, names, where or {})


def _read(spark: SparkSession, path: str, table: dict, names: Sequence[str], where: Mapping[str, Collection]) -> DataFrame:
    schema = T.StructType.fromJson(table["schema"])
    for column, kind in table["by"].items():
        schema = schema.add(column, kind)
    batches = [f"{path}/part={n}" for n in names if not _level(n)]
    folders = _folders(spark, path, list(table["by"]), [n for n in names if _level(n)], where)
    found = spark.createDataFrame([], schema)
    if batches:
        found = spark.read.schema(schema).parquet(*batches)
        for column, chosen in where.items():
            wanted = F.col(column).isin([v for v in chosen if v is not None])
            found = found.where(wanted | F.col(column).isNull() if None in chosen else wanted)
    if folders:
        merged = spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*schema.fieldNames())
        found = found.unionByName(merged) if batches else merged
    return found


def _folders(spark: SparkSession, path: str, by: Sequence[str], names: Sequence[str], where: Mapping[str, Collection]) -> list[str]:
    """Folders of merged parts, down to the last column that ``where`` limits."""
    if not names or not where:
        return [f"{path}/part={n}" for n in names]
    if not all(where.values()):
        return []
    steps = []
    for column in by[: max(map(by.index, where)) + 1]:
        texts = sorted(_NULL if v is None else str(v) for v in where[column]) if column in where else ["*"]
        steps.append(f"{column}={{{','.join(texts)}}}")
    return matching(spark, "/".join([path, f"part={{{','.join(names)}}}", *steps]))


def values(spark: SparkSession, path: str, column: str) -> list[str | None]:
    """Values of a dividing column that occur, as text: names of folders, and a look into the batches."""
    table = _load(spark, path)
    names = _names(spark, path, table)
    merged, steps = [n for n in names if _level(n)], ["*"] * list(table["by"]).index(column) + [f"{column}=*"]
    found = {p.rsplit("=", 1)[1] for p in matching(spark, "/".join([path, f"part={{{','.join(merged)}}}", *steps]))} if merged else set()
    batches = _read(spark, path, table, [n for n in names if not _level(n)], {})
    found |= {_NULL if r[0] is None else r[0] for r in batches.select(F.col(column).cast("string")).distinct().collect()}
    return [None if v == _NULL else v for v in sorted(found)]


def merge_parts(
    spark: SparkSession, path: str, *, fan: int = FAN, skip: Collection[str] = (),
    combine: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Merge levels that have ``fan`` parts or more, the lowest first; ``combine`` may shorten the rows of a merge.

    Batches in ``skip`` (the one being written) stay as they are. Run it from the one
    writer of the table: between batches nothing else may change its parts.
    """
    while True:
        table = _load(spark, path)
        by_level: dict[int, list[str]] = {}
        for name in _names(spark, path, table):
            if name not in {_batch(x) for x in skip}:
                by_level.setdefault(_level(name), []).append(name)
        full = min((level for level, names in by_level.items() if len(names) >= fan), default=None)
        if full is None:
            return
        taken = by_level[full]
        rows = _read(spark, path, table, taken, {})
        merged = f"L{full + 1}-{uuid.uuid4().hex}"
        _write(combine(rows) if combine else rows, f"{path}/part={merged}", table["by"])
        there = set(names_in(spark, path))
        table["merged"] = [n for n in table["merged"] if n not in taken] + [merged]
        table["gone"] = taken + [n for n in table["gone"] if f"part={n}" in there]
        _save(spark, path, table)
        for name in there:  # what this merge has replaced and what a broken one has left
            part = name.removeprefix("part=")
            if name.startswith("part=") and (part in table["gone"] or _level(part) and part not in table["merged"]):
                delete(spark, f"{path}/{name}")
