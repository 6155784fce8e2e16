"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many arcs of a ring of 65,536 cells. A key's cell is the start
of the MD5 of its id, its place inside the cell the whole MD5. Keys settle in
ring order: a key goes to the shard of its arc, or, where that shard is full,
continues clockwise to the next shard with room. With ``slack`` 0 the shards'
limits add up to the number of rows and differ by one at most, so do the counts;
with more slack fewer keys leave their own arc and less moves when shards change.

Only counts decide: rows per cell are counted first, the arcs (shards times
``virtual_nodes``) are settled in one row, and a row finds its shard and its slot
by its rank in its cell. No text moves. Cells that one id makes large are ranked by
counts added up in two steps, so no task sorts all rows of an id.

Defined results: a null id is keyed by the text's hash; rows that agree in id and
text are interchangeable and settle one after the other.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martline.llm.common import column
from martline.sources.staging import stage

CELLS = 1 << 16
VIRTUAL_NODES = 64
#: A cell with this many times the rows of an average one is numbered by counts instead of one sort.
HOT = 8
#: Leading bits of a hash that cut the rows of one place into stretches.
STRETCH_BITS = 12


def arcs(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, list[int]]]:
    """First cell and, clockwise, the shards in the order a key meets them."""
    if not 0 < shards * virtual_nodes <= CELLS // 4:
        raise ValueError(f"shards times virtual nodes must lie between 1 and {CELLS // 4}")
    owner: dict[int, int] = {}
    for node in range(virtual_nodes):
        for shard in range(shards):
            turn = 0
            while (cell := _cell(f"{shard}/{node}/{turn}")) in owner:
                turn += 1
            owner[cell] = shard
    starts = sorted(owner)
    around = [owner[s] for s in starts] * 2
    return [(s, list(dict.fromkeys(around[i : i + len(starts)]))) for i, s in enumerate(starts)]


def _cell(name: str) -> int:
    return int.from_bytes(hashlib.md5(name.encode()).digest()[:2], "big")


def ring_table(spark: SparkSession, shards: int, virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """One row per cell: ``cell``, ``arc`` and ``order`` of shards. Its size is fixed by CELLS."""
    placed = arcs(shards, virtual_nodes)
    rows = [(i, s, placed[i + 1][0] if i + 1 < len(placed) else CELLS, order) for i, (s, order) in enumerate(placed)]
    if placed[0][0] > 0:  # the last arc goes on past cell 0
        rows.append((-1, 0, placed[0][0], placed[-1][1]))
    table = spark.createDataFrame(rows, "arc int, first int, last int, shard_order array<int>")
    return table.select(F.explode(F.sequence("first", F.col("last") - 1)).alias("cell"), "arc", "shard_order")


def assign(
    docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", slack: float = 0.0,
    virtual_nodes: int = VIRTUAL_NODES, keep: tuple[str, ...] = (),
) -> DataFrame:
    """``key``, the columns of ``keep``, ``home_shard``, ``shard`` and ``slot`` of every row of ``docs``.

    ``home_shard`` owns the key's arc; slots count from 0 in every shard without
    a gap. Names of ``keep`` must differ from those three.
    """
    spark = docs.sparkSession
    place = F.md5(F.coalesce(column(key).cast("string"), F.concat(F.lit("text:"), F.md5(column(text))), F.lit("none")))
    ties = [column(c) for c in keep]
    keyed = docs.select(
        F.struct(*[column(c) for c in dict.fromkeys((key, *keep))]).alias("row"), place.alias("place"),
        F.xxhash64(F.lit(0), *ties).alias("tie"), F.spark_partition_id().alias("part"),
    )
    # Narrow rows, written once: counts and ranks see the same parts even if a task runs again.
    rows = stage(keyed.withColumn("cell", F.conv(F.substring("place", 1, 4), 16, 10).cast("int")), "ring-rows")
    counts = rows.groupBy("cell").agg(F.count("*").alias("rows"))
    settled = _settle(counts, ring_table(spark, shards, virtual_nodes), shards, slack)

    often = HOT * F.greatest(counts.agg(F.sum("rows")).scalar() / F.lit(CELLS), F.lit(1.0))
    hot = F.broadcast(counts.where(F.col("rows") > often).select("cell"))  # fewer than CELLS / HOT rows
    in_row = [F.col("row")[c] for c in keep]
    in_cell = Window.partitionBy("cell").orderBy("place", *in_row)
    plain = rows.join(hot, "cell", "left_anti").select("row", "cell", (F.row_number().over(in_cell) - 1).cast("long").alias("rank"))
    ranked = plain.unionByName(_split_ranks(rows.join(hot, "cell", "left_semi"), in_row))
    met = ranked.join(F.broadcast(settled), "cell")  # at most CELLS rows, with arcs plus shards parts in all arcs
    nth = F.col("before") + F.col("rank")
    part = F.element_at(F.filter("parts", lambda p: (p["first"] <= nth) & (nth < p["first"] + p["rows"])), 1)
    return met.select(
        "row.*", F.col("home").alias("home_shard"), part["shard"].alias("shard"),
        (part["slot"] + nth - part["first"]).alias("slot"),
    )


def _split_ranks(rows: DataFrame, ties: list[Column]) -> DataFrame:
    """Ranks from 0 in each cell for cells that one task should not sort.

    The order is place, hash of the kept columns, input task. Counts per place and
    stretch of hashes are added up per cell, counts per hash and task per stretch,
    and only rows of one hash and one task are numbered together.
    """
    unit = ["cell", "place", "stretch", "tie", "part"]
    cut = rows.withColumn("stretch", F.shiftrightunsigned("tie", 64 - STRETCH_BITS).cast("int"))
    units = stage(cut.groupBy(*unit).agg(F.count("*").alias("n")), "ring-units")
    stretches = units.groupBy("cell", "place", "stretch").agg(F.sum("n").alias("n"))
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    in_cell = earlier.partitionBy("cell").orderBy("place", "stretch")
    before = stretches.select("cell", "place", "stretch", F.coalesce(F.sum("n").over(in_cell), F.lit(0)).alias("skip"))
    in_stretch = earlier.partitionBy("cell", "place", "stretch").orderBy("tie", "part")
    within = units.select(*unit, F.coalesce(F.sum("n").over(in_stretch), F.lit(0)).alias("ahead"))
    starts = within.join(before, ["cell", "place", "stretch"]).select(*unit, (F.col("skip") + F.col("ahead")).alias("start"))
    nth = F.row_number().over(Window.partitionBy(*unit).orderBy(*ties, "part")) - 1
    return cut.withColumn("nth", nth).join(starts, unit).select("row", "cell", (F.col("start") + F.col("nth")).alias("rank"))


def _settle(counts: DataFrame, ring: DataFrame, shards: int, slack: float) -> DataFrame:
    """Per cell with rows: rows ``before`` it in its arc, and the arc's ``parts``.

    The ring is settled as one row: an array of arcs, at most CELLS / 4 long.
    A part says that ``rows`` rows of the arc, from its row ``first`` on, fill
    ``shard`` from ``slot`` on.
    """
    cells = ring.join(counts, "cell")
    order = Window.partitionBy("arc").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("before", F.coalesce(F.sum("rows").over(order), F.lit(0)))
    by_arc = cells.groupBy("arc").agg(F.sum("rows").alias("rows"), F.first("shard_order").alias("shard_order"))
    circle = by_arc.agg(
        F.sort_array(F.collect_list(F.struct("arc", "rows", "shard_order"))).alias("arcs"), F.sum("rows").alias("total")
    )
    share = F.floor(F.col("total") / shards)
    limits = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: (share + F.when(s < F.col("total") % shards, 1).otherwise(0)) if slack <= 0
        else F.ceil(F.col("total") / shards * (1 + slack)),
    )
    part = "struct<shard:int,first:bigint,rows:bigint,slot:bigint>"
    settled = circle.withColumn("limits", limits).select(F.aggregate(
        "arcs",
        F.struct(F.transform("limits", lambda _: F.lit(0).cast("long")).alias("loads"),
                 F.array().cast(f"array<struct<arc:int,home:int,parts:array<{part}>>>").alias("out")),
        lambda acc, arc: _next_arc(acc, arc, F.col("limits"), part),
        lambda acc: acc["out"],
    ).alias("out"))
    by_arc = settled.select(F.inline("out"))
    return cells.select("cell", "arc", "before").join(by_arc, "arc").select("cell", "before", "home", "parts")


def _next_arc(acc: Column, arc: Column, limits: Column, part: str) -> Column:
    """Settle one arc: walk its shards clockwise until its rows are placed."""
    walk = F.aggregate(
        arc["shard_order"],
        F.struct(acc["loads"].alias("loads"), F.lit(0).cast("long").alias("done"),
                 F.array().cast(f"array<{part}>").alias("parts")),
        lambda st, s: _let(
            F.least(arc["rows"] - st["done"], limits[s] - st["loads"][s]),
            lambda take: F.when(take <= 0, st).otherwise(F.struct(
                F.transform(st["loads"], lambda load, i: load + F.when(i == s, take).otherwise(0)).alias("loads"),
                (st["done"] + take).alias("done"),
                F.concat(st["parts"], F.array(F.struct(
                    s.alias("shard"), st["done"].alias("first"), take.alias("rows"), st["loads"][s].alias("slot")))).alias("parts"),
            )),
        ),
    )
    return _let(walk, lambda w: F.struct(
        w["loads"].alias("loads"),
        F.concat(acc["out"], F.array(F.struct(
            arc["arc"].alias("arc"), arc["shard_order"][0].alias("home"), w["parts"].alias("parts")))).alias("out"),
    ))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]
