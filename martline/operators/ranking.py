"""Row numbers over a whole table without putting it into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martline.sources.staging import stage

# monotonically_increasing_id holds the partition above 33 bits of row position.
_POSITION_BITS = 33


def global_rank(df: DataFrame, ranks: dict[str, str], unique: str) -> DataFrame:
    """Number all rows from 1 by each measure, greatest first, nulls last.

    ``ranks`` maps the new column, a bigint, to its measure; ``unique`` breaks ties,
    so every order is total and no value, however common, can overfill a range.

    The input is written once, with a number per row. One sort by range then orders all
    measures: of narrow rows that hold the measure's place among ``ranks``, its value
    and the row's number. Adding up the rows of each measure per range (a few numbers
    per range) turns positions into ranks, which join the rows by their number.
    Tables of every size take this way.
    """
    spark = df.sparkSession
    number = "_row"
    placed = stage(df.withColumn(number, F.monotonically_increasing_id()), "rank-input", "zstd")
    # A column per type, null where another type's measure is ranked: values keep their type.
    kinds = list(dict.fromkeys(df.schema[m].dataType for m in ranks.values()))
    values = [f"_value{i}" for i in range(len(kinds))]
    entries = [
        F.struct(
            F.lit(i).alias("_measure"),
            *[F.when(F.lit(df.schema[m].dataType == kind), F.col(m) if df.schema[m].dataType == kind else F.lit(None).cast(kind)).alias(v)
              for v, kind in zip(values, kinds)],
            F.col(unique).alias("_unique"), F.col(number),
        )
        for i, m in enumerate(ranks.values())
    ]
    order = ["_measure", *[F.col(v).desc_nulls_last() for v in values], F.col("_unique").asc_nulls_last(), number]
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = placed.select(F.explode(F.array(*entries)).alias("e")).select("e.*").repartitionByRange(width, *order).sortWithinPartitions(*order)
    at = stage(sorted_rows.select("_measure", number, F.monotonically_increasing_id().alias("_at")), "rank-positions", "zstd")
    at = at.withColumn("_part", F.shiftright("_at", _POSITION_BITS))

    here = at.groupBy("_measure", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy("_measure").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per measure and range: bounded by the shuffle width.
    starts = here.select("_measure", "_part", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_start"))
    ranked = at.join(F.broadcast(starts), ["_measure", "_part"]).select(number, "_measure", (F.col("_at") + F.col("_start")).alias("_rank"))
    by_row = ranked.groupBy(number).agg(*[F.max(F.when(F.col("_measure") == i, F.col("_rank"))).alias(name) for i, name in enumerate(ranks)])
    return placed.join(by_row, number).drop(number)
