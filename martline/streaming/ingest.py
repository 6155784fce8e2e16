"""Point-of-sale stream: source, decoding, idempotent sink."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from martline.schemas import POS_EVENT
from martline.sources import parts
from martline.sources.files import read_or_empty
from martline.sources.fs import read_text
from martline.streaming import live

DRAIN = {"availableNow": True}
EVERY_TWO_SECONDS = {"processingTime": "2 seconds"}

# A batch starts at 50 messages or after 2 seconds.
KAFKA_BATCHING = {"minOffsetsPerTrigger": "50", "maxTriggerDelay": "2s"}

#: Place of a line: the order of files, and of the blocks a file is split into.
FILE_PLACE = ["file_modification_time", "file_path", "file_block_start"]


def read_pos_stream(spark: SparkSession, source: str = "kafka", **options: str) -> DataFrame:
    """Message texts as a streaming frame with the column ``value``.

    ``kafka`` starts at the earliest offset and needs ``subscribe`` and
    ``kafka.bootstrap.servers`` (and the connector on the class path); it adds
    ``partition`` and ``offset``. ``files`` reads one message per line from the
    folder ``path`` and adds the place of the line: time and path of its file and
    start of its block (``FILE_PLACE``).
    """
    if source == "files":
        path = options.pop("path")
        place = [F.col(f"_metadata.{name}").alias(name) for name in FILE_PLACE]
        return spark.readStream.options(**options).text(path).select("value", *place)
    reader = spark.readStream.format(source).option("startingOffsets", "earliest")
    return reader.options(**{**KAFKA_BATCHING, **options}).load().select(
        F.col("value").cast("string").alias("value"), "partition", "offset"
    )


def _typed(text: Column, kind: T.DataType) -> Column:
    """A field as a database would cast it; what does not parse is null."""
    if isinstance(kind, T.LongType):
        return F.round(text.try_cast("decimal(38,18)"), 0).try_cast("bigint")
    return text if isinstance(kind, T.StringType) else text.try_cast(kind)


def decode_messages(messages: DataFrame) -> DataFrame:
    """Parse message texts; other columns of ``messages`` pass through.

    Good (``is_valid``) is every JSON object with an ``event_id``. Fields are read
    as text and cast, so "2" and 2.0 are quantities too. ``fields`` lists the names
    that the object has, with a value or an explicit null.
    """
    names = POS_EVENT.fieldNames()
    as_text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = messages.select(
        "*", F.from_json("value", as_text).alias("_e"), F.json_object_keys("value").alias("fields")
    )
    valid = F.col("fields").isNotNull() & F.col("_e.event_id").isNotNull()
    typed = [_typed(F.col(f"_e.{f.name}"), f.dataType).alias(f.name) for f in POS_EVENT.fields]
    return rows.select(*typed, *messages.columns, "fields", F.coalesce(valid, F.lit(False)).alias("is_valid"))


def with_defaults(events: DataFrame) -> DataFrame:
    """Line 1 and no discount where the message lacks the field; an explicit null stays null."""
    present = {n: F.array_contains("fields", n) for n in ("line_item_id", "discount_amount")}
    return events.withColumns(
        {
            "line_item_id": F.when(present["line_item_id"], F.col("line_item_id")).otherwise(F.lit(1).cast("bigint")),
            "discount_amount": F.when(present["discount_amount"], F.col("discount_amount")).otherwise(F.lit(0.0)),
        }
    )


def unseen(batch: DataFrame, stored: DataFrame, key: str, first_by: Sequence[str] = ()) -> DataFrame:
    """One row per key of ``batch`` for keys that ``stored`` does not have.

    Of rows that repeat a key the first by ``first_by`` is kept, any of them if
    that is empty. The stored side is only filtered by the keys of the batch, which
    Spark can broadcast when the batch is small; the stored rows themselves do not
    move.
    """
    keyed = batch.where(F.col(key).isNotNull())
    if first_by:
        nth = F.row_number().over(Window.partitionBy(key).orderBy(*first_by))
        unique = keyed.withColumn("_nth", nth).where("_nth = 1").drop("_nth")
    else:
        unique = keyed.dropDuplicates([key])
    seen = stored.select(key).join(unique.select(key), key, "left_semi")
    return unique.join(seen, key, "left_anti")


#: Dividing columns of an event table and the number of key buckets.
DAY, BUCKET, BUCKETS = "event_day", "key_bucket", 16
_DIVIDED = {DAY: "date", BUCKET: "integer"}


def _divided(rows: DataFrame, key: str, day: str | None) -> DataFrame:
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")
    event_day = F.to_date(day) if day else F.lit(None).cast("date")
    return rows.withColumns({BUCKET: bucket, DAY: event_day})


def stored_candidates(batch: DataFrame, path: str, *, skip: Sequence[str] = (), same_day: bool = False) -> DataFrame:
    """Stored rows that could repeat a row of ``batch``: those in its key buckets, and of its days if ``same_day``.

    ``batch`` has the dividing columns. At most ``BUCKETS`` numbers, and one per day,
    reach the driver.
    """
    asked = [BUCKET, DAY] if same_day else [BUCKET]
    where = {c: [r[0] for r in batch.select(c).distinct().collect()] for c in asked}
    return parts.read_parts(batch.sparkSession, path, skip=skip, where=where)


def append_new(
    batch: DataFrame, path: str, key: str = "event_id", first_by: Sequence[str] = (), *,
    day: str | None = "created_at", same_day: bool = False, name: str | None = None,
) -> None:
    """Append the rows of ``batch`` whose key the table does not have yet.

    Running it again with the same batch adds nothing: what ``name`` has written is
    replaced, all else is looked up. The table is divided by hash bucket of the key and
    by day, and only the buckets of the batch are opened. ``same_day`` opens only its
    days too: for sources whose repeats carry the ``day`` of the first, so that a batch
    costs the same however long the table gets. The columns ``first_by`` are not stored.
    One writer per table.
    """
    spark = batch.sparkSession
    rows = T.StructType([f for f in batch.schema if f.name not in first_by])
    parts.create(spark, path, rows, _DIVIDED)
    name = name or uuid.uuid4().hex
    parts.merge_parts(spark, path, skip=[name])
    keyed = _divided(batch, key, day if day in batch.columns else None)
    stored = stored_candidates(keyed, path, skip=[name], same_day=same_day)
    fresh = unseen(keyed, stored, key, first_by)
    parts.write_part(fresh.select(*parts.schema_of(spark, path).fieldNames(), DAY, BUCKET), path, name)


def rejects_of(path: str) -> str:
    """Where the bad messages of the event table at ``path`` are kept."""
    return f"{path.rstrip('/')}-rejects"


def progress_of(path: str) -> str:
    """Where the progress of the event table at ``path`` is kept."""
    return f"{path.rstrip('/')}-progress"


def ingest(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    *,
    trigger: Mapping = DRAIN,
    rejects_path: str | None = None,
    same_day: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Start writing decoded messages into the event table at ``path``.

    The default trigger takes everything available and stops; with a timed one
    call ``awaitTermination(timeout)`` and ``stop()``. A batch that cannot be
    written fails the query, which resumes there from its checkpoint. Of messages
    that repeat an event the first to arrive is stored. Bad messages always go to
    ``rejects_path`` (default: beside the table), one row per batch to the progress
    table, and the figures of its new events to the table of live figures. Each is
    written under the id of the query and the batch, so that a replay replaces it and
    another consumer does not. ``same_day``: see ``append_new``.
    """
    rejects, progress, figures = rejects_path or rejects_of(path), progress_of(path), live.figures_of(path)
    run = uuid.uuid4().hex
    parts.create(messages.sparkSession, path, POS_EVENT, _DIVIDED)
    for table, schema in ((rejects, _REJECTS), (progress, _PROGRESS), (figures, live.FIGURES)):
        parts.create(messages.sparkSession, table, schema)

    def write(batch: DataFrame, batch_id: int) -> None:
        began, spark = time.time(), batch.sparkSession
        # The id stays with the checkpoint: a new checkpoint, whose batches start at 0 again, replaces nothing.
        query = json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]
        name = f"{query}-{batch_id}"
        place = [c for c in ("partition", *FILE_PLACE) if c in batch.columns]
        if "offset" not in batch.columns:  # lines of a block are read in order
            batch = batch.withColumn("offset", F.monotonically_increasing_id())
        decoded = decode_messages(batch).persist()
        try:
            counted = decoded.agg(F.count("*").alias("messages"), F.count_if(~F.col("is_valid")).alias("rejected")).first()
            good = with_defaults(decoded.where("is_valid")).drop("value", "fields", "is_valid")
            append_new(good, path, first_by=[*place, "offset"], same_day=same_day, name=name)
            stored = parts.read_parts(spark, path, only=[name])
            bad = decoded.where("NOT is_valid").select("value", F.lit(batch_id).cast("bigint").alias("batch_id"))
            row = (*counted, time.time() - began, run, query, batch_id)
            kept = [
                (figures, live.partial_figures(stored).coalesce(1), live.merge_figures),  # one row per store
                (progress, spark.createDataFrame([row], _PROGRESS).coalesce(1), None),
            ]
            # Rebalanced: few files, and still written by as many tasks as there are bad messages for.
            for table, rows, combine in kept + [(rejects, bad.hint("rebalance"), None)] * (counted["rejected"] > 0):
                parts.merge_parts(spark, table, skip=[name], combine=combine)
                parts.write_part(rows, table, name)
        finally:
            decoded.unpersist()

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**trigger).start()


def dedupe_within(events: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """Drop repeated keys that arrive within ``delay``; state beyond it is let go."""
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


_PROGRESS = T.StructType(
    [
        T.StructField("messages", T.LongType()),
        T.StructField("rejected", T.LongType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("run", T.StringType()),
        T.StructField("query", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
_REJECTS = T.StructType([T.StructField("value", T.StringType()), T.StructField("batch_id", T.LongType())])


def ingest_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per batch that was written to the event table at ``path``, over all runs and consumers."""
    return read_or_empty(spark, progress_of(path), _PROGRESS)


def ingest_summary(spark: SparkSession, path: str) -> DataFrame:
    """Batches, messages read and refused, and seconds, from the first batch on."""
    return ingest_progress(spark, path).agg(
        F.count("*").alias("batches"), F.coalesce(F.sum("messages"), F.lit(0)).alias("messages"),
        F.coalesce(F.sum("rejected"), F.lit(0)).alias("rejected"), F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("seconds"),
    )


def ingest_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Bad messages set aside beside the event table at ``path``, by all consumers."""
    return read_or_empty(spark, rejects_of(path), _REJECTS)
