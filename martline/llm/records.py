"""Token ids as framed binary records, with an offset index for shuffled reads.

A data file is a run of records. A record is framed as
    length of the body     8 bytes
    masked CRC-32 of the length field    4 bytes
    body
    masked CRC-32 of the body    4 bytes
all little-endian. The body holds the document's id (8 bytes, signed), its flags
(4 bytes; bit 0: the id is null), the number of tokens (4 bytes), and the tokens,
2 bytes each where the vocabulary allows it, else 4. Beside each data file lies an
index: for every record its offset (8 bytes) and its length with the frame (8 bytes).

Documents are sorted by id over all files (null last, then by text). Tasks write under
names of their own and report what they wrote; only files that the manifest, a
Parquet table, lists belong to the data, so a repeated task leaves no trace in it.
The manifest lists segments of about ``SEGMENT`` bytes: the units of reading.

Defined results: a null or empty text becomes a record with the end id alone;
repeated rows are records each.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martline.llm.common import column

SEGMENT = 4 << 20
_LENGTH, _CRC, _BODY, _INDEX = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<qII"), struct.Struct("<QQ")
#: Most units kept, units encoded as one text, and bytes of texts encoded at a time (or one text).
_CACHE_UNITS, _JOINED, _AT_ONCE = 800_000, 1000, 8 << 20
MANIFEST = "part int, segment int, file string, offset long, bytes long, first long, records long, tokens long, width int"


def masked(data: bytes) -> int:
    """A rotated CRC plus a constant, so that a CRC of data that holds CRCs stays telling."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(body: bytes) -> bytes:
    length = _LENGTH.pack(len(body))
    return length + _CRC.pack(masked(length)) + body + _CRC.pack(masked(body))


def unframe(data: memoryview, at: int) -> tuple[memoryview, int]:
    """The body at ``at`` and the place of the next record; raises if a checksum is wrong."""
    length = bytes(data[at : at + 8])
    if _CRC.unpack_from(data, at + 8)[0] != masked(length):
        raise ValueError(f"damaged length at byte {at}")
    body = data[at + 12 : at + 12 + _LENGTH.unpack(length)[0]]
    end = at + 12 + len(body)
    if _CRC.unpack_from(data, end)[0] != masked(body):
        raise ValueError(f"damaged record at byte {at}")
    return body, end + 4


def _bare(unit: str) -> int:
    """Where the signs at the end of a unit begin; the splits never join them to a letter or digit before."""
    k = len(unit)
    while k and not unit[k - 1].isalnum():
        k -= 1
    return k or len(unit)


def _together(arrays: list[np.ndarray], dtype) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([np.empty(0, dtype), *arrays]), np.fromiter(map(len, arrays), np.int64, len(arrays))


class UnitEncoder:
    """Ids of whole texts from the ids of their units.

    The tokenizer splits text before every white space that follows other text, and
    between letters or digits and other signs, and merges inside the splits only. So a
    text's ids are those of its units, a unit being white space with what follows it;
    units repeat, with and without signs at their end, and are encoded once. Texts with
    the name of a special token, or with white space in runs, are encoded as they are.

    Units are told apart by Arrow's dictionaries; the ids of all known ones lie in one
    array, from which a batch of texts is gathered.
    """

    def __init__(self, tokenizer, dtype: str):
        self.tokenizer, self.dtype = tokenizer, np.dtype(dtype)
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        # Bytes of each token: the vocabulary writes one character per byte.
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.starts, self.sizes = np.empty(0, self.dtype), np.empty(0, np.int64), np.empty(0, np.int64)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > _CACHE_UNITS:
            self._forget()
        plain = [self._plain(t) for t in texts]
        odd = iter(self._encoded([t for t, p in zip(texts, plain) if not p]))
        marked = pa.array([t.replace(" ", "\0 ").replace("\n", "\0\n") for t, p in zip(texts, plain) if p], pa.large_string())
        lists = pc.split_pattern(marked, "\0")
        coded = lists.values.dictionary_encode()
        units = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._learn(units)
        number = np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))[np.asarray(coded.indices)]
        size = self.sizes[number]
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[number] - ends + size, size)
        data, width = self.ids[at].tobytes(), self.dtype.itemsize
        cuts = np.concatenate([[0], ends])[np.asarray(lists.offsets)] * width
        regular = (data[a:b] for a, b in pairwise(cuts.tolist()))
        return [next(regular) if p else next(odd).tobytes() for p in plain]

    def _learn(self, units: list[str]) -> None:
        """Encode what is new of ``units``, without the signs at its end, and of those signs."""
        fresh = [u for u in units if u not in self.known]
        signed = [(u, k) for u in fresh if u and not u[-1].isalnum() and (k := _bare(u)) < len(u)]
        new = set(fresh).difference([u for u, _ in signed])
        new.update([p for u, k in signed for p in (u[:k], u[k:]) if p not in self.known])
        apart = [p for p in new if p[:1] not in (" ", "\n")]
        joined = [p for p in new if p[:1] in (" ", "\n")]
        self._append(apart, *_together(self._encoded(apart), self.dtype))
        self._append(joined, *self._encoded_joined(joined))
        body, tail = (np.array([self.known[p] for p in some], np.int64) for some in ([u[:k] for u, k in signed], [u[k:] for u, k in signed]))
        both = np.stack([body, tail], 1).ravel()
        size = self.sizes[both]
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[both] - ends + size, size)
        self._append([u for u, _ in signed], self.ids[at], size.reshape(-1, 2).sum(axis=1))

    def _append(self, units: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        if not units:
            return
        first = len(self.starts)
        self.known.update(zip(units, range(first, first + len(units))))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes, self.ids = np.concatenate([self.sizes, sizes]), np.concatenate([self.ids, ids])

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded_joined(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units that begin with white space and how many each has: many in one text, token lengths tell where a unit ends."""
        groups = [units[at : at + _JOINED] for at in range(0, len(units), _JOINED)]
        every, sizes = [], []
        for group, ids in zip(groups, self._encoded(["".join(g) for g in groups])):
            ends = np.cumsum(np.fromiter(map(len, map(str.encode, group)), np.int64, len(group)))
            reached = np.cumsum(self.bytes_of[ids])
            cuts = np.searchsorted(reached, ends)
            if len(reached) and cuts[-1] == len(ids) - 1 and (reached[cuts] == ends).all():
                size = np.diff(cuts, prepend=-1)
            else:  # a vocabulary that writes bytes in another way
                ids, size = _together(self._encoded(group), self.dtype)
            every.append(ids)
            sizes.append(size)
        return _together(every, self.dtype)[0], _together(sizes, np.int64)[0]

    def _plain(self, text: str) -> bool:
        """Not empty, and white space is single blanks or line ends between other signs."""
        spaces = text.count(" ") + text.count("\n")
        return len(text.split()) == spaces + 1 and "\0" not in text and not any(s in text for s in self.special)


@lru_cache(maxsize=2)
def _encoder(vocabulary: str) -> tuple[UnitEncoder, int]:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    width = 2 if tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
    return UnitEncoder(tokenizer, f"<u{width}"), width


def write_records(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 0, key: str = "doc_id", text: str = "text") -> None:
    """Encode ``docs`` and write data files, indexes and the manifest to a new ``folder``."""
    rows = docs.select(column(key).cast("long").alias("id"), column(text).alias("text"))
    order = [F.col("id").asc_nulls_last(), F.col("text")]
    dealt = rows.repartitionByRange(*order[:1]).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        segments = list(_write_part(batches, folder, part, vocabulary, end_id))
        if segments:
            yield pa.RecordBatch.from_pylist(segments, schema=_manifest_schema())

    dealt.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")


def _manifest_schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (field.split() for field in MANIFEST.split(", "))])


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Neighbouring rows whose texts have up to _AT_ONCE bytes together, or one row."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(1)), 0), np.int64))
    start = before = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, before + _AT_ONCE, "right")))
        yield batch.slice(start, stop - start)
        start, before = stop, int(ends[stop - 1])


def _write_part(batches: Iterator[pa.RecordBatch], folder: str, part: int, vocabulary: str, end_id: int) -> Iterator[dict]:
    encoder, width = _encoder(vocabulary)
    store, root = pa.fs.FileSystem.from_uri(folder)
    name = f"part-{part:06d}-{uuid.uuid4().hex}"
    end = np.array([end_id], encoder.dtype).tobytes()
    data = index = None
    at = first = 0
    now = {"offset": 0, "first": 0, "records": 0, "tokens": 0}
    segment = 0

    def close(upto: int) -> dict:
        return {"part": part, "segment": segment, "file": name, "offset": now["offset"], "bytes": upto - now["offset"],
                "first": now["first"], "records": now["records"], "tokens": now["tokens"], "width": width}

    try:
        for batch in batches:
            for some in _slices(batch):
                ids = some.column(0).to_pylist()
                for key, tokens in zip(ids, encoder.encode_all([t or "" for t in some.column(1).to_pylist()])):
                    if data is None:
                        store.create_dir(root, recursive=True)
                        data = store.open_output_stream(f"{root}/{name}.records", buffer_size=1 << 20)
                        index = store.open_output_stream(f"{root}/{name}.index", buffer_size=1 << 16)
                    body = tokens + end
                    count = len(body) // width
                    record = frame(_BODY.pack(key or 0, key is None, count) + body)
                    data.write(record)
                    index.write(_INDEX.pack(at, len(record)))
                    at, first = at + len(record), first + 1
                    now["records"] += 1
                    now["tokens"] += count
                    if at - now["offset"] >= SEGMENT:
                        yield close(at)
                        segment += 1
                        now = {"offset": at, "first": first, "records": 0, "tokens": 0}
        if now["records"]:
            yield close(at)
    finally:
        for stream in (data, index):
            if stream is not None:
                stream.close()


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Segments with ``start``: the tokens before each. One row per few MB of data."""
    segments = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    per_part = segments.groupBy("part").agg(F.sum("tokens").alias("in_part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = per_part.select("part", F.coalesce(F.sum("in_part").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    within = segments.withColumn("within", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    return within.join(parts, "part").select(*segments.columns, (F.col("before") + F.col("within")).alias("start"))


def read_records(spark: SparkSession, folder: str, with_ids: bool = True, seed: int | None = None) -> DataFrame:
    """One row per record: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` and, if asked, ``ids`` (32-bit).

    With a ``seed`` the segments are dealt out in a random order and the records of
    a segment are fetched in a random order by the index; else they are read in a run.
    """
    listed = manifest(spark, folder)
    turn = F.xxhash64(F.lit(seed or 0), "part", "segment")
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = listed.withColumn("turn", turn).repartition(tasks, "part", "segment")
    if seed is not None:
        dealt = dealt.sortWithinPartitions("turn")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pa.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for s in batch.to_pylist():
                rows = list(_read_segment(store, root, s, with_ids, seed))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.binary() if i == 4 else pa.int64()) for i, c in enumerate(zip(*rows))],
                    names=[f.split()[0] for f in schema.split(", ")],
                )

    return dealt.mapInArrow(read, schema)


def _read_segment(store, root: str, s: dict, with_ids: bool, seed: int | None) -> Iterator[tuple]:
    with store.open_input_file(f"{root}/{s['file']}.index") as file:
        table = np.frombuffer(file.read_at(s["records"] * 16, s["first"] * 16), "<u8").reshape(-1, 2)
    with store.open_input_file(f"{root}/{s['file']}.records") as file:
        data = memoryview(file.read_at(s["bytes"], s["offset"]))
    order = range(len(table)) if seed is None else np.random.default_rng([seed & 0xFFFFFFFF, s["part"], s["segment"]]).permutation(len(table))
    counts = [0] * len(table)
    for i, (at, _) in enumerate(table):
        counts[i] = _BODY.unpack_from(data, int(at) - s["offset"] + 12)[2]
    starts = s["start"] + np.cumsum([0, *counts])
    for i in order:
        body, end = unframe(data, int(table[i][0]) - s["offset"])
        if end != int(table[i][0] + table[i][1]) - s["offset"]:
            raise ValueError(f"index and data of {s['file']} differ")
        key, flags, count = _BODY.unpack_from(body)
        ids = np.frombuffer(body, f"<u{s['width']}", count, _BODY.size).astype("<u4").tobytes()
        row = (None if flags & 1 else key, int(starts[i]), count, zlib.crc32(ids))
        yield (*row, ids) if with_ids else row
