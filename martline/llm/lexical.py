"""Ranked lexical search: every document is scored for every item by dense matrix products.

1. ``term_counts``: one pass over the documents keeps, per document, its number of terms
   and how often it holds each term of the items' vocabulary, found by a plain look-up.
2. ``weigh`` counts documents, terms and document frequencies over all documents.
3. Items are cut into tiles of ``ITEMS``. A tile has a vocabulary of its own, its items'
   terms only, in columns of ``TERMS`` at a time: the compact item matrix holds 1 where an
   item has the term. Documents are cut into tiles of ``DOCUMENTS``: their matrix holds
   weight times impact of each term. Products are float64 BLAS calls; as all entries are
   integers and a product adds at most ``TERMS`` of them, its sums stay below 2**53 and so
   are exact whatever the order of additions. Sums over column tiles are integers.
4. Of each tile the documents that reach the ``k``-th score of an item are kept, ties
   included, then cut by score and id; a task keeps ``k`` per item. Tasks' rows are
   ranked in two steps, so that no task of the second one reads rows of all tasks.

Bounds: the items are the stated query set. They are taken in blocks of at most
``BLOCK`` pairs of item and term, or one item; a block's terms are what a task and the
driver hold, and each block is one pass over the documents. A document's counts of a
block's terms are one row.

Defined results: a null text has no term; so have an item without text and one without
terms, which no document matches. Repeated item rows are items of their own, a null
``item_id`` is one too. Rows of equal score and id (repeated ones) take consecutive
ranks; a null document id comes last among equals.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.llm.common import column
from martline.sources.staging import stage

TOP = 50
ITEMS, TERMS, DOCUMENTS = 256, 4096, 512
#: Most pairs of item and term of a block, and of a tile, unless one item has more.
BLOCK, TILE = 1 << 16, 1 << 14
EXACT = 1 << 53
#: Every ASCII byte that is no letter or digit parts terms; A-Z become a-z; other bytes stay.
_FOLD = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: str | None) -> list[bytes]:
    """The terms of a whole text, in order, repeats included."""
    return (text or "").encode().translate(_FOLD).split()


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """Written: ``item`` (a number), ``item_id`` and ``term``, each term of an item once; items without terms are left out."""

    @F.arrow_udf(T.ArrayType(T.BinaryType()))
    def distinct(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(set(terms(t.as_py()))) for t in texts], pa.list_(pa.binary()))

    numbered = items.select(column(item_id).alias("item_id"), column(text).alias("text"))
    numbered = stage(numbered.withColumn("item", F.monotonically_increasing_id()), "lexical-items")
    return stage(numbered.select("item", "item_id", F.explode(distinct("text")).alias("term")), "lexical-item-terms")


def _blocks(asked: DataFrame) -> Iterator[dict[int, list[bytes]]]:
    """Terms by item, BLOCK pairs at a time."""
    block: dict[int, list[bytes]] = {}
    pairs = 0
    by_item = asked.groupBy("item").agg(F.collect_list("term").alias("terms")).orderBy("item")
    for row in by_item.toLocalIterator():
        if block and pairs + len(row["terms"]) > BLOCK:
            yield block
            block, pairs = {}, 0
        block[row["item"]] = [bytes(x) for x in row["terms"]]
        pairs += len(row["terms"])
    if block:
        yield block


def term_counts(docs: DataFrame, vocabulary: Sequence[bytes], doc_id: str, text: str) -> DataFrame:
    """Written, per document: ``doc_id``, ``n`` (its terms) and ``ids``, ``tfs`` of those in the vocabulary, by their place in it."""
    shared = docs.sparkSession.sparkContext.broadcast(list(vocabulary))
    kind = T.StructType([
        T.StructField("n", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.LongType())),
    ])

    @F.arrow_udf(kind)
    def matched(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        number = {term: i for i, term in enumerate(shared.value)}
        for texts in batches:
            n, ids, tfs = [], [], []
            for t in texts:
                found = Counter(terms(t.as_py()))
                here = [(number[x], c) for x, c in found.items() if x in number]
                n.append(found.total())
                ids.append([i for i, _ in here])
                tfs.append([c for _, c in here])
            yield pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))], names=["n", "ids", "tfs"]
            )

    rows = docs.select(column(doc_id).cast("long").alias("doc_id"), matched(column(text)).alias("s"))
    return stage(rows.select("doc_id", "s.n", "s.ids", "s.tfs"), "lexical-counts")


def corpus(counts: DataFrame) -> tuple[int, int]:
    """Documents that have a term, and terms of all documents."""
    row = counts.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    return row[0], row[1]


def weigh(counts: DataFrame, documents: int) -> DataFrame:
    """``id, w``: the weight of each vocabulary term that a document has."""
    frequency = counts.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count("*").alias("df"))
    ratio = F.lit(2 * documents + 2).cast("double") / (2 * F.col("df") + 1).cast("double")
    return frequency.select("id", F.floor(1000 * F.log(ratio)).cast("long").alias("w"))


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """(1000000000 * tf) div (1000 * tf + 20 * m), m = 50 + (50 * n * documents) div length; beyond 64 bits by exact integers."""
    most = 50 * documents * int(n.max(initial=0))
    wide = n if max(most, 10**9 * int(tf.max(initial=0))) < 1 << 63 else n.astype(object)
    m = 50 + (50 * wide * documents) // length
    return ((10**9 * tf.astype(m.dtype)) // (1000 * tf.astype(m.dtype) + 20 * m)).astype(np.int64)


class _Tile:
    """Up to ITEMS items with their own vocabulary and the best documents so far."""

    def __init__(self, items: Sequence[int], of_item: dict[int, np.ndarray], k: int):
        self.items, self.k = items, k
        self.ids = np.unique(np.concatenate([of_item[i] for i in items]))
        self.columns = []
        for at in range(0, len(self.ids), TERMS):
            ids = self.ids[at : at + TERMS]
            matrix = np.zeros((len(items), len(ids)))
            for row, i in enumerate(items):
                own = of_item[i]
                matrix[row, np.searchsorted(ids, own[(own >= ids[0]) & (own <= ids[-1])])] = 1
            self.columns.append((ids, matrix))
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)) for _ in items]
        self.least = np.zeros(len(items), np.int64)  # a document below an item's k-th score so far cannot enter

    def add(self, documents: np.ndarray, null: np.ndarray, rows: np.ndarray, ids: np.ndarray, values: np.ndarray) -> None:
        """Score a tile of documents: ``rows`` (numbers in it), ``ids`` and ``values`` of their terms."""
        scores = np.zeros((len(self.items), len(documents)), np.int64)
        for known, matrix in self.columns:
            place = np.searchsorted(known, ids)
            place[place == len(known)] = 0
            hit = known[place] == ids
            if hit.any():
                dense = np.zeros((len(known), len(documents)))
                dense[place[hit], rows[hit]] = values[hit]
                scores += (matrix @ dense).astype(np.int64)
        for row in np.flatnonzero((scores > 0).any(axis=1) & (scores.max(axis=1) >= self.least)):
            own = scores[row]
            # All that reach the k-th score, ties included; ids decide among them.
            near = np.flatnonzero(own >= max(1, self.least[row]))
            if len(near) > self.k:
                near = near[own[near] >= np.partition(own[near], -self.k)[-self.k]]
            if len(near):
                self._keep(row, own[near], documents[near], null[near])

    def _keep(self, row: int, score: np.ndarray, document: np.ndarray, null: np.ndarray) -> None:
        score, document, null = (np.concatenate(x) for x in zip(self.best[row], (score, document, null)))
        order = np.lexsort((document, null, -score))[: self.k]
        self.best[row] = score[order], document[order], null[order]
        if len(order) == self.k:
            self.least[row] = score[order[-1]]


def _tiled(numbers: Sequence[int], of_item: dict[int, np.ndarray]) -> Iterator[list[int]]:
    tile: list[int] = []
    pairs = 0
    for i in numbers:
        if tile and (len(tile) == ITEMS or pairs + len(of_item[i]) > TILE):
            yield tile
            tile, pairs = [], 0
        tile.append(i)
        pairs += len(of_item[i])
    if tile:
        yield tile


_FOUND = "item long, doc_id long, score long"


def _search(of_item: dict[int, np.ndarray], weights: dict[int, int], documents: int, length: int, k: int):
    """Batches of counted documents to the best of them per item."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = sorted(of_item, key=lambda i: (of_item[i].tolist(), i))  # items that share terms share tiles
        tiles = [_Tile(items, of_item, k) for items in _tiled(numbers, of_item)]
        table = np.zeros(max(weights, default=0) + 1, np.int64)
        table[list(weights)] = list(weights.values())
        for batch in batches:
            for at in range(0, batch.num_rows, DOCUMENTS):
                part = batch.slice(at, DOCUMENTS)
                lists, tfs = part["ids"], part["tfs"]
                size = np.asarray(lists.value_lengths())
                rows = np.repeat(np.arange(len(size)), size)
                ids, tf = np.asarray(lists.flatten()), np.asarray(tfs.flatten())
                n = np.asarray(part["n"])
                values = table[ids] * impacts(tf, n[rows], documents, length)
                null = np.asarray(part["doc_id"].is_null())
                named = np.asarray(part["doc_id"].fill_null(0))
                for tile in tiles:
                    tile.add(named, null, rows, ids, values)
        for tile in tiles:
            for item, (score, document, null) in zip(tile.items, tile.best):
                if len(score):
                    yield pa.RecordBatch.from_pydict(
                        {"item": pa.array(np.full(len(score), item)), "doc_id": pa.array(document, mask=null), "score": pa.array(score)}
                    )

    return search


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """``rank`` of the best ``k`` per item; first per item and part, then per item."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    split = found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(max(1, parts // 4))))
    some = split.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("rank") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k).drop("part")


def search(
    items: DataFrame, docs: DataFrame, item_id: str = "item_id", item_text: str = "text", doc_id: str = "doc_id", text: str = "text",
    k: int = TOP,
) -> DataFrame:
    """``item_id, rank, doc_id, score`` of each item's ``k`` best documents of score above 0."""
    spark = docs.sparkSession
    asked = item_terms(items, item_id, item_text)
    names = asked.select("item", "item_id").distinct()
    found = spark.createDataFrame([], "item long, doc_id long, score long, rank int")
    for block in _blocks(asked):
        vocabulary = sorted({x for own in block.values() for x in own})
        number = {term: i for i, term in enumerate(vocabulary)}
        counts = term_counts(docs, vocabulary, doc_id, text)
        of_item = {i: np.array(sorted(number[x] for x in own), np.int32) for i, own in block.items()}
        found = found.unionByName(_best(counts, of_item, k))
    return found.join(names, "item").select("item_id", "rank", "doc_id", "score")


def _best(counts: DataFrame, of_item: dict[int, np.ndarray], k: int) -> DataFrame:
    documents, length = corpus(counts)
    weights = {r["id"]: r["w"] for r in weigh(counts, documents).toLocalIterator()}  # at most one per term of the block
    if TERMS * max(weights.values(), default=0) * 10**6 >= EXACT:
        raise ValueError("a sum of TERMS products could leave 53 bits: lower TERMS")
    best = counts.where(F.size("ids") > 0).mapInArrow(_search(of_item, weights, documents, length, k), _FOUND)
    return stage(_ranked(best, k), "lexical-best")
