"""Exact top-k inner products, norm-sorted, with rotated partial sums.

1. Equal vectors are one candidate that carries its ``k + 1`` smallest ids; equal
   queries are asked once. So a vector that a third of all rows hold costs one.
2. Candidates are cut into blocks by descending length; a block is bounded by its
   longest vector. Block edges come from a count per length class, and a class
   that is too large for a block is split by hash.
3. All vectors are rotated by the right singular vectors of the candidate matrix,
   from its Gram matrix (dimension by dimension, summed over all rows), so that
   the first coordinates hold most of the length.
4. Every query first meets the block of the longest vectors; its k-th score there
   is a bound. It goes on only to blocks whose longest vector can still reach the
   bound by the Cauchy-Schwarz inequality.
5. Within a block, the partial sum over the first rotated coordinates plus the product of
   the lengths of the rest bounds a score; only pairs that can reach the running
   k-th score are computed, in integers.

Pruning uses floating point with a margin for rounding; scores are exact integers.

Defined results: components are turned into integers floor(scale * x); vectors that
are null, or hold a null or a component that is not finite, take no part, neither do
rows without an id; shorter vectors count as filled up with zeros. Integers are kept
as doubles, which hold every floor of a double exactly; beyond 2**300 they count as
2**300. A score beyond 2**63 - 1 in size counts as that, with its sign, so such scores
tie. Rows that repeat id and vector count once; a query never meets its own id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martline.llm.common import column
from martline.sources.staging import stage

#: Rows of a candidate block and of a query part: what one task holds. Larger ones move less.
BLOCK_ROWS, QUERY_ROWS = 1 << 14, 1 << 13
_CHUNK, _ASKED, _LEADING = 2048, 512, 16
_LARGEST, _MOST = 2.0**300, (1 << 63) - 1
#: Length classes: 64 to a doubling. Integers up to 2**300 leave 20,000 of them at most.
_CLASSES = 64


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) per component, as a double; null for a vector that takes no part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))

    def one(x: Column) -> Column:  # from 2**53 on every double is an integer
        large = F.greatest(F.least(x, F.lit(_LARGEST)), F.lit(-_LARGEST))
        return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(large)

    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), F.transform(vector, lambda x: one(x.cast("double") * scale)))


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = 256,
    block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: per query its k best other rows, ties to smaller ids."""
    rows = vectors.select(column(key).cast("long").alias("id"), integers(column(vector), scale).alias("v"), is_query.alias("asks"))
    rows = stage(rows.where("id is not null and v is not null").groupBy("id", "v").agg(F.max("asks").alias("asks")), "topk-rows")

    few = Window.partitionBy("v").orderBy("id")
    listed = rows.select("id", "v").withColumn("nth", F.row_number().over(few)).where(F.col("nth") <= k + 1)
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x))
    classes = listed.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("length", length)
    classes = stage(classes, "topk-classes")
    asked = stage(_parts(rows.where("asks").select("v").distinct().withColumn("length", length), query_rows), "topk-queries")

    most = classes.agg(F.max(F.size("v"))).first()[0] or 1
    rotation = _rotation(classes, most)
    blocks = stage(_blocks(classes, block_rows), "topk-blocks")
    none = F.lit(None).cast("long")
    first = asked.select("part", "q", "v", "length", none.alias("floor"), F.lit(0).alias("block"))
    found = stage(_scored(blocks.where("block = 0"), first, rotation, k), "topk-first")
    floors = found.groupBy("part", "q").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    floors = floors.select("part", "q", F.when(F.col("n") > k, F.col("least")).alias("floor"))
    # Block tops fall, so the blocks a query still needs are those from 1 up to some last one.
    tops = blocks.groupBy("block").agg(F.max("length").alias("top")).agg(F.sort_array(F.collect_list(F.struct("block", "top"))).alias("tops"))
    reach = F.filter(
        "tops", lambda t: F.col("floor").isNull() | (F.col("length") * t["top"] * (1 + 1e-9) + 1 >= F.col("floor"))
    )
    going = asked.join(floors, ["part", "q"], "left").withColumn("tops", tops.scalar())
    going = going.withColumn("last", F.size(reach) - 1).where("last >= 1")
    going = going.select("part", "q", "v", "length", "floor", F.explode(F.sequence(F.lit(1), F.col("last"))).alias("block"))
    more = _scored(blocks.where("block > 0"), going, rotation, k)

    best = Window.partitionBy("part", "q").orderBy(F.col("score").desc(), "vec_id")
    top = found.unionByName(more).withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    own = rows.where("asks").select(F.col("id").alias("query_id"), "v").join(asked.select("part", "q", "v"), "v")
    met = own.drop("v").join(top.drop("place"), ["part", "q"]).where("query_id != vec_id")
    rank = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _parts(queries: DataFrame, query_rows: int) -> DataFrame:
    """``part`` and, within it, the number ``q`` of every distinct query."""
    parts = max(1, -(-queries.count() // query_rows))
    at = queries.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(parts)).cast("int"))
    return at.withColumn("q", F.row_number().over(Window.partitionBy("part").orderBy("v")))


def _blocks(classes: DataFrame, block_rows: int) -> DataFrame:
    """``classes`` with ``block``, numbered by descending length of the longest vector."""
    kind = F.floor(F.log2(F.col("length") + 1) * _CLASSES)
    at = classes.withColumn("kind", kind)
    before = Window.orderBy(F.col("kind").desc()).rowsBetween(Window.unboundedPreceding, -1)
    kinds = at.groupBy("kind").agg(F.count("*").alias("n"))
    kinds = kinds.select(
        "kind", F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / block_rows).alias("base"),
        F.ceil(F.col("n") / block_rows).alias("splits"),
    )
    # 20,000 rows at most, whatever the input: see _CLASSES.
    at = at.join(F.broadcast(kinds), "kind").withColumn("salt", F.pmod(F.xxhash64("v"), F.col("splits"))).drop("kind", "splits")
    tops = at.groupBy("base", "salt").agg(F.max("length").alias("top"))
    number = F.row_number().over(Window.orderBy(F.col("top").desc(), "base", "salt")) - 1
    return at.join(tops.select("base", "salt", number.alias("block")), ["base", "salt"]).select("block", "v", "ids", "length")


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of integers as doubles, filled up with zeros to ``width``."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _rotation(classes: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all candidates, largest singular value first.

    The Gram matrix is summed entry by entry; width * width numbers reach the driver.
    """

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            some = _matrix(batch.column(0), width)
            total += some.T @ some
        yield pa.RecordBatch.from_arrays([pa.array(range(width * width), pa.int32()), pa.array(total.ravel())], names=["at", "x"])

    sums = classes.select("v").mapInArrow(gram, "at int, x double").groupBy("at").agg(F.sum("x").alias("x"))
    matrix = np.zeros(width * width)
    for row in sums.collect():
        matrix[row["at"]] = row["x"]
    return np.linalg.eigh(matrix.reshape(width, width))[1][:, ::-1].copy()


def _scored(blocks: DataFrame, asked: DataFrame, rotation: np.ndarray, k: int) -> DataFrame:
    """Per block and query part, each query's best ``k + 1`` rows: ``part, q, vec_id, score``."""
    needed = asked.select(F.col("block").alias("to_block"), F.col("part").alias("to_part")).distinct()
    sent = blocks.join(needed, F.col("block") == F.col("to_block")).select("to_block", "to_part", "v", "ids", "length")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("part", pa.int32()), ("q", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        width = len(rotation)
        ids = left.column("ids").to_pylist()
        vectors, lengths = _matrix(left.column("v"), width), left.column("length").to_numpy()
        order = np.argsort(-lengths, kind="stable")
        queries = _matrix(right.column("v"), width)
        floors = np.array([np.iinfo(np.int64).min if x is None else x for x in right.column("floor").to_pylist()], np.int64)
        smallest = np.array([x[0] for x in ids], np.int64)
        q, at, scores = best_classes(vectors[order], lengths[order], smallest[order], queries, floors, rotation, k + 1)
        own = [ids[order[i]] for i in at]
        counts = np.array([len(x) for x in own], np.int64)
        q, scores, found = np.repeat(q, counts), np.repeat(scores, counts), np.array([i for x in own for i in x], np.int64)
        keep = _first(q, scores, found, k + 1)
        part = np.full(len(keep), right.column("at_part")[0].as_py(), np.int32)
        return pa.table([part, right.column("q").to_numpy()[q[keep]].astype(np.int32), found[keep], scores[keep]], schema=schema)

    here = asked.select(F.col("block").alias("at_block"), F.col("part").alias("at_part"), "q", "v", "floor")
    return sent.groupBy("to_block", "to_part").cogroup(here.groupBy("at_block", "at_part")).applyInArrow(score, "part int, q int, vec_id long, score long")


def _first(group: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of each group's ``k`` highest scores, ties to smaller ids."""
    order = np.lexsort((ids, -scores, group))
    ranked = group[order]
    starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if len(ranked) else np.empty(0, np.int64)
    nth = np.arange(len(ranked)) - np.repeat(starts, np.diff(np.r_[starts, len(ranked)]))
    return order[nth < k]


def best_classes(
    vectors: np.ndarray, lengths: np.ndarray, ids: np.ndarray, queries: np.ndarray, floors: np.ndarray,
    rotation: np.ndarray, k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, vector and score of each query's ``k`` best; ``vectors`` come by descending length.

    Pairs that cannot reach a query's floor, or its k-th score so far, are not computed.
    """
    lead = min(_LEADING, rotation.shape[1])
    turned, asked = vectors @ rotation, queries @ rotation
    rest, asked_rest = (np.sqrt((x[:, lead:] ** 2).sum(axis=1)) for x in (turned, asked))
    asked_lengths = np.sqrt((asked**2).sum(axis=1))
    in_floats = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * vectors.shape[1] < 2**52
    out = []
    for begin in range(0, len(queries), _ASKED):
        some = slice(begin, begin + _ASKED)
        least = floors[some].copy()
        best = tuple(np.empty(0, np.int64) for _ in range(3))  # query, vector, score
        for at in range(0, len(vectors), _CHUNK):
            margin = asked_lengths[some] * lengths[at] * 1e-9 + 1
            open_ = np.flatnonzero(asked_lengths[some] * lengths[at] + margin >= least)
            if not len(open_):
                break  # vectors only get shorter
            chunk = slice(at, at + _CHUNK)
            bound = asked[some][open_, :lead] @ turned[chunk, :lead].T
            bound += asked_rest[some][open_, None] * rest[None, chunk]
            q, v = np.nonzero(bound + margin[open_, None] >= least[open_, None])
            q, v = open_[q], v + at
            if not len(q):
                continue
            score = _products(queries[some], vectors, q, v, in_floats)
            enough = score >= least[q]
            best = tuple(np.concatenate(x) for x in zip(best, (q[enough], v[enough], score[enough])))
            keep = _first(best[0], best[2], ids[best[1]], k)
            best = tuple(x[keep] for x in best)
            full = np.bincount(best[0], minlength=len(least)) >= k
            lowest = np.full(len(least), np.iinfo(np.int64).max)
            np.minimum.at(lowest, best[0], best[2])
            least = np.where(full, np.maximum(least, lowest), least)
        out.append((best[0] + begin, best[1], best[2]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _products(queries: np.ndarray, vectors: np.ndarray, q: np.ndarray, v: np.ndarray, in_floats: bool) -> np.ndarray:
    """Exact integer inner products of the listed pairs, at most ``_MOST`` in size."""
    low, high = v.min(), v.max() + 1
    if in_floats and len(q) * 4 > len(queries) * (high - low):  # most of the block is wanted; every sum fits a double
        return (queries @ vectors[low:high].T).astype(np.int64)[q, v - low]
    out = np.empty(len(q), np.int64)
    for i in range(0, len(q), 1 << 16):
        part = slice(i, i + (1 << 16))
        out[part] = _exact(queries[q[part]], vectors[v[part]], in_floats)
    return out


def _exact(a: np.ndarray, b: np.ndarray, in_floats: bool) -> np.ndarray:
    """Row by row. A sum is at most the product of the lengths: in 64 bits where that is, else certain to be beyond, or added up in long integers."""
    if in_floats:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    sizes = np.sqrt((a**2).sum(axis=1)) * np.sqrt((b**2).sum(axis=1))
    fits = sizes < 2.0**62
    out = np.zeros(len(a), np.int64)
    small = fits & (sizes > 0)
    out[small] = np.einsum("ij,ij->i", a[small].astype(np.int64), b[small].astype(np.int64))
    about = np.einsum("ij,ij->i", a, b)
    beyond = ~fits & (np.abs(about) > 2.0**63 + sizes * 1e-9)
    out[beyond] = np.where(about[beyond] > 0, _MOST, -_MOST)
    for i in np.flatnonzero(~fits & ~beyond):
        score = sum(int(x) * int(y) for x, y in zip(a[i], b[i]))
        out[i] = max(-_MOST, min(_MOST, score))
    return out
