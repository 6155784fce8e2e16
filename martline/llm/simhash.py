"""Near-duplicate documents by SimHash fingerprints and a binary trie self-join.

A fingerprint bit is 1 if it is set in more than half of the hashes of a text's
shingles, repeats included. Fingerprints of at most ``BITS`` differing bits are linked.

The trie is a sorted list of distinct fingerprints: a node is the range that shares a
prefix. A pair of nodes is followed from the root, both nodes together: to the pairs of
their children, adding up the bits in which the branches differ, and no further once
these exceed the budget. Small pairs of ranges are compared fingerprint by fingerprint
with the bits that are left.

1. Equal fingerprints become one, with its smallest id.
2. The upper levels of the trie are followed as rows: every level turns a node pair into
   its child pairs and drops those beyond the budget. Node pairs whose nodes exist
   remain. Nodes hold ``BLOCK`` fingerprints or fewer on average, a fuller one is cut
   into blocks, each of which meets all that the node meets.
3. A group holds one block and up to ``PARTNERS`` that it meets; the lower levels are
   followed in it. Of the links found a group gives only those that connect what it has
   not connected yet, so a crowd of near copies gives no more rows than it has members.
4. Components of the links, by repeated smallest labels; then every row takes the
   smallest id of its component.

Defined results: A-Z lower-cased, words are runs of anything but the six ASCII
white-space characters; fewer words than a shingle takes are one shingle, a text without
words has fingerprint zero and is linked like any other. Rows are the nodes: repeated rows
have one fingerprint and so one component. A null id is never the smallest; a component of
null ids only has a null one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.llm.common import column
from martline.llm.minhash import connected
from martline.sources.staging import stage

SHINGLE, SEED, BITS, WIDTH = 4, 42, 4, 64
#: Most fingerprints of a block on average; the least for which a trie is cut at all, up to 2**FEW_LEVELS nodes.
BLOCK, LEAST, FEW_LEVELS = 1 << 20, 1 << 12, 5
PARTNERS = 8
#: Ranges with no more pairs of fingerprints are compared directly, the smaller ones many at a time; most node pairs held at a time.
DIRECT, FEW, FRONTIER = 1 << 13, 64, 1 << 13
#: Shingles of a long text that are hashed at a time.
PART = 1 << 16
_U64 = np.uint64


def fingerprint(text: str | None, size: int = SHINGLE, seed: int = SEED) -> int:
    """The 64 bits of a whole text, as a signed number."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, six white-space characters
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(size, len(words))
    starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    hashed, counts = xxhash.xxh64_intdigest, np.zeros(WIDTH, np.int64)
    for at in range(0, len(starts), PART):
        places = zip(starts[at : at + PART].tolist(), ends[at : at + PART].tolist())
        part = np.array([hashed(joined[a:b], seed) for a, b in places], "<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<i8")[0])


def fingerprints(text: Column, size: int = SHINGLE, seed: int = SEED) -> Column:
    @F.arrow_udf(T.LongType())
    def each(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.as_py(), size, seed) for t in texts], pa.int64())

    return each(text)


# --- the lower levels, in one group ----------------------------------------------


def _split(block: np.ndarray, lo: np.ndarray, hi: np.ndarray, level: int) -> np.ndarray:
    """Where the fingerprints with bit ``level`` begin in ranges whose higher bits are equal."""
    above = _U64((1 << WIDTH) - (1 << level + 1))
    middle = np.searchsorted(block, (block[lo] & above) | _U64(1 << level))
    return np.clip(middle, lo, hi)


def _product(lo_a, hi_a, lo_b, hi_b) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of positions of each pair of ranges."""
    n, m = hi_a - lo_a, hi_b - lo_b
    total = n * m
    of = np.repeat(np.arange(len(total)), total)
    at = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
    return lo_a[of] + at // m[of], lo_b[of] + at % m[of]


def _compared(a: np.ndarray, b: np.ndarray, bits: int, lo_a, hi_a, lo_b, hi_b) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the fingerprints within ``bits`` bits of each other, of each pair of ranges."""
    few = (hi_a - lo_a) * (hi_b - lo_b) <= FEW
    x, y = _product(lo_a[few], hi_a[few], lo_b[few], hi_b[few])
    met = np.bitwise_count(a[x] ^ b[y]) <= bits
    xs, ys = [x[met]], [y[met]]
    for i, i_end, j, j_end in zip(*(v[~few].tolist() for v in (lo_a, hi_a, lo_b, hi_b))):
        table = np.bitwise_count(a[i:i_end, None] ^ b[None, j:j_end]) <= bits
        if table.any():
            x, y = table.nonzero()
            xs.append(x + i)
            ys.append(y + j)
    return np.concatenate(xs), np.concatenate(ys)


def near(a: np.ndarray, b: np.ndarray, bits: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions in two sorted arrays of distinct fingerprints that differ in at most ``bits`` bits, part by part.

    ``same``: both are one array, and each pair of different positions comes once.
    Parts of the traversal are put aside on a stack, so memory does not grow with it.
    """
    if not len(a) or not len(b):
        return
    root = (np.array([0]), np.array([len(a)]), np.array([0]), np.array([len(b)]), np.array([0]), WIDTH - 1)
    stack = [root]
    while stack:
        lo_a, hi_a, lo_b, hi_b, spent, level = stack.pop()
        if len(lo_a) > FRONTIER:
            cut = len(lo_a) // 2
            for part in (slice(cut), slice(cut, None)):
                stack.append((lo_a[part], hi_a[part], lo_b[part], hi_b[part], spent[part], level))
            continue
        small = (hi_a - lo_a) * (hi_b - lo_b) <= DIRECT
        if level < 0:
            small[:] = True
        if small.any():
            x, y = _compared(a, b, bits, lo_a[small], hi_a[small], lo_b[small], hi_b[small])
            if same:
                x, y = x[x < y], y[x < y]
            if len(x):
                yield x, y
        lo_a, hi_a, lo_b, hi_b, spent = (v[~small] for v in (lo_a, hi_a, lo_b, hi_b, spent))
        if not len(lo_a):
            continue
        mid_a, mid_b = _split(a, lo_a, hi_a, level), _split(b, lo_b, hi_b, level)
        children = [
            (*left, *right, spent + (i != j))
            for i, left in enumerate(((lo_a, mid_a), (mid_a, hi_a)))
            for j, right in enumerate(((lo_b, mid_b), (mid_b, hi_b)))
        ]
        joined = [np.concatenate(c) for c in zip(*children)]
        alive = (joined[0] < joined[1]) & (joined[2] < joined[3]) & (joined[4] <= bits)
        if same:  # the mirror image of a pair is left out
            alive &= joined[0] <= joined[2]
        if alive.any():
            stack.append((*(v[alive] for v in joined), level - 1))


class Forest:
    """Components of numbers from 0; adds links and tells which of them connected anything."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.label[x]
            if (up == x).all():
                return x
            x = up

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        """Hooks larger roots under smaller ones until all ends agree."""
        ends = np.concatenate([x, y])
        while len(x):
            x, y = self.roots(x), self.roots(y)
            apart = x != y
            x, y = x[apart], y[apart]
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
        self.label[ends] = self.roots(ends)

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Each number that is no root with its root."""
        top = self.roots(np.arange(len(self.label)))
        own = np.flatnonzero(top != np.arange(len(top)))
        return own, top[own]


_LINKS = "a long, a2 long"


def _links_of(bits: int):
    def links(left: pa.Table, right: pa.Table) -> pa.Table:
        block = np.sort(np.concatenate([np.asarray(v.values) for v in left["fps"]]).view(_U64))
        others = [(np.sort(np.asarray(v.values).view(_U64)), same) for v, same in zip(right["fps"], right["same"].to_pylist())]
        every = np.unique(np.concatenate([block, *(o for o, _ in others)]))
        forest, here = Forest(len(every)), np.searchsorted(every, block)
        for other, same in others:
            there = np.searchsorted(every, other)
            for x, y in near(block, other, bits, same):
                forest.add(here[x], there[y])
        x, y = forest.edges()
        return pa.table({"a": every[x].view(np.int64), "a2": every[y].view(np.int64)})

    return links


# --- the upper levels, as rows -----------------------------------------------------


def node_pairs(df: DataFrame, levels: int, bits: int) -> DataFrame:
    """``x, y``: pairs of prefixes of ``levels`` bits, x <= y, that differ in at most ``bits`` bits.

    ``df`` gives the session. Every level turns a pair into its child pairs.
    """
    spark = df.sparkSession
    pairs = spark.range(1).select(F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), F.lit(0).alias("spent"))
    branches = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)]))
    for level in range(levels):
        pairs = pairs.select("*", branches.alias("to")).select(
            (2 * F.col("x") + F.col("to.i")).alias("x"), (2 * F.col("y") + F.col("to.j")).alias("y"),
            (F.col("spent") + F.when(F.col("to.i") != F.col("to.j"), 1).otherwise(0)).alias("spent"),
        ).where((F.col("spent") <= bits) & (F.col("x") <= F.col("y")))
        if level % 6 == 5:
            pairs = pairs.repartition("x", "y")
    return pairs.select("x", "y")


def _blocks(own: DataFrame, levels: int) -> DataFrame:
    """Fingerprints by trie node of ``levels`` bits, fuller nodes cut: ``node``, ``cut``, ``cuts``, ``fps``; written."""
    node = F.shiftrightunsigned("fp", WIDTH - levels) if levels else F.lit(0).cast("long")
    placed = own.select("fp", node.alias("node"))
    sizes = placed.groupBy("node").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("cuts"))
    named = placed.join(sizes, "node").withColumn("cut", F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int"))
    return stage(named.groupBy("node", "cuts", "cut").agg(F.collect_list("fp").alias("fps")), "simhash-blocks")


def links(own: DataFrame, bits: int = BITS) -> DataFrame:
    """``a, a2``: links that connect all ``fp`` of ``own`` (distinct, written) within ``bits`` bits of each other."""
    n = own.count()
    levels = max(math.ceil(math.log2(max(1, n / BLOCK))), min(FEW_LEVELS, math.ceil(math.log2(max(1, n / LEAST)))))
    blocks = _blocks(own, levels)
    names = blocks.select("node", "cut")
    left, right = names.select(F.col("node").alias("x"), F.col("cut").alias("i")), names.select(F.col("node").alias("y"), F.col("cut").alias("j"))
    met = node_pairs(own, levels, bits).join(left, "x").join(right, "y").where((F.col("x") < F.col("y")) | (F.col("i") <= F.col("j")))
    part = F.pmod(F.xxhash64("y", "j"), F.ceil(F.col("all") / PARTNERS)).cast("int")
    counted = stage(met, "simhash-pairs")
    sizes = counted.groupBy("x", "i").agg(F.count("*").alias("all"))
    pairs = counted.join(sizes, ["x", "i"]).select("x", "i", "y", "j", part.alias("part"))
    fps = blocks.select("node", "cut", "fps")
    ours = pairs.select("x", "i", "part").distinct().join(fps, (F.col("x") == F.col("node")) & (F.col("i") == F.col("cut")))
    same = ((F.col("x") == F.col("y")) & (F.col("i") == F.col("j"))).alias("same")
    theirs = pairs.join(fps, (F.col("y") == F.col("node")) & (F.col("j") == F.col("cut"))).select("x", "i", "part", same, "fps")
    keys = ["x", "i", "part"]
    ours, theirs = ours.select(*keys, "fps").toDF(*keys, "fps"), theirs.toDF("ox", "oi", "opart", "same", "fps")
    return ours.groupBy(*keys).cogroup(theirs.groupBy("ox", "oi", "opart")).applyInArrow(_links_of(bits), _LINKS)


def components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, seed: int = SEED, bits: int = BITS
) -> DataFrame:
    """Per row: ``doc_id``, ``fp`` (signed) and ``component_id``."""
    rows = docs.select(column(key).cast("long").alias("doc_id"), fingerprints(column(text), size, seed).alias("fp"))
    rows = stage(rows, "simhash-rows")
    own = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-own")
    zero = F.lit(0).cast("long")
    found = stage(links(own, bits).distinct(), "simhash-links")
    joined = found.select("a", zero.alias("b"), "a2", zero.alias("b2"))
    labels = connected(joined, rows.sparkSession.createDataFrame([], "a long, b long, la long, lb long"))
    named = own.join(labels.select(F.col("a").alias("fp"), "la"), "fp", "left").select("fp", "least", F.coalesce("la", "fp").alias("label"))
    tops = named.groupBy("label").agg(F.min("least").alias("component_id"))
    by_fp = stage(named.join(tops, "label").select("fp", "component_id"), "simhash-components")
    return rows.join(by_fp, "fp").select("doc_id", "fp", "component_id")
