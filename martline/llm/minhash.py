"""Near-duplicate documents by fast similarity sketching, banding and exact checks.

A document's set holds the hashes of its distinct shingles. Its sketch has
``BANDS * ROWS`` coordinates. Round after round every element is thrown into one
coordinate and leaves there round plus hash, if that is smaller; after as many
rounds as there are coordinates, round ``t + b`` throws all elements into coordinate
b. So every coordinate is filled, mostly in the first rounds, and agrees between two
sets with the chance of their Jaccard similarity, with sums as concentrated as those
of independent draws.

1. Rows with equal sets form a class; its smallest id stands for it.
2. Classes that share a band meet in a bucket. Members are compared on full sets with
   their bucket's leader, drawn by hash, if they are not in its component yet: first
   in a few bands, which connect most of a large group, then in all of them, and
   again with other leaders while many pairs are open and links are found.
3. Then members of a bucket that are still in different components are compared,
   unless they have been, or are surely no link. In buckets with up to ``LIST`` open
   pairs per member a bound from ``PARITY`` bits per set tells that. In larger ones
   only pairs are listed that share one of their rarest shingles: sets that are links
   must, if each shows as many as it may miss, plus one. So each pair that shares a
   band is compared, already connected or surely none: no link that banding finds is
   lost. Where the rarest shingles are so common that they would list more pairs than
   the buckets hold, the parity bits decide there too.

A pair at the threshold of 0.8 shares no band with a chance of (1 - 0.8**ROWS)**BANDS,
about 2e-6.

Hot groups: copies are one class; a group of near copies costs its leader
comparisons, not its pairs; leaders are found by aggregation and members meet them
in joins that the engine splits; large classes, components and shingles are salted.

Defined results: words are runs of anything but the six ASCII white-space
characters, A-Z lower-cased. A text without words has the empty set and is linked
with nothing. Rows are the nodes: rows of one id may lie in different components. A
null id is never the smallest; a component of null ids only has a null one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.llm.common import WORD, column, free_name, two_hashes, whole
from martline.operators.joins import hot_keys, left_join
from martline.sources.staging import stage

SHINGLE, PERCENT = 5, 80
ROWS, BANDS = 7, 56
#: Bits of the parity words; long sets fill them and are then not told apart by them.
PARITY = 1024
#: Bands of the first round, most rounds with leaders, and open pairs per member that end them.
FIRST_BANDS, LEADER_ROUNDS, FEW = 4, 6, 256
#: Open pairs per member up to which a bucket's pairs are listed without looking at shingles.
LIST = 16
_U64 = np.uint64
_MIX = (_U64(0xBF58476D1CE4E5B9), _U64(0x94D049BB133111EB))
#: Odd multipliers, one per place in a shingle, repeated with another rotation for longer ones.
_PLACE = 0x9E3779B97F4A7C15


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(30))) * _MIX[0]
    x = (x ^ (x >> _U64(27))) * _MIX[1]
    return x ^ (x >> _U64(31))


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a whole text."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, six white-space characters
    if not words:
        return np.empty(0, _U64)
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words])
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in number], _U64)[ids]
    width = min(size, len(words))
    total = np.zeros(len(words) - width + 1, _U64)
    for i in range(width):
        total = _mixed(total * _U64(_PLACE) + hashes[i : i + len(total)] + _U64(i + 1))
    return np.unique(total)


def sketch(elements: np.ndarray, size: int) -> np.ndarray:
    """``size`` coordinates of a set that is not empty."""
    empty = np.iinfo(_U64).max
    filled = np.full(size, empty, _U64)
    at, some = 0, max(1, math.ceil(size * (math.log(size) + 1) / len(elements)))
    while at < size and (filled == empty).any():
        rounds = np.arange(at, min(size, at + some), dtype=_U64)
        thrown = _mixed(elements[None, :] ^ _mixed(rounds + _U64(1))[:, None])
        place = ((thrown >> _U64(40)) * _U64(size)) >> _U64(24)
        value = (rounds[:, None] << _U64(40)) | (thrown & _U64((1 << 40) - 1))
        np.minimum.at(filled, place.ravel().astype(np.int64), value.ravel())
        at, some = at + len(rounds), max(1, some // 2)
    for b in np.flatnonzero(filled == empty):
        thrown = _mixed(elements ^ _mixed(np.array([size + b + 1], _U64)))
        filled[b] = _U64((size + int(b)) << 40) | (thrown & _U64((1 << 40) - 1)).min()
    return filled


def bands(coordinates: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band, different from band to band."""
    table = coordinates.reshape(-1, rows)
    keys = _mixed(np.arange(1, len(table) + 1, dtype=_U64))
    for i in range(rows):
        keys = _mixed(keys * _U64(_PLACE) + table[:, i])
    return keys


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """100 * intersection >= percent * union, on sorted distinct arrays."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    place = np.searchsorted(b, a)
    place[place == len(b)] = 0
    common = int(np.count_nonzero(b[place] == a))
    return 100 * common >= percent * (len(a) + len(b) - common)


def parity(elements: np.ndarray) -> np.ndarray:
    """PARITY bits, as 64-bit words: each element flips the bit its hash names.

    Two sets' words differ in no more bits than the sets differ in elements.
    """
    named = (_mixed(elements ^ _MIX[0]) >> _U64(32)) % _U64(PARITY)
    odd = np.bincount(named.astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _signatures(size: int, rows: int, count: int):
    long = T.LongType()
    kinds = {"n": long, "a": long, "b": long, "bands": T.ArrayType(long), "odd": T.ArrayType(long)}

    @F.arrow_udf(T.StructType([T.StructField(name, kind) for name, kind in kinds.items()]))
    def signed(texts: pa.Array) -> pa.Array:
        n, a, b, keys, odd = [], [], [], [], []
        for text in texts:
            found = shingles(text.as_py(), size)
            n.append(len(found))
            a.append(_signed(int(_mixed(found).sum(dtype=_U64))))
            b.append(_signed(int(_mixed(found ^ _U64(_PLACE)).sum(dtype=_U64))))
            keys.append(bands(sketch(found, rows * count), rows).view(np.int64) if len(found) else [])
            odd.append(parity(found) if len(found) else [])
        return pa.StructArray.from_arrays(
            [*(pa.array(x, pa.int64()) for x in (n, a, b)), *(pa.array(x, pa.list_(pa.int64())) for x in (keys, odd))],
            names=list(kinds),
        )

    return signed


def _linked(size: int, percent: int):
    @F.arrow_udf(T.BooleanType())
    def linked(left: pa.Array, right: pa.Array) -> pa.Array:
        out, last, last_set = [], None, None
        for x, y in ((x.as_py(), y.as_py()) for x, y in zip(left, right)):  # a pair at a time: a batch's texts twice over are large
            if x != last:
                last, last_set = x, shingles(x, size)
            out.append(similar(last_set, shingles(y, size), percent))
        return pa.array(out, pa.bool_())

    return linked


def _elements(size: int):
    @F.arrow_udf(T.ArrayType(T.LongType()))
    def elements(texts: pa.Array) -> pa.Array:
        return pa.array([shingles(text.as_py(), size).view(np.int64) for text in texts], pa.list_(pa.int64()))

    return elements


def _text_key(text: Column) -> list[Column]:
    a, b = two_hashes(whole(text))
    return [a.alias("ta"), b.alias("tb")]


def components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT,
    rows: int = ROWS, count: int = BANDS,
) -> DataFrame:
    """Per row: ``doc_id``, ``ta`` and ``tb`` (128 bits of the text), ``n_shingles``, ``class_a``, ``class_b``, ``component_id``."""
    spark = docs.sparkSession
    source = docs.select(column(key).cast("long").alias("doc_id"), column(text).alias("text"))
    nodes = source.withColumn("s", _signatures(size, rows, count)("text"))
    nodes = stage(nodes.select("doc_id", *_text_key(F.col("text")), "s.*"), "minhash-nodes")

    first = ["doc_id", "ta", "tb"]
    in_class = Window.partitionBy("a", "b", "n").orderBy(F.col("doc_id").asc_nulls_last(), "ta", "tb")
    ranked = nodes.where("n > 0").withColumn("place", F.row_number().over(in_class)).where("place = 1")
    reps = stage(ranked.select(*first, "n", "a", "b", "bands", "odd"), "minhash-classes")

    members = reps.select(F.posexplode("bands").alias("place", "band"), "a", "b", "n")
    shared = members.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    crowd = stage(members.join(shared.select("band"), "band", "left_semi"), "minhash-buckets")
    texts = _texts(source, reps, crowd.select("a", "b").distinct())  # the corpus is read for texts this once

    tested = spark.createDataFrame([], "a long, b long, a2 long, b2 long")
    labels = spark.createDataFrame([], "a long, b long, la long, lb long")
    turn, found, crossed = 1, True, False
    while not crossed:
        here = crowd.where(F.col("place") < FIRST_BANDS) if turn == 1 else crowd
        open_members = stage(_unresolved(here, labels), "minhash-open")
        if turn > 2:
            crossed = not found or turn > LEADER_ROUNDS or _few_open_pairs(open_members)
        if crossed:
            asked = _last_pairs(open_members, reps.select("a", "b", "odd"), texts, size, percent)
        else:
            asked = _leader_pairs(open_members, turn)
        fresh = _close(asked, percent).distinct().join(tested, ["a", "b", "a2", "b2"], "left_anti")
        judged = _verify(stage(fresh, "minhash-pairs"), texts, size, percent)
        links = judged.where("linked").drop("linked")
        found = not links.isEmpty()
        if found:
            labels = connected(links, labels)
        if not crossed:
            tested = stage(tested.unionByName(judged.drop("linked")), "minhash-tested")
        turn += 1
    return _labelled(nodes, labels)


def _close(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs that their sizes allow, the smaller fingerprint first."""
    swap = F.struct("a", "b") > F.struct(F.col("a2").alias("a"), F.col("b2").alias("b"))
    allowed = pairs.where(100 * F.least("n", "n2") >= percent * F.greatest("n", "n2"))
    return allowed.select(
        F.when(swap, F.col("a2")).otherwise(F.col("a")).alias("a"), F.when(swap, F.col("b2")).otherwise(F.col("b")).alias("b"),
        F.when(swap, F.col("a")).otherwise(F.col("a2")).alias("a2"), F.when(swap, F.col("b")).otherwise(F.col("b2")).alias("b2"),
    )


def _texts(source: DataFrame, reps: DataFrame, classes: DataFrame) -> DataFrame:
    """``a, b, text`` of the representatives of ``classes``, written."""
    where = reps.select("doc_id", "ta", "tb", "a", "b").join(classes, ["a", "b"], "left_semi").alias("w")
    rows = source.select("doc_id", *_text_key(F.col("text")), "text").alias("s")
    same = F.col("s.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("s.ta") == F.col("w.ta")) & (F.col("s.tb") == F.col("w.tb"))
    texts = rows.join(where, same).select("w.a", "w.b", "s.text")
    return stage(texts.dropDuplicates(["a", "b"]), "minhash-texts")


def _verify(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """``pairs`` with ``linked``, from the whole texts of both classes."""
    other = texts.select(F.col("a").alias("a2"), F.col("b").alias("b2"), F.col("text").alias("text2"))
    both = pairs.join(texts, ["a", "b"]).join(other, ["a2", "b2"])
    judged = both.withColumn("linked", _linked(size, percent)("text", "text2"))
    return stage(judged.select("a", "b", "a2", "b2", "linked"), "minhash-tested")


def connected(links: DataFrame, labels: DataFrame) -> DataFrame:
    """``labels`` after ``links``: ``a, b`` (node) and ``la, lb`` (label) for every node with a link.

    Links are carried over to the components they join, so old ones are not walked
    again. Each turn then takes the smallest label among the neighbours and that
    label's label, until none changes. Labels are written after each turn.
    """
    ends = links.select(F.struct("a", "b").alias("x"), F.struct(F.col("a2").alias("a"), F.col("b2").alias("b")).alias("y"))
    known = stage(labels.select(F.struct("a", "b").alias("id"), F.struct(F.col("la").alias("a"), F.col("lb").alias("b")).alias("top")), "labels")
    for end in ("x", "y"):
        ends = ends.join(known, F.col(end) == F.col("id"), "left").withColumn(end, F.coalesce("top", end)).drop("id", "top")
    both = F.explode(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y"))))
    edges = stage(ends.where("x != y").select(both.alias("e")).select("e.x", "e.y").distinct(), "links")
    merged = stage(edges.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("id"), F.least("x", "m").alias("label")), "labels")
    while True:
        near = edges.join(merged, edges.y == merged.id).groupBy("x").agg(F.min("label").alias("m"))
        stepped = merged.join(near, merged.id == near.x).select("id", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        stepped = stage(stepped, "labels")
        up = stepped.select(F.col("id").alias("up"), F.col("label").alias("top"))
        jumped = stepped.join(up, stepped.label == up.up).select("id", "old", F.least("label", "top").alias("label"))
        merged = stage(jumped, "labels")
        if merged.where("old != label").isEmpty():
            break
        merged = merged.select("id", "label")
    merged = merged.select(F.col("id").alias("from"), "label")
    old = known.join(merged, F.col("top") == F.col("from"), "left").select("id", F.coalesce("label", "top").alias("label"))
    new = merged.join(known, F.col("from") == F.col("id"), "left_anti").select(F.col("from").alias("id"), "label")
    return stage(old.union(new).select("id.a", "id.b", F.col("label.a").alias("la"), F.col("label.b").alias("lb")), "labels")


def _unresolved(crowd: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets with several components, with their labels."""
    named = crowd.join(labels, ["a", "b"], "left").select(
        "band", "a", "b", "n", F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("lb"))
    label = F.struct("la", "lb")
    mixed = named.groupBy("band").agg(F.min(label).alias("lo"), F.max(label).alias("hi")).where("lo != hi")
    return named.join(mixed.select("band"), "band", "left_semi")


def _few_open_pairs(members: DataFrame) -> bool:
    """Whether pairs of different components are no more than FEW per member, counted without listing them."""
    parts = members.groupBy("band", "la", "lb").agg(F.count("*").cast("double").alias("n"))
    buckets = parts.groupBy("band").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("within"))
    total = buckets.agg(F.sum(F.col("n") * F.col("n") - F.col("within")) / 2, F.sum("n")).first()
    return (total[0] or 0) <= FEW * (total[1] or 0)


def _leader_pairs(members: DataFrame, turn: int) -> DataFrame:
    drawn = F.struct(F.xxhash64(F.lit(turn), "a", "b").alias("turn"), "a", "b", "n", "la", "lb")
    leaders = members.groupBy("band").agg(F.min(drawn).alias("l"))
    met = members.join(leaders, "band").where((F.col("la") != F.col("l.la")) | (F.col("lb") != F.col("l.lb")))
    return met.select("a", "b", "n", F.col("l.a").alias("a2"), F.col("l.b").alias("b2"), F.col("l.n").alias("n2"))


def _last_pairs(members: DataFrame, odd: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs that leaders have left open: by parity words in small buckets, by rare shingles in large ones."""
    parts = members.groupBy("band", "la", "lb").agg(F.count("*").cast("double").alias("n"))
    buckets = parts.groupBy("band").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("within"))
    pairs = (F.col("n") * F.col("n") - F.col("within")) / 2
    large = stage(buckets.where(pairs > LIST * F.col("n")).select("band", pairs.alias("pairs")), "minhash-large")
    total = large.agg(F.sum("pairs")).first()[0]
    if total is None:
        return _cross_pairs(members.join(odd, ["a", "b"]), percent)
    rare = _rarest(members.join(large, "band", "left_semi").select("a", "b", "n", "la", "lb").distinct(), texts, size, percent)
    if _listed_by(rare) > total:
        return _cross_pairs(members.join(odd, ["a", "b"]), percent)
    small = members.join(large, "band", "left_anti").join(odd, ["a", "b"])
    return _cross_pairs(small, percent).unionByName(_rare_pairs(rare, percent))


def _rarest(classes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """``e`` (shingle of more than one class), its place ``nth`` among those of ``a, b``, rarest first.

    Listed are the places at which the first shingle shared with a larger set may
    stand; ``short`` marks those at which one shared with a set at least as small may not.
    """
    sets = texts.join(classes.select("a", "b", "n"), ["a", "b"])
    elements = stage(sets.select("a", "b", "n", F.explode(_elements(size)("text")).alias("e")), "minhash-elements")
    counts = stage(elements.groupBy("e").agg(F.count("*").alias("classes")).where("classes > 1"), "minhash-counts")
    counted = left_join(elements, counts, "e", "a", hot=stage(hot_keys(elements, "e"), "minhash-hot-elements"))
    order = Window.partitionBy("a", "b").orderBy(F.coalesce("classes", F.lit(1)), "e")
    left = F.col("n") - F.col("nth") + 1  # elements from this one on
    placed = counted.withColumn("nth", F.row_number().over(order)).where((F.col("classes") > 1) & (100 * left >= percent * F.col("n")))
    short = (100 + percent) * left >= 2 * percent * F.col("n")
    return stage(placed.select("e", "nth", "a", "b", short.alias("short")).join(classes, ["a", "b"]), "minhash-rarest")


def _listed_by(rare: DataFrame) -> float:
    """How many pairs of rows meet in a shingle, counted without listing them."""
    met = rare.groupBy("e").agg(F.count_if("short").cast("double").alias("x"), F.count("*").cast("double").alias("y"))
    return met.agg(F.sum(F.col("x") * F.col("y"))).first()[0] or 0


def _rare_pairs(rare: DataFrame, percent: int) -> DataFrame:
    """Pairs of two components that share a shingle before too few are left for a link."""
    x, y = rare.where("short").alias("x"), rare.alias("y")
    apart = (F.col("x.la") != F.col("y.la")) | (F.col("x.lb") != F.col("y.lb"))
    ordered = F.struct("x.n", "x.a", "x.b") < F.struct("y.n", "y.a", "y.b")
    both = F.col("x.n") + F.col("y.n")
    enough = [(100 + percent) * (F.col(f"{s}.n") - F.col(f"{s}.nth") + 1) >= percent * both for s in "xy"]
    met = x.join(y, (F.col("x.e") == F.col("y.e")) & apart & ordered & enough[0] & enough[1])
    return met.select("x.a", "x.b", "x.n", F.col("y.a").alias("a2"), F.col("y.b").alias("b2"), F.col("y.n").alias("n2"))


def _cross_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of one bucket and two components that can still be links; what leaders have left open.

    Sets of sizes summing to s are links only if they differ in no more than
    s * (100 - percent) / (100 + percent) elements. Their parity words differ in at
    most as many bits, so pairs beyond that are surely none and are not listed.
    """
    x, y = members.alias("x"), members.alias("y")
    apart = (F.col("x.la") != F.col("y.la")) | (F.col("x.lb") != F.col("y.lb"))
    ordered = F.struct(F.col("x.a"), F.col("x.b")) < F.struct(F.col("y.a"), F.col("y.b"))
    differ = sum(
        (F.bit_count(F.col("x.odd")[i].bitwiseXOR(F.col("y.odd")[i])) for i in range(PARITY // 64)), start=F.lit(0)
    )
    near = (100 + percent) * differ <= (100 - percent) * (F.col("x.n") + F.col("y.n"))
    met = x.join(y, (F.col("x.band") == F.col("y.band")) & apart & ordered & near)
    return met.select("x.a", "x.b", "x.n", F.col("y.a").alias("a2"), F.col("y.b").alias("b2"), F.col("y.n").alias("n2"))


def _labelled(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row of ``nodes`` with the smallest id of its component."""
    own = nodes.select("doc_id", "ta", "tb", "n", "a", "b")
    worded = own.where("n > 0").select("doc_id", "ta", "tb", "n", F.struct("a", "b").alias("class"))
    worded = stage(worded.withColumn("spread", F.monotonically_increasing_id()), "minhash-worded")
    known = labels.select(F.struct("a", "b").alias("class"), F.struct(F.col("la").alias("a"), F.col("lb").alias("b")).alias("label"))
    named = left_join(worded, known, "class", "spread", hot=stage(hot_keys(worded, "class"), "minhash-hot-classes"))
    named = stage(named.select("doc_id", "ta", "tb", "n", F.coalesce("label", "class").alias("label"), "spread"), "minhash-named")
    smallest = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    full = left_join(named, smallest, "label", "spread", hot=stage(hot_keys(named, "label"), "minhash-hot-labels"))
    full = full.select("doc_id", "ta", "tb", "n", F.col("label.a").alias("la"), F.col("label.b").alias("lb"), "component_id")
    empty = own.where("n = 0").select("doc_id", "ta", "tb", "n", F.lit(None).cast("long").alias("la"), F.lit(None).cast("long").alias("lb"),
                                      F.col("doc_id").alias("component_id"))
    return full.unionByName(empty).select("doc_id", "ta", "tb", F.col("n").alias("n_shingles"), F.col("la").alias("class_a"), F.col("lb").alias("class_b"), "component_id")


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row of each component of ``docs``: the smallest id, then the smallest text hash. Rows without words all stay."""
    found = components(docs, key, text, **how).where("n_shingles > 0")
    rank = Window.partitionBy("class_a", "class_b").orderBy(F.col("doc_id").asc_nulls_last(), "ta", "tb")
    keepers = stage(found.withColumn("place", F.row_number().over(rank)).where("place = 1").select("doc_id", "ta", "tb"), "minhash-kept")
    names = {c: free_name(docs, f"kept_{c}") for c in ("doc_id", "ta", "tb")}
    keepers = keepers.withColumnsRenamed(names)
    at = {c: free_name(docs, f"row_{c}", keepers) for c in ("id", "ta", "tb", "copy")}
    a, b = two_hashes(whole(column(text)))
    rows = docs.withColumns({at["id"]: column(key).cast("long"), at["ta"]: a, at["tb"]: b})
    worded = F.coalesce(column(text).rlike(WORD), F.lit(False))
    same = (
        F.col(at["id"]).eqNullSafe(F.col(names["doc_id"])) & (F.col(at["ta"]) == F.col(names["ta"])) & (F.col(at["tb"]) == F.col(names["tb"]))
    )
    kept = rows.where(worded).join(keepers, same, "left_semi")
    copies = Window.partitionBy(at["id"], at["ta"], at["tb"]).orderBy(at["id"])
    kept = kept.withColumn(at["copy"], F.row_number().over(copies)).where(F.col(at["copy"]) == 1)
    columns = [column(c) for c in docs.columns]
    return kept.select(*columns).unionByName(rows.where(~worded).select(*columns))
