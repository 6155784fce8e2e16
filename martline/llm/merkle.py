"""A Merkle manifest of a table: written levels of parent-linked nodes and a recursive climb.

``build`` orders the leaves of each tree over the whole cluster, joins every ``FAN``
consecutive nodes of a level into one until a single one remains, and does the same with
the roots of the trees. Each level is written. A node's link row names its parent and
holds the digests of all children of that parent.

``climb`` is one recursive query over the links. A row of it is a run of up to ``FAN``
neighbouring leaves, which share all that lies above them: it carries what each leaf
claims, folded up to where the row stands, and the siblings met so far. Each turn joins
the rows with the links of their nodes, folds every claim with the siblings and appends
these, until the root is reached.

Hot nodes: a node that lies above many runs is written in copies, one per ``SPREAD``
runs below it, so that no key of a join has more rows than that. There are about
1 / (FAN * SPREAD) as many copies as leaves on a level.

Defined results: leaves of one tree ascend by key, a null key first, then by digest;
equal rows are leaves of their own with equal digests. A null tree is a tree and comes
first, the others follow by bytes. An empty table has no root and no rows. Columns other
than those named do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martline.llm.common import column
from martline.sources.staging import stage

FAN = 16
#: Bytes of a digest.
DIGEST = 32
SPREAD = 128
#: Tree of the roots; trees of rows are named "n" (null) or "s" and their value, which sorts as asked.
_TOP = ""
_POSITION_BITS = 33
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


@dataclass(frozen=True)
class Manifest:
    """``runs``: the leaves by run. ``links``: every node but the root with its parent. ``root``: digest, or none."""

    runs: DataFrame
    links: DataFrame
    root: str | None
    root_id: tuple[str, int, int] | None


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(values: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of the fields, one after the other."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _ranked(rows: DataFrame, tree: str, order: Sequence[Column]) -> DataFrame:
    """``rows``, written, with ``idx`` (from 0, within the tree) and ``n`` (rows of the tree).

    One sort by range; a row's place is its place in its partition less the tree's first
    one there, plus the tree's rows in earlier partitions.
    """
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(tree), *order]
    placed = rows.repartitionByRange(width, *by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    placed = stage(placed, "merkle-order").withColumn("_part", F.shiftright("_at", _POSITION_BITS))
    here = placed.groupBy(tree, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    whole_tree = Window.partitionBy(tree)
    before = whole_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per tree and partition that holds some of it.
    starts = here.select(
        tree, "_part", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(whole_tree).alias("n"),
    )
    met = placed.join(starts, [tree, "_part"])
    return met.withColumn("idx", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_part", "_first", "_rows", "_before")


def _next_size(n: Column) -> Column:
    return F.floor((n + (FAN - 1)) / FAN)


def _joined(nodes: DataFrame) -> DataFrame:
    """One row per parent of a level: ``tree``, ``idx``, ``n``, ``kids`` in order, ``weight``."""
    kid = F.struct((F.col("idx") % FAN).alias("place"), "digest", "id", "weight")
    by = [F.col("tree"), F.floor(F.col("idx") / FAN).alias("idx"), _next_size(F.col("n")).alias("n"), (F.col("level") + 1).alias("level")]
    return nodes.groupBy(*by).agg(F.sort_array(F.collect_list(kid)).alias("kids"), F.sum("weight").alias("weight"))


def _digest_of(kids: str) -> Column:
    return F.sha2(F.array_join(F.transform(kids, lambda k: k["digest"]), ""), 256)


def _bytes_of(kids: str) -> Column:
    return F.unhex(F.array_join(F.transform(kids, lambda k: k["digest"]), ""))


def _nodes(parents: DataFrame) -> DataFrame:
    own = F.struct("tree", F.col("level").alias("height"), "idx").alias("id")
    return parents.select("tree", "level", "idx", "n", own, _digest_of("kids").alias("digest"), "weight")


def _copies(weight: Column) -> Column:
    return F.ceil(weight / SPREAD).cast("int")


def _links(parents: DataFrame) -> DataFrame:
    """A row per child and copy: its digest, its parent, and the digests of the children before and after it, as bytes."""
    each = parents.select(
        F.explode("kids").alias("kid"), _bytes_of("kids").alias("all"),
        F.struct("tree", F.col("level").alias("height"), "idx").alias("up"), _copies(F.col("weight")).alias("up_copies"),
    )
    place = F.col("kid.place").cast("int")
    return each.select(
        F.col("kid.id").alias("id"), F.explode(F.sequence(F.lit(0), _copies(F.col("kid.weight")) - 1)).alias("salt"),
        F.unhex("kid.digest").alias("own"), F.substring("all", F.lit(1), place * DIGEST).alias("ahead"),
        F.substring("all", place * DIGEST + DIGEST + 1, F.octet_length("all")).alias("behind"), "up", "up_copies",
    )


def _grow(nodes: DataFrame, most: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Links and finished roots of trees whose largest has ``most`` nodes; a written table per level."""
    links, roots = [], [nodes.where("n = 1")]
    while most > 1:
        parents = stage(_joined(nodes.where("n > 1")), "merkle-level")
        links.append(_links(parents))
        nodes = _nodes(parents)
        roots.append(nodes.where("n = 1"))
        most = -(-most // FAN)
    return links, roots


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    first, *rest = frames
    for other in rest:
        first = first.unionByName(other)
    return first


def build(leaves: DataFrame, tree: str, key: str, digest: str, claim: str | None = None) -> Manifest:
    """The manifest of ``leaves``: one tree per value of ``tree``, ascending by ``key``.

    ``claim`` is a digest to be folded instead of the leaf's own, null for its own.
    """
    name = F.when(column(tree).isNull(), "n").otherwise(F.concat(F.lit("s"), column(tree)))
    claimed = F.coalesce(column(claim), column(digest)) if claim else column(digest)
    rows = leaves.select(name.alias("tree"), column(key).alias("key"), column(digest).alias("digest"), claimed.alias("claim"))
    # A written number tells equal rows apart, so that a range can split them.
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    ranked = _ranked(rows, "tree", [F.col("key").asc_nulls_first(), F.col("digest"), F.col("row")])
    lane = F.struct((F.col("idx") % FAN).alias("place"), "key", "digest", "claim")
    runs = ranked.groupBy("tree", F.floor(F.col("idx") / FAN).alias("idx"), "n").agg(F.sort_array(F.collect_list(lane)).alias("lanes"))
    alone = F.col("n") == 1
    height = F.when(alone, 0).otherwise(1)
    runs = runs.select(
        "tree", "idx", _next_size(F.col("n")).alias("n"), F.struct("tree", height.alias("height"), "idx").alias("id"), "lanes",
        F.when(alone, F.col("lanes")[0]["digest"]).otherwise(_digest_of("lanes")).alias("digest"),
    )
    runs = stage(runs, "merkle-runs")

    most = runs.agg(F.max("n")).first()[0]
    if most is None:
        return Manifest(runs, _links(_joined(_bottom(runs))), None, None)
    links, roots = _grow(_bottom(runs), most)
    subroots = _ranked(_union(roots).select(F.lit(_TOP).alias("top"), "tree", "id", "digest", "weight"), "top", [F.col("tree")])
    tops = stage(subroots.select(F.col("top").alias("tree"), F.lit(0).alias("level"), "idx", "n", "id", "digest", "weight"), "merkle-tops")
    more, last = _grow(tops, tops.agg(F.max("n")).first()[0])
    root = _union(last).select("id.tree", "id.height", "id.idx", "digest").first()  # one row
    return Manifest(runs, stage(_union([*links, *more]), "merkle-links") if links or more else _links(_joined(tops.limit(0))),
                    root["digest"], (root["tree"], root["height"], root["idx"]))


def _bottom(runs: DataFrame) -> DataFrame:
    return runs.select("tree", F.lit(1).alias("level"), "idx", "n", "id", "digest", F.lit(1).cast("bigint").alias("weight"))


def _run_with_claim(lane: Column) -> Column:
    """What the leaf's run becomes when the leaf is what it claims; a lone leaf is no run."""
    others = F.transform("lanes", lambda x: F.when(x["place"] == lane["place"], lane["claim"]).otherwise(x["digest"]))
    return F.when(F.col("id.height") == 0, lane["claim"]).otherwise(F.sha2(F.array_join(others, ""), 256))


def _text(digests: Column | str) -> Column:
    return F.lower(F.hex(digests))


_CLIMB = f"""
with recursive climb(run, id, salt, folded, siblings, subroot) as (
    select id, id, 0, folded, cast('' as binary), cast(null as binary) from {{runs}}
    union all
    select c.run, l.up, cast(pmod(xxhash64(c.run), l.up_copies) as int),
           transform(c.folded, f -> unhex(sha2(lower(hex(concat(l.ahead, f, l.behind))), 256))),
           concat(c.siblings, l.ahead, l.behind),
           if(l.up.tree = '{_TOP}' and c.id.tree <> '{_TOP}', l.own, c.subroot)
    from climb c join {{links}} l on c.id.tree = l.id.tree and c.id.height = l.id.height and c.id.idx = l.id.idx and c.salt = l.salt
)
select run, folded, siblings, subroot from climb where id.tree = {{tree}} and id.height = {{height}} and id.idx = {{idx}}
"""


def climb(manifest: Manifest) -> DataFrame:
    """Per leaf: ``key``, ``leaf``, ``subroot``, ``root``, ``proof`` (the siblings, level by level), ``folded_root``.

    The climb counts its rows against a limit of the session, which is lifted while it runs.
    """
    runs, spark = manifest.runs, manifest.runs.sparkSession
    start = runs.select("id", F.transform("lanes", lambda x: F.unhex(_run_with_claim(x))).alias("folded"))
    before = spark.conf.get(_ROW_LIMIT, None)
    spark.conf.set(_ROW_LIMIT, "-1")
    try:
        tree, height, idx = manifest.root_id or (_TOP, -1, -1)
        risen = spark.sql(_CLIMB, runs=start, links=manifest.links, tree=tree, height=height, idx=idx)
        risen = stage(risen, "merkle-climb")
    finally:
        if before is None:
            spark.conf.unset(_ROW_LIMIT)
        else:
            spark.conf.set(_ROW_LIMIT, before)
    met = runs.join(risen, F.col("id") == F.col("run"))
    lanes = met.select("lanes", "folded", "siblings", "subroot", F.posexplode("lanes").alias("at", "lane"))
    others = F.array_join(F.transform(F.filter("lanes", lambda x, i: i != F.col("at")), lambda x: x["digest"]), "")
    root = F.lit(manifest.root).cast("string")
    return lanes.select(
        F.col("lane.key").alias("key"), F.col("lane.digest").alias("leaf"), F.coalesce(_text("subroot"), root).alias("subroot"),
        root.alias("root"), F.concat(others, _text("siblings")).alias("proof"), _text(F.col("folded")[F.col("at")]).alias("folded_root"),
    )
