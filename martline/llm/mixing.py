"""Mix sources to target weights, exactly and without replacement within an epoch.

1. Targets. Every source has a weight; the budget (all words) is shared by
   weight. No target exceeds ``MAX_EPOCHS`` times its source, the excess is
   shared again by weight.
2. Blocks. A source's documents fall into ``BLOCKS`` blocks by a hash. A source
   draws every block once per full epoch, and in its last epoch those blocks of a
   permuted order that fit into what is left of the target. Its quota is the
   number of its draws.
3. Splitting tree. The quotas are dealt to the output shards by halving the
   shards again and again: the left half's share of each source is a draw from
   the multivariate hypergeometric law, the right half gets the rest. So every
   shard holds an exact number of blocks of each source, as a random deal would.
4. A shard takes its quota from the source's permuted draws, disjoint from all
   others, and is shuffled by itself.

Randomness comes from hashes of the seed, so reruns agree. Windows and folds see
blocks and sources only: at most BLOCKS rows per source, and one row per source,
which is the size of the mixture's definition.

Defined results: a null source is a source of its own, the last one; a null text
has no words, is never more than its size and so takes nothing. Documents without
words belong to a block like others and are drawn with it. Rows that agree in
key and size fall into the same block and fare alike.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martline.llm.common import WORD, column, free_name, whole
from martline.sources.staging import stage

BLOCKS, MAX_EPOCHS, SHARDS = 1024, 3, 16
WEIGHTS = (5, 2, 1)


def n_words(text: Column) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MAX_EPOCHS) -> DataFrame:
    """``source``, ``words``, ``target`` from one row (source, words) per source.

    Sources by code point, null last, weigh as ``weights``, repeating. Ordered by
    words per weight, the sources that stop at their limit come first; a source
    stops if the rest of the budget, shared by weight among it and those after it,
    gives it its limit or more.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights) + 1
    weighed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place))
    full = Window.orderBy(F.col("words") / F.col("weight"), F.col("source").asc_nulls_last())
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    limit = F.col("words") * float(most)
    everything = Window.partitionBy()
    rest = F.sum("words").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0.0))
    rest_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = rest / rest_weight
    shared = weighed.select("source", "words", "weight", limit.alias("limit"), level.alias("level"))
    stops = F.col("weight") * F.col("level") >= F.col("limit")
    # Levels fall from the first source that does not stop on; the first one's holds for all of them.
    final = F.max(F.when(~stops, F.col("level"))).over(everything)
    shared = shared.withColumn("final", final)
    target = F.when(stops, F.col("limit")).otherwise(F.col("weight") * F.col("final"))
    return shared.select("source", "words", target.alias("target"))


def plan(
    docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
    weights: Sequence[float] = WEIGHTS, shards: int = SHARDS, blocks: int = BLOCKS, seed: int = 0,
) -> DataFrame:
    """One row per block: ``source``, ``block``, the source's ``words`` and ``target``, and ``draws``.

    ``draws`` lists (epoch, shard) of every time the block is drawn. The result
    is written to the shared folder: the documents meet it more than once.
    """
    sized = docs.select(
        column(source).alias("source"), n_words(column(text)).alias("size"),
        _block(column(key), column(text), seed, blocks).alias("block"),
    )
    counted = stage(sized.groupBy("source", "block").agg(F.sum("size").alias("words")), "mix-blocks")
    drawn = stage(_drawn(counted, weights, seed), "mix-draws")
    ends = shard_ends(drawn.select("source", F.size("drawn").cast("long").alias("quota")), shards, seed)
    met = drawn.alias("d").join(ends.alias("e"), F.col("d.source").eqNullSafe(F.col("e.source")))
    each = met.select("d.source", "words", "target", "ends", F.size("permuted").alias("n"), F.posexplode("drawn").alias("nth", "block"))
    shard = F.size(F.filter("ends", lambda end: end <= F.col("nth"))).cast("int")
    epoch = F.floor(F.col("nth") / F.col("n")).cast("int")
    draws = each.groupBy("source", "block").agg(
        F.sort_array(F.collect_list(F.struct(epoch.alias("epoch"), shard.alias("shard")))).alias("draws")
    )
    listed = drawn.select("source", "words", "target", F.explode("permuted").alias("block"))
    found = listed.alias("l").join(
        draws.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source")) & (F.col("l.block") == F.col("r.block")), "left"
    )
    none = F.array().cast("array<struct<epoch:int,shard:int>>")
    return stage(found.select("l.source", "l.block", "words", "target", F.coalesce("draws", none).alias("draws")), "mix-plan")


def _drawn(counted: DataFrame, weights: Sequence[float], seed: int) -> DataFrame:
    """Per source: its blocks in permuted order, and its draws epoch after epoch."""
    wanted = targets(counted.groupBy("source").agg(F.sum("words").alias("words")), weights)
    order = F.xxhash64(F.lit(seed), F.lit("order"), "source", "block")
    per_source = counted.groupBy("source").agg(
        F.sort_array(F.collect_list(F.struct(order.alias("order"), "block", F.col("words").alias("size")))).alias("listed")
    )
    met = per_source.alias("p").join(wanted.alias("w"), F.col("p.source").eqNullSafe(F.col("w.source")))
    epochs = F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(0).cast("long")
    met = met.select("w.*", "listed", epochs.alias("epochs"), F.transform("listed", lambda b: b["block"]).alias("permuted"))
    rest = (F.col("target") - F.col("epochs") * F.col("words")).cast("double")
    none = F.array().cast("array<int>")
    fitting = F.aggregate(
        "listed",
        F.struct(rest.alias("rest"), none.alias("taken")),
        lambda acc, b: F.when((b["size"] > 0) & (b["size"] <= acc["rest"]), F.struct(
            (acc["rest"] - b["size"]).alias("rest"), F.concat(acc["taken"], F.array(b["block"])).alias("taken"),
        )).otherwise(acc),
        lambda acc: acc["taken"],
    )
    full = F.flatten(F.transform(
        F.sequence(F.lit(1), F.lit(MAX_EPOCHS)), lambda e: F.when(e <= F.col("epochs"), F.col("permuted")).otherwise(none)
    ))
    return met.select("source", "words", "target", "permuted", F.concat(full, fitting).alias("drawn"))


def shard_ends(quotas: DataFrame, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """``source`` and ``ends``: draws of the source in the shards up to each, from the splitting tree.

    A node is one row with the quotas of all sources; each level turns a row into two.
    """
    root = quotas.agg(
        F.sort_array(F.collect_list(F.struct(F.xxhash64("source").alias("h"), "source", "quota"))).alias("listed")
    )
    node = root.select(
        F.transform("listed", lambda x: x["source"]).alias("sources"), F.transform("listed", lambda x: x["quota"]).alias("quotas"),
        F.lit(0).alias("first"), F.lit(shards).alias("width"),
    )
    for level in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        wide = F.floor(F.col("width") / 2).cast("int")
        split = node.withColumn("left", F.when(F.col("width") > 1, _left_share("quotas", wide, F.col("width"), seed, level)))
        right = F.zip_with("quotas", "left", lambda q, x: q - x)
        halves = F.when(F.col("width") <= 1, F.array(F.struct("first", "width", "quotas"))).otherwise(F.array(
            F.struct(F.col("first"), wide.alias("width"), F.col("left").alias("quotas")),
            F.struct((F.col("first") + wide).alias("first"), (F.col("width") - wide).alias("width"), right.alias("quotas")),
        ))
        node = split.select("sources", F.inline(halves))
    leaves = node.select(F.col("first").alias("shard"), F.explode(F.arrays_zip("sources", "quotas")).alias("x"))
    leaves = leaves.select("shard", F.col("x.sources").alias("source"), F.col("x.quotas").alias("quota"))
    listed = leaves.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("shard", "quota"))).alias("parts"))
    summed = F.aggregate(
        "parts", F.array().cast("array<bigint>"),
        lambda acc, p: F.concat(acc, F.array(p["quota"] + F.when(F.size(acc) > 0, F.element_at(acc, -1)).otherwise(0))),
    )
    return listed.select("source", summed.alias("ends"))


def _left_share(quotas: str, wide: Column, width: Column, seed: int, level: int) -> Column:
    """Source by source: how many of the node's draws for the left half are of this source."""
    total = F.aggregate(quotas, F.lit(0).cast("long"), lambda acc, q: acc + q)
    start = F.struct(
        total.alias("left_over"), F.floor(total * wide / width).cast("long").alias("to_draw"), F.array().cast("array<bigint>").alias("out")
    )

    def step(acc: Column, q: Column) -> Column:
        uniform = _uniform(F.xxhash64(F.lit(seed), F.lit(level), F.col("first"), F.size(acc["out"])))
        return _let(hypergeometric(acc["left_over"], q, acc["to_draw"], uniform), lambda k: F.struct(
            (acc["left_over"] - q).alias("left_over"), (acc["to_draw"] - k).alias("to_draw"),
            F.concat(acc["out"], F.array(k)).alias("out"),
        ))

    return F.aggregate(quotas, start, step, lambda acc: acc["out"])


def hypergeometric(population: Column, marked: Column, drawn: Column, uniform: Column) -> Column:
    """The number of marked among ``drawn`` of ``population``, by inverting its distribution at ``uniform``.

    Chances are added up from ten standard deviations below the mean to ten above;
    what lies outside is below 1e-20.
    """
    low = F.greatest(F.lit(0).cast("long"), drawn - (population - marked))
    high = F.least(marked, drawn)
    n, k, d = (c.cast("double") for c in (population, marked, drawn))
    mean = F.when(n > 0, d * k / n).otherwise(0.0)
    spread = F.sqrt(F.when(n > 1, d * (k / n) * (1 - k / n) * (n - d) / (n - 1)).otherwise(0.0))
    near_low = F.greatest(low, F.floor(mean - 10 * spread - 10).cast("long"))
    near_high = F.least(high, F.ceil(mean + 10 * spread + 10).cast("long"))

    def chance(x: Column) -> Column:
        logs = (
            _log_choose(marked, x) + _log_choose(population - marked, drawn - x) - _log_choose(population, drawn)
        )
        return F.exp(logs)

    walked = F.aggregate(
        F.sequence(near_low, near_high),
        F.struct(F.lit(0.0).alias("below"), near_low.alias("at")),
        lambda acc, x: F.when(acc["below"] < uniform, F.struct((acc["below"] + chance(x)).alias("below"), x.alias("at"))).otherwise(acc),
        lambda acc: acc["at"],
    )
    return F.when(low >= high, low).otherwise(walked)


def _log_choose(n: Column, k: Column) -> Column:
    return _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)


def _log_factorial(n: Column) -> Column:
    """Stirling's series at n + 8, stepped down again."""
    x = n.cast("double") + 8
    steps = x
    for i in range(1, 8):
        steps = steps * (x - i)
    series = x * F.log(x) - x + 0.5 * F.log(x * (2 * math.pi)) + 1 / (12 * x) - 1 / (360 * x * x * x)
    return series - F.log(steps)


def _uniform(hashed: Column) -> Column:
    return (F.pmod(hashed, F.lit(1 << 52)) + 0.5) / float(1 << 52)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _block(key: Column, text: Column, seed: int, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.lit("block"), key.cast("string"), text), F.lit(blocks)).cast("int")


def with_draws(
    docs: DataFrame, planned: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
    blocks: int = BLOCKS, seed: int = 0, into: str = "mix", keep_text: bool = True,
) -> DataFrame:
    """``docs`` with a struct ``into``: size, source_size, target, draws, taken.

    A document meets its block, not its source, so a source with a third of all
    rows is spread over BLOCKS keys. Without ``keep_text`` the text stays behind.
    """
    names = {"source": "plan_source", "block": "plan_block", "words": "plan_words", "target": "plan_target", "draws": "plan_draws"}
    names = {old: free_name(docs, new) for old, new in names.items()}
    size, block = free_name(docs, "plan_size"), free_name(docs, "doc_block")
    own = [c for c in docs.columns if c.lower() != into.lower() and (keep_text or c != text)]
    at = docs.select(
        *[column(c) for c in dict.fromkeys([*own, source])], n_words(column(text)).alias(size),
        _block(column(key), column(text), seed, blocks).alias(block),
    )
    met = at.join(
        planned.withColumnsRenamed(names),
        column(source).eqNullSafe(F.col(names["source"])) & (F.col(block) == F.col(names["block"])), "left",
    )
    draws = F.col(names["draws"])
    mix = F.struct(
        F.col(size).alias("size"), F.col(names["words"]).alias("source_size"), F.col(names["target"]).alias("target"),
        draws.alias("draws"), (F.col(size) * F.size(draws)).alias("taken"),
    )
    return met.select(*[column(c) for c in own], mix.alias(into))


def mixture(docs: DataFrame, planned: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
            blocks: int = BLOCKS, seed: int = 0, shard_into: str | None = None) -> DataFrame:
    """The mixed documents: one row per draw, shard after shard, shuffled within each shard."""
    drawn, shard, order = free_name(docs, "drawn"), free_name(docs, "shard_of_draw"), free_name(docs, "order_of_draw")
    met = with_draws(docs, planned, key, source, text, blocks, seed, drawn)
    each = met.withColumn(drawn, F.explode(F.col(drawn)["draws"]))
    mixed = F.xxhash64(F.lit(seed), F.lit("local"), F.col(drawn)["epoch"], column(key).cast("string"), column(text))
    each = each.withColumns({shard: F.col(drawn)["shard"], order: mixed})
    dealt = each.repartitionByRange(shard, order).sortWithinPartitions(shard, order)
    columns = [column(c) for c in docs.columns]
    return dealt.select(*columns, *([F.col(shard).alias(shard_into)] if shard_into else []))
