"""Mix sources to target weights by a multivariate-hypergeometric splitting tree.

Each source is cut into blocks of about ``block_words`` words by a hash of its
documents. A source's target becomes an exact quota of block copies: all blocks
for each full pass, then the first blocks of a random order, and of one last
block the documents that fit. The tree starts with the quotas of all sources; each
node gives its left child half of its block copies, as a draw without replacement
from its own quotas gives them, and the rest to the right, until there is a leaf
for each output shard. A source's block copies, in a random order, then go to the
shards by these quotas: the draws are disjoint, and every copy is used once.
Within its shard each document gets a random place.

All of it is expressions over DataFrames; draws come from hashes of a seed, so
every run gives the same mix. Blocks and shards have the same sizes whatever the totals.
Only blocks are put in order by source, in ranges, never documents; a block's documents
are bounded by its words. A node of the tree is a row with a number for each source, so
sources may be some thousands.

Defined results: a null or empty text has size 0 and is taken as often as its
block; a null source is a source of its own, the last; rows with the same id and
text are one document that counts as often as it stands there; no documents give
no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataline.llm.common import ROW, free_name, let, packed, quoted, space_words, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 1 << 14
SHARD_WORDS = 1 << 22
SEED = 20
RANGE = 1 << 12
"""Blocks of a source that are summed in order by one task; their sums are then summed in turn."""
DEAL_BITS = 12
"""A source's block copies are numbered in so many parts, as a power of two."""
LEVELS_AT_ONCE = 8
"""Levels of the tree that one stage makes."""
FILL_ROUNDS = 6
FEW_SOURCES = 100_000


@dataclass
class Mix:
    """What a mix is made of: tables by document, source, block and cut block."""

    units: DataFrame
    sources: DataFrame
    blocks: DataFrame
    chosen: DataFrame
    copies: DataFrame


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.lit(SEED), F.coalesce(text, F.lit("")), text.isNull())


def _draw(*parts: Column | int) -> Column:
    """A uniform number in [0, 1) from a hash of the parts."""
    hashed = F.xxhash64(*(p if isinstance(p, Column) else F.lit(p) for p in parts))
    return F.shiftrightunsigned(hashed, 11).cast("double") / float(1 << 53)


def _few(sources: DataFrame) -> DataFrame:
    """With a broadcast hint, as long as the sources are few."""
    return F.broadcast(sources) if sources.count() <= FEW_SOURCES else sources


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """(``source``, ``words``) with number, weight and target of each source.

    A target stops at ``MOST`` times the source's words. Sources that stop are those
    with the least limit per weight: in that order, each is held against its part of
    what earlier ones leave.
    """
    everything = W.partitionBy()
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    by_limit = W.orderBy(F.col("words") / F.col("weight"), "number")
    earlier = by_limit.rowsBetween(W.unboundedPreceding, -1)
    later = by_limit.rowsBetween(0, W.unboundedFollowing)
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("number") - 1) % len(weights) + 1).cast("int"))
    left = share * F.sum("words").over(everything) - F.coalesce(F.sum("limit").over(earlier), F.lit(0))
    ranked = (
        totals.withColumn("number", F.row_number().over(by_name))
        .withColumn("weight", weight)
        .withColumn("limit", MOST * F.col("words"))
        .withColumn("level", left.cast("double") / F.sum("weight").over(later))
        .withColumn("stops", F.col("level") * F.col("weight") >= F.col("limit"))
    )
    level = F.min(F.when(~F.col("stops"), F.struct("limit_rank", "level"))).over(everything)["level"]
    return (
        ranked.withColumn("limit_rank", F.row_number().over(by_limit))
        .withColumn("shared_level", level)
        .withColumn(
            "target",
            F.when(F.col("stops"), F.col("limit").cast("double")).otherwise(F.col("shared_level") * F.col("weight")),
        )
        .select("source", "words", "number", "weight", "target")
    )


def _log_factorial(n: Column) -> Column:
    """By Stirling's series; exact enough from 2 on."""
    x = F.greatest(n, F.lit(1)).cast("double")
    series = 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    return F.when(n < 2, 0.0).otherwise(x * F.ln(x) - x + 0.5 * F.ln(2 * math.pi * x) + series)


def _log_choose(n: Column, k: Column) -> Column:
    return _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)


def hypergeometric(total: Column, kind: Column, drawn: Column, u: Column) -> Column:
    """How many of ``kind`` among ``total`` are in ``drawn`` draws without replacement.

    The distribution function is inverted at ``u`` over the values within eight
    standard deviations of the mode; beyond them is less than 1e-14.
    """
    as_long = lambda c: F.floor(c).cast("bigint")
    part = kind.cast("double") / F.greatest(total, F.lit(1))
    variance = drawn * part * (1 - part) * (total - drawn) / F.greatest(total - 1, F.lit(1))
    reach = as_long(8 * F.sqrt(F.greatest(variance, F.lit(0.0)))) + 8
    mode = as_long((drawn + 1).cast("double") * (kind + 1) / (total + 2))
    bounds = F.struct(
        F.greatest(F.lit(0).cast("bigint"), drawn - (total - kind), mode - reach).alias("low"),
        F.least(kind, drawn, mode + reach).alias("high"),
    )

    def invert(b: Column) -> Column:
        log_all = _log_choose(total, drawn)

        def step(state: Column, k: Column) -> Column:
            weight = F.exp(_log_choose(kind, k) + _log_choose(total - kind, drawn - k) - log_all)
            reached = state["sum"] + weight
            return F.struct(
                reached.alias("sum"),
                F.when(state["pick"] >= 0, state["pick"]).when(reached > u, k).otherwise(state["pick"]).alias("pick"),
            )

        start = F.struct(F.lit(0.0).alias("sum"), F.lit(-1).cast("bigint").alias("pick"))
        return F.aggregate(
            F.sequence(b["low"], b["high"]), start, step,
            lambda s: F.when(s["pick"] >= 0, s["pick"]).otherwise(b["high"]),
        )

    return let(bounds, invert)


def _take_left(level: int, seed: int) -> Callable[[Column, Column], Column]:
    """One source after the other: what of its quota the left child gets."""

    def step(state: Column, quota: Column) -> Column:
        u = _draw(seed, level, F.col("shard"), F.size(state["left"]))
        return let(
            hypergeometric(state["rest"], quota, state["draws"], u),
            lambda k: F.struct(
                (state["rest"] - quota).alias("rest"),
                (state["draws"] - k).alias("draws"),
                F.concat(state["left"], F.array(k)).alias("left"),
            ),
        )

    return step


def split_quotas(root: DataFrame, levels: int, seed: int = SEED) -> DataFrame:
    """From one row with the ``quotas`` of all sources, (``shard``, ``quotas``) of each leaf.

    The sums over the leaves are exactly the root's quotas.
    """
    nodes = root.select(F.lit(0).cast("bigint").alias("shard"), "quotas")
    for level in range(levels):
        if level and level % LEVELS_AT_ONCE == 0:
            nodes = written(nodes.repartition("shard"), "mix-nodes")
        total = F.aggregate("quotas", F.lit(0).cast("bigint"), lambda a, q: a + q)
        start = F.struct(
            F.col("total").alias("rest"),
            F.floor((F.col("total") + F.pmod("shard", F.lit(2))) / 2).cast("bigint").alias("draws"),
            F.array().cast("array<bigint>").alias("left"),
        )

        nodes = (
            nodes.withColumn("total", total)
            .withColumn("left", F.aggregate("quotas", start, _take_left(level, seed), lambda s: s["left"]))
            .withColumn("right", F.zip_with("quotas", "left", lambda q, k: q - k))
            .select(F.col("shard").alias("above"), F.posexplode(F.array("left", "right")).alias("side", "quotas"))
            .select((2 * F.col("above") + F.col("side")).alias("shard"), "quotas")
        )
    return nodes


def plan_mix(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> Mix:
    """Decide which documents the mix takes, how often, and into which shards."""
    units = written(
        documents.select(
            quoted(source).alias("source"),
            quoted(doc_id).alias("doc_id"),
            _text_hash(quoted(text)).alias("hash"),
            F.size(space_words(quoted(text))).cast("bigint").alias("size"),
        )
        .groupBy("source", "doc_id", "hash")
        .agg(F.first("size").alias("size"), F.count("*").alias("n")),
        "mix-units",
    )
    totals = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    n_blocks = F.greatest(F.lit(1), F.ceil(F.col("words") / block_words))
    passes = F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(0).cast("bigint")
    sources = written(
        targets(totals)
        .withColumn("passes", passes)
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("words"))
        .withColumn("n_blocks", n_blocks.cast("bigint")),
        "mix-sources",
    )
    placed = _in_blocks(units, sources, seed)
    summed = written(
        placed.groupBy("number", "block")
        .agg(F.sum(F.col("size") * F.col("n")).alias("block_words"), F.first("passes").alias("passes"), F.first("rest").alias("rest"))
        .withColumn("range", F.floor(F.col("block") / RANGE)),
        "mix-block-sums",
    )
    in_order = W.partitionBy("number").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    ranges = summed.groupBy("number", "range").agg(F.sum("block_words").alias("range_words")).select(
        "number", "range", F.coalesce(F.sum("range_words").over(in_order), F.lit(0)).alias("earlier")
    )
    blocks = (
        summed.join(ranges, ["number", "range"])
        .withColumn("up_to", F.col("earlier") + F.sum("block_words").over(W.partitionBy("number", "range").orderBy("block")))
        .drop("range", "earlier")
        .withColumn("before", F.col("up_to") - F.col("block_words"))
        .withColumn(
            "whole",
            F.col("passes") + ((F.col("up_to") <= F.col("rest")) & (F.col("passes") < MOST)).cast("bigint"),
        )
        .withColumn("cut", (F.col("before") < F.col("rest")) & (F.col("up_to") > F.col("rest")))
    )
    blocks = written(blocks.withColumn("room", F.col("rest") - F.col("before")), "mix-blocks")
    chosen = written(_fill(placed, blocks.where("cut"), seed), "mix-chosen")
    copies = written(_deal(blocks, shard_words, seed), "mix-copies")
    return Mix(units, sources, blocks, chosen, copies)


def _in_blocks(units: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """Each document with its source's numbers and its block there."""
    of = _few(sources.select(F.col("source").alias("name"), "number", "n_blocks", "words", "target", "passes", "rest"))
    joined = units.join(of, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    return joined.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "hash"), F.col("n_blocks")))


def _fill(placed: DataFrame, cut: DataFrame, seed: int) -> DataFrame:
    """Of each cut block the documents that fit its room, in several rounds.

    Each round takes documents in a random order up to the first that does not fit;
    the next goes on with those that still fit. In the end the smallest one left is
    taken too if that brings the sum nearer to the room.
    """
    cut = cut.select("number", "block", "room")
    block = W.partitionBy("number", "block")
    in_order = block.orderBy("order", "doc_id", "hash").rowsBetween(W.unboundedPreceding, 0)
    units = (
        placed.select("number", "block", "doc_id", "hash", "source", (F.col("size") * F.col("n")).alias("units_words"))
        .join(_few(cut), ["number", "block"])
        .withColumn("order", F.xxhash64(F.lit(seed + 1), "doc_id", "hash"))
        .withColumn("taken", F.lit(False))
    )
    for _ in range(FILL_ROUNDS):
        fits = ~F.col("taken") & (F.col("units_words") <= F.col("left"))
        units = (
            units.withColumn("left", F.col("room") - F.sum(F.when(F.col("taken"), F.col("units_words")).otherwise(0)).over(block))
            .withColumn("wanted", F.when(fits, F.col("units_words")).otherwise(0))
            .withColumn("sum", F.sum("wanted").over(in_order))
            .withColumn("taken", F.col("taken") | (fits & (F.col("sum") <= F.col("left"))))
        )
    smallest = block.orderBy("taken", "units_words", "order", "doc_id", "hash")
    units = (
        units.withColumn("left", F.col("room") - F.sum(F.when(F.col("taken"), F.col("units_words")).otherwise(0)).over(block))
        .withColumn("rank", F.row_number().over(smallest))
        .withColumn("taken", F.col("taken") | ((F.col("rank") == 1) & (F.col("units_words") < 2 * F.col("left"))))
    )
    return units.where("taken").select("number", "block", "doc_id", "hash")


def _deal(blocks: DataFrame, shard_words: int, seed: int) -> DataFrame:
    """(``number``, ``block``, ``whole``, ``shard``) of each copy of a block that is taken."""
    n_copies = F.col("whole") + F.col("cut").cast("bigint")
    copies = blocks.where(n_copies > 0).select(
        "number", "block", F.explode(F.sequence(F.lit(1).cast("bigint"), n_copies)).alias("copy"), "whole"
    )
    words = blocks.agg(F.sum(F.col("whole") * F.col("block_words"))).first()[0] or 0
    n_shards = max(1, math.ceil(words / shard_words))
    quotas = copies.groupBy("number").agg(F.count("*").alias("quota"))
    listed = F.array_sort(F.collect_list(F.struct("number", "quota")))
    root = quotas.agg(listed.alias("all")).select(F.col("all.number").alias("numbers"), F.col("all.quota").alias("quotas"))
    leaves = split_quotas(root.select("quotas"), math.ceil(math.log2(n_shards)), seed)
    ordered = W.partitionBy("number").orderBy("shard")
    dealt = (
        leaves.select("shard", F.posexplode("quotas").alias("at", "quota"))
        .join(root.select(F.posexplode("numbers").alias("at", "number")), "at")
        .withColumn("to", F.sum("quota").over(ordered))
        .where(F.col("quota") > 0)
        .select("number", "shard", F.explode(F.sequence(F.col("to") - F.col("quota") + 1, F.col("to"))).alias("turn"))
    )
    copies = copies.withColumn("order", F.xxhash64(F.lit(seed + 2), "block", "copy"))
    copies = copies.withColumn("part", F.shiftrightunsigned("order", 64 - DEAL_BITS))
    earlier = W.partitionBy("number").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = copies.groupBy("number", "part").agg(F.count("*").alias("n")).select(
        "number", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier")
    )
    permuted = W.partitionBy("number", "part").orderBy("order", "block", "copy")
    turns = copies.join(parts, ["number", "part"]).withColumn("turn", F.col("earlier") + F.row_number().over(permuted))
    return turns.join(dealt, ["number", "turn"]).select(
        "number", "block", "shard", (F.col("copy") <= F.col("whole")).alias("whole")
    )


def taken(mix: Mix, seed: int = SEED) -> DataFrame:
    """Each document with ``size``, ``source_size``, ``target``, and ``taken``, its words in the mix."""
    placed = _in_blocks(mix.units, mix.sources, seed)
    blocks = mix.copies.groupBy("number", "block").agg(
        F.sum(F.col("whole").cast("int")).alias("whole"), F.sum((~F.col("whole")).cast("int")).alias("part")
    )
    chosen = mix.chosen.withColumn("fits", F.lit(1))
    found = placed.join(blocks, ["number", "block"], "left").join(
        chosen,
        (placed["number"] == chosen["number"])
        & (placed["block"] == chosen["block"])
        & (placed["hash"] == chosen["hash"])
        & placed["doc_id"].eqNullSafe(chosen["doc_id"]),
        "left",
    )
    times = F.coalesce("whole", F.lit(0)) + F.when(F.col("fits") == 1, F.coalesce("part", F.lit(0))).otherwise(0)
    return found.select(
        placed["doc_id"],
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("row"),
        "size",
        F.col("words").alias("source_size"),
        "target",
        (times * F.col("size")).cast("bigint").alias("taken"),
    ).drop("row")


def mixed(
    documents: DataFrame,
    mix: Mix,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = SEED,
) -> DataFrame:
    """The mix: the documents' columns, a row for each time one is taken, by shard in a random order.

    Added are ``mix_shard`` and ``mix_place``, the place within the shard; where the
    documents have columns of these names, with an underscore behind them. Copies of
    blocks are few enough to meet the documents by a broadcast where Spark finds so;
    documents move once, to their shards.
    """
    shard, place = (free_name(name, documents.columns) for name in ("mix_shard", "mix_place"))
    row = F.col(ROW)
    units = documents.select(*packed(documents, text)).select(
        ROW,
        "text",
        row.getField(source).alias("source"),
        row.getField(doc_id).alias("doc_id"),
        _text_hash(F.col("text")).alias("hash"),
    )
    placed = _in_blocks(units, mix.sources, seed).select(ROW, "text", "number", "block", "doc_id", "hash")
    chosen = mix.chosen.select(
        F.col("number").alias("c_number"), F.col("block").alias("c_block"), F.col("doc_id").alias("c_id"),
        F.col("hash").alias("c_hash"),
    )
    shards = mix.copies.groupBy("number", "block").agg(
        F.collect_list(F.when(F.col("whole"), F.col("shard"))).alias("whole"),
        F.collect_list(F.when(~F.col("whole"), F.col("shard"))).alias("part"),
    )
    found = placed.join(shards, ["number", "block"]).join(
        chosen,
        (F.col("number") == F.col("c_number"))
        & (F.col("block") == F.col("c_block"))
        & (F.col("hash") == F.col("c_hash"))
        & F.col("doc_id").eqNullSafe(F.col("c_id")),
        "left",
    )
    to = F.concat("whole", F.when(F.col("c_hash").isNotNull(), F.col("part")).otherwise(F.array().cast("array<bigint>")))
    dealt = (
        found.select(ROW, "text", "doc_id", "hash", F.posexplode(to).alias("copy", "mix_shard"))
        .withColumn("mix_place", F.xxhash64(F.lit(seed + 3), "doc_id", "hash", "copy"))
        .repartition("mix_shard")
        .sortWithinPartitions("mix_shard", "mix_place")
    )
    values = (F.col("text") if c == text else row.getField(c) for c in documents.columns)
    return dealt.select(
        *(value.alias(c) for value, c in zip(values, documents.columns, strict=True)),
        F.col("mix_shard").alias(shard),
        F.col("mix_place").alias(place),
    )
