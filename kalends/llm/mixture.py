"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree (operator 5, DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kalends.llm.common import WORD, count_words, stored
from kalends.operators.windows import ranked

SEED = 20_240_607
BROADCAST_ROWS = 50_000  # of the plan, each of some 150 bytes
RANGES = 64  # of the sources, in code-point order and by size for their weight
CELL_BITS = 10  # a node counts the hashes of its blocks in cells of their first bits


def source_targets(sources: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """Share the whole size among sources by weight, none above ``most`` times its own size.

    ``sources`` has ``key``, ``source`` and ``source_size``. Sources in code-point order, null last, take the weights in
    turn. If the sources with the least size for their weight are full, the rest shares what they leave; the level at which
    nobody is above is the highest over all numbers of full sources. Places and running sums come from range partitions
    (``ranked``), so any number of sources will do.
    """
    placed = ranked(sources, (F.col("source").asc_nulls_last(),), "place_", RANGES)
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("place_") - 1) % len(weights) + 1).cast("int"))
    table = placed.withColumn("weight", weight).drop("place_")
    full = F.col("source_size") * most
    scarce = (F.col("source_size") / F.col("weight"), F.col("key"))
    table = ranked(table, scarce, "place_", RANGES, full_upto=full, weight_upto=F.col("weight")).drop("place_")
    table = stored(table, "sources")
    sums = table.agg(F.struct(F.sum("source_size").alias("size"), F.sum("weight").alias("weight"))).scalar()
    left = F.col("sums_.weight") - (F.col("weight_upto") - F.col("weight"))
    table = table.withColumn("sums_", sums).withColumn("level", (F.col("sums_.size") - (F.col("full_upto") - full)) / left)
    target = F.least(full, table.agg(F.max("level")).scalar() * F.col("weight")).cast("double")
    return table.withColumn("target", target).select("key", "source_size", "target", F.round("target").cast("long").alias("quota"))


def _filled(rows: DataFrame, by: list[str], order: Column, size: str) -> DataFrame:
    """How much of each row, in ``order`` within ``by``, the column ``rest`` covers: ``part`` of its ``size``."""
    before = Window.partitionBy(*by).orderBy(order, *(c for c in ("block", "sub", "h", "doc_id") if c in rows.columns)).rowsBetween(Window.unboundedPreceding, -1)
    gone = F.coalesce(F.sum(size).over(before), F.lit(0))
    return rows.withColumn("part", F.greatest(F.lit(0), F.least(F.col(size), F.col("rest") - gone)).cast("long"))


def split(quotas: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """Blocks of each source for each shard: exact quotas that sum up to ``n``, drawn down a binary tree over the shards.

    ``quotas`` has ``key`` and ``n``, the blocks of a source. A node of the tree holds how many blocks of each source it has and hands
    a random part of them, as large as its left shards' share, to its left child: the blocks with the smallest hashes. That is one
    multivariate hypergeometric draw, since blocks count by source only. Which hashes are small enough is found by
    counting them in ``2 ** CELL_BITS`` cells of each node; hashes are ordered within a cell only. Shards differ by at
    most one block for each level. Returns ``key``, ``shard`` and ``n`` above zero; an empty table gives an empty result.
    """
    nodes = quotas.where("n > 0").select("key", F.lit(0).alias("low"), F.lit(shards).alias("high"), F.col("n").cast("long").alias("n"))
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    for level in range(max(shards - 1, 0).bit_length()):
        nodes = stored(nodes, "nodes")
        inner = nodes.where("high - low > 1")
        balls = inner.select("key", "low", "high", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("ball"))
        balls = balls.withColumn("h", F.xxhash64(F.lit(seed), F.lit(level), "key", "ball"))
        balls = balls.withColumn("cell", F.shiftrightunsigned("h", 64 - CELL_BITS).cast("int"))
        within = Window.partitionBy("low")  # cells of one node: 2 ** CELL_BITS rows at most
        cells = balls.groupBy("low", "high", "cell").agg(F.count("*").alias("held"))
        part = F.round(F.sum("held").over(within) * (middle - F.col("low")) / (F.col("high") - F.col("low"))).cast("long")
        upto = F.sum("held").over(within.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0))
        room = F.least(F.col("held"), F.greatest(F.lit(0).cast("long"), F.col("part") - (F.col("upto") - F.col("held"))))
        cells = cells.withColumns({"part": part, "upto": upto}).select("low", "cell", room.alias("room"))
        rank = F.row_number().over(Window.partitionBy("low", "cell").orderBy("h", "key", "ball"))
        drawn = balls.join(cells, ["low", "cell"]).withColumn("rank", rank)
        parted = drawn.groupBy("key", "low", "high").agg(F.count("*").alias("n"), F.count_if(F.col("rank") <= F.col("room")).alias("goes_left"))
        sides = F.array(
            F.struct(F.col("low"), middle.alias("high"), F.col("goes_left").alias("n")),
            F.struct(middle.alias("low"), F.col("high"), (F.col("n") - F.col("goes_left")).alias("n")),
        )
        nodes = parted.select("key", F.explode(sides).alias("side")).select("key", "side.*").where("n > 0").unionByName(nodes.where("high - low = 1"))
    return nodes.select("key", F.col("low").alias("shard"), "n")


def plan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
    weights: tuple[int, ...] = (1, 2, 3), most: int = 3, bits: int = 8, shards: int = 16, seed: int = SEED, others: tuple[str, ...] = (),
) -> DataFrame:
    """Decide how often, and for which output shard, the mix takes every document.

    A hash of id and text deals the documents of a source into ``2 ** bits`` blocks. As often as the source's target holds its
    whole size, all blocks are taken; of one more pass the first blocks of a keyed permutation are, up to the target. In the
    block where the target falls, sub-blocks and then documents are counted the same way, and the last document may be
    taken in part, so each source's taken words are its target, rounded. The taken blocks are divided among the shards by
    the splitting tree and drawn from the permuted order: shards get disjoint blocks. Reruns agree.

    Returns for every row of ``docs``: ``doc_id``, ``others``, ``size`` (words; null has none), ``source_size``, ``target``
    and ``takes``, an array of (copy, shard, words). Each step's small table is written, so the driver, which plans a query anew
    after each of its shuffles, never holds more than one step. Sums are pre-aggregated; windows run over cells of a node, over blocks of a
    source, or over the documents of one sub-block (one in ``4 ** bits`` of the source); a block has a shard only through the tree. Null sources are a source of their
    own, null ids and repeated rows count like any other; other columns are not read; an empty table gives an empty result.
    """
    h = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
    every = docs.select(
        F.col(id_col).alias("doc_id"), *others, F.col(source_col).alias("source_"), count_words(F.col(text_col)).alias("size"), h.alias("h"),
    ).withColumns({
        "key": F.coalesce(F.concat(F.lit("="), F.col("source_").cast("string")), F.lit("")),
        "block": F.shiftrightunsigned("h", 64 - bits).cast("int"), "sub": F.shiftrightunsigned(F.shiftleft("h", bits), 64 - bits).cast("int"),
    })
    sizes = stored(every.drop(*others), "sizes")
    blocks = stored(sizes.groupBy("key", "block").agg(F.sum("size").alias("block_size"), F.first("source_").alias("source")), "blocks")
    sources = blocks.groupBy("key").agg(F.first("source").alias("source"), F.sum("block_size").alias("source_size"))
    targets = source_targets(sources, weights, most).withColumn("full", F.when(F.col("source_size") > 0, F.floor(F.col("quota") / F.col("source_size"))).otherwise(0))
    targets = targets.withColumn("rest", F.col("quota") - F.col("full") * F.col("source_size"))
    permuted = F.xxhash64(F.lit(seed), F.lit("order"), "key", "block")
    blocks = _filled(blocks.drop("source").join(targets, "key"), ["key"], permuted, "block_size")
    blocks = stored(blocks.withColumnRenamed("part", "block_part"), "blocks")
    # units: a block once for each pass that takes it, in whole or in part
    units = blocks.select("key", "block", F.explode(F.sequence(F.lit(0).cast("long"), "full")).alias("copy"), "full", "block_part")
    units = units.where("copy < full or block_part > 0").select("key", "block", "copy")
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64(F.lit(seed), F.lit("draw"), "key", "block", "copy"), "block", "copy"))
    quotas = stored(split(units.groupBy("key").agg(F.count("*").alias("n")), shards, seed), "quotas")
    upto = F.sum("n").over(Window.partitionBy("key").orderBy("shard"))
    places = quotas.withColumn("upto", upto).select("key", "shard", F.explode(F.sequence(F.col("upto") - F.col("n") + 1, "upto")).alias("place"))
    drawn = units.withColumn("place", rank.cast("long")).join(places, ["key", "place"]).groupBy("key", "block")
    drawn = drawn.agg(F.sort_array(F.collect_list(F.struct("copy", "shard"))).alias("units"))  # most + 1 at most
    blocks = stored(blocks.join(drawn, ["key", "block"], "left"), "blocks")

    # the plan has at most ``2 ** bits`` rows for each source; it is broadcast where that is little, so that documents stay where they are
    small = F.broadcast if blocks.count() <= BROADCAST_ROWS else (lambda df: df)
    rows = (every if others else sizes).join(small(blocks), ["key", "block"])
    inside = (F.col("block_part") > 0) & (F.col("block_part") < F.col("block_size"))
    within = sizes.join(blocks.where(inside).select("key", "block", F.col("block_part").alias("rest")), ["key", "block"])
    subs = within.groupBy("key", "block", "sub", "rest").agg(F.sum("size").alias("sub_size"))
    subs = _filled(subs, ["key", "block"], F.col("sub"), "sub_size").select("key", "block", "sub", "sub_size", F.col("part").alias("sub_part"))
    subs = stored(subs, "subs")
    rows = rows.join(small(subs), ["key", "block", "sub"], "left")
    divided = F.coalesce((F.col("sub_part") > 0) & (F.col("sub_part") < F.col("sub_size")), F.lit(False))
    whole = rows.where(~divided).withColumn("part", F.when(F.coalesce("sub_part", "block_part") > 0, F.col("size")).otherwise(0))
    cut = _filled(rows.where(divided).withColumn("rest", F.col("sub_part")), ["key", "block", "sub"], F.col("h"), "size")
    out = whole.unionByName(cut)
    words = F.transform(F.coalesce("units", F.array().cast("array<struct<copy:bigint,shard:int>>")), lambda u: F.struct(
        u["copy"].alias("copy"), u["shard"].alias("shard"), F.when(u["copy"] < F.col("full"), F.col("size")).otherwise(F.col("part")).alias("words"),
    ))
    return out.select("doc_id", *others, "size", "source_size", "target", F.filter(words, lambda t: t["words"] > 0).alias("takes"))


def taken(planned: DataFrame) -> DataFrame:
    """``planned`` with ``taken``, the words that the mix takes of each document, repeats counted."""
    return planned.withColumn("taken", F.aggregate("takes", F.lit(0).cast("long"), lambda a, t: a + t["words"]))


def copies(planned: DataFrame, text_col: str = "text", seed: int = SEED, whole: bool = False) -> DataFrame:
    """One row for each copy of a document in the mix, with its ``shard``, shuffled within each shard.

    ``text_col`` must be among the plan's ``others``. The one copy of a source that is taken in part holds its first words,
    joined by single spaces; with ``whole`` it is taken in whole if that is at least half of it, else not at all, so a source
    is off its target by at most half a document.
    """
    if whole:
        most = F.filter("takes", lambda t: 2 * t["words"] >= F.col("size"))
        planned = planned.withColumn("takes", F.transform(most, lambda t: t.withField("words", F.col("size"))))
    rows = planned.withColumn("take", F.explode("takes"))
    first = F.concat_ws(" ", F.slice(F.regexp_extract_all(text_col, F.lit(WORD), F.lit(0)), 1, F.col("take.words").cast("int")))
    rows = rows.withColumn(text_col, F.when(F.col("take.words") < F.col("size"), first).otherwise(F.col(text_col)))
    rows = rows.withColumn("shard", F.col("take.shard")).withColumn("_order", F.xxhash64(F.lit(seed), F.lit("shuffle"), "doc_id", "take.copy", "shard"))
    return rows.repartition("shard", F.pmod("_order", F.lit(64))).sortWithinPartitions("shard", "_order").drop("take", "takes", "_order")
