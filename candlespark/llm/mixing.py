"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Each source's documents are put in a keyed random order (a 64-bit hash) and cut by its upper bits into ``BLOCKS``
permuted blocks. A source's target gives every document ``base`` copies and the documents up to a cut in that
order one more. The copies of blocks are the units that a binary tree deals to ``2 ** levels`` output shards: at
each node the units are put in a fresh keyed order and halved, which draws the sources' shares from the
multivariate hypergeometric distribution exactly. Inside a shard documents are ordered by another keyed hash.

Only counts per source and block are gathered; documents move at most once, to their shard.

Edge cases: a null source is a source of its own and comes last. A null or blank text has size 0 and gets copies
like its neighbours in the order. Rows that repeat (same id and text) share a place in the order and are taken
together. Sources or tables without words get target 0. Input columns named like result columns give way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlespark.llm.common import WORD, stored
from candlespark.session import materialize

WEIGHTS = (5, 2, 1)
LIMIT = 3
BLOCK_BITS = 8
#: The lots of a node's units are counted by their upper bits: a row per range and node, whatever the number of units.
LOT_BITS = 12
LEVELS = 4
#: Rows that a part of a shard, which one task sorts, is meant to hold, once a shard has more than 16 parts.
SHARD_ROWS = 65_536


def place(seed: int) -> Column:
    """A document's place in its source's random order."""
    return F.xxhash64(F.lit(seed), "doc_id", "text")


def block_of(place_column: Column) -> Column:
    return F.shiftright(place_column, 64 - BLOCK_BITS).cast("int")


def sizes(docs: DataFrame, seed: int) -> DataFrame:
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("bigint")
    return docs.select("doc_id", "source", size.alias("size"), place(seed).alias("place"))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """Target words per source: shares by weight, none above ``limit`` times the source, the excess reshared.

    With the sources ordered by limit over weight, the share per unit of weight that results is the largest of
    (words left after the limits of the sources before) / (weight from here on).
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(named) - 1) % len(weights) + 1).cast("int"))
    per_source = per_source.withColumn("weight", weight.cast("double"))
    tight = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, whole = tight.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum(limit * F.col("source_size")).over(before), F.lit(0))
    rest = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    per_source = per_source.withColumn("level", left / rest).withColumn("level", F.max("level").over(whole))
    return per_source.select("source", "source_size", F.least(limit * F.col("source_size").cast("double"), F.col("weight") * F.col("level")).alias("target"))


def cuts(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """Per source ``base`` copies for all documents, and ``cut``: places up to it get one more (null: none)."""
    goals = goals.withColumn("base", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int"))
    goals = goals.withColumn("extra", F.col("target") - F.col("base") * F.col("source_size"))
    blocks = sized.groupBy("source", block_of(F.col("place")).alias("block")).agg(F.sum("size").alias("words"))
    order = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("words").over(order), F.lit(0)))
    same = F.col("b.source").eqNullSafe(F.col("g.source"))
    cut_blocks = (
        blocks.alias("b").join(goals.alias("g"), same)
        .filter("g.extra > b.before AND g.extra <= b.before + b.words")
        .select(F.col("b.source").alias("source"), "b.block", (F.col("g.extra") - F.col("b.before")).alias("open"))
    )
    # One block of each source is ordered row by row; its cut falls where the words taken come nearest.
    inside = sized.withColumn("block", block_of(F.col("place"))).alias("s").join(
        cut_blocks.alias("c"), F.col("s.source").eqNullSafe(F.col("c.source")) & (F.col("s.block") == F.col("c.block"))
    ).select("s.source", "s.place", "s.size", "c.open", "c.block")
    upto = Window.partitionBy("source", "block").orderBy("place")
    taken = inside.withColumn("middle", F.sum("size").over(upto) - F.col("size") / 2).filter("middle <= open")
    # The first place of the block less one stands for "nothing of the cut block".
    lowest = cut_blocks.select("source", (F.shiftleft(F.col("block").cast("bigint"), 64 - BLOCK_BITS) - 1).alias("place"))
    cut = taken.select("source", "place").unionByName(lowest).groupBy("source").agg(F.max("place").alias("cut"))
    return (
        goals.alias("g").join(cut.alias("c"), F.col("g.source").eqNullSafe(F.col("c.source")), "left")
        .select("g.source", "g.source_size", "g.target", "g.base", "c.cut")
    )


def deal(blocks: DataFrame, seed: int, levels: int, rows: int) -> DataFrame:
    """Shards of the block copies ``(source, block, copies)``: an array per block, one shard per copy.

    A unit's place in its node's order is its place in its lot's range plus the counts of the ranges before, so that
    no task holds a node's units. ``rows`` documents bound the size of the tables between.
    """
    units = blocks.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).withColumn("node", F.lit(0))
    for level in range(levels):
        drawn = units.withColumn("lot", F.xxhash64(F.lit(seed), F.lit(level), "source", "block", "copy"))
        drawn = drawn.withColumn("lots", F.shiftright("lot", 64 - LOT_BITS).cast("int"))
        counts = drawn.groupBy("node", "lots").agg(F.count("*").alias("n"))
        node = Window.partitionBy("node")
        before = F.sum("n").over(node.orderBy("lots").rowsBetween(Window.unboundedPreceding, -1))
        counts = counts.select("node", "lots", F.coalesce(before, F.lit(0)).alias("before"), (F.sum("n").over(node) / 2).alias("half"))
        inside = F.row_number().over(Window.partitionBy("node", "lots").orderBy("lot", "source", "block", "copy"))
        placed = drawn.withColumn("inside", inside).join(counts, ["node", "lots"])
        right = (F.col("before") + F.col("inside") > F.col("half")).cast("int")
        # Written out: the next level reads the units twice.
        units = stored(placed.select("source", "block", "copy", (F.col("node") * 2 + right).alias("node")), "mix-units", rows)
    drawn = F.transform(F.array_sort(F.collect_list(F.struct("copy", "node"))), lambda x: x["node"])
    return units.groupBy("source", "block").agg(drawn.alias("shards"))


def plan_mix(docs: DataFrame, seed: int = 0, levels: int = LEVELS) -> DataFrame:
    """One row per source and block: ``source, block, source_size, target, base, cut, shards``."""
    sized = materialize(sizes(docs, seed), "mix-sizes")
    rows = sized.count()
    goals = stored(cuts(sized, targets(sized)), "mix-targets", rows)
    blocks = sized.select("source", block_of(F.col("place")).alias("block")).distinct()
    blocks = blocks.alias("b").join(goals.alias("g"), F.col("b.source").eqNullSafe(F.col("g.source"))).select("b.*", "g.source_size", "g.target", "g.base", "g.cut")
    copies = F.col("base") + (F.coalesce(F.col("cut"), F.lit(-(2**63))) >= F.shiftleft(F.col("block").cast("bigint"), 64 - BLOCK_BITS)).cast("int")
    shards = deal(blocks.select("source", "block", copies.alias("copies")).filter("copies > 0"), seed, levels, rows)
    same = F.col("b.source").eqNullSafe(F.col("s.source")) & (F.col("b.block") == F.col("s.block"))
    planned = blocks.alias("b").join(shards.alias("s"), same, "left").select("b.*", F.coalesce("s.shards", F.array().cast("array<int>")).alias("shards"))
    # Written out, its true size is known, and the planner may pick a broadcast for itself.
    return stored(planned, "mix-plan", rows)


def attach(docs: DataFrame, plan: DataFrame, seed: int = 0) -> DataFrame:
    """``docs`` as column ``packed_row`` with its plan, ``place`` and ``n_copies``."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    own = docs.select(row.alias("packed_row"), F.col("source").alias("own_source"), place(seed).alias("place"))
    own = own.withColumn("own_block", block_of(F.col("place")))
    joined = own.join(plan, F.col("own_source").eqNullSafe(F.col("source")) & (F.col("own_block") == F.col("block")))
    more = F.coalesce(F.col("place") <= F.col("cut"), F.lit(False)).cast("int")
    return joined.withColumn("n_copies", F.col("base") + more)


def mix_figures(docs: DataFrame, seed: int = 0) -> DataFrame:
    """Per document its size, its source's size and target, the words taken, and the shards of its copies."""
    slim = sizes(docs, seed).withColumnRenamed("size", "own_size").withColumnRenamed("place", "own_place")
    plan = plan_mix(docs, seed)
    slim = slim.withColumn("own_block", block_of(F.col("own_place"))).withColumnRenamed("source", "own_source")
    joined = slim.join(plan, F.col("own_source").eqNullSafe(F.col("source")) & (F.col("own_block") == F.col("block")))
    more = F.coalesce(F.col("own_place") <= F.col("cut"), F.lit(False)).cast("int")
    joined = joined.withColumn("n_copies", F.col("base") + more)
    return joined.select(
        "doc_id",
        F.col("own_size").alias("size"),
        "source_size",
        "target",
        (F.col("own_size") * F.col("n_copies")).cast("bigint").alias("taken"),
        F.slice("shards", F.lit(1), F.col("n_copies")).alias("shards"),
    )


def mix(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The mixed documents, a row per copy, in the columns of ``docs``; shard by shard, shuffled inside."""
    both = attach(docs, plan_mix(docs, seed), seed).filter("n_copies > 0")
    # Parts of a shard grow in number with the rows, not in size.
    pieces = max(16, docs.count() // (SHARD_ROWS * 2**LEVELS))
    copies = both.select("packed_row", "place", F.posexplode(F.slice("shards", F.lit(1), F.col("n_copies"))).alias("copy", "shard"))
    shuffled = copies.repartition("shard", F.pmod(F.xxhash64("place", "copy"), F.lit(pieces))).sortWithinPartitions(
        "shard", F.xxhash64(F.lit(seed), "shard", "place", "copy")
    )
    return shuffled.select("packed_row.*")
