"""The trie of conversation prefixes, with subtree figures from an Euler tour.

1. Every conversation is rebuilt from the shared head of its base conversation and its own turns. A prefix is named by the
   exclusive or of 128-bit hashes of (place, role, text) of its turns, so that names come from running sums, and a
   parent's name is the node's without its last turn. Equal names form one node.
2. Each node has an enter and an exit arc; each arc knows its successor in the tour of the tree.
3. The tour is ranked as a list: every arc jumps ahead by doubling until it meets a splitter, about one arc in ``SPREAD``;
   the splitters form a shorter list that is ranked the same way. ``DIRECT`` arcs or fewer are walked in one task.
4. Leaves and savings of a subtree are differences of prefix sums between its two arcs, added up by blocks of positions.

No step holds a node's members or children together: places of turns, siblings, and prefix sums go by blocks, members by
blocks of ids. Only the SHA-256 of the members that end in one node runs in one task, over strings of up to 256 ids each.

Edge cases: rows without ``conv_id`` belong to no conversation and are left out. Null roles and texts are empty; a null turn
comes first; rows with one turn number are ordered by a digest of role and text, so repeated rows are repeated turns. A
conversation whose base is absent keeps only its turns after the head. An empty table gives no rows, not even the root. Extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlespark.llm.common import discard
from candlespark.session import materialize

#: Bits of the block sizes: turns of a conversation, siblings, positions of the tour, ids of ending members.
TURNS, SIBLINGS, POSITIONS, IDS = 10, 14, 12, 8
#: One arc in so many is a splitter; lists of so many arcs are walked in one task.
SPREAD, DIRECT = 16, 4096
#: A conversation belongs to the smallest id of its hundred, of which it shares fewer than ``HEADS`` turns.
FAMILY, HEADS = 100, 6

KEY = ["depth", "name_a", "name_b"]


def running(df: DataFrame, key: str, order: str, bits: int, sums: dict[str, Column], total) -> DataFrame:
    """Adds running totals ``sums`` of each ``key`` by ``order``, counted from 0: within blocks, then over the blocks."""
    df = df.withColumn("block", F.shiftright(order, bits))
    blocks = df.groupBy(key, "block").agg(*[total(c).alias(f"before_{n}") for n, c in sums.items()])
    earlier = Window.partitionBy(key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumns({f"before_{n}": total(F.col(f"before_{n}")).over(earlier) for n in sums})
    inside = Window.partitionBy(key, "block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    parts = df.withColumns({n: total(c).over(inside) for n, c in sums.items()})
    return parts.join(blocks, [key, "block"])


def placed_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, turn_a, turn_b, length``: every turn with its place from 0 on and a digest of role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        digest.alias("digest"), F.length(text).cast("bigint").alias("length"),
    )
    turns = turns.select(
        "conv_id", "turn", "length", F.xxhash64("digest").alias("turn_a"), F.xxhash64(F.lit("b"), "digest").alias("turn_b"),
        F.coalesce(F.shiftright("turn", TURNS), F.lit(-(2**63)).cast("bigint")).alias("block"),
    )
    turns = materialize(turns, "trie-turns")
    blocks = turns.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv_id", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    order = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "turn_a", "turn_b")
    placed = turns.withColumn("pos", F.row_number().over(order) - 1).join(blocks, ["conv_id", "block"])
    return placed.select("conv_id", (F.col("pos") + F.col("before")).alias("pos"), "turn_a", "turn_b", "length")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations as ``conv_id, total``, and their turns as ``conv_id, pos, total, turn_a, turn_b, length``."""
    family = lambda c: F.try_subtract(c, F.pmod(c, F.lit(FAMILY)))
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")).select(
        "*", F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS)).alias("head"), family(F.col("conv_id")).alias("base")
    )
    bases = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    shared = F.least("head", F.coalesce("base_own", F.lit(0)))
    convs = convs.join(bases, "base", "left").select(
        "conv_id", "base", "head", shared.alias("shared"), (shared + F.greatest(F.col("own") - F.col("head"), F.lit(0))).alias("total")
    )
    convs = materialize(convs, "trie-conversations")
    heads = turns.where((F.col("pos") < HEADS) & (F.col("conv_id") == family(F.col("conv_id")))).withColumnRenamed("conv_id", "base")
    columns = ["conv_id", "pos", "total", "turn_a", "turn_b", "length"]
    first = heads.join(convs, "base").where("pos < head").select(columns)
    rest = turns.join(convs, "conv_id").where("pos >= head").withColumn("pos", F.col("pos") - F.col("head") + F.col("shared"))
    return convs.select("conv_id", "total"), first.unionByName(rest.select(columns))


def prefixes(turns: DataFrame) -> DataFrame:
    """Names of all prefixes, and of their parents."""
    own = {
        "own_a": F.xxhash64("pos", "turn_a", "turn_b"),
        "own_b": F.xxhash64(F.lit("b"), "turn_b", "pos", "turn_a"),
    }
    summed = running(turns.withColumns(own), "conv_id", "pos", TURNS, {"in_a": F.col("own_a"), "in_b": F.col("own_b")}, F.bit_xor)
    name = {s: F.col(f"in_{s}").bitwiseXOR(F.coalesce(f"before_in_{s}", F.lit(0))) for s in "ab"}
    return summed.select(
        "conv_id", (F.col("pos") + 1).alias("depth"), "total", "length", *[name[s].alias(f"name_{s}") for s in "ab"],
        *[name[s].bitwiseXOR(F.col(f"own_{s}")).alias(f"parent_{s}") for s in "ab"],
    )


def trie_nodes(convs: DataFrame, found: DataFrame) -> DataFrame:
    """One row per node with an ``id``, its parent's id and conversation, and the figures of its own."""
    nodes = found.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("parent_a").alias("parent_a"),
        F.min("parent_b").alias("parent_b"), F.min("length").alias("length"),
    )
    zero = F.lit(0).cast("bigint")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        "*", *[zero.alias(c) for c in ("depth", "name_a", "name_b", "length")], *[F.lit(None).cast("bigint").alias(c) for c in ("parent_a", "parent_b")]
    )
    nodes = materialize(nodes.unionByName(root).withColumn("id", F.monotonically_increasing_id()), "trie-nodes")
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("name_a").alias("parent_a"), F.col("name_b").alias("parent_b"),
        F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"),
    )
    linked = nodes.join(parents, ["depth", "parent_a", "parent_b"], "left").drop("parent_a", "parent_b")
    return materialize(linked, "trie-links")


def tour(nodes: DataFrame, children: DataFrame) -> DataFrame:
    """The arcs ``2 * id`` (enter) and ``2 * id + 1`` (exit) of all nodes, with their successors and weights.

    Children follow each other by id, block by block, so that a node of any number of children is no single task.
    """
    block = F.shiftright("id", SIBLINGS).alias("block")
    firsts = nodes.groupBy("parent", block).agg(F.min("id").alias("first"))
    after = firsts.select("parent", "block", F.lead("first").over(Window.partitionBy("parent").orderBy("block")).alias("after"))
    siblings = nodes.select("*", block).withColumn("sibling", F.lead("id").over(Window.partitionBy("parent", "block").orderBy("id")))
    joined = siblings.join(after, ["parent", "block"], "left").join(children, F.col("id") == F.col("of"), "left")
    enter, leave = 2 * F.col("id"), 2 * F.col("id") + 1
    following = F.coalesce(F.col("sibling"), F.col("after"))
    zero = F.lit(0).cast("bigint")
    arcs = F.array(
        F.struct(
            enter.alias("arc"), F.coalesce(2 * F.col("first_child"), leave).alias("next"),
            F.col("first_child").isNull().cast("bigint").alias("leaf"), ((F.col("n_convs") - 1) * F.col("length")).alias("saved"),
        ),
        F.struct(leave.alias("arc"), F.coalesce(2 * following, 2 * F.col("parent") + 1).alias("next"), zero.alias("leaf"), zero.alias("saved")),
    )
    return materialize(joined.select(F.inline(arcs)), "trie-arcs")


def walked(links: DataFrame) -> DataFrame:
    """Weights from each arc to the end of a list of at most ``DIRECT`` arcs."""

    def walk(frame):
        import pandas as pd

        step = {a: (n, w) for a, n, w in zip(frame["arc"], frame["next"].astype("Int64"), frame["weight"])}
        ahead = {n for n, _ in step.values() if n is not pd.NA}
        at, path = next(a for a in step if a not in ahead), []
        while at in step:
            path.append((at, step[at][1]))
            at = step[at][0] if step[at][0] is not pd.NA else None
        out = pd.DataFrame(path, columns=["arc", "left"])
        return out.assign(left=out["left"][::-1].cumsum())

    return links.groupBy().applyInPandas(walk, "arc bigint, left bigint")


def ranked(links: DataFrame, level: int = 0) -> DataFrame:
    """``arc, left``: the weights from each arc of the list ``arc, next, weight`` to its end, its own included."""
    if links.count() <= DIRECT:
        return walked(links)
    splitter = lambda c: F.pmod(F.xxhash64(c, F.lit(level)), F.lit(SPREAD)) == 0
    state = links.withColumn("done", F.col("next").isNull() | splitter(F.col("next")))
    rounds = None
    while not state.where("NOT done").isEmpty():
        ahead = state.select(F.col("arc").alias("next"), F.col("next").alias("target"), F.col("weight").alias("more"), F.col("done").alias("stop"))
        jumped = state.where("NOT done").join(ahead, "next").select(
            "arc", F.col("target").alias("next"), (F.col("weight") + F.col("more")).alias("weight"), F.col("stop").alias("done")
        )
        state = materialize(state.where("done").unionByName(jumped), "trie-jumps")
        if rounds is not None:
            discard(rounds)
        rounds = state
    tops = materialize(state.where(splitter(F.col("arc"))).drop("done"), "trie-splitters")
    beyond = ranked(tops, level + 1).select(F.col("arc").alias("next"), F.col("left").alias("beyond"))
    return state.join(beyond, "next", "left").select("arc", (F.col("weight") + F.coalesce("beyond", F.lit(0))).alias("left"))


def subtrees(arcs: DataFrame) -> DataFrame:
    """``id, n_leaves, saved_tokens`` from prefix sums along the tour."""
    ranks = ranked(arcs.select("arc", "next", F.lit(1).cast("bigint").alias("weight")))
    ordered = arcs.join(ranks, "arc").select("arc", "leaf", "saved", (-F.col("left")).alias("place"), F.lit(0).alias("all"))
    sums = running(materialize(ordered, "trie-tour"), "all", "place", POSITIONS, {"sum_leaf": F.col("leaf"), "sum_saved": F.col("saved")}, F.sum)
    upto = {c: F.col(f"sum_{c}") + F.coalesce(f"before_sum_{c}", F.lit(0)) for c in ("leaf", "saved")}
    # At the exit arc the sum up to it, at the enter arc the sum before it.
    span = lambda c: F.max(upto[c]) - F.min(upto[c] - F.col(c))
    return sums.groupBy(F.shiftright("arc", 1).alias("id")).agg(span("leaf").alias("n_leaves"), span("saved").alias("saved_tokens"))


def endings(convs: DataFrame, found: DataFrame) -> DataFrame:
    """Per node in which conversations end: the digest of their ids."""
    zero = F.lit(0).cast("bigint")
    ends = found.where("depth = total").select(*KEY, "conv_id").unionByName(
        convs.where("total = 0").select(*[zero.alias(c) for c in KEY], "conv_id")
    )
    pieces = ends.groupBy(*KEY, F.shiftright("conv_id", IDS).alias("block")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    pieces = pieces.select(*KEY, "block", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))

    def digests(batches: Iterator) -> Iterator:
        import hashlib

        import pandas as pd

        last, digest = None, None
        for batch in batches:
            rows = []
            for *key, ids in zip(*[batch[c] for c in KEY], batch["ids"]):
                if key == last:
                    digest.update(b"," + ids.encode())
                    continue
                if last:
                    rows.append((*last, digest.hexdigest()))
                last, digest = key, hashlib.sha256(ids.encode())
            yield pd.DataFrame(rows, columns=[*KEY, "ends_sha256"])
        if last:
            yield pd.DataFrame([(*last, digest.hexdigest())], columns=[*KEY, "ends_sha256"])

    ordered = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "block")
    return ordered.mapInPandas(digests, "depth bigint, name_a bigint, name_b bigint, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations."""
    convs, turns = rebuilt(materialize(placed_turns(conversations), "trie-placed"))
    found = materialize(prefixes(turns), "trie-prefixes")
    nodes = trie_nodes(convs, found)
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("of")).agg(
        F.min("id").alias("first_child"), F.count(F.lit(1)).alias("n_children")
    )
    children = materialize(children, "trie-children")
    figures = materialize(subtrees(tour(nodes, children)), "trie-subtrees")
    joined = nodes.join(children, F.col("id") == F.col("of"), "left").join(figures, "id").join(endings(convs, found), KEY, "left")
    return joined.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
