"""Prefix trie of conversations by one ROLLUP over positional turn-id columns.

Conversations that begin with the same turns share a node; a node is a distinct sequence of first turns.

1. A turn's id is a 128-bit digest of role and text. Every conversation becomes one row for each block of
   BLOCK turns: the block's turn ids in positional columns, keyed by the node that the blocks before it
   reach (a 128-bit digest of that sequence). So a conversation of any length takes more rows, never more
   columns, and all blocks of all conversations go through the same aggregate.
2. ROLLUP over the positional columns, with grouping_id for the depth, aggregates all prefixes together:
   members and the least member, which names and owns the node.
3. A conversation owns the nodes from some depth on, so what it shares with conversations of smaller id is
   one prefix, of `shared` bytes. A node's subtree then needs no walk: each member but the owner saves
   what it shares below the node's parent, and every leaf is owned by one member. A second ROLLUP sums
   both over the members.

Odd rows: a null role or text is empty; rows without a conv_id belong to no conversation and are left out,
since a node is named by a conv_id; turns of one number follow each other by role and text, and a repeated
row is a further turn. A conversation without turns ends at the root. An empty table has no nodes. Turn
numbers need not be dense. Columns beside those named are ignored.

Nothing is held per group: positions and prefix digests are found in two levels (within a range of turn
numbers, then over the ranges), node statistics combine on the map side, and the ids that end at one node
reach its digest as joined ranges of ids, in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equitrace.llm.text import text_of
from equitrace.sources.workspace import stage

#: turns in a block of positional columns
BLOCK = 8
#: turn numbers, blocks and conversation ids in a range of the two-level steps
TURN_RANGE, BLOCK_RANGE, ID_RANGE = 512, 512, 4096

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def _with_offsets(rows: DataFrame, part: str, totals: dict[str, Column]) -> DataFrame:
    """Adds, for every total, its sum over the conversation's ranges before the row's own: base_<name>."""
    sums = rows.groupBy("conv_id", part).agg(*[c.alias(n) for n, c in totals.items()])
    before = Window.partitionBy("conv_id").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    fold = {n: (F.bit_xor(n) if n.startswith("x") else F.sum(n)).over(before) for n in totals}
    offsets = sums.select("conv_id", part, *[F.coalesce(c, F.lit(0)).alias(f"base_{n}") for n, c in fold.items()])
    return rows.join(offsets, ["conv_id", part])


def place_turns(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), role, text: the turns of every conversation in order."""
    rows = turns.where("conv_id is not null").select(
        "conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"),
        F.coalesce(F.floor(F.col("turn") / TURN_RANGE), F.lit(-(2**62))).alias("part"),
    )
    within = Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("rank", F.row_number().over(within).cast("long"))
    rows = _with_offsets(rows, "part", {"n": F.count("*")})
    return rows.select("conv_id", (F.col("base_n") + F.col("rank")).alias("pos"), "role", "text")


def turn_ids(placed: DataFrame) -> DataFrame:
    """conv_id, pos, a, b (the turn's id) and s (the UTF-8 bytes of its text)."""
    whole = F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    halves = [F.conv(F.substring(whole, k, 16), 16, -10).cast("long") for k in (1, 17)]
    size = F.octet_length("text").cast("long")
    return placed.select("conv_id", "pos", halves[0].alias("a"), halves[1].alias("b"), size.alias("s"))


def _step(pos: Column, a: Column, b: Column) -> tuple[Column, Column]:
    """What a turn at a place adds to the two halves of a prefix digest."""
    return F.xxhash64(F.lit(1), pos, a, b), F.xxhash64(F.lit(2), pos, a, b)


def _blocks(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each conversation and block: x_u, x_v, n and s of the block, its positional columns."""
    none = F.lit(None).cast("long")
    start = conversations.select(
        "conv_id", F.lit(0).cast("long").alias("pos"), none.alias("a"), none.alias("b"), F.lit(0).cast("long").alias("s")
    )
    rows = turns.unionByName(start).withColumn("block", F.floor(F.greatest(F.col("pos") - 1, F.lit(0)) / BLOCK))
    slot = F.col("pos") - BLOCK * F.col("block")
    u, v = _step(F.col("pos"), F.col("a"), F.col("b"))
    columns = [
        F.max(F.when(slot == k, F.col(c))).alias(f"{c}{k}") for k in range(1, BLOCK + 1) for c in ("a", "b", "s")
    ]
    real = F.col("pos") > 0
    return rows.groupBy("conv_id", "block").agg(
        F.bit_xor(F.when(real, u).otherwise(0)).alias("x_u"),
        F.bit_xor(F.when(real, v).otherwise(0)).alias("x_v"),
        F.sum("s").alias("s"),
        F.count(F.when(real, True)).alias("n"),
        *columns,
    )


def _keyed(blocks: DataFrame) -> DataFrame:
    """Adds u, v, the digest of all blocks before, and before, their bytes."""
    rows = blocks.withColumn("part", F.floor(F.col("block") / BLOCK_RANGE))
    totals = {"x_u": F.bit_xor("x_u"), "x_v": F.bit_xor("x_v"), "s": F.sum("s")}
    rows = _with_offsets(rows, "part", totals)
    earlier = Window.partitionBy("conv_id", "part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    def so_far(name: str, fold) -> Column:
        return F.coalesce(fold(name).over(earlier), F.lit(0))

    return rows.select(
        "conv_id", "block",
        so_far("x_u", F.bit_xor).bitwiseXOR(F.col("base_x_u")).alias("u"),
        so_far("x_v", F.bit_xor).bitwiseXOR(F.col("base_x_v")).alias("v"),
        (so_far("s", F.sum) + F.col("base_s")).alias("before"),
        *[f"{c}{k}" for k in range(1, BLOCK + 1) for c in ("a", "b", "s")],
    )


def _rollup(blocks: DataFrame, measures: str) -> DataFrame:
    """All nodes: u, v, depth, the parent's digest, bytes of the path before the last turn, the measures.

    The digest of the prior node, and with it block and before, stay grouped; the turn ids are rolled up.
    """
    levels = ", ".join(f"(a{k}, b{k}, s{k})" for k in range(1, BLOCK + 1))
    groups = blocks.sparkSession.sql(
        f"select u, v, block, before, {', '.join(f'a{k}, b{k}, s{k}' for k in range(1, BLOCK + 1))}, "
        f"{BLOCK} - bit_count(grouping_id()) div 3 as level, {measures} "
        f"from {{blocks}} group by u, v, block, before, rollup({levels})",
        blocks=blocks,
    )
    # a shorter conversation has no turn at the level; the top of a later block is a node of the one before
    last = F.coalesce(*[F.when(F.col("level") == k, F.col(f"a{k}").isNotNull()) for k in range(1, BLOCK + 1)])
    groups = groups.where(F.coalesce(last, F.col("block") == 0))
    steps = [
        _step(F.col("block") * BLOCK + k, F.col(f"a{k}"), F.col(f"b{k}")) for k in range(1, BLOCK + 1)
    ]

    def digest(half: int, level: Column) -> Column:
        out = F.col("uv"[half])
        for k in range(1, BLOCK + 1):
            out = out.bitwiseXOR(F.when(level >= k, steps[k - 1][half]).otherwise(0))
        return out

    above = F.col("level") - 1
    path = F.col("before")
    for k in range(1, BLOCK + 1):
        path = path + F.when(above >= k, F.col(f"s{k}")).otherwise(0)
    return groups.select(
        digest(0, F.col("level")).alias("u"),
        digest(1, F.col("level")).alias("v"),
        (F.col("block") * BLOCK + F.col("level")).alias("depth"),
        digest(0, above).alias("parent_u"),
        digest(1, above).alias("parent_v"),
        path.alias("above"),
        *[m.split(" as ")[1].strip() for m in measures.split(",")],
    )


def _ends(conversations: DataFrame) -> DataFrame:
    """u, v, depth, ends_sha256 of the nodes at which conversations end.

    Ids are joined by range first; a node's ranges then stream through its digest in order.
    """
    part = F.floor(F.col("conv_id") / ID_RANGE)
    listed = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",")
    ranges = conversations.groupBy("u", "v", "depth", part.alias("part")).agg(listed.alias("ids"))
    key = ["u", "v", "depth"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*key, "ends_sha256"]
        node, state = None, None
        for batch in batches:
            done = []
            for *at, ids in zip(*[batch.column(k).to_pylist() for k in range(4)], strict=True):
                if at != node:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = at, hashlib.sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=names)
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, state.hexdigest())], names=names)

    ordered = ranges.repartition(*key).sortWithinPartitions(*key, "part").select(*key, "ids")
    return ordered.mapInArrow(digest, "u bigint, v bigint, depth bigint, ends_sha256 string")


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per node, from turns (conv_id, pos from 1, a, b, s) and all conversations (conv_id).

    conv_id (the least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (bytes
    that the subtree's conversations share), ends_sha256 (digest of the ids that end here).
    """
    cut = stage(_blocks(turns, conversations), "trie-cut")
    blocks = stage(_keyed(cut), "trie-blocks")
    nodes = stage(_rollup(blocks, "count(*) as n_convs, min(conv_id) as conv_id"), "trie-nodes")

    children = nodes.where("depth > 0").groupBy("parent_u", "parent_v", (F.col("depth") - 1).alias("depth"))
    children = children.agg(F.count("*").alias("n_children"))
    children = children.select(F.col("parent_u").alias("u"), F.col("parent_v").alias("v"), "depth", "n_children")
    nodes = nodes.join(children, ["u", "v", "depth"], "left").na.fill(0, ["n_children"])
    nodes = stage(nodes, "trie-counted")

    # a conversation's nodes of its own start below what it shares with one of smaller id
    owners = nodes.groupBy("conv_id").agg(
        F.min("above").alias("shared"), F.count(F.when(F.col("n_children") == 0, True)).alias("leaves")
    )
    whole = cut.groupBy("conv_id").agg(
        F.bit_xor("x_u").alias("u"), F.bit_xor("x_v").alias("v"), F.sum("n").alias("depth"), F.sum("s").alias("s")
    )
    whole = whole.join(owners, "conv_id", "left").select(
        "conv_id", "u", "v", "depth",
        F.coalesce("shared", "s").alias("shared"), F.coalesce("leaves", F.lit(0)).alias("leaves"),
    )
    whole = stage(whole, "trie-whole")

    members = blocks.join(whole.select("conv_id", "shared", "leaves"), "conv_id")
    sums = _rollup(members, "sum(shared) as member_shared, sum(leaves) as n_leaves")
    sums = sums.select("u", "v", "depth", "member_shared", "n_leaves")
    parents = nodes.select(
        F.col("u").alias("parent_u"), F.col("v").alias("parent_v"), (F.col("depth") + 1).alias("depth"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    out = (
        nodes.join(sums, ["u", "v", "depth"])
        .join(whole.select("conv_id", "shared"), "conv_id")
        .join(_ends(whole.select("conv_id", "u", "v", "depth")), ["u", "v", "depth"], "left")
        .join(parents, ["parent_u", "parent_v", "depth"], "left")
    )
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        (F.col("member_shared") - F.col("shared") - (F.col("n_convs") - 1) * F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
