"""Prefix trie of conversations by collapsing whole sequences.

Conversations that read alike from the first turn to the last are one weighted sequence with a
list of ends. Sequences that are a proper prefix of another are taken out by an anti-join; the
others are the leaves. Every prefix of every sequence is a node; weights and leaves are added up
by node.

A prefix is known by its depth and two 64-bit values: the turns' SHA-256 digests, hashed with
their depth and combined by exclusive or, so that the values of all prefixes are running totals.
Running totals and places go through blocks, so a conversation of any length is never one task's.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

GROUP = 100                 # conversations that share the head of their first one
HEADS = 6                   # a head is shorter than this
BLOCK = 4096                # turns of a conversation that meet in one window
SORT_LETTERS = 64
CHUNK_BYTES = 1 << 16
NODE = ["depth", "a", "b"]


def ordered(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """(conv_id, place, role, text): the turns with their place in the conversation, from 1.

    In the order of the turn, null first; ties by role, then by text; repeated rows are turns of
    their own. Null roles and texts are empty; rows without a conversation are left out. Other
    columns are not read. Rows are sorted by ranges of conversation, turn and the first letters
    of role and text; each range is numbered by itself, and what a conversation has in earlier
    ranges (a number per range) is added.
    """
    rows = df.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    first = [F.col("conv_id"), F.col("turn").asc_nulls_first()]
    # a cut role says nothing about the order of the texts behind it
    letters = F.when(F.length("role") < SORT_LETTERS, F.substring("text", 1, SORT_LETTERS))
    ranges = rows.repartitionByRange(*first, F.substring("role", 1, SORT_LETTERS),
                                     F.coalesce(letters, F.lit("")))
    sorted_rows = ranges.sortWithinPartitions(*first, "role", "text").drop("turn")

    def number(batches):
        part, last, held = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            keys = batch.column("conv_id").to_numpy()
            if not len(keys):
                continue
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            sizes = np.diff(np.r_[starts, len(keys)])
            places = np.arange(len(keys)) - np.repeat(starts, sizes) + 1
            if keys[0] == last:
                places[:sizes[0]] += held
            last, held = keys[-1], places[-1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(places), batch.column("role"),
                 batch.column("text"), pa.array(np.full(len(keys), part, np.int32))],
                ["conv_id", "place", "role", "text", "part"])

    numbered = common.store(sorted_rows.mapInArrow(
        number, "conv_id long, place long, role string, text string, part int"), "turns")
    earlier = _carried(numbered)
    if earlier:
        known = numbered.sparkSession.createDataFrame(
            earlier, "part int, conv_id long, earlier long")
        numbered = numbered.join(F.broadcast(known), ["part", "conv_id"], "left").withColumn(
            "place", F.col("place") + F.coalesce("earlier", F.lit(0)))
    return numbered.select("conv_id", "place", "role", "text")


def _carried(numbered: DataFrame) -> list[tuple[int, int, int]]:
    """(part, conversation, turns in earlier parts): at most one row per range."""
    ends = numbered.groupBy("part").agg(
        F.min("conv_id").alias("low"), F.max(F.struct("conv_id", "place")).alias("high"))
    out, last, held = [], None, 0
    for row in sorted(ends.collect(), key=lambda r: r["part"]):
        before = held if row["low"] == last else 0
        if before:
            out.append((row["part"], row["low"], before))
        last, held = row["high"]["conv_id"], row["high"]["place"]
        if last == row["low"]:
            held += before
    return out


def head_length(conv_id: Column, heads: int = HEADS) -> Column:
    """How many turns a conversation takes from the first one of its group."""
    return F.pmod(F.crc32(conv_id.cast("string")), F.lit(heads))


def rebuild(turns: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """(conv_id, depth, role, text): the head of the group's first conversation, then the own
    turns after as many; also a row of depth 0, without role and text, per conversation.

    A group's first conversation, conv_id - conv_id % group, may be absent or shorter than the
    head: then its turns are fewer, and the own ones follow directly.
    """
    base = F.col("conv_id") - F.col("conv_id") % group
    convs = turns.select("conv_id").distinct().select(
        "conv_id", base.alias("base"), head_length(F.col("conv_id"), heads).alias("h"))
    first = turns.where((F.col("conv_id") % group == 0) & (F.col("place") < heads))
    lengths = first.groupBy(F.col("conv_id").alias("base")).agg(F.count("*").alias("there"))
    convs = common.store(convs.join(lengths, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("taken")),
        "convs")
    shared = convs.join(first.withColumnRenamed("conv_id", "base"), "base").where(
        "place <= h").select("conv_id", F.col("place").alias("depth"), "role", "text")
    own = turns.join(convs, "conv_id").where("place > h").select(
        "conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), "role", "text")
    none = F.lit(None).cast("string")
    roots = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), none.alias("role"),
                         none.alias("text"))
    return shared.unionByName(own).unionByName(roots)


def running(df: DataFrame, key: str, place: str, values: dict[str, Column], total,
            block: int = BLOCK) -> DataFrame:
    """`df` with running totals of `values`, by `place` within `key`, this row included.

    `total` is the aggregate, F.sum or F.bit_xor. Windows hold `block` places; the totals of the
    blocks, one row each, are summed up before.
    """
    rows = df.withColumn("__block", F.floor(F.col(place) / block))
    inside = Window.partitionBy(key, "__block").orderBy(place).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    sums = rows.groupBy(key, "__block").agg(*[total(v).alias(n) for n, v in values.items()])
    blocks = Window.partitionBy(key).orderBy("__block").rowsBetween(
        Window.unboundedPreceding, -1)
    before = sums.select(key, "__block", *[
        total(n).over(blocks).alias(f"__{n}") for n in values]).where(F.col("__block") > 0)
    out = rows.withColumns({n: total(v).over(inside) for n, v in values.items()}).join(
        before, [key, "__block"], "left")
    if total is F.bit_xor:
        whole = {n: F.col(n).bitwiseXOR(F.coalesce(f"__{n}", F.lit(0))) for n in values}
    else:
        whole = {n: F.col(n) + F.coalesce(f"__{n}", F.lit(0)) for n in values}
    return out.withColumns(whole).drop("__block", *[f"__{n}" for n in values])


def prefixes(rebuilt: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b, up_a, up_b, chars): every prefix, and that which it continues."""
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"),
                             F.col("text")), 256)
    rows = rebuilt.select(
        "conv_id", "depth", digest.alias("digest"),
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("chars"))
    own = {n: F.when(F.col("depth") > 0, F.xxhash64("depth", F.substring("digest", p, 32)))
           .otherwise(F.lit(0)) for n, p in (("own_a", 1), ("own_b", 33))}
    rows = rows.withColumns(own).drop("digest")
    found = running(rows, "conv_id", "depth", {"a": F.col("own_a"), "b": F.col("own_b")},
                    F.bit_xor)
    return found.select("conv_id", *NODE, F.col("a").bitwiseXOR(F.col("own_a")).alias("up_a"),
                        F.col("b").bitwiseXOR(F.col("own_b")).alias("up_b"), "chars")


def ends_digest(ends: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256): SHA-256 of the node's conversations, ascending, with commas.

    Conversations are sorted by ranges and put together to texts of CHUNK_BYTES; a node's texts
    then pass through one hash, one at a time, however many they are.
    """
    key = [*NODE, "conv_id"]
    ranges = ends.select(*key).repartitionByRange(*key).sortWithinPartitions(*key)

    def join(batches):
        node, first, held, size = None, 0, [], 0

        def piece():
            return pa.RecordBatch.from_pydict({
                "depth": [node[0]], "a": [node[1]], "b": [node[2]], "first": [first],
                "ids": [",".join(held)]})

        for batch in batches:
            for *at, conv in zip(*[batch.column(c).to_pylist() for c in key], strict=True):
                if at != node or size > CHUNK_BYTES:
                    if held:
                        yield piece()
                    node, first, held, size = at, conv, [], 0
                held.append(str(conv))
                size += len(held[-1]) + 1
        if held:
            yield piece()

    pieces = ranges.mapInArrow(join, "depth long, a long, b long, first long, ids string")

    def digest(batches):
        node, state = None, None
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in [*NODE, "ids"]]
            for *at, ids in zip(*columns, strict=True):
                if at != node:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = at, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _digests(out)
        if node is not None:
            yield _digests([(*node, state.hexdigest())])

    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(
        digest, "depth long, a long, b long, ends_sha256 string")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = [*NODE, "ends_sha256"], [pa.int64()] * 3 + [pa.string()]
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def trie(rebuilt: DataFrame) -> DataFrame:
    """The nodes of the rebuilt conversations (`rebuild`), one row each:

    (depth, a, b), which identify it; conv_id, its smallest member; parent_conv_id, that of its
    parent (root: null); n_convs, its members; n_children; n_leaves, childless nodes below it or
    itself; saved_tokens, over its subtree, members but one times characters of the last turn;
    ends_sha256 of the members that end here. No conversations, no nodes. `texts` adds the turn.

    A node's smallest member is the first conversation of its sequence too, and the nodes that a
    sequence is first in are the last ones on its way. So each node counts for one sequence; a
    subtree's sum is that of the sequences through its top, less what they have before it.
    """
    paths = common.store(prefixes(rebuilt), "prefixes")
    ends = paths.groupBy("conv_id").agg(F.max_by(F.struct(*NODE), "depth").alias("n")).select(
        "conv_id", "n.*")
    ends = common.store(ends, "ends")
    sequences = common.store(ends.groupBy(*NODE).agg(
        F.count("*").alias("weight"), F.min("conv_id").alias("conv_id")), "sequences")
    ways = common.store(paths.join(sequences.select(
        "conv_id", "weight", F.col("depth").alias("length")), "conv_id"), "ways")

    inner = ways.where("depth < length").select(*NODE).distinct()
    leaves = sequences.join(inner, NODE, "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    nodes = common.store(ways.groupBy(*NODE).agg(
        F.sum("weight").alias("n_convs"), F.min("conv_id").alias("conv_id"),
        F.min("up_a").alias("up_a"), F.min("up_b").alias("up_b"), F.min("chars").alias("chars"))
        .withColumn("value", (F.col("n_convs") - 1) * F.col("chars")), "nodes")

    owned = nodes.groupBy("conv_id").agg(F.sum("value").alias("whole"))
    own = sequences.select("conv_id").join(owned, "conv_id", "left").join(
        leaves, "conv_id", "left").select(
        "conv_id", F.coalesce("whole", F.lit(0)).alias("whole"),
        F.coalesce("leaf", F.lit(0)).alias("leaf"))
    sums = ways.select("conv_id", *NODE).join(own, "conv_id").groupBy(*NODE).agg(
        F.sum("whole").alias("through"), F.sum("leaf").cast("long").alias("n_leaves"))
    upto = running(nodes, "conv_id", "depth", {"upto": F.col("value")}, F.sum)

    children = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"),
        F.col("up_b").alias("b")).agg(F.count("*").alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"),
                           F.col("b").alias("up_b"), F.col("conv_id").alias("parent_conv_id"))
    none = F.lit(hashlib.sha256().hexdigest())
    return (
        upto.join(sums, NODE).join(children, NODE, "left").join(ends_digest(ends), NODE, "left")
        .join(parents, ["depth", "up_a", "up_b"], "left")
        .select(
            *NODE, "conv_id", "parent_conv_id", "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves",
            (F.col("through") - F.col("upto") + F.col("value")).alias("saved_tokens"),
            F.coalesce("ends_sha256", none).alias("ends_sha256")))


def texts(nodes: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """`nodes` with role and text of the last turn: that of the smallest member at its depth."""
    return nodes.join(rebuilt, ["conv_id", "depth"], "left")
