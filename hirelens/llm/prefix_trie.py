"""Conversation prefix trie by vertical bitmaps.

Every distinct sequence of a conversation's first turns is a node. The node of
depth d + 1 below a node holds the conversations that the node holds and that
have the same turn at position d, so with one bitset of conversations for each
(position, turn) a child is the intersection of its parent's bitset with a
posting.

Conversations in order of their ids are cut into shards of ``SHARD``, their
turns into blocks of ``BLOCK`` positions; one task holds one block of one
shard, whatever the length of a conversation or the number of its copies. In a
shard, nodes are visited depth first: the lowest conversation left in the
parent's bitset names a posting, the intersection is the child (its popcount
the members, its lowest bit the smallest one, its intersection with the
conversations that end here the end list), and what it holds leaves the rest.
A node's key is a hash chain over its turns, so shards agree on it; a block
starts from the keys of the blocks before it, chained in a pass over one key a
block. Shards' nodes meet by key: counts are summed before the shuffle, and end
lists, each a run of ascending ids, are hashed one after the other.

Sums over subtrees double their reach each round: a node adds the sums of the
nodes whose known ancestor it is, then looks up its ancestor's ancestor. Nodes
with one member are a single path with one leaf and nothing saved, so only
shared nodes take part, and the rounds are the logarithm of the depth that two
conversations share.

Turns and prefixes are told apart by 128 bits of SHA-256 with lengths inside.
Defined results: a conversation without turns is a member of the root alone; an
empty table has no node. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm._shared import Scratch
from hirelens.operators.dedupe import digest

BLOCK = 64
SHARD = 1024
ROOT = bytes(16)
NODE = "node binary, parent binary, turn binary, depth long, bytes long, n_convs long, conv long, shard long, ends string"


def turn_key(role: str, text: str) -> Column:
    """128 bits that tell turns apart by role and text."""
    return F.unhex(F.left(digest(role, text), F.lit(32)))


def _hash(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(parts)).digest()[:16]


def _starts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The key that each block of a conversation starts from: a chain over the
    hashes of the blocks before it, which come in order."""
    conv, key = None, ROOT
    for pdf in batches:
        out = []
        for c, block, whole in zip(pdf["conv"], pdf["block"], pdf["whole"]):
            if c != conv:
                conv, key = c, ROOT
            out.append((c, block, key))
            key = _hash(key, whole)
        yield pd.DataFrame(out, columns=["conv", "block", "start"])


def _nodes(pdf: pd.DataFrame, width: int) -> pd.DataFrame:
    """The nodes of one block, ``width`` positions of one shard, depth first."""
    pdf = pdf.sort_values("conv")
    convs, held = pdf["conv"].tolist(), pdf["held"].tolist()
    block, shard = int(pdf["block"].iloc[0]), int(pdf["shard"].iloc[0])
    turns = [[bytes(k) for k in x] for x in pdf["turns"]]
    sizes = [list(x) for x in pdf["sizes"]]
    postings: dict[tuple[int, bytes], int] = {}
    going, ending, begin = [0] * (width + 1), [0] * (width + 1), {}
    for i, keys in enumerate(turns):
        bit = 1 << i
        for j, key in enumerate(keys):
            postings[j, key] = postings.get((j, key), 0) | bit
            going[j] |= bit
        if held[i] == block * width + len(keys):
            ending[len(keys)] |= bit
        start = bytes(pdf["start"].iloc[i])
        begin[start] = begin.get(start, 0) | bit

    out = []

    def emit(node, parent, turn, j, size, bits):
        ends, left = [], bits & ending[j]
        while left:
            low = left & -left
            ends.append(str(convs[low.bit_length() - 1]))
            left ^= low
        out.append((node, parent, turn, block * width + j, size, bits.bit_count(), convs[(bits & -bits).bit_length() - 1],
                    shard, ",".join(ends) if ends else None))

    if block == 0:
        emit(ROOT, None, None, 0, 0, begin[ROOT])
    stack = [(start, start, 0, bits) for start, bits in begin.items()]
    while stack:
        start, node, j, bits = stack.pop()
        rest = bits & going[j] if j < width else 0
        while rest:
            i = (rest & -rest).bit_length() - 1
            turn = turns[i][j]
            child = rest & postings[j, turn]
            rest ^= child
            key = _hash(node, turn) if j + 1 < width else _hash(start, _hash(*turns[i]))
            emit(key, node, turn, j + 1, int(sizes[i][j]), child)
            stack.append((start, key, j + 1, child))
    return pd.DataFrame(out, columns=[f.split()[0] for f in NODE.split(", ")])


def _end_hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each node's end lists, which come in order."""
    node, sha = None, None
    for pdf in batches:
        done = []
        for key, ends in zip(pdf["node"], pdf["ends"]):
            if key != node:
                if sha is not None:
                    done.append((node, sha.hexdigest()))
                node, sha = key, hashlib.sha256(ends.encode())
            else:
                sha.update(("," + ends).encode())
        yield pd.DataFrame(done, columns=["node", "ends_sha256"])
    if sha is not None:
        yield pd.DataFrame([(node, sha.hexdigest())], columns=["node", "ends_sha256"])


def _subtree_sums(own: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, leaves, saved) summed over the nodes below, from (node, up,
    leaves, saved) of each."""
    sums, r = scratch.save(own, "sums-0"), 0
    while sums.where("up IS NOT NULL").limit(1).count():
        below = (sums.where("up IS NOT NULL").groupBy(F.col("up").alias("node"))
                 .agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")))
        above = sums.select(F.col("node").alias("up"), F.col("up").alias("over"))
        sums = scratch.save(
            sums.join(below, "node", "left").join(above, "up", "left")
            .select("node", F.col("over").alias("up"), (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                    (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")), f"sums-{r + 1}")
        scratch.drop(f"sums-{r}")
        r += 1
    return sums.drop("up")


def prefix_trie(convs: DataFrame, turns: DataFrame, scratch: Scratch) -> DataFrame:
    """The trie of ``convs`` (conv: long and not null, held: its turns), given
    ``turns`` (conv, place from 0, turn: its key, size: its bytes): node,
    parent, turn (keys), depth, bytes, conv (smallest member), parent_conv,
    n_convs, n_children, n_leaves, saved, ends_sha256."""
    width = BLOCK  # the workers' own copy of this module has the default
    tasks = int(convs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.monotonically_increasing_id()
    shards = (convs.select("conv", "held").repartitionByRange(tasks, "conv").sortWithinPartitions("conv").withColumn("at", at)
              .select("conv", "held", F.expr(f"shiftleft(shiftright(at, 33), 33) + (at & {(1 << 33) - 1}) div {SHARD}").alias("shard")))
    shards = scratch.save(shards, "shards")
    blocks = (turns.groupBy("conv", F.expr(f"place div {BLOCK}").alias("block"))
              .agg(F.sort_array(F.collect_list(F.struct("place", "turn", "size"))).alias("x")))  # BLOCK of them at most
    blocks = scratch.save(blocks.select("conv", "block", F.col("x.turn").alias("turns"), F.col("x.size").alias("sizes")), "blocks")

    long = blocks.join(shards.where(f"held > {BLOCK}").select("conv"), "conv", "left_semi")
    whole = F.unhex(F.left(F.sha2(F.expr("unhex(array_join(transform(turns, x -> hex(x)), ''))"), 256), F.lit(32)))
    starts = (long.select("conv", "block", whole.alias("whole")).repartition("conv").sortWithinPartitions("conv", "block")
              .mapInPandas(_starts, "conv long, block long, start binary"))
    none = F.array().cast("array<binary>"), F.array().cast("array<bigint>")
    parts = (blocks.join(shards, "conv").join(starts, ["conv", "block"], "left")
             .select("conv", "held", "shard", "block", "turns", "sizes", F.coalesce("start", F.lit(ROOT)).alias("start"))
             .union(shards.where("held = 0").select("conv", "held", "shard", F.lit(0).cast("long"), *none, F.lit(ROOT))))
    found = scratch.save(parts.groupBy("block", "shard").applyInPandas(lambda pdf: _nodes(pdf, width), NODE), "found")

    nodes = scratch.save(found.groupBy("node", "parent", "turn", "depth", "bytes")
                         .agg(F.sum("n_convs").alias("n_convs"), F.min("conv").alias("conv")), "nodes")
    ends = (found.where("ends IS NOT NULL").select("node", "shard", "ends").repartition("node").sortWithinPartitions("node", "shard")
            .drop("shard").mapInPandas(_end_hashes, "node binary, ends_sha256 string"))
    children = (nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node"))
                .agg(F.count("*").alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("alone")))
    nodes = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = scratch.save(nodes, "counted")
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(F.coalesce("alone", F.lit(0)))
    sums = _subtree_sums(nodes.where("n_convs > 1").select(
        "node", F.col("parent").alias("up"), leaf.cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")), scratch)
    parents = nodes.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv"))
    return (nodes.join(sums, "node", "left").join(ends, "node", "left").join(parents, "parent", "left")
            .select("node", "parent", "turn", "depth", "bytes", "conv", "parent_conv", "n_convs", "n_children",
                    F.coalesce("leaves", F.lit(1)).alias("n_leaves"), F.coalesce("saved", F.lit(0)).alias("saved"),
                    F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))
