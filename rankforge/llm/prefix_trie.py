"""The trie of conversation prefixes by truncation peeling.

A node is a distinct sequence of first turns. Peeling starts at the greatest
depth and comes up: the conversations that end at a depth join the nodes that
are left there, equal prefixes become one node whose figures are the sums of
what it was made of, the last turn is stripped and the rest is grouped again.
Nodes are found and their figures summed in the same pass.

* A turn is a 128-bit digest of role and text; a prefix is the digest chained
  over its turns, so a node's key has a fixed width at any depth.
* Depths are cut into blocks (1, 2, 4, ... ``BLOCK`` levels). Each conversation
  has one row a block, with the keys of its prefixes there: rows are bounded,
  and all rows together hold each turn once.
* A block whose groups (rows under one prefix at its floor) are small is peeled
  within tasks, all its levels after one shuffle. If a prefix holds too many
  rows, the block is peeled level by level with grouped aggregates, which
  combine before each shuffle: a first turn that a third of all conversations
  share meets no single task.
* What goes up to the next block is one row per node, with the figures summed;
  copies of a conversation are combined first.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankforge.llm.common import join_spread, materialize

#: Levels of the largest blocks; the first ones are of 1, 1, 2, 4, ... levels.
BLOCK = 256
#: Rows times levels that one task peels under one prefix.
GROUP_STEPS = 500_000
#: Bytes of a key; the root's key.
KEY, ROOT = 16, b"\0" * 16
#: Ids in one piece of a list of ended conversations.
PIECE = 4096
#: Conversations share a base of BASE ids; at most HEADS - 1 of its turns come first.
BASE, HEADS = 100, 6

_CHUNK = "conv_id long, block int, floor binary, path binary, sizes binary, last boolean"
_NODE = "key binary, parent binary, depth int, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def block_bounds(block: int, largest: int = BLOCK) -> tuple[int, int]:
    """Depths lo + 1 .. hi of a block, numbered from 1: 1, 2, 3-4, 5-8, ... then ``largest`` at a time."""
    lo, hi = 0, 1
    for _ in range(block - 1):
        lo, hi = hi, hi + min(hi, largest)
    return lo, hi


def turn_rows(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, digest, size) of every turn of a conversation with an id."""
    r, t = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.char_length(r).cast("string"), F.lit(":"), r, t).cast("binary"), 256)), 1, KEY)
    return (conversations.where(F.col(conv_id).isNotNull())
            .select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), digest.alias("digest"), F.char_length(t).alias("size")))


def as_recorded(turns: DataFrame) -> DataFrame:
    """(conv_id, at, turn, digest, size, skip): each conversation's own turns in order, none skipped."""
    return turns.select("conv_id", F.lit(1).alias("at"), "turn", "digest", "size", F.lit(0).alias("skip"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, at, turn, digest, size, skip): the first h turns of the base conversation, then the own ones, of which h are to be skipped.

    A base's turns are cut to five before they are shuffled, and a base serves
    at most 100 ids, so no group grows with the data."""
    own = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    heads = (turns.where(F.col("conv_id") % BASE == 0).withColumn("nth", F.row_number().over(order)).where(F.col("nth") < HEADS)
             .select(F.col("conv_id").alias("base"), "nth", F.col("digest"), F.col("size")))
    ids = turns.select("conv_id").distinct().withColumn("h", own).withColumn("base", F.col("conv_id") - F.col("conv_id") % BASE)
    first = ids.join(heads, "base").where(F.col("nth") <= F.col("h"))
    first = first.select("conv_id", F.lit(0).alias("at"), F.col("nth").cast("long").alias("turn"), "digest", "size", F.lit(0).alias("skip"))
    rest = turns.select("conv_id", F.lit(1).alias("at"), F.col("turn").cast("long").alias("turn"), "digest", "size", own.cast("int").alias("skip"))
    return first.unionByName(rest)


def _chunks(turns: DataFrame, largest: int) -> DataFrame:
    """One row per conversation and block: the keys and text sizes of its prefixes there. Block 0: a conversation without turns.

    A task reads its conversations as a sorted stream and holds one row at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        conv, skip, depth, block, key, floor, hi, path, sizes = None, 0, 0, 0, ROOT, ROOT, 0, [], []

        def close(last: bool) -> None:
            out.append((conv, block, floor, b"".join(path), np.array(sizes, dtype=">i4").tobytes(), last))

        def emit() -> pa.RecordBatch:
            cols = list(zip(*out)) if out else [[]] * 6
            types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.bool_()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["conv_id", "block", "floor", "path", "sizes", "last"])

        for b in batches:
            for c, at, digest, size, left in zip(*(b.column(k).to_pylist() for k in range(5))):
                if c != conv:
                    if conv is not None:
                        close(True)
                    conv, skip, depth, block, key, floor, hi, path, sizes = c, None, 0, 0, ROOT, ROOT, 0, [], []
                if at == 1:
                    if skip is None:
                        skip = left
                    if skip:
                        skip -= 1
                        continue
                if depth == hi:
                    if block:
                        close(False)
                    block += 1
                    floor, path, sizes, hi = key, [], [], block_bounds(block, largest)[1]
                depth += 1
                key = hashlib.blake2b(key + digest, digest_size=KEY).digest()
                path.append(key)
                sizes.append(size)
                if len(out) >= 2000:
                    yield emit()
            if out:
                yield emit()
        if conv is not None:
            close(True)
        yield emit()

    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "at", F.col("turn").asc_nulls_first(), "digest")
    return dealt.select("conv_id", "at", "digest", "size", "skip").mapInArrow(run, _CHUNK)


_SUMS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]


def _finish(parts: DataFrame, keys: list, size) -> DataFrame:
    """Nodes from the contributions that share ``keys``; ``size``: code points of the node's last text."""
    g = parts.groupBy(*keys).agg(F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in _SUMS])
    return g.withColumn("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long")) \
        .withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * size)


def _peel_levels(rows: DataFrame, lo: int, hi: int) -> list[DataFrame]:
    """Nodes of a block, level by level: group the rows that reach the depth, strip the last turn, group again."""
    nodes, left = [], None
    size = F.conv(F.hex(F.substring("sizes", -4, 4)), 16, 10).cast("long")
    for d in range(hi, lo, -1):
        here = rows.where(F.col("depth") == d).drop("depth")
        here = here if left is None else here.unionByName(left)
        level = materialize(_finish(here, ["floor", "path", "sizes"], size), "level")
        nodes.append(level.select(F.substring("path", -KEY, KEY).alias("key"),
                                  (F.substring("path", (d - lo - 2) * KEY + 1, KEY) if d - lo > 1 else F.col("floor")).alias("parent"),
                                  F.lit(d).alias("depth"), "conv_id", *_SUMS))
        left = level.select("floor", F.substring("path", 1, (d - lo - 1) * KEY).alias("path"), F.substring("sizes", 1, (d - lo - 1) * 4).alias("sizes"),
                            "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens")
    return nodes


def _peel_group(rows: list[tuple], lo: int, hi: int) -> Iterator[tuple]:
    """Nodes of a block under one prefix. Rows: (path, sizes, depth, conv_id, n_convs, n_children, n_leaves, saved_tokens)."""
    ending: dict[int, list[tuple]] = {}
    for r in rows:
        ending.setdefault(r[2], []).append(r)
    left: list[tuple] = []
    for d in range(max(ending), lo, -1):
        at, level = (d - lo - 1) * KEY, {}
        for path, sizes, _, conv, n, children, leaves, saved in itertools.chain(ending.get(d, ()), left):
            key = path[at: at + KEY]
            node = level.get(key)
            if node is None:
                level[key] = [conv, n, children, leaves, saved, path, sizes]
            else:
                node[0] = min(node[0], conv)
                node[1] += n
                node[2] += children
                node[3] += leaves
                node[4] += saved
        left = []
        for key, (conv, n, children, leaves, saved, path, sizes) in level.items():
            leaves = leaves if children else 1
            saved += (n - 1) * int.from_bytes(sizes[4 * (d - lo - 1): 4 * (d - lo)], "big")
            yield key, path[at - KEY: at] if at else None, d, conv, n, children, leaves, saved
            left.append((path, sizes, d, conv, n, 1, leaves, saved))


def _peel_local(rows: DataFrame, lo: int, hi: int) -> DataFrame:
    """Nodes of a block whose groups under one prefix are small: one shuffle, all levels within the tasks."""
    types = [pa.binary(), pa.binary(), pa.int32(), *[pa.int64()] * 5]
    names = [c.split()[0] for c in _NODE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (r for b in batches for r in zip(*(b.column(k).to_pylist() for k in range(b.num_columns))))
        nodes = ((n[0], floor if n[1] is None else n[1], *n[2:]) for floor, g in itertools.groupby(stream, key=lambda r: r[0])
                 for n in _peel_group([r[1:] for r in g], lo, hi))
        while part := list(itertools.islice(nodes, 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), types)], names=names)

    return rows.select("floor", "path", "sizes", "depth", "conv_id", *_SUMS).repartition("floor").sortWithinPartitions("floor").mapInArrow(run, _NODE)


def _nodes(chunks: DataFrame, group_steps: int, largest: int) -> DataFrame:
    """All nodes (columns ``_NODE``), from the deepest block to the root."""
    none, found, left = F.lit(0).cast("long"), [], None
    zeros = [none.alias(c) for c in _SUMS[1:]]
    for block in range(chunks.agg(F.max("block")).first()[0] or 0, 0, -1):
        lo, hi = block_bounds(block, largest)
        here = chunks.where(F.col("block") == block)
        rows = here.where("last").groupBy("floor", "path", "sizes").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
        rows = rows.select("*", *zeros, (F.octet_length("path") / KEY + lo).cast("int").alias("depth"))
        if left is not None:
            rows = rows.unionByName(here.where("NOT last").select("conv_id", "floor", "path", "sizes").join(left, "conv_id").withColumn("depth", F.lit(hi)))
        rows = materialize(rows, "block")
        most = rows.groupBy("floor").count().agg(F.max("count")).first()[0] or 0
        if hi - lo > 1 and most * (hi - lo) <= group_steps:
            nodes = [materialize(_peel_local(rows, lo, hi), "nodes")]
        else:
            nodes = _peel_levels(rows, lo, hi)
        found += nodes
        # the nodes right above the floor, stripped of their last turn and grouped
        left = nodes[-1].where(F.col("depth") == lo + 1).groupBy("parent").agg(
            F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.count("*").alias("n_children"),
            F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")).drop("parent")
    bare = chunks.where("block = 0").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select("*", *zeros)
    tops = bare if left is None else bare.unionByName(left)
    root = _finish(tops.withColumn("key", F.lit(ROOT)), ["key"], none).select(
        "key", F.lit(None).cast("binary").alias("parent"), F.lit(0).alias("depth"), "conv_id", *_SUMS)
    for n in found:
        root = root.unionByName(n)
    return materialize(root, "nodes")


def _ends(chunks: DataFrame) -> DataFrame:
    """(key, first, ids): the ids of the conversations that end at a node, ascending, ``PIECE`` at most in a row.

    Sorted over the cluster by node and id, so the copies of one conversation are spread over tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = ((k, i) for b in batches for k, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        rows = []
        for key, g in itertools.groupby(stream, key=lambda r: r[0]):
            while ids := [i for _, i in itertools.islice(g, PIECE)]:
                rows.append((key, ids[0], ids))
                if len(rows) >= 1000:
                    yield batch(rows)
                    rows = []
        yield batch(rows)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) if rows else [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.int64(), pa.list_(pa.int64())))], names=["key", "first", "ids"])

    key = F.when(F.octet_length("path") > 0, F.substring("path", -KEY, KEY)).otherwise(F.lit(ROOT))
    ended = chunks.where("last").select(key.alias("key"), "conv_id")
    parts = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ended.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(run, "key binary, first long, ids array<long>")


def ends_digest(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): SHA-256 of the ids of a node as one comma-joined list, read piece by piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        rows = ((key, _digest(text for _, text in g)) for key, g in itertools.groupby(stream, key=lambda r: r[0]))
        while part := list(itertools.islice(rows, 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), (pa.binary(), pa.string()))], names=["key", "ends_sha256"])

    text = F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids")
    dealt = ends.select("key", "first", text).repartition("key").sortWithinPartitions("key", "first")
    return dealt.select("key", "ids").mapInArrow(run, "key binary, ends_sha256 string")


def _digest(pieces: Iterator[str]) -> str:
    h = hashlib.sha256()
    for i, p in enumerate(pieces):
        h.update(b"," * (i > 0) + p.encode())
    return h.hexdigest()


def prefix_trie(turns: DataFrame, group_steps: int = GROUP_STEPS, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends) of the trie of ``turns``, as ``as_recorded`` or ``rebuilt`` make them of ``turn_rows``.

    ``nodes``: one row per node, ``key, parent, depth, conv_id, n_convs,
    n_children, n_leaves, saved_tokens, parent_conv_id``: the smallest member,
    the members, the nodes one turn longer, the childless nodes at or below
    it, and the code points that sharing saves at or below it. ``ends``: ``key,
    first, ids``: the ids that end at a node, in pieces.

    Turns are ordered by ``turn``, NULL first, equal ones by their content; a
    turn that is there twice counts twice. NULL role and text are empty. Rows
    without a conversation id are left out. ``group_steps`` bounds what one
    task peels under one prefix and ``block`` the levels of a block; neither
    changes the result. No conversations: no nodes."""
    chunks = materialize(_chunks(turns, block).sortWithinPartitions("block"), "chunks")
    nodes = _nodes(chunks, group_steps, block)
    parents = nodes.where("n_children > 0").select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("share"))
    return join_spread(nodes, parents, "parent", "share", "left").drop("share"), _ends(chunks)
