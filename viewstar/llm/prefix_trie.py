"""Prefix trie of conversations: union-find over neighbours in sorted order, block by block.

A conversation is the row of its turns' digests. In sorted order the conversations below any
node of the trie stand side by side, and the longest common prefix (LCP) of two neighbours is the
depth at which their paths part. Sorted conversations are numbered over the whole cluster and
cut into blocks of equal count; each block also sees the row before and the row after it. Within
a block the edges between neighbours are merged by union-find in descending depth: a merge of
two components makes the node where they part, or hangs one of them below the other's top.

What a block knows for certain, the nodes that no neighbouring block shares, is final. The others
lie on the two paths along the block's borders; everything below them is contracted to
sums, and the pieces of one node from all blocks are added up by the digest of its path. So that
sums hold, each node, leaf and child is counted by one block: nodes and children by the block
where they begin, leaves by the block of their last copy.

Copies, however many, spread over blocks, as equal rows are sorted by ``conv_id``. One task holds
one block: ``BLOCK`` conversations of 20 bytes a turn; a conversation is never split. The digest
of the ids that end at a node is made of one stream of ids, as its definition asks.

Defined cases: a null ``turn`` comes first; equal turns of a conversation follow the digest of
their role and text; null role or text is empty text; rows without ``conv_id`` belong to no
conversation and are left out; a repeated row is one more turn. A rebuilt conversation without
turns is a member of the root alone. The remainder of a negative id is negative, as in SQL. An
empty table has no node, not even a root. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from viewstar.operators.numbering import number_rows
from viewstar.staging import Staging

#: Conversations per block.
BLOCK = 512
#: At most this many turns are taken from the head of another conversation.
HEAD = 8
DIGEST = 16

NO_IDS = hashlib.sha256().hexdigest()

CLOSED, HUNG, PIECE, END = range(4)
FOREST = pa.schema([
    ("kind", pa.int32()), ("block", pa.int64()), ("conv_id", pa.int64()),
    ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("held", pa.int64()),
    ("distinct", pa.int64()), ("path", pa.binary()), ("parent_path", pa.binary()),
    ("ends_sha256", pa.string())])
FOREST_DDL = (
    "kind int, block long, conv_id long, depth long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, held long, distinct long, path binary, "
    "parent_path binary, ends_sha256 string")
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256")


def turn_digest(role: str, text: str):
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns) with the digest and the text's bytes of each turn, in order."""
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"), F.struct(
            F.col("turn").alias("turn"), turn_digest("role", "text").alias("digest"),
            F.octet_length(F.coalesce("text", F.lit(""))).alias("size")).alias("turn"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))


def rebuilt(found: DataFrame) -> DataFrame:
    """(conv_id, key, sizes): the head of the first of five conversations, then the own turns.

    ``found`` is a stored table of ``sequences``.
    """
    bases = found.where("conv_id % 5 = 0").select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, HEAD).alias("head"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    joined = found.withColumn("taken", taken).join(
        bases, F.expr("conv_id - conv_id % 5 = base"), "left")
    turns = F.concat(
        F.expr("coalesce(slice(head, 1, taken), slice(turns, 1, 0))"),
        F.expr("slice(turns, taken + 1, size(turns))"))
    return joined.select("conv_id", turns.alias("turns")).select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")).alias("key"),
        F.transform("turns", lambda t: t["size"]).alias("sizes"))


def common_turns(one: bytes, other: bytes) -> int:
    least = min(len(one), len(other))
    if one[:least] == other[:least]:
        return least // DIGEST
    unequal = np.frombuffer(one, np.uint8, least) != np.frombuffer(other, np.uint8, least)
    return int(unequal.argmax()) // DIGEST


class Forest:
    """The trie of one block of sorted conversations, with only its branching nodes and ends.

    Node v covers the conversations ``low[v]`` to ``high[v]`` and has the paths below it in
    ``below[v]``. ``top`` is the one node left when all neighbours are merged.
    """

    def __init__(self, lengths: list[int], common: list[int]):
        count = len(lengths)
        self.depth, self.low, self.high = list(lengths), list(range(count)), list(range(count))
        self.below: list[list[int]] = [[] for _ in range(count)]
        component, tops = list(range(count)), list(range(count))

        def find(at: int) -> int:
            while component[at] != at:
                component[at] = component[component[at]]
                at = component[at]
            return at

        self.top = 0
        for edge in sorted(range(count - 1), key=lambda e: -common[e]):
            left, right = find(edge), find(edge + 1)
            self.top = self._merge(tops[left], tops[right], common[edge])
            component[right] = left
            tops[left] = self.top

    def _merge(self, x: int, y: int, depth: int) -> int:
        """The node at ``depth`` above x and, to its right, y; both are at least as deep."""
        if self.depth[x] == depth:
            node = x
            if self.depth[y] == depth:
                self.below[x].extend(self.below[y])
            else:
                self.below[x].append(y)
        elif self.depth[y] == depth:
            node = y
            self.below[y].append(x)
        else:
            node = len(self.depth)
            self.depth.append(depth)
            self.low.append(0)
            self.high.append(0)
            self.below.append([x, y])
        self.low[node], self.high[node] = self.low[x], self.high[y]
        return node

    def parents(self) -> list[tuple[int, int]]:
        """All nodes that are left, each with the node above it, from the top down."""
        out, open_ = [], [(self.top, -1)]
        while open_:
            node, above = open_.pop()
            out.append((node, above))
            open_.extend((child, node) for child in self.below[node])
        return out


def _paths(key: bytes, depth: int) -> list[bytes]:
    """Digests of the first 0, 1, … ``depth`` turns."""
    running = hashlib.md5(usedforsecurity=False)
    out = [running.digest()]
    for at in range(depth):
        running.update(key[at * DIGEST:(at + 1) * DIGEST])
        out.append(running.copy().digest())
    return out


def _block_rows(block: int, keys: list[bytes], ids: list[int], sizes: list[np.ndarray],
                before: bytes | None, after: bytes | None) -> Iterator[tuple]:
    """Rows of ``FOREST`` for one block; ``before`` and ``after`` are its neighbours' keys."""
    last = len(keys) - 1
    lengths = [len(key) // DIGEST for key in keys]
    common = [common_turns(keys[i], keys[i + 1]) for i in range(last)]
    shared_left = -1 if before is None else common_turns(before, keys[0])
    shared_right = -1 if after is None else common_turns(keys[last], after)
    forest = Forest(lengths, common)
    leaves = np.concatenate(([0], np.cumsum(
        [reach < length for reach, length in zip([*common, shared_right], lengths)])))
    left_paths, right_paths = _paths(keys[0], shared_left), _paths(keys[last], shared_right)

    def began(node: int, depth: int) -> bool:
        return forest.low[node] > 0 or depth > shared_left

    def path(node: int, depth: int) -> bytes | None:
        if forest.low[node] == 0 and depth <= shared_left:
            return left_paths[depth]
        if forest.high[node] == last and depth <= shared_right:
            return right_paths[depth]
        return None

    order = forest.parents()
    least = [0] * len(forest.depth)
    # Bytes below each node, held by members and in distinct nodes, its own line not included.
    held, distinct = [0] * len(forest.depth), [0] * len(forest.depth)
    rows = []
    for node, above in reversed(order):
        low, high, depth = forest.low[node], forest.high[node], forest.depth[node]
        ended = low
        while ended <= high and lengths[ended] == depth:
            ended += 1
        least[node] = min(ids[low:ended] + [least[child] for child in forest.below[node]])
        count = high - low + 1
        children = sum(began(child, depth + 1) for child in forest.below[node])
        highest = forest.depth[above] + 1 if above >= 0 else 0
        for at in range(depth, highest - 1, -1):
            size = int(sizes[low][at - 1]) if at else 0
            held[node] += size * count
            if began(node, at):
                distinct[node] += size
            here = path(node, at)
            ends = ids[low:ended] if at == depth else []
            over = (node if at > highest else above) if at else -1
            rows.append((node, at, over, here, children, held[node], distinct[node], count,
                         int(leaves[high + 1] - leaves[low]), ends))
            children = int(began(node, at))
        if above >= 0:
            held[above] += held[node]
            distinct[above] += distinct[node]
    for node, at, over, here, children, held_, distinct_, count, leafs, ends in rows:
        parent_path = path(over, at - 1) if over >= 0 else None
        if here is not None:
            yield (PIECE, block, least[node], at, None, count, children, leafs, held_,
                   distinct_, here, parent_path, None)
            for conv_id in ends:
                yield (END, block, conv_id, at, None, None, None, None, None, None, here,
                       None, None)
            continue
        sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        if parent_path is None:
            yield (CLOSED, block, least[node], at, least[over] if over >= 0 else None,
                   count, children, leafs, held_, distinct_, None, None, sha)
        else:
            yield (HUNG, block, least[node], at, None, count, children, leafs, held_,
                   distinct_, None, parent_path, sha)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(column, field.type) for column, field in zip(
        zip(*rows), FOREST)], schema=FOREST)


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks come whole and in order; ``side`` is -1, 0, 1 for the row before, own, after."""
    current, keys, ids, sizes, before, after = None, [], [], [], None, None
    rows: list[tuple] = []

    def close() -> None:
        if keys:
            rows.extend(_block_rows(current, keys, ids, sizes, before, after))

    for batch in batches:
        column = {name: batch.column(name) for name in ("block", "side", "conv_id", "key")}
        numbers = {name: column[name].to_pylist() for name in ("block", "side", "conv_id")}
        offsets = batch.column("sizes").offsets.to_numpy()
        flat = batch.column("sizes").values.to_numpy(zero_copy_only=False)
        for at, (block, side, conv_id) in enumerate(zip(*numbers.values())):
            if block != current:
                close()
                while rows:
                    yield _batch(rows[:10_000])
                    del rows[:10_000]
                current, keys, ids, sizes, before, after = block, [], [], [], None, None
            key = column["key"][at].as_py()
            if side < 0:
                before = key
            elif side > 0:
                after = key
            else:
                keys.append(key)
                ids.append(conv_id)
                sizes.append(flat[offsets[at]:offsets[at + 1]].copy())
    close()
    for start in range(0, len(rows), 10_000):
        yield _batch(rows[start:start + 10_000])


def _streamed_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per path from its ids in order; nothing but the running digest is kept."""
    current, running, done = None, None, []
    for batch in batches:
        for path, conv_id in zip(batch.column("path").to_pylist(),
                                 batch.column("conv_id").to_pylist()):
            if path != current:
                if running:
                    done.append((current, running.hexdigest()))
                current, running = path, hashlib.sha256(str(conv_id).encode())
            else:
                running.update(f",{conv_id}".encode())
        if done:
            paths, shas = zip(*done)
            yield pa.record_batch({"path": pa.array(paths, pa.binary()),
                                   "ends_sha256": pa.array(shas, pa.string())})
            done = []
    if running:
        yield pa.record_batch({"path": pa.array([current], pa.binary()),
                               "ends_sha256": pa.array([running.hexdigest()], pa.string())})


def trie(rows: DataFrame, staging: Staging, block: int = BLOCK) -> DataFrame:
    """One row per node of the trie of ``rows`` (conv_id, key, sizes), with ``COLUMNS``.

    ``conv_id`` is unique, ``key`` the digests of its turns end to end, ``sizes`` their bytes.
    """
    ranked = number_rows(rows, ["key", "conv_id"], "rank", staging)
    at = F.floor((F.col("rank") - 1) / block).cast("long")
    place = (F.col("rank") - 1) % block

    def seen(to, side: int, when):
        return F.when(when, F.struct(to.alias("block"), F.lit(side).alias("side")))

    in_blocks = ranked.withColumn("seen", F.explode(F.array_compact(F.array(
        seen(at, 0, F.lit(True)), seen(at - 1, 1, (place == 0) & (at > 0)),
        seen(at + 1, -1, place == block - 1))))).select("seen.*", "rank", "conv_id", "key", "sizes")
    forests = in_blocks.repartition("block").sortWithinPartitions("block", "rank").mapInArrow(
        _forests, FOREST_DDL)
    kinds = staging.split(forests, "forests", "kind", (CLOSED, HUNG, PIECE, END))

    saved = (F.col("held") - F.col("distinct")).alias("saved_tokens")
    final = kinds[CLOSED].withColumn("saved_tokens", saved).select(*COLUMNS)
    pieces = kinds[PIECE]
    merged = staging.table(pieces.groupBy("path").agg(
        F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.first("parent_path").alias("parent_path"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "held", "distinct")]),
        "merged")
    names = merged.select(F.col("path").alias("parent_path"),
                          F.col("conv_id").alias("parent_conv_id"))
    ends = kinds[END].select("path", "conv_id").repartition("path").sortWithinPartitions(
        "path", "conv_id").mapInArrow(_streamed_ends, "path binary, ends_sha256 string")
    shared = merged.join(names, "parent_path", "left").join(ends, "path", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(NO_IDS))).withColumn("saved_tokens", saved)
    # A shared node may have children all over the data: each block looks its names up once.
    by_block = pieces.select("block", F.col("path").alias("parent_path")).join(
        names, "parent_path")
    hung = kinds[HUNG].drop("parent_conv_id").join(
        by_block, ["block", "parent_path"]).withColumn("saved_tokens", saved)
    return final.unionByName(hung.select(*COLUMNS)).unionByName(shared.select(*COLUMNS))
