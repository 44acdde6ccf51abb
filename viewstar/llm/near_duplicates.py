"""N-gram Jaccard join with Bayesian candidate pruning, exact at the end.

Texts are sets of five-word shingles; two different texts are linked if the Jaccard similarity
of their sets is at least 0.8.

1. Equal texts are one node, named by the MD5 of the text; all later work is on nodes.
2. Each node gets ``HASHES`` MinHash values. Nodes that agree on one of ``BANDS`` bands of
   ``ROWS`` values are candidates: a pair at the threshold is missed with a chance of
   (1 - 0.8**3)**20, below 1e-6. A large bucket is cut into blocks of ``BLOCK`` nodes, and each
   pair of blocks is a group of its own, so no task holds a bucket and no pair leaves a task.
3. Bayesian pruning: the values are compared ``STEP`` at a time. With a uniform prior the
   similarity after m agreements among n has a Beta(m + 1, n - m + 1) posterior; a pair is
   dropped as soon as the chance of reaching the threshold falls below ``TOLERANCE``.
   Of what survives in a group only a star per connected piece leaves the task.
4. The stars give clusters. Only their nodes are read again for their shingles, and all
   pairs in a cluster, block by block, are pruned as before and then verified exactly. A task
   gives each node's number of links and a star per piece that links connect.
5. The exact stars give the classes; equal texts get their node's class.

Defined cases: a null text is an empty text; a text without words has no shingle, and so links
to none but still forms a class with equal texts; a text of fewer than five words has one
shingle, all its words; rows with a null or repeated id are kept, one result row each; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from viewstar.llm.graph import components
from viewstar.llm.names import free_name, own_columns
from viewstar.llm.text import (
    WHITE_SPACE, Words, hashed_words, mixed, row_chunks, shingles)
from viewstar.staging import Staging

SHINGLE = 5
THRESHOLD = 0.8
ROWS, BANDS = 3, 20
HASHES = 64
STEP = 16
TOLERANCE = 1e-7
BLOCK = 256
#: Shingle bytes that a block holds on average, at most.
BLOCK_BYTES = 64 << 20
#: Rows, and shingle bytes, that a group of small buckets holds on average, at most.
PACK = 4000
PACK_BYTES = 64 << 20
#: Buckets of a fixed-size filter by which documents outside all clusters are left out early.
FILTER_BUCKETS = 1 << 20

_SEEDS = np.random.default_rng(7).integers(0, 2**63, HASHES, dtype=np.uint64) * 2 + 1


def least_agreement(threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
                    hashes: int = HASHES, step: int = STEP) -> list[int]:
    """For n = step, 2 step, ... the fewest agreements among n values that keep a pair.

    P(s >= t | m of n) for a uniform prior is the chance that a binomial of n + 1 draws with
    success chance t is at most m.
    """
    from math import comb
    fewest = []
    for n in range(step, hashes + 1, step):
        chance, m = 0.0, -1
        while chance < tolerance:
            m += 1
            chance += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        fewest.append(m)
    return fewest


def minhashes(sets: Words) -> np.ndarray:
    """One row of 32-bit MinHash values per document with shingles; zeros for the others."""
    out = np.zeros((len(sets.first) - 1, HASHES), np.uint32)
    filled = np.flatnonzero(np.diff(sets.first))
    if len(filled):
        heads = sets.first[filled]
        for k, seed in enumerate(_SEEDS):
            values = ((sets.words ^ (seed >> np.uint64(7))) * seed) >> np.uint64(32)
            out[filled, k] = np.minimum.reduceat(values.astype(np.uint32), heads)
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per row and band; the band's number is part of the key."""
    keys = np.zeros((len(signatures), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(signatures), np.uint64(band + 1))
        for value in range(band * ROWS, (band + 1) * ROWS):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + signatures[:, value])
        keys[:, band] = key
    return keys


def _digests(column: pa.Array) -> list[bytes]:
    return [hashlib.md5((text or "").encode()).digest() for text in column.to_pylist()]


SIGNED = "doc_id long, node binary, n_shingles long, keys array<long>, signature binary"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, end in row_chunks(batch.column("text")):
            rows = batch.slice(start, end - start)
            sets = shingles(hashed_words(rows.column("text"), WHITE_SPACE), SHINGLE)
            counts = np.diff(sets.first)
            signatures = minhashes(sets)
            keys = band_keys(signatures).view(np.int64)
            lengths = np.where(counts > 0, BANDS, 0)
            yield pa.record_batch({
                "doc_id": rows.column("doc_id").cast(pa.int64()),
                "node": pa.array(_digests(rows.column("text")), pa.binary()),
                "n_shingles": pa.array(counts, pa.int64()),
                "keys": pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32()),
                    pa.array(keys[counts > 0].ravel(), pa.int64())),
                "signature": pa.array([row.tobytes() for row in signatures], pa.binary())})


def _spread(members: DataFrame, key: str) -> DataFrame:
    """Rows of ``members`` with a column ``cell`` for each pair of blocks they take part in.

    A bucket has as many blocks as the column ``blocks`` says; the node's hash gives its block.
    """
    return members.withColumn(
        "block", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks"))
    ).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    ).withColumn("cell", F.xxhash64(
        F.col(key), F.least("block", "other"), F.greatest("block", "other"))
    ).withColumn("low", F.col("block") <= F.col("other")
    ).withColumn("same", F.col("block") == F.col("other"))


def _packed(cells: DataFrame, rows: int, size: int = 0) -> DataFrame:
    """Cells dealt into packs of about ``PACK`` rows, or ``PACK_BYTES`` bytes where ``size`` tells
    those of all; a cell stays whole, two blocks at most."""
    packs = max(1, rows // PACK, size // PACK_BYTES)
    return cells.withColumn("pack", F.pmod(F.xxhash64("cell"), F.lit(packs)))


def _runs(cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of equal values in a sorted array."""
    edges = np.flatnonzero(cell[1:] != cell[:-1]) + 1
    return np.concatenate(([0], edges)), np.concatenate((edges, [len(cell)]))


def _pairs_of_run(start: int, end: int, same: np.ndarray, low: np.ndarray):
    """All pairs within a block, or all pairs between the two blocks of a cell."""
    if same[start]:
        left, right = np.triu_indices(end - start, 1)
        return left + start, right + start
    one = np.flatnonzero(low[start:end]) + start
    two = np.flatnonzero(~low[start:end]) + start
    return np.repeat(one, len(two)), np.tile(two, len(one))


def _pair_slices(cell: np.ndarray, same: np.ndarray, low: np.ndarray, limit: int = 1 << 17):
    """The pairs of all runs, some hundred thousand at a time."""
    left, right, held = [], [], 0
    for start, end in zip(*_runs(cell)):
        if end - start < 2:
            continue
        one, two = _pairs_of_run(start, end, same, low)
        left.append(one)
        right.append(two)
        held += len(one)
        if held >= limit:
            yield np.concatenate(left), np.concatenate(right)
            left, right, held = [], [], 0
    if held:
        yield np.concatenate(left), np.concatenate(right)


def _pruned(left, right, signatures, fewest):
    """The pairs that keep a chance of reaching the threshold, comparing step by step."""
    agreed = np.zeros(len(left), np.int64)
    for number, least in enumerate(fewest):
        part = slice(number * STEP, (number + 1) * STEP)
        agreed = agreed + (signatures[left, part] == signatures[right, part]).sum(axis=1)
        alive = agreed >= least
        left, right, agreed = left[alive], right[alive], agreed[alive]
        if not len(left):
            break
    return left, right


def _stars(left: np.ndarray, right: np.ndarray, size: int) -> list[tuple[int, int]]:
    """(member, least member) of each connected piece: the same star wherever it is found."""
    parent = list(range(size))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(left.tolist(), right.tolist()):
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
    touched = np.unique(np.concatenate((left, right))).tolist()
    return [(x, root(x)) for x in touched if root(x) != x]


def _columns(table: pa.Table, key: str):
    table = table.combine_chunks().sort_by([(key, "ascending"), ("node", "ascending")])
    signatures = np.frombuffer(
        b"".join(table.column("signature").to_pylist()), np.uint32).reshape(-1, HASHES)
    return (table, table.column(key).to_numpy(), table.column("same").to_numpy(),
            table.column("low").to_numpy(), signatures)


def _candidates(table: pa.Table) -> pa.Table:
    """Stars over the pairs of a pack that survive the pruning."""
    table, cell, same, low, signatures = _columns(table, "cell")
    fewest = least_agreement()
    nodes = table.column("node").to_pylist()
    a, b = [], []
    for left, right in _pair_slices(cell, same, low):
        left, right = _pruned(left, right, signatures, fewest)
        for one, two in _stars(left, right, len(cell)):
            a.append(nodes[one])
            b.append(nodes[two])
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def _intersections(left, right, sets: list[np.ndarray]) -> np.ndarray:
    """|A and B| for each pair; many pairs over few sets are counted by a matrix product."""
    used = np.unique(np.concatenate((left, right)))
    if len(left) < 4 * len(used):
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                         for i, j in zip(left.tolist(), right.tolist())], np.int64)
    place = np.zeros(len(sets), np.int64)
    place[used] = np.arange(len(used))
    values = np.concatenate([sets[i] for i in used])
    owner = np.repeat(np.arange(len(used)), [len(sets[i]) for i in used])
    _, column, count = np.unique(values, return_inverse=True, return_counts=True)
    shared = count > 1
    rank = np.cumsum(shared) - 1
    keep = shared[column]
    column, owner = rank[column[keep]], owner[keep]
    common = np.zeros((len(used), len(used)), np.float32)
    for start in range(0, int(shared.sum()), 8192):
        inside = (column >= start) & (column < start + 8192)
        matrix = np.zeros((len(used), 8192), np.float32)
        matrix[owner[inside], column[inside] - start] = 1
        common += matrix @ matrix.T
    return common[place[left], place[right]].astype(np.int64)


def _verified(table: pa.Table) -> pa.Table:
    """Exact links of a pack: (node, links) rows, and (node, least node) rows of stars."""
    table, cell, same, low, signatures = _columns(table, "cell")
    fewest = least_agreement()
    nodes = table.column("node").to_pylist()
    sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
    sizes = np.array([len(s) for s in sets])
    links = np.zeros(len(cell), np.int64)
    a, b = [], []
    for start, end in zip(*_runs(cell)):
        if end - start < 2:
            continue
        left, right = _pairs_of_run(start, end, same, low)
        left, right = _pruned(left, right, signatures, fewest)
        if not len(left):
            continue
        common = _intersections(left - start, right - start, sets[start:end])
        # Jaccard >= 4/5 in whole numbers: 5 * common >= 4 * union.
        union = sizes[left] + sizes[right] - common
        linked = 5 * common >= 4 * union
        left, right = left[linked], right[linked]
        links += np.bincount(left, minlength=len(cell)) + np.bincount(
            right, minlength=len(cell))
        for one, two in _stars(left, right, len(cell)):
            a.append(nodes[one])
            b.append(nodes[two])
    some = np.flatnonzero(links)
    return pa.table({
        "a": pa.array([nodes[i] for i in some] + a, pa.binary()),
        "b": pa.array([None] * len(some) + b, pa.binary()),
        "links": pa.array(links[some].tolist() + [0] * len(a), pa.int64())})


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, end in row_chunks(batch.column("text")):
            rows = batch.slice(start, end - start)
            sets = shingles(hashed_words(rows.column("text"), WHITE_SPACE), SHINGLE)
            yield pa.record_batch({
                "node": pa.array(_digests(rows.column("text")), pa.binary()),
                "shingles": pa.array([
                    np.unique(sets.words[sets.first[i]:sets.first[i + 1]]).tobytes()
                    for i in range(len(rows))], pa.binary())})


def _candidate_edges(nodes: DataFrame, staging: Staging) -> DataFrame:
    keyed = nodes.where("n_shingles > 0").select("node", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    members = staging.table(keyed.join(shared, "key"), "members")
    members = members.withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("long"))
    cells = _spread(members, "key")
    rows = members.agg(F.sum("blocks")).first()[0] or 0
    signed = cells.join(nodes.select("node", "signature"), "node").select(
        "cell", "low", "same", "node", "signature")
    return staging.table(_packed(signed, rows).groupBy("pack").applyInArrow(
        _candidates, "a binary, b binary"), "candidates")


def _sets_of(docs: DataFrame, wanted: DataFrame, staging: Staging) -> DataFrame:
    """Shingle sets of the nodes in ``wanted`` (columns node, doc_id of one such document).

    A filter of fixed size, however many nodes there are, leaves most other texts out before
    they move; the join decides.
    """
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BUCKETS))
    slots = wanted.select(slot.alias("slot")).distinct()
    some = docs.select("doc_id", "text").withColumn("slot", slot).join(
        F.broadcast(slots), "slot", "left_semi").select("text")
    sets = some.mapInArrow(_shingle_sets, "node binary, shingles binary")
    return sets.dropDuplicates(["node"])


def near_duplicates(docs: DataFrame, staging: Staging) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, copy_id, n_copies, n_links, and the node
    of the text and of its class, which name them where ids are null.

    ``copy_id`` is the least id with an equal text, ``class_id`` the least id of the class that
    links reach, ``n_links`` the number of other texts at or above the threshold.
    """
    signed = staging.table(
        docs.select("doc_id", "text").mapInArrow(_sign, SIGNED), "signed")
    nodes = signed.groupBy("node").agg(
        F.min("doc_id").alias("copy_id"), F.count("*").alias("n_copies"),
        F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys"),
        F.first("signature").alias("signature"))
    nodes = staging.table(nodes, "nodes")

    clusters = components(_candidate_edges(nodes, staging), staging)
    clustered = staging.table(clusters.join(
        nodes.select("node", "copy_id", "signature", "n_shingles"), "node"), "clustered")
    # Sizes by root first, so that a large cluster is one row on the side that is joined.
    bytes_ = F.col("n_shingles") * 8
    sizes = clustered.groupBy("root").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK), F.ceil(F.sum(bytes_) / BLOCK_BYTES)).cast("long").alias(
        "blocks"))
    sized = clustered.join(sizes, "root")
    sets = _sets_of(docs, clustered.select("node", F.col("copy_id").alias("doc_id")), staging)
    rows, size = sized.agg(F.sum("blocks"), F.sum(bytes_ * F.col("blocks"))).first()
    cells = _spread(sized.join(sets, "node"), "root").select(
        "cell", "low", "same", "node", "signature", "shingles")
    found = staging.table(_packed(cells, rows or 0, size or 0).groupBy("pack").applyInArrow(
        _verified, "a binary, b binary, links long"), "verified")

    links = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(
        F.sum("links").alias("n_links"))
    classes = components(found.where("b IS NOT NULL").select("a", "b"), staging)
    named = classes.join(nodes.select("node", "copy_id"), "node")
    least = named.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    resolved = nodes.select("node", "copy_id", "n_copies").join(
        classes.join(least, "root"), "node", "left").join(
        links, "node", "left").select(
        "node", F.coalesce("root", "node").alias("class_node"),
        F.coalesce("class_id", "copy_id").alias("class_id"), "copy_id", "n_copies",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return signed.select("doc_id", "node").join(resolved, "node")


def keep_one(docs: DataFrame, staging: Staging) -> DataFrame:
    """``docs`` with one row of each class, the one with the least id (nulls come first)."""
    rows = near_duplicates(docs, staging).groupBy("class_node", "doc_id", "node").agg(
        F.count("*").alias("rows"))
    name = free_name(docs, "_kept")
    id_, node, number = f"{name}_id", f"{name}_node", f"{name}_rows"
    kept = staging.table(rows.groupBy("class_node").agg(
        F.min(F.struct("doc_id", "node", "rows")).alias("k")).select(
        F.col("k.doc_id").alias(id_), F.col("k.node").alias(node),
        F.col("k.rows").alias(number)), "kept")
    digest = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit(""))))
    same = F.col(id_).eqNullSafe(F.col("doc_id")) & (F.col(node) == digest)
    once = docs.join(kept.where(F.col(number) == 1), same, "left_semi")
    repeated = kept.where(F.col(number) > 1)
    if not repeated.limit(1).count():
        return once
    # Rows with one id and text: one of each stays.
    again = docs.join(repeated, same).dropDuplicates([id_, node])
    return once.union(again.select(*own_columns(docs)))
