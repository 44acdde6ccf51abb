"""Balanced label propagation: linked documents move to one shard, and shards stay even.

Every document starts in the shard of a hash of its id. In a round each active document counts
its neighbours per shard and asks to move where it has more than at home. A pair of shards may
swap as many documents as want to go both ways, and a shard with room below its capacity takes
more (only linked documents take room, as the others fill up what is left); requests are admitted by gain, through a histogram of at most shards² x ``SLOTS`` rows, so
no request list is sorted or collected. Active are, in turn, documents with a neighbour of
lower id and those without one; neighbours of a star therefore never swap places for ever.

At the end documents without links are dealt by a hash in proportion to the room that is left,
all are numbered in the order shard, place among linked ones, id, and shard s takes the numbers
of its equal share. Shards differ by one row at most. Documents without links stand at both
ends of a shard's stretch, so the exact cut falls on them.

Defined cases: rows of one id move together; rows with a null id have no links; links of a
document with itself or repeated links count once; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from viewstar.llm.names import free_name, own_columns
from viewstar.operators.numbering import number_rows
from viewstar.staging import Staging

SHARDS = 8
ROUNDS = 6
#: Rows that a shard may hold above its equal share while documents move.
SLACK = 0.02
#: Links that a document of a large group has to those below it, at most.
FAN_OUT = 4096
CHUNK = 1024
GAINS, CHANCES = 16, 64
SLOTS = GAINS * CHANCES


def equal_text_links(docs: DataFrame, shards: int, staging: Staging) -> DataFrame:
    """Links (a, b) of documents with equal texts: a tree per group, the least id on top.

    The members of a group are numbered in the order of their ids, and number k hangs on number
    (k - 1) div f. So a group of up to f + 1 documents is a star, and no document of a larger
    one has more than f + 1 links, however large the group: f is ``FAN_OUT``, or an eighth of a
    shard if that is less. Numbers come from a range partitioning, which cuts a large group into
    many tasks, and links are found by text and number. A null text is an empty text.
    """
    rows = staging.table(docs.where("doc_id IS NOT NULL").select("doc_id", F.md5(
        F.coalesce(F.col("text"), F.lit(""))).alias("same")).distinct(), "texts")
    fan_out = max(1, min(FAN_OUT, rows.count() // (8 * shards)))
    numbered = staging.table(_places(rows, staging), "members")
    children = numbered.where("place > 0").select(
        F.col("doc_id").alias("a"), "same", F.expr(f"(place - 1) div {fan_out}").alias("place"))
    parents = numbered.select(F.col("doc_id").alias("b"), "same", "place")
    return children.join(parents, ["same", "place"]).select("a", "b")


def _places(rows: DataFrame, staging: Staging) -> DataFrame:
    """(doc_id, same, place) of the groups of two or more, place 0, 1, 2 … in the order of ids.

    All rows are numbered as one, and a group's first number is taken off. That number reaches
    the rows by way of chunks of ``CHUNK`` numbers, so no key of a join is on more rows than a
    chunk holds, or, between chunks and groups, than a group has chunks.
    """
    numbered = staging.table(number_rows(rows, ["same", "doc_id"], "number", staging).withColumn(
        "chunk", F.expr(f"number div {CHUNK}")), "numbered")
    chunks = numbered.groupBy("same", "chunk").agg(
        F.min("number").alias("first"), F.count("*").alias("n"))
    groups = chunks.groupBy("same").agg(
        F.min("first").alias("start"), F.sum("n").alias("n")).where("n > 1").drop("n")
    starts = chunks.join(groups, "same").select("same", "chunk", "start")
    return numbered.join(starts, ["same", "chunk"]).select(
        "doc_id", "same", (F.col("number") - F.col("start")).alias("place"))


def first_shard(doc_id: str, shards: int) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(shards)).cast("int")


def _requests(both: DataFrame, labels: DataFrame, lower: bool) -> DataFrame:
    """(node, home, target, gain, weight) of the active nodes that gain by a move."""
    here = labels.where(F.col("has_lower") == lower).select(
        F.col("node").alias("a"), F.col("shard").alias("home"), "weight")
    there = labels.select(F.col("node").alias("b"), F.col("shard").alias("theirs"))
    votes = both.join(here, "a").join(there, "b").groupBy("a", "home", "weight", "theirs").agg(
        F.count("*").alias("n"))
    best = votes.groupBy(F.col("a").alias("node"), "home", "weight").agg(
        F.max(F.struct("n", (-F.col("theirs")).alias("minus"))).alias("best"),
        F.max(F.when(F.col("theirs") == F.col("home"), F.col("n")).otherwise(0)).alias("own"))
    return best.where(F.col("best.n") > F.col("own")).select(
        "node", "home", "weight", (-F.col("best.minus")).alias("target"),
        (F.col("best.n") - F.col("own")).alias("gain"))


def _admitted(asked: DataFrame, sizes: dict[int, int], capacity: int) -> DataFrame:
    """(home, target, slot) that may move; at most shards² x SLOTS rows."""
    table = asked.groupBy("home", "target", "slot").agg(F.sum("weight").alias("w"))
    pairs = table.groupBy("home", "target").agg(F.sum("w").alias("out"))
    back = pairs.select(F.col("home").alias("target"), F.col("target").alias("home"),
                        F.col("out").alias("back"))
    room = F.create_map(*[F.lit(x) for s, n in sizes.items() for x in (s, max(0, capacity - n))])
    both = pairs.join(back, ["home", "target"], "left").withColumn(
        "swap", F.least("out", F.coalesce("back", F.lit(0)))
    ).withColumn("over", F.col("out") - F.col("swap"))
    into = Window.partitionBy("target")
    quota = both.withColumn("quota", F.col("swap") + F.floor(
        room[F.col("target")] * F.col("over") / F.greatest(F.sum("over").over(into), F.lit(1))))
    running = Window.partitionBy("home", "target").orderBy("slot")
    return table.join(quota.select("home", "target", "quota"), ["home", "target"]).withColumn(
        "sum", F.sum("w").over(running)).where("sum <= quota").select("home", "target", "slot")


def propagated(docs: DataFrame, links: DataFrame, shards: int, staging: Staging,
               rounds: int = ROUNDS, slack: float = SLACK) -> DataFrame:
    """(node, shard, near, weight) for every linked document after the rounds."""
    both = staging.table(links.union(links.select("b", "a")).where("a <> b").distinct(), "links")
    counts = docs.groupBy(F.col("doc_id").alias("node")).agg(F.count("*").alias("weight"))
    nodes = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    labels = staging.table(nodes.join(counts, "node").select(
        "node", "weight", F.least("node", "least").alias("near"),
        (F.col("least") < F.col("node")).alias("has_lower"),
        first_shard("node", shards).alias("shard")), "labels")

    capacity = int(-(-docs.count() // shards) * (1 + slack))
    still = 0
    for number in range(rounds):
        asked = staging.table(_requests(both, labels, lower=number % 2 == 0).withColumn(
            "slot", (F.lit(GAINS) - F.least("gain", F.lit(GAINS))) * CHANCES + F.pmod(
                F.xxhash64("node", F.lit(number)), F.lit(CHANCES))), "asked")
        moves = asked.join(F.broadcast(_admitted(asked, held_by(labels, shards), capacity)),
                           ["home", "target", "slot"]).select("node", "target")
        moves = staging.table(moves, "moves")
        still = 0 if moves.limit(1).count() else still + 1
        if still == 2:
            break
        labels = staging.table(labels.join(moves, "node", "left").withColumn(
            "shard", F.coalesce("target", "shard").cast("int")).drop("target"), "labels")
    return labels.select("node", "shard", "near", "weight")


def held_by(labels: DataFrame, shards: int) -> dict[int, int]:
    """Linked rows per shard: one number each."""
    held = {row[0]: row[1] for row in labels.groupBy("shard").agg(F.sum("weight")).collect()}
    return {s: held.get(s, 0) for s in range(shards)}


def _dealt(doc_id: str, held: dict[int, int], total: int) -> Column:
    """A shard for a document without links: by hash, in proportion to the room that is left."""
    room = {s: max(0.0, total / len(held) - n) for s, n in held.items()}
    chance = F.pmod(F.xxhash64(doc_id, F.lit(2)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    every, below, shard = sum(room.values()) or 1.0, 0.0, F.lit(len(held) - 1)
    steps = []
    for s, free in room.items():
        below += free / every
        steps.append((s, below))
    for s, limit in reversed(steps):
        shard = F.when(chance < F.lit(limit), F.lit(s)).otherwise(shard)
    return shard


def cut_links(links: DataFrame, placed: DataFrame) -> int:
    """Links whose ends are in different shards; ``placed`` has doc_id and shard."""
    one = placed.select(F.col("doc_id").alias("a"), F.col("shard").alias("one"))
    two = placed.select(F.col("doc_id").alias("b"), F.col("shard").alias("two"))
    return links.join(one, "a").join(two, "b").where("one <> two").count()


def sharded(docs: DataFrame, links: DataFrame, staging: Staging, shards: int = SHARDS,
            rounds: int = ROUNDS) -> DataFrame:
    """``docs`` with shard (0 ... shards - 1) and slot (gapless from 0 in each shard).

    Columns of those names in the input are replaced.
    """
    docs = docs.drop("shard", "slot")
    name = free_name(docs, "_shard")
    node, label, side, near, number = (f"{name}_{c}" for c in (
        "node", "label", "side", "near", "number"))
    found = propagated(docs, links, shards, staging, rounds)
    total = docs.count()
    dealt = _dealt("doc_id", held_by(found, shards), total)
    labels = found.select(
        F.col("node").alias(node), F.col("shard").alias(label), F.col("near").alias(near))
    end = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)) * 2 - 1
    rows = docs.join(labels, F.col("doc_id") == F.col(node), "left").select(
        *own_columns(docs), F.coalesce(label, dealt).alias(label),
        F.when(F.col(near).isNull(), end).otherwise(0).alias(side),
        F.coalesce(near, "doc_id").alias(near))
    numbered = number_rows(rows, [label, side, near, "doc_id"], number, staging)
    # Whole-number arithmetic: shard s holds the places from ceil(s * total / shards) on.
    place = F.col(number) - 1
    shard = F.expr(f"(`{number}` - 1) * {shards} div {max(total, 1)}")
    start = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return numbered.withColumn("shard", shard.cast("int")).withColumn(
        "slot", (place - start).cast("long")).select(*own_columns(docs), "shard", "slot")
