"""Mix sources to target weights along a curriculum, with DataFrame functions only.

1. Sizes in words are summed per source; targets share the total by weight, stop at
   ``max_repeat`` times their source, and what is above is shared again (``source_targets``).
2. The documents of a source stand in the order of a hash of their id. Whole passes over the
   source and the first part of one more meet the target to the word (``mixed``).
3. Each source has a schedule of its weight over training time. The integral of the schedule
   is the share of the target that is used by then; a document's place in its source is sent
   through the inverse of that integral, which gives its training position from 0 to 1.
4. ``training_order`` range-sorts by position; ``copies`` gives the whole documents to train on.

The running sums are exact for a source of any size: a source is cut into buckets by that hash,
buckets are summed first, and a window sees one bucket of about ``BUCKET_ROWS`` rows.

Defined cases: a null text has size 0; a null source is a source of its own, after all others; a
null id hashes as an empty one; rows that repeat are separate documents; an empty table gives an
empty result. Columns of the input are kept; the results come back in one struct column.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import pairwise

from pyspark.sql import Column, DataFrame, Window, functions as F

from viewstar.llm.names import free_name, own_columns
from viewstar.llm.quality_rules import words_of

MAX_REPEAT = 3
WEIGHTS = (1, 2, 3)
BUCKET_ROWS = 1 << 15
MIN_BUCKETS = 64

#: Knots (time, multiple of the weight), linear between them, per place in ``WEIGHTS``.
SCHEDULES = (
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
)


def word_count(text: Column) -> Column:
    return F.size(words_of(F.coalesce(text, F.lit("")))).cast("long")


def _source_key(source: Column) -> Column:
    """A key that is never null, so that plain joins and windows keep null sources."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS,
                   max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Per source (columns source, source_size): its place in ``weights`` and its target.

    A source is at its limit if the limit per weight is below what the rest would get per
    weight. In the order of that ratio the sources at their limit come first, so one pass of
    running sums finds them. The windows see one row per source, as weights are stated per
    source.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    table = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn(
        "place", (F.row_number().over(by_name) - 1) % F.lit(len(weights))
    ).withColumn("weight", F.get(table, F.col("place"))
    ).withColumn("limit", F.lit(float(max_repeat)) * F.col("source_size"))

    by_ratio = everything.orderBy(
        (F.col("limit") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    from_here = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(
        F.sum("limit").over(earlier), F.lit(0.0))
    rates = ranked.withColumn("rate", left / F.sum("weight").over(from_here)).withColumn(
        "at_limit", F.col("limit") / F.col("weight") < F.col("rate"))
    rate = F.min(F.when(~F.col("at_limit"), F.struct("limit_per", "rate"))).over(everything)["rate"]
    return (
        rates.withColumn("limit_per", F.col("limit") / F.col("weight"))
        .withColumn("target", F.when(F.col("at_limit"), F.col("limit"))
                    .otherwise(F.col("weight") * rate))
        .select("source", "source_size", "place", "target"))


def position_of(share: Column, place: Column, schedules=SCHEDULES) -> Column:
    """The time at which a schedule has used up ``share`` of its integral."""
    result = None
    for index, knots in enumerate(schedules):
        pieces = [(t0, m0, t1, m1, (m0 + m1) / 2 * (t1 - t0))
                  for (t0, m0), (t1, m1) in pairwise(knots)]
        used = share * F.lit(sum(piece[4] for piece in pieces))
        before, time = 0.0, F.lit(float(knots[-1][0]))
        steps = []
        for t0, m0, t1, m1, area in pieces:
            rest = used - F.lit(before)
            slope = (m1 - m0) / (t1 - t0)
            root = F.sqrt(F.lit(m0 * m0) + F.lit(2 * slope) * rest)
            steps.append((before + area, F.lit(t0) + F.lit(2.0) * rest / (F.lit(m0) + root)))
            before += area
        for upper, inside in reversed(steps):
            time = F.when(used < F.lit(upper), inside).otherwise(time)
        result = (F.when(place == index, time) if result is None
                  else result.when(place == index, time))
    return result


def mixed(docs: DataFrame, name: str, weights: Sequence[float] = WEIGHTS,
          schedules=SCHEDULES, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``docs`` with a struct: size, source_size, target, taken, passes, offset, position.

    ``taken`` counts the words the mix takes of the document, ``position`` is the time of the
    first of them (null if none is taken). The words taken of a source add up to its target,
    rounded to whole words.
    """
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sized = docs.select(*own_columns(docs), F.struct(
        word_count(F.col("text")).alias("size"), _source_key(F.col("source")).alias("key"),
        order.alias("order")).alias(name))
    rows = sized.count()
    buckets = max(MIN_BUCKETS, rows // BUCKET_ROWS)
    high = F.conv(F.substring(F.col(f"{name}.order"), 1, 8), 16, 10).cast("long")
    sized = sized.withColumn(f"{name}_bucket", F.shiftright(high * F.lit(buckets), 32)
                             ).withColumn(f"{name}_key", F.col(f"{name}.key"))

    # One row per source and bucket, then per source: partial sums before any shuffle.
    sums = sized.groupBy(f"{name}_key", f"{name}_bucket").agg(
        F.sum(f"{name}.size").alias("words"), F.first("source").alias("source"))
    per_source = sums.groupBy(f"{name}_key").agg(
        F.sum("words").alias("source_size"), F.first("source").alias("source"))
    targets = source_targets(per_source, weights, max_repeat).select(
        _source_key(F.col("source")).alias(f"{name}_key"), "source_size", "place", "target")
    before = Window.partitionBy(f"{name}_key").orderBy(f"{name}_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    bases = sums.withColumn("base", F.coalesce(F.sum("words").over(before), F.lit(0))).join(
        targets, f"{name}_key").select(f"{name}_key", f"{name}_bucket", F.struct(
            "base", "source_size", "place", "target").alias(f"{name}_base"))

    within = Window.partitionBy(f"{name}_key", f"{name}_bucket").orderBy(
        f"{name}.order", f"{name}.size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn(
        f"{name}_before", F.coalesce(F.sum(f"{name}.size").over(within), F.lit(0))
    ).join(bases, [f"{name}_key", f"{name}_bucket"])

    base, size = F.col(f"{name}_base"), F.col(f"{name}.size")
    total = base["source_size"]
    demand = F.floor(base["target"] + F.lit(0.5))
    passes = F.when(total > 0, F.floor(demand / total)).otherwise(F.lit(0))
    # Whole numbers well below 2**53, so the division above rounds down right.
    rest = demand - passes * total
    offset = base["base"] + F.col(f"{name}_before")
    part = F.greatest(F.lit(0), F.least(rest - offset, size))
    taken = passes * size + part
    share = offset.cast("double") / demand.cast("double")
    return placed.select(*own_columns(docs), F.struct(
        size.alias("size"), total.alias("source_size"), base["target"].alias("target"),
        taken.cast("long").alias("taken"), passes.cast("long").alias("passes"),
        part.cast("long").alias("part"), offset.alias("offset"), demand.alias("demand"),
        base["place"].alias("place"),
        F.when(taken > 0, position_of(share, base["place"], schedules)).alias("position"),
    ).alias(name))


def training_order(mix: DataFrame, name: str) -> DataFrame:
    """Rows range-partitioned and sorted by training position, those not taken last."""
    return mix.orderBy(F.col(f"{name}.position").asc_nulls_last(), "doc_id")


def copies(docs: DataFrame, schedules=SCHEDULES, **options) -> DataFrame:
    """The whole documents to train on, in training order, with the columns of ``docs``.

    A document is there once per pass, and once more if at least half of its words belong to
    the started pass. At most ``max_repeat`` copies, so the rows stay in proportion.
    """
    name = free_name(docs, "_mix")
    mix = mixed(docs, name, schedules=schedules, **options)
    got = {c: F.col(f"{name}.{c}") for c in
           ("passes", "part", "size", "offset", "source_size", "demand", "place")}
    whole = got["passes"] + F.when(
        (got["part"] > 0) & (2 * got["part"] >= got["size"]), 1).otherwise(0)
    times = F.when(whole > 0, F.sequence(F.lit(0).cast("long"), whole - 1))
    repeated = mix.withColumn(f"{name}_pass", F.explode(times))
    offset = got["offset"] + F.col(f"{name}_pass") * got["source_size"]
    share = offset.cast("double") / got["demand"].cast("double")
    at = position_of(share, got["place"], schedules)
    return repeated.withColumn(f"{name}_at", at).orderBy(f"{name}_at", "doc_id").select(
        *own_columns(docs))
