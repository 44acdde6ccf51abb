"""Dense row numbers without a single-task window, and the surrogate keys made of them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from viewstar.staging import Staging

# monotonically_increasing_id keeps the row's place within its partition in these bits.
_PLACE_BITS = (1 << 33) - 1


def number_rows(df: DataFrame, order_by: Sequence[str], name: str, staging: Staging,
                within: Sequence[str] = ()) -> DataFrame:
    """Number rows 1, 2, 3 … in the order of ``order_by``, restarting per ``within`` group.

    Equal to ``row_number() OVER (PARTITION BY within ORDER BY order_by)``, nulls first,
    for rows that are unique in ``within + order_by``, but a group of any size spreads
    over many tasks: rows are range-partitioned and sorted, each remembers its place in
    its partition, and what the partitions before it hold is added.

    Range bounds come from sampling, so the placed rows are written once and both the
    counts and the result read that. ``within`` should have few values (dates, kinds):
    the counts table has at most one row per range partition plus one per group.
    """
    placed = staging.table(_place(df, [*within, *order_by]), f"placed-{name}")
    offsets = staging.table(_offsets(placed, within), f"offsets-{name}")
    return _numbered(placed, offsets, name, within)


@dataclass(frozen=True)
class Group:
    """The numbered rows of one group, how many they are, and the bytes of their text."""

    rows: DataFrame
    count: int
    text_bytes: int


def number_groups(df: DataFrame, group: str, values: Sequence[str], text: str, name: str,
                  staging: Staging) -> dict[str, Group]:
    """``number_rows`` by ``text`` within each value of ``group``, one frame per value.

    All groups share one shuffle, one write and one counts table; each frame reads its
    own folder, and its size is known without another pass.
    """
    parts = staging.split(_place(df, [group, text]), f"placed-{name}", group, values)
    everything = reduce(DataFrame.unionByName, [
        part.withColumn(group, F.lit(value)) for value, part in parts.items()])
    offsets = _offsets(everything, [group], F.sum(F.octet_length(text)).alias("_bytes"))
    # At most one row per range partition and group.
    counts = offsets.collect()

    def numbered(value: str, part: DataFrame) -> Group:
        rows = [row for row in counts if row[0] == value]
        known = df.sparkSession.createDataFrame(rows, offsets.schema)
        return Group(_numbered(part, known, name, ()), sum(row["_n"] for row in rows),
                     sum(row["_bytes"] for row in rows))

    return {value: numbered(value, part) for value, part in parts.items()}


def _place(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return (
        df.repartitionByRange(*columns)
        .sortWithinPartitions(*columns)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE_BITS)))
    )


def _offsets(placed: DataFrame, within: Sequence[str], *measures: Column) -> DataFrame:
    """Rows held by the partitions before each one; the window sees these counts only."""
    before = (
        Window.partitionBy(*within, F.lit(0)).orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    counts = placed.groupBy(*within, "_part").agg(
        F.count("*").alias("_n"), F.min("_place").alias("_first"), *measures)
    return counts.withColumn(
        "_before", F.coalesce(F.sum("_n").over(before), F.lit(0))
    ).withColumnsRenamed({c: f"_w_{c}" for c in [*within, "_part"]})


def _numbered(placed: DataFrame, offsets: DataFrame, name: str,
              within: Sequence[str]) -> DataFrame:
    same = F.col("_part") == F.col("_w__part")
    for column in within:
        same = same & F.col(column).eqNullSafe(F.col(f"_w_{column}"))
    kept = [c for c in placed.columns if c not in ("_part", "_place")]
    # Without groups there is one row per range partition; with groups their number counts,
    # so Catalyst decides by the size of the stored table.
    counts = offsets if within else F.broadcast(offsets)
    return placed.join(counts, same).select(
        *kept, (F.col("_before") + F.col("_place") - F.col("_first") + 1).alias(name))


def dense_keys(members: DataFrame, natural: str, key: str, staging: Staging) -> DataFrame:
    """Distinct members with a key 1 … n in the order of the natural key."""
    return number_rows(members, [natural], key, staging)


def hash_key(natural) -> Column:
    """A key computed from the natural key alone: no shuffle, the same in every run."""
    natural = F.col(natural) if isinstance(natural, str) else natural
    return F.when(natural.isNotNull(), F.xxhash64(natural))


def hash_keys(members: DataFrame, natural: str, key: str) -> DataFrame:
    return members.withColumn(key, hash_key(natural))


def hash_collisions(members: DataFrame, key: str) -> DataFrame:
    """Hash keys that more than one member got; the run must fail if there are any."""
    return members.groupBy(key).agg(F.count("*").alias("members")).filter("members > 1")


def incremental_keys(stored: DataFrame, members: DataFrame, natural: str, key: str,
                     staging: Staging) -> DataFrame:
    """Members not stored yet, keyed from the highest stored key on; old keys never move."""
    new = members.join(stored.select(natural), natural, "left_anti")
    highest = F.coalesce(stored.agg(F.max(key)).scalar(), F.lit(0))
    return dense_keys(new, natural, "_number", staging).select(
        natural, (F.col("_number") + highest).alias(key))
