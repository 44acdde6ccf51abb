"""Left equi-join that swaps a natural key for a surrogate key, safe under skew."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

# A dimension is broadcast if its two key columns measure at most this many bytes.
BROADCAST_BYTES = 64 << 20
# A value is hot if it holds more than one in HOT_SHARE rows: at most HOT_SHARE values can.
HOT_SHARE = 10_000
# A longer value is not broadcast, so that all hot values together have a bound in bytes.
HOT_BYTES = 4096
# Rows that need no shuffle lookup go to this many join values that match nothing.
SPREAD = 1 << 16


# Added per row to the bytes of its text: the surrogate key and the hash table's share.
ROW_BYTES = 64


def broadcast_size(count: int, text_bytes: int) -> int:
    return count * ROW_BYTES + text_bytes


def measured_sizes(dims: dict[str, tuple[DataFrame, str]]) -> dict[str, int]:
    """The broadcast sizes of dimensions and their natural keys, by name, from one job."""
    sizes = reduce(DataFrame.unionByName, [
        dim.agg(F.lit(name).alias("name"), F.count("*").alias("rows"),
                F.coalesce(F.sum(F.octet_length(natural)), F.lit(0)).alias("bytes"))
        for name, (dim, natural) in dims.items()])
    return {row.name: broadcast_size(row.rows, row.bytes) for row in sizes.collect()}


def measured_size(dim: DataFrame, natural: str) -> int:
    """The size of a dimension's two key columns in a broadcast."""
    return measured_sizes({natural: (dim, natural)})[natural]


def lookup(fact: DataFrame, dim: DataFrame, natural: str, key: str,
           size: int | None = None, keys_of: DataFrame | None = None,
           broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``fact`` with the column ``key`` of ``dim``; null where the natural key has no match.

    A null natural key never matches. ``dim`` has one row per natural key. A dimension
    of known small size is broadcast (measured here unless ``size`` tells it); a larger
    one is joined by shuffle with hot values kept out of it. ``keys_of`` is a cheaper
    frame with the same distribution of ``natural`` than ``fact`` (the stored table
    ``fact`` derives from).
    """
    pairs = dim.select(F.col(natural).alias("_natural"), F.col(key))
    size = measured_size(dim, natural) if size is None else size
    if size <= broadcast_bytes:
        return fact.join(F.broadcast(pairs), F.col(natural) == F.col("_natural"),
                         "left").drop("_natural")
    return spread_lookup(fact, pairs, natural, key, fact if keys_of is None else keys_of)


def hot_values(df: DataFrame, column: str, share: int = HOT_SHARE) -> DataFrame:
    """Values of ``column`` on more than one in ``share`` rows; never more than ``share``, of at
    most ``HOT_BYTES`` bytes each."""
    total = df.agg(F.count("*")).scalar()
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column).agg(F.count("*").alias("_rows"))
        .filter(F.col("_rows") * share > total)
        .filter(F.octet_length(column) <= HOT_BYTES)
        .select(column)
    )


def spread_lookup(fact: DataFrame, pairs: DataFrame, natural: str, key: str,
                  keys_of: DataFrame, share: int = HOT_SHARE) -> DataFrame:
    """The shuffle way of ``lookup``, exact for every row.

    Hot values find their key in a broadcast of at most ``share`` rows. They and the
    nulls then enter the shuffle join under a value derived from the row itself, which
    spreads them over all tasks and matches nothing; all other rows join on the natural
    key, of which none holds more than one in ``share`` rows.
    """
    hot = F.broadcast(
        pairs.join(
            F.broadcast(hot_values(keys_of, natural, share)
                        .select(F.col(natural).alias("_hot"))),
            F.col("_natural") == F.col("_hot"))
        .groupBy("_hot").agg(F.min(key).alias("_hot_key")))
    row = F.pmod(F.xxhash64(*[F.col(c) for c in fact.columns]), F.lit(SPREAD))
    cold = F.col(natural).isNotNull() & F.col("_hot").isNull()
    joined = (
        fact.join(hot, F.col(natural) == F.col("_hot"), "left")
        .withColumn("_on", F.when(cold, F.concat(F.lit("="), F.col(natural)))
                    .otherwise(F.concat(F.lit("#"), row.cast("string"))))
    )
    targets = pairs.groupBy(F.concat(F.lit("="), F.col("_natural")).alias("_target")).agg(
        F.min(key).alias(key))
    return joined.join(targets, F.col("_on") == F.col("_target"), "left").select(
        *fact.columns, F.coalesce(F.col("_hot_key"), F.col(key)).alias(key))
