"""The distinct members of every dimension, found in one pass over the events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from viewstar.schemas import NATURAL_KEYS


def distinct_members(df: DataFrame, natural: str) -> DataFrame:
    """Distinct non-null values of one natural key; empty text is a member."""
    return df.select(natural).filter(F.col(natural).isNotNull()).distinct()


def all_members(df: DataFrame, naturals: Sequence[str] = tuple(NATURAL_KEYS)) -> DataFrame:
    """``(kind, member)`` for several natural keys: one scan, one shuffle.

    Each row becomes one pair per key, and the map side of ``distinct`` removes repeats
    before anything moves, so a value held by a third of the rows costs one row per task.
    """
    pairs = F.array(*[
        F.struct(F.lit(name).alias("kind"), F.col(name).cast("string").alias("member"))
        for name in naturals
    ])
    return (
        df.select(F.explode(pairs).alias("pair"))
        .select("pair.kind", "pair.member")
        .filter(F.col("member").isNotNull())
        .distinct()
    )
