"""Column names that cannot clash with those of an input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` begins with it."""
    taken = [c.lower() for c in df.columns]
    while any(c.startswith(name.lower()) for c in taken):
        name += "_"
    return name


def own_columns(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever characters their names hold."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]
