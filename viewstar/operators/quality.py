"""The warehouse constraints as jobs: each returns what violates it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from viewstar.schemas import Table
from viewstar.staging import Staging


class ConstraintViolation(ValueError):
    """Raised in strict mode where a constraint does not hold."""


def strict(violations: DataFrame, constraint: str) -> None:
    """Fail the run if there is any violating row."""
    example = violations.take(1)
    if example:
        raise ConstraintViolation(f"{constraint}: {example[0]}")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values on more than one row. A key with a null part is never a duplicate."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(
        F.count("*").alias("rows")).filter(F.col("rows") > 1)


def null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a null in a column that must not hold one."""
    return df.filter(reduce(Column.__or__, [F.col(name).isNull() for name in columns]))


def orphan_rows(fact: DataFrame, dim: DataFrame, key: str, staging: Staging) -> DataFrame:
    """Rows whose non-null key is missing from ``dim``.

    The distinct keys are compared first: the map side removes repeats, so a hot key moves
    once per task. The keys found missing are stored, so Catalyst knows how few they are
    and the fact is filtered where it lies, without a shuffle.
    """
    missing = (
        fact.select(key).filter(F.col(key).isNotNull()).distinct()
        .join(dim.select(key), key, "left_anti")
    )
    return fact.join(staging.table(missing, f"missing-{key}"), key, "left_semi")


def too_long(column: str, length: int) -> Column:
    return F.coalesce(F.char_length(F.col(column)) > length, F.lit(False))


def long_rows(df: DataFrame, column: str, length: int) -> DataFrame:
    """Rows whose text is longer than the warehouse column."""
    return df.filter(too_long(column, length))


def does_not_fit(column: str, data_type: str) -> Column:
    """True where a value has no counterpart in ``data_type``."""
    return F.col(column).isNotNull() & F.col(column).try_cast(data_type).isNull()


def narrowing_rows(df: DataFrame, column: str, data_type: str) -> DataFrame:
    """Rows whose value does not fit the narrower type."""
    return df.filter(does_not_fit(column, data_type))


def guard_length(df: DataFrame, column: str, length: int) -> tuple[DataFrame, DataFrame]:
    """``(kept, quarantined)`` by the length of a text; null is kept."""
    flag = too_long(column, length)
    return df.filter(~flag), df.filter(flag)


def violations(df: DataFrame, table: Table) -> Column:
    """Names of the row-wise constraints of ``table`` a row breaks, all in one pass."""
    types = dict(df.dtypes)
    found = []
    for column in table.columns:
        if column.name not in types:
            continue
        if column.required:
            found.append(F.when(F.col(column.name).isNull(),
                                F.lit(f"{column.name}: null")))
        if column.length is not None:
            found.append(F.when(too_long(column.name, column.length),
                                F.lit(f"{column.name}: too long")))
        if types[column.name] != column.type:
            found.append(F.when(does_not_fit(column.name, column.type),
                                F.lit(f"{column.name}: does not fit")))
    return F.array_compact(F.array(*found))


def split_by_constraints(df: DataFrame, table: Table) -> tuple[DataFrame, DataFrame]:
    """``(kept, rejected)`` by the row-wise constraints; rejected rows name what they break."""
    checked = df.withColumn("violations", violations(df, table))
    broken = F.size("violations") > 0
    return checked.filter(~broken).drop("violations"), checked.filter(broken)


def enforce(checked: DataFrame, table: Table) -> DataFrame:
    """Rows of a frame with ``violations``; the job that reads them fails on the first one.

    The check runs in the pass that writes the rows, and a failed write commits nothing.
    """
    message = F.concat(F.lit(f"{table.name}: "), F.concat_ws("; ", "violations"))
    holds = F.when(F.size("violations") == 0, F.lit(True)).otherwise(
        F.raise_error(message).cast("boolean"))
    return checked.filter(holds).drop("violations")


def align(df: DataFrame, table: Table) -> DataFrame:
    """The frame with the table's columns in the table's order and types.

    A column the frame lacks gets its default, or a null of its type.
    """
    present = set(df.columns)

    def aligned(column):
        if column.name in present:
            value = F.col(column.name)
        elif column.default is not None:
            value = F.expr(column.default)
        else:
            value = F.lit(None)
        return value.cast(column.type).alias(column.name)

    return df.select([aligned(column) for column in table.columns])


def verify_star(tables: dict[str, DataFrame], schemas: dict[str, Table],
                staging: Staging) -> None:
    """Check every key and reference of a star; raise on the first that does not hold."""
    for name, df in tables.items():
        schema = schemas[name]
        strict(duplicate_keys(df, [schema.primary_key]), f"{name} primary key")
        strict(duplicate_keys(df, schema.unique), f"{name} unique")
        for key, target in schema.references:
            strict(orphan_rows(df, tables[target], key, staging), f"{name}.{key} reference")
