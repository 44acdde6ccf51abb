"""Writing the star to Parquet folders; ``versions`` makes them part of the warehouse."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, functions as F

from viewstar.operators.buckets import BUCKET, COUNT, in_buckets
from viewstar.operators.quality import align, enforce
from viewstar.operators.sketches import device_sketches
from viewstar.schemas import TABLES
from viewstar.sources.warehouse import SKETCHES
from viewstar.streaming.outcomes import observed


#: The combined views of each date, kept beside the fact so that a batch can be merged with them.
GRAIN = "view_grain"


def _write(checked: DataFrame, name: str, strict: bool, path: str,
           partition_by: tuple[str, ...],
           placed: Callable[[DataFrame], DataFrame] = lambda rows: rows,
           gathered: bool = False) -> tuple[int, int]:
    """Write the rows without violations; returns ``(written, rejected)`` row counts.

    The counts come with the write, not from another job. Rows that are ``gathered``, as those of
    a folder lie together already, are written where they are.
    """
    table = TABLES[name]
    seen = Observation(f"write {name}")
    broken = F.size("violations") > 0
    counted = checked.observe(seen, F.count_if(~broken).alias("written"),
                              F.count_if(broken).alias("rejected"))
    kept = enforce(counted, table) if strict else counted.filter(~broken)
    rows = _by_folder(placed(align(kept, table)), gathered, *partition_by)
    rows.write.partitionBy(*partition_by).parquet(path)
    # Where no row is left to write, the plan that was run may hold no observation any more.
    counts = observed(seen) or checked.agg(
        F.count_if(~broken).alias("written"), F.count_if(broken).alias("rejected")).first()
    return counts["written"], counts["rejected"]


def _by_folder(rows: DataFrame, gathered: bool, *partition_by: str) -> DataFrame:
    """Few files per folder: rows meet by folder, unless they lie so, and a hot folder's rows are
    split into partitions of the advised size."""
    return rows if gathered else rows.hint("rebalance", *partition_by)


def write_dimension(checked: DataFrame, warehouse: str, name: str, run: str,
                    strict: bool, buckets: int = 1) -> tuple[int, int]:
    """Write a run's new members to the run's folder, one folder per bucket in it."""
    natural = TABLES[name].unique[0]
    return _write(checked, name, strict, run_path(warehouse, name, run), (COUNT, BUCKET),
                  lambda rows: in_buckets(rows, natural, buckets))


def write_fact(checked: DataFrame, warehouse: str, run: str, strict: bool,
               gathered: bool = False) -> tuple[int, int]:
    """Write a run's dates to the run's folder, one folder per date in it."""
    return _write(checked, "fact_product_views", strict,
                  run_path(warehouse, "fact_product_views", run), ("date_key",),
                  gathered=gathered)


def write_sketches(fact: DataFrame, warehouse: str, run: str) -> None:
    """Write the sketches of some dates of a fact, in the layout of the fact."""
    (device_sketches(fact).hint("rebalance", "date_key").write.partitionBy("date_key")
     .parquet(run_path(warehouse, SKETCHES, run)))


def write_grain(grain: DataFrame, warehouse: str, run: str, gathered: bool = False) -> None:
    """Write the combined views a fact was made of, in the layout of the fact."""
    (_by_folder(grain, gathered, "date_key").write.partitionBy("date_key")
     .parquet(run_path(warehouse, GRAIN, run)))


def run_path(warehouse: str, name: str, run: str) -> str:
    return f"{warehouse.rstrip('/')}/{name}/run={run}"


def write_rejected(checked: DataFrame, warehouse: str, name: str, batch_id: str) -> None:
    """Keep the rows that break a constraint, per run; a repeated run replaces its own."""
    (checked.filter(F.size("violations") > 0).withColumn("batch", F.lit(batch_id))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch").parquet(f"{warehouse.rstrip('/')}/quarantine/{name}"))
