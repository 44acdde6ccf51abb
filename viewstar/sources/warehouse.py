"""The star's tables, as Parquet folders or in a database."""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, types as T

from viewstar.operators.buckets import FIELDS, only
from viewstar.operators.sketches import SCHEMA
from viewstar.schemas import TABLES
from viewstar.versions import MissingTable, Version, Versions

#: Sketches of the devices of each date and key.
SKETCHES = "device_sketches"


def read_table(spark: SparkSession, warehouse: str, name: str,
               version: Version | None = None) -> DataFrame:
    """One table of the warehouse's last version, or of a given one, with its contract schema.

    A warehouse without a version, or a version without the table, is an error: a star that is
    not there must not pass for an empty one.
    """
    versions = Versions(spark, warehouse)
    version = version or versions.current()
    return versions.read(name, TABLES[name].struct(), version.folders(name))


def read_members(spark: SparkSession, warehouse: str, name: str, version: Version,
                 numbers: Iterable[int]) -> DataFrame:
    """Members of a dimension that are in some buckets (``operators.buckets``)."""
    fields = T.StructType(TABLES[name].struct().fields + T.StructType.fromDDL(FIELDS).fields)
    stored = Versions(spark, warehouse).read(name, fields, version.folders(name))
    return only(stored, numbers).select(*TABLES[name].column_names)


def read_sketches(spark: SparkSession, warehouse: str, first: datetime.date, last: datetime.date,
                  version: Version | None = None) -> DataFrame:
    """The device sketches of some dates; a date of the fact that has none is an error, as a
    count without it would pass for the whole."""
    versions = Versions(spark, warehouse)
    version = version or versions.current()
    low, high = (day.year * 10000 + day.month * 100 + day.day for day in (first, last))
    kept, built = version.partitions(SKETCHES), version.partitions("fact_product_views")
    days = [day for day in built if low <= int(day) <= high]
    missing = [day for day in days if day not in kept]
    if missing:
        raise MissingTable(f"no device sketches of {', '.join(sorted(missing)[:5])}")
    return versions.read(SKETCHES, T.StructType.fromDDL(SCHEMA),
                         [folder for day in days for folder in kept[day]])


def read_star(spark: SparkSession, warehouse: str,
              version: Version | None = None) -> dict[str, DataFrame]:
    """All tables, of one and the same version."""
    version = version or Versions(spark, warehouse).current()
    return {name: read_table(spark, warehouse, name, version) for name in TABLES}


def jdbc_read_options(url: str, table: str, properties: Mapping[str, str],
                      partition_column: str | None = None, lower: int = 0, upper: int = 0,
                      partitions: int = 1) -> dict[str, str]:
    """Options of a database scan; with a column and its range, many tasks share the scan."""
    options = {"url": url, "dbtable": table, **properties}
    if partition_column is not None:
        options.update(partitionColumn=partition_column, lowerBound=str(lower),
                       upperBound=str(upper), numPartitions=str(partitions))
    return options


def read_jdbc_table(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_read_options(**options)).load()


def read_jdbc_star(spark: SparkSession, url: str, properties: Mapping[str, str],
                   schema: str) -> dict[str, DataFrame]:
    """All tables from a database that ``sinks.jdbc`` wrote them to."""
    return {name: read_jdbc_table(spark, url=url, table=f"{schema}.{name}",
                                  properties=properties) for name in TABLES}
