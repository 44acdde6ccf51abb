"""Writing the star to a database through Spark's JDBC writer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from viewstar.schemas import DIMENSIONS

# Rows per insert batch; every task holds one connection, so tasks are bounded too, by as
# many as the database takes.
BATCH_ROWS = 10_000
CONNECTIONS = 32


def jdbc_write_options(url: str, table: str, properties: Mapping[str, str],
                       truncate: bool = False, cascade: bool = False,
                       connections: int = CONNECTIONS) -> dict[str, str]:
    """Options of a table write; ``cascade`` also empties the tables that reference it."""
    options = {"url": url, "dbtable": table, "batchsize": str(BATCH_ROWS),
               "numPartitions": str(connections), **properties}
    if truncate:
        options["truncate"] = "true"
        if cascade:
            options["cascadeTruncate"] = "true"
    return options


def write_jdbc_star(tables: Mapping[str, DataFrame], url: str, properties: Mapping[str, str],
                    schema: str = "public", connections: int = CONNECTIONS) -> None:
    """Truncate and write the dimensions, then append the fact.

    Truncating a dimension cascades to the fact, so afterwards the database holds the
    given fact only. Generated keys keep the order: dimensions before the fact.
    """
    for dimension in DIMENSIONS:
        options = jdbc_write_options(url, f"{schema}.{dimension.name}", properties,
                                     truncate=True, cascade=True, connections=connections)
        tables[dimension.name].write.format("jdbc").options(**options).mode(
            "overwrite").save()
    options = jdbc_write_options(url, f"{schema}.fact_product_views", properties,
                                 connections=connections)
    tables["fact_product_views"].write.format("jdbc").options(**options).mode(
        "append").save()
