"""The analytical reports over the star.

Views are summed per key before a dimension is joined: a dimension key is unique, so the
totals stay the same, and a join sees one row per key instead of the whole fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def views_by_date_product(fact: DataFrame, dim_date: DataFrame, dim_product: DataFrame,
                          with_distinct: bool = False) -> DataFrame:
    """Views per date and product name, latest date first.

    ``total_unique_visitors`` adds the visitors of the fact rows, so a device that comes
    through two referrers counts twice. ``with_distinct`` adds the true distinct devices.
    """
    if with_distinct:
        # Per device first: the distinct count then needs no second pass over the fact,
        # and a hot product is spread over its devices.
        per_key = (
            fact.groupBy("date_key", "product_key", "device_key")
            .agg(F.sum("view_count").alias("views"),
                 F.sum("unique_visitors").alias("visitors"))
            .groupBy("date_key", "product_key")
            .agg(F.sum("views").alias("views"), F.sum("visitors").alias("visitors"),
                 F.count("device_key").alias("devices"))
        )
    else:
        per_key = fact.groupBy("date_key", "product_key").agg(
            F.sum("view_count").alias("views"), F.sum("unique_visitors").alias("visitors"))
    totals = [F.sum("views").alias("total_views"),
              F.sum("visitors").alias("total_unique_visitors")]
    if with_distinct:
        # product_name is one to one with the product, so the counts add up.
        totals.append(F.sum("devices").alias("distinct_devices"))
    return (
        per_key.join(dim_date.select("date_key", "date"), "date_key")
        .join(dim_product.select("product_key", "product_name"), "product_key")
        .groupBy("date", "product_name").agg(*totals)
        .orderBy(F.desc("date"), F.desc("total_views"), "product_name")
    )


def top_countries(fact: DataFrame, dim_country: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` countries with the most views; ties in the order of their names."""
    return (
        fact.groupBy("country_key").agg(F.sum("view_count").alias("views"))
        .join(dim_country.select("country_key", "country_name", "region"), "country_key")
        .groupBy("country_name", "region").agg(F.sum("views").alias("total_views"))
        .orderBy(F.desc("total_views"), "country_name", "region")
        .limit(n)
    )


def traffic_sources(fact: DataFrame, dim_referrer: DataFrame,
                    approximate: bool = False) -> DataFrame:
    """Views and distinct devices per traffic type and domain.

    ``approximate`` counts the devices by sketches, which merge without a shuffle of the
    devices themselves; the standard error is 5 %.

    Combining per referrer and device first spreads a hot referrer over its devices and
    drops dates, products and countries before the join.
    """
    devices = F.approx_count_distinct if approximate else F.count_distinct
    return (
        fact.groupBy("referrer_key", "device_key").agg(F.sum("view_count").alias("views"))
        .join(dim_referrer.select("referrer_key", "referrer_type", "referrer_domain"),
              "referrer_key")
        .groupBy("referrer_type", "referrer_domain")
        .agg(F.sum("views").alias("total_views"),
             devices("device_key").alias("unique_devices"))
        .orderBy(F.desc("total_views"), "referrer_type", "referrer_domain")
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, one line each."""
    counts = [
        df.agg(F.count("*").alias("count")).select(F.lit(name).alias("table_name"), "count")
        for name, df in tables.items()
    ]
    first, *rest = counts
    for count in rest:
        first = first.unionByName(count)
    return first
