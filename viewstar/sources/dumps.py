"""Exported collections of a document store: files with one document a line.

Spark's text reader cuts a file into byte ranges and reads a line where it begins, so a document
that lies over a border is read once, whatever its length, and files of any size are spread over
tasks. Values may be wrapped to keep their type (``{"$oid": …}``, ``{"$numberLong": …}``,
``{"$date": …}``); they are unwrapped by column expressions. An export as one array is read too, if
its documents stand on lines of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from viewstar.functions.documents import as_text, is_object, with_document
from viewstar.schemas import EVENT_FIELDS

# Wrappers of the extended JSON notation that hold a value as text.
WRAPPERS = ("$oid", "$uuid", "$symbol", "$numberInt", "$numberLong", "$numberDouble",
            "$numberDecimal", "$date")
FIELDS = ("_id", *EVENT_FIELDS, "user_agent", "json", "raw")


def unwrapped(document: str, name: str) -> Column:
    """A field as text without its wrapper; a date in milliseconds as a time without a zone."""
    def at(*steps: str) -> Column:
        path = "$" + "".join(f"['{step}']" for step in steps)
        return F.try_variant_get(document, path, "string")

    milliseconds = at(name, "$date", "$numberLong").try_cast("bigint")
    moment = F.date_format(F.timestamp_add(
        "MILLISECOND", milliseconds, F.lit("1970-01-01").cast("timestamp_ntz")),
        "yyyy-MM-dd'T'HH:mm:ss")
    return F.coalesce(moment, *[at(name, wrapper) for wrapper in WRAPPERS], at(name))


def collection_dump(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: its id and the fields that landing stores, as text.

    Lines that hold no object (the brackets of an array, empty ones) are no documents; text that
    cannot be parsed comes back in ``broken`` with null fields, so nothing is lost unseen.
    """
    lines = spark.read.text(path).select(F.regexp_replace(
        F.regexp_replace("value", r"^\s*\[?\s*(?=\{)", ""), r"(?<=\})\s*,?\s*\]?\s*$", "").alias(
        "text")).filter(~F.col("text").rlike(r"^[\s\[\],]*$"))
    found = with_document(lines)
    document = F.when(is_object("text"), F.col("document"))
    fields = found.withColumn("document", document)
    return fields.select(
        *[unwrapped("document", name).alias(name) for name in FIELDS],
        F.when(F.col("document").isNull(), F.col("text")).alias("broken"))


def dump_events(dump: DataFrame, keep_nulls: bool = False) -> DataFrame:
    """The events of a dump, as ``sources.landing.events_of`` gives those of a landing table."""
    return as_text(dump.filter("broken IS NULL").select(*EVENT_FIELDS, "user_agent"),
                   keep_nulls=keep_nulls)
