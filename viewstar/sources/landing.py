"""The landing table and document stores, read by Spark's own tasks."""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from viewstar.functions.documents import DOCUMENT, ERROR, as_text
from viewstar.operators.facts import FUTURE_DAYS
from viewstar.operators.schemas import with_document_columns
from viewstar.schemas import EVENT, EVENT_FIELDS
from viewstar.versions import Version, Versions, partition_value

#: The table's name in the versions of its folder.
TABLE = "landing"
NO_DATE = "__HIVE_DEFAULT_PARTITION__"

LANDING = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("route", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("document", T.VariantType()),
    *EVENT.fields,
    T.StructField("user_agent", T.StringType()),
    T.StructField("event_date", T.DateType()),
])


def landing_table(spark: SparkSession, path: str, version: Version | None = None) -> DataFrame:
    """All rows of the last version of a landing table, or of a given one."""
    versions = Versions(spark, path)
    return landed_rows(versions, (version or versions.current()).folders(TABLE))


def key_registry(spark: SparkSession, path: str, version: Version | None = None) -> dict[str, str]:
    """The keys of all documents that ever landed, each with the type that covers its values."""
    return dict((version or Versions(spark, path).current()).ledger.get("keys", {}))


def landed_documents(spark: SparkSession, path: str) -> DataFrame:
    """The position and one column per key of every landed document, of one version."""
    version = Versions(spark, path).current()
    rows = landing_table(spark, path, version).filter(F.col("route") == DOCUMENT)
    return with_document_columns(rows, key_registry(spark, path, version),
                                 "topic", "partition", "offset")


def landed_rows(versions: Versions, folders: list[str]) -> DataFrame:
    """Rows of some folders of a landing table."""
    return versions.read(TABLE, LANDING, folders)


def landing_stream(spark: SparkSession, path: str,
                   versions_per_trigger: int | None = None) -> DataFrame:
    """The versions of a landing table as they appear: (version, added folders).

    Rows stand in folders that a version names, so a reader that follows the versions sees
    whole batches only, each once, and does not take compacted files for new rows.
    """
    reader = spark.readStream.schema("version bigint, added array<string>")
    if versions_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", versions_per_trigger)
    return reader.json(Versions(spark, path).prepare())


def events_of(landing: DataFrame, keep_nulls: bool = False) -> DataFrame:
    """The five event fields of every stored document, as text, and the event's date.

    Text that was no JSON is a stored document without any of the fields, so it counts
    with empty text in each. The user agent, which many events lack, stays null without one.
    Only these columns and the route are read; the date is the name of the folder.
    """
    stored = landing.filter(F.col("route") != ERROR)
    return as_text(stored.select(*EVENT_FIELDS, "user_agent", "event_date"),
                   keep_nulls=keep_nulls)


def of_dates(landing: DataFrame, dates: Iterable[datetime.date]) -> DataFrame:
    """The partitions of some dates; the other folders are not listed for the scan."""
    return landing.filter(F.col("event_date").isin(list(dates)))


def latest_landed_day(spark: SparkSession, path: str,
                      today: datetime.date | None = None) -> datetime.date | None:
    """The report date of a landing table, read off its version: no file is opened for it.

    Messages without a date are in the folder of none. The latest folder that is not in the
    future and holds a row counts; nearly always the first one looked at does.
    """
    last = (today or datetime.date.today()) + datetime.timedelta(days=FUTURE_DAYS)
    versions = Versions(spark, path)
    folders = versions.current().partitions(TABLE)
    days = {datetime.date.fromisoformat(text): text for text in folders if text != NO_DATE}
    for day in sorted((day for day in days if day <= last), reverse=True):
        if not landed_rows(versions, folders[days[day]]).isEmpty():
            return day
    return None


def document_store(spark: SparkSession, uri: str, database: str, collection: str,
                   options: Mapping[str, str] | None = None) -> DataFrame:
    """A collection of a document store, partitioned by the connector, not by the driver.

    Needs the store's Spark connector. The event schema is given, so nothing is inferred
    and only these fields travel.
    """
    return (
        spark.read.format("mongodb").schema(EVENT)
        .option("connection.uri", uri).option("database", database)
        .option("collection", collection).options(**(options or {})).load()
    )


def empty_events(spark: SparkSession) -> DataFrame:
    """No events, with their schema."""
    return spark.createDataFrame([], EVENT)
