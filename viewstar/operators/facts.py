"""The view fact: aggregate by natural keys first, swap in surrogate keys after.

Natural and surrogate keys stand one to one, so grouping by the first gives the groups of
the second. Raw events then shuffle once, combined on the map side, and every lookup moves
aggregated rows only.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from viewstar.functions.times import date_key, epoch_seconds, event_date, event_time
from viewstar.operators.lookup import BROADCAST_BYTES, lookup, measured_sizes
from viewstar.operators.numbering import hash_key, number_rows
from viewstar.schemas import FACT_KEYS, FACT_KEYS_PER_DATE, NATURAL_KEYS
from viewstar.staging import Staging


# Days after today that a clock running ahead may still name; later dates are no report date.
FUTURE_DAYS = 1


def _latest(date: Column, today: Column | None) -> Column:
    """The latest date that is not in the future, by more than ``FUTURE_DAYS``, else today."""
    today = F.current_date() if today is None else today
    last = F.date_add(F.greatest(today, F.current_date()), FUTURE_DAYS)
    return F.coalesce(F.max(F.when(date <= last, date)), today)


def report_date(events: DataFrame, today: Column | None = None) -> DataFrame:
    """One row: the latest valid date among the events, else today, as text."""
    latest = _latest(event_date("local_time"), today)
    return events.agg(latest.cast("string").alias("report_date"))


def with_valid_date(events: DataFrame) -> DataFrame:
    """Events whose time starts with a valid date."""
    return events.filter(event_date("local_time").isNotNull())


def on_report_date(events: DataFrame, today: Column | None = None,
                   day: datetime.date | None = None) -> DataFrame:
    """Events of the report date: those whose parsed date equals it.

    ``day`` is the report date where the caller knows it (``latest_landed_day`` reads it off
    the folders of a landing table); else a scalar subquery finds it. Events from the landing
    table carry the parsed date as their partition column, so that the scan opens one folder.
    """
    stored = "event_date" in events.columns
    date = F.col("event_date") if stored else event_date("local_time")
    latest = events.agg(_latest(date, today)).scalar() if day is None else F.lit(day)
    return events.filter(date == latest)


def view_grain(events: DataFrame) -> DataFrame:
    """Events combined by date and natural keys; nulls form groups of their own."""
    seconds = epoch_seconds("_time")
    return (
        events.select(
            event_date("local_time").alias("date"), *NATURAL_KEYS,
            event_time("local_time").alias("_time"))
        .groupBy("date", *NATURAL_KEYS)
        .agg(F.count("*").alias("views"),
             F.min("_time").alias("first_view_time"),
             F.max("_time").alias("last_view_time"),
             F.count(seconds).alias("timed_views"),
             # Whole seconds add up exactly, whatever the order of the tasks.
             F.sum(seconds).alias("seconds"))
    )


def event_views(events: DataFrame) -> DataFrame:
    """Each event as a row of the shape of the grain: ``merged_grain`` combines them, alone or
    with grains, in one shuffle."""
    seconds = epoch_seconds("_time")
    return events.select(
        event_date("local_time").alias("date"), *NATURAL_KEYS,
        event_time("local_time").alias("_time")
    ).select(
        "date", *NATURAL_KEYS, F.lit(1).cast("bigint").alias("views"),
        F.col("_time").alias("first_view_time"), F.col("_time").alias("last_view_time"),
        seconds.isNotNull().cast("bigint").alias("timed_views"), seconds.alias("seconds"))


#: How the measures of the grain add up: over events of one date that came in several batches.
MERGES = {"views": F.sum, "first_view_time": F.min, "last_view_time": F.max,
          "timed_views": F.sum, "seconds": F.sum}


def merged_grain(*parts: DataFrame) -> DataFrame:
    """One grain of several: equal to the grain of all their events together."""
    both = reduce(DataFrame.unionByName, [
        part.select("date", *NATURAL_KEYS, *MERGES) for part in parts])
    return both.groupBy("date", *NATURAL_KEYS).agg(
        *[merge(name).alias(name) for name, merge in MERGES.items()])


def keyed_grain(grain: DataFrame, staging: Staging) -> DataFrame:
    """A grain as a stored table, each row with the key its fact row will have.

    The key is the date key followed by the row's number within the date, in the order of
    the natural keys, nulls first: unique over all dates, the same in every run over the
    same events, and unmoved when another date is refreshed. A date of any size is numbered
    by many tasks. Numbering here, before the lookups, sorts a plain aggregate and not the
    outcome of four joins.
    """
    numbered = number_rows(grain, list(NATURAL_KEYS), "_number", staging,
                           within=["date"])
    limit = F.lit(FACT_KEYS_PER_DATE)
    key = F.when(F.col("_number") < limit,
                 date_key("date").cast("bigint") * limit + F.col("_number")).otherwise(
        F.raise_error(F.lit("a date holds more fact rows than its key space")))
    return numbered.withColumn("fact_key", key).drop("_number")


def hash_keyed_grain(grain: DataFrame, staging: Staging) -> DataFrame:
    """A grain as a stored table, each row with a key hashed from its date and natural keys.

    Nothing is sorted or numbered. Two rows of a run that share a key make the caller fail.
    """
    key = F.xxhash64("date", *NATURAL_KEYS)
    return staging.table(grain.withColumn("fact_key", key), "grain")


def _measures(views, visitors, first, last, seconds, timed) -> list[Column]:
    return [
        views.alias("view_count"),
        visitors.cast("bigint").alias("unique_visitors"),
        last.alias("last_view_time"),
        first.alias("first_view_time"),
        F.when(timed > 0, seconds / timed).alias("avg_view_timestamp"),
        (epoch_seconds(last) - epoch_seconds(first)).alias("view_duration_seconds"),
    ]


def _grain_measures(device: Column | None = None) -> list[Column]:
    # A group holds one device, so it has one visitor, or none where the device is null.
    known = F.col("device_id").isNotNull() if device is None else device
    return _measures(F.col("views"), known.cast("int"),
                     F.col("first_view_time"), F.col("last_view_time"),
                     F.col("seconds"), F.col("timed_views"))


def _fact_key(grain: DataFrame) -> list[str]:
    return ["fact_key"] if "fact_key" in grain.columns else []


def with_surrogate_keys(grain: DataFrame, dims: dict[str, DataFrame],
                        sizes: dict[str, int] | None = None,
                        broadcast_bytes: int = BROADCAST_BYTES,
                        keep: Sequence[str] = ()) -> DataFrame:
    """``grain``, a stored table, with the surrogate keys of the four member dimensions in
    place of the natural ones; those of ``keep`` stay beside theirs.

    Small dimensions come first: where a larger one moves the rows, they carry short keys
    instead of texts.
    """
    if sizes is None:
        sizes = measured_sizes({table: (dims[table], natural)
                                for natural, (table, _) in NATURAL_KEYS.items()})
    fact = grain
    for natural, (table, key) in sorted(NATURAL_KEYS.items(), key=lambda item: sizes[item[1][0]]):
        fact = lookup(fact, dims[table], natural, key, sizes[table], grain, broadcast_bytes)
        if natural not in keep:
            fact = fact.drop(natural)
    return fact


def fact_from_grain(grain: DataFrame, dims: dict[str, DataFrame],
                    sizes: dict[str, int] | None = None,
                    broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The fact over dimensions that hold every natural key of ``grain``, a stored table.

    Each grain row is one fact row. ``sizes`` are broadcast sizes already known.
    """
    fact = with_surrogate_keys(grain, dims, sizes, broadcast_bytes)
    # Every device has a member.
    return fact.select(*_fact_key(grain), date_key("date").alias("date_key"),
                       *FACT_KEYS[1:], *_grain_measures(F.col("device_key").isNotNull()))


def fact_by_lookup(grain: DataFrame, dims: dict[str, DataFrame],
                   sizes: dict[str, int] | None = None,
                   broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The fact over dimensions that may lack members, the calendar included.

    A key that finds no member becomes null, so several groups can fall into one; the
    grain rows are combined again on the surrogate keys.
    """
    # A calendar has at most 366 rows a year.
    calendar = F.broadcast(dims["dim_date"].select("date", "date_key"))
    fact = with_surrogate_keys(grain, dims, sizes, broadcast_bytes, ["device_id"]).join(
        calendar, "date", "left")
    merged = fact.groupBy(*FACT_KEYS).agg(
        F.sum("views").alias("views"), F.count_distinct("device_id").alias("visitors"),
        F.min("first_view_time").alias("first"), F.max("last_view_time").alias("last"),
        F.sum("seconds").alias("seconds"), F.sum("timed_views").alias("timed"),
        *[F.min(key).alias(key) for key in _fact_key(grain)])
    return merged.select(*_fact_key(grain), *FACT_KEYS, *_measures(*[
        F.col(c) for c in ("views", "visitors", "first", "last", "seconds", "timed")]))


def fact_from_hash_keys(grain: DataFrame) -> DataFrame:
    """The fact with keys hashed from the natural keys: no lookup at all."""
    return grain.select(
        *_fact_key(grain), date_key("date").alias("date_key"),
        *[hash_key(natural).alias(key) for natural, (_, key) in NATURAL_KEYS.items()],
        *_grain_measures())


def undated(events: DataFrame) -> DataFrame:
    """Events without a valid date: they belong to no date of the fact."""
    return events.filter(event_date("local_time").isNull())
