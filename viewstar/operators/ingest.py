"""Message streams as tables: bounded reads, positions, counts, routes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from viewstar.functions.documents import (
    DOCUMENT, decode_text, document_fields, normalised_json, route, with_document)
from viewstar.functions.times import event_date
from viewstar.operators.numbering import number_rows
from viewstar.schemas import EVENT_FIELDS
from viewstar.staging import Staging

POSITION = ("topic", "partition", "offset")


#: So many positions are sorted in one task; more are numbered by many.
SORTED = 1 << 18


def first_messages(envelope: DataFrame, cap: int, staging: Staging) -> DataFrame:
    """The first ``cap`` messages by topic, partition and offset, for any size of ``cap``.

    Nothing past the cap is consumed: ``next_positions`` of the result is where the next
    run starts (``unread``). Only positions are read to find the last offset taken per partition
    (``last_offsets``); the messages themselves are filtered, not moved.
    """
    return up_to(envelope, last_offsets(envelope, cap, staging))


def last_offsets(envelope: DataFrame, cap: int, staging: Staging) -> dict[str, int]:
    """The last offset of the first ``cap`` messages per ``topic/partition`` they come from."""
    cuts, left = {}, cap
    # One row per topic partition.
    for part in sorted(topic_counts(envelope).collect(), key=lambda part: (
            part.topic is not None, part.topic, part.partition is not None, part.partition)):
        if left <= 0:
            break
        last = part.last_offset
        if part.messages > left:
            rows = envelope.filter((F.col("topic") == part.topic)
                                   & (F.col("partition") == part.partition))
            last = _nth_offset(rows, left, part.first_offset, staging)
        if None not in (part.topic, part.partition, last):
            cuts[f"{part.topic}/{part.partition}"] = last
        left -= part.messages
    return cuts


def up_to(envelope: DataFrame, last: Mapping[str, int]) -> DataFrame:
    """Messages up to the given offsets (``topic/partition`` to offset), none of other partitions.

    A plain filter, so a source that knows its positions reads no others.
    """
    # One entry per topic partition.
    known = F.create_map(*[F.lit(x) for entry in last.items() for x in entry]).cast(
        "map<string,bigint>")
    partition = F.concat("topic", F.lit("/"), F.col("partition").cast("string"))
    return envelope.filter(F.col("offset") <= F.try_element_at(known, partition))


def _nth_offset(rows: DataFrame, n: int, first: int, staging: Staging) -> int:
    """The ``n``-th offset of one topic partition, which may have gaps.

    Without gaps the first ``n`` offsets span ``n``: where that span holds ``n`` rows, its last
    is the one. Else rows are counted by how often the span was doubled to reach them, and only
    the doublings needed are sorted.
    """
    span = rows.filter(F.col("offset") < first + n).agg(
        F.count("*").alias("messages"), F.max("offset").alias("last")).first()
    if span.messages == n:
        return span.last
    doublings = F.greatest(F.lit(0), F.ceil(F.log2((F.col("offset") - first + 1) / n)))
    offsets = rows.select("offset", doublings.alias("_doublings"))
    reached, needed = 0, 0
    # At most one row per doubling of a 64-bit number.
    for count in offsets.groupBy("_doublings").count().orderBy("_doublings").collect():
        reached, needed = reached + count["count"], count["_doublings"]
        if reached >= n:
            break
    near = offsets.filter(F.col("_doublings") <= needed).select("offset")
    if reached <= SORTED:
        return near.orderBy("offset").limit(n).agg(F.max("offset")).first()[0]
    return number_rows(near, ["offset"], "_number", staging).filter(
        F.col("_number") == n).first().offset


def _text(value: str) -> str:
    """A text in SQL, whatever its characters are."""
    return f"CAST(X'{value.encode().hex()}' AS STRING)"


def before(envelope: DataFrame, topic: str, partition: int) -> DataFrame:
    """Messages that come before a topic partition in the order of ``first_messages``."""
    return envelope.filter(
        f"coalesce(topic < {_text(topic)}, true) OR (topic = {_text(topic)} "
        f"AND coalesce(partition < {partition}, true))")


def span(envelope: DataFrame, topic: str, partition: int, first: int, end: int) -> DataFrame:
    """Messages of one topic partition from ``first`` to before ``end``; plain bounds."""
    return envelope.filter(f"topic = {_text(topic)} AND partition = {partition} "
                           f"AND `offset` >= {first}L AND `offset` < {end}L")


def unread(envelope: DataFrame, positions: Mapping[str, int],
           start: Mapping[int, int] | None = None) -> DataFrame:
    """Messages from the given positions (``topic/partition`` to offset) on.

    ``start`` names later positions of partitions. A partition without one is read from its
    beginning.
    """
    # One entry per topic partition. One text, as a run asks often and each column costs a call.
    known = ", ".join(f"{_text(name)}, {offset}L" for name, offset in positions.items())
    least = ", ".join(f"{partition}, {offset}L" for partition, offset in (start or {}).items())
    return envelope.filter(f"""`offset` >= greatest(
        coalesce(try_element_at(CAST(map({known}) AS map<string, bigint>),
                                concat_ws('/', topic, partition)), 0L),
        coalesce(try_element_at(CAST(map({least}) AS map<int, bigint>), partition), 0L))""")


def next_positions(envelope: DataFrame) -> DataFrame:
    """The offset after the last one, per topic and partition."""
    return envelope.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("next_offset"))


def topic_counts(envelope: DataFrame) -> DataFrame:
    """Messages and offset range per topic and partition."""
    return envelope.groupBy("topic", "partition").agg(
        F.count("*").alias("messages"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"))


def routed(envelope: DataFrame) -> DataFrame:
    """Messages as text with their document and route; positions are kept, keys are not."""
    texts = envelope.select(*POSITION, "timestamp", decode_text("value").alias("text"))
    return with_document(texts).withColumn("route", route("text", "document"))


def landed(envelope: DataFrame) -> DataFrame:
    """Rows of the landing table: text, document, route, the fields read, and the date.

    The fields stand in columns of their own, so that a reader prunes to them instead of
    parsing every document again.
    """
    rows = routed(envelope).withColumn("_fields", document_fields(
        F.when(F.col("route") == DOCUMENT, F.col("document")), (*EVENT_FIELDS, "user_agent")))
    return rows.select(
        F.concat_ws("-", *POSITION).alias("_id"),
        *POSITION, "timestamp", "route", "text", "document",
        *[F.col("_fields")[name].alias(name) for name in (*EVENT_FIELDS, "user_agent")],
        event_date(F.col("_fields.local_time")).alias("event_date"))


def forwarded(envelope: DataFrame) -> DataFrame:
    """Messages to pass on: any JSON value, normalised, without the key; others flagged.

    ``valid`` is false where the value is no JSON; such rows go to the dead letters.
    """
    rows = with_document(envelope.select(*POSITION, decode_text("value").alias("text")))
    valid = F.col("document").isNotNull()
    return rows.select(
        *POSITION, valid.alias("valid"),
        F.lit(None).cast("binary").alias("key"),
        F.when(valid, normalised_json("text")).otherwise(F.col("text"))
        .cast("binary").alias("value"))


def route_counts(rows: DataFrame) -> DataFrame:
    """Messages per route."""
    return rows.groupBy("route").agg(F.count("*").alias("messages"))
