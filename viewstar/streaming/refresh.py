"""Landing table to star, in micro-batches.

A batch is some versions of the landing table. The rows they added are combined and merged with
the combined views kept of each date they touch, and those dates of the fact are replaced, in
one version of the warehouse whose ledger names the batch. Late events need no watermark, and a
repeated batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from viewstar.plans.star import StarRun, merge_star
from viewstar.sources.landing import (
    events_of, landed_rows, landing_stream, landing_table, of_dates)
from viewstar.streaming.bridge import run_name
from viewstar.versions import Versions


def refresh_batch(batch: DataFrame, landing: str, warehouse: str, stream: str, number: int,
                  strict: bool = False, sketches: bool = False) -> StarRun:
    """Bring the star up to date with some versions of the landing table."""
    spark = batch.sparkSession
    # One row per version of the batch.
    found = sorted((row.version, row.added) for row in batch.collect())
    folders = [folder for _, added in found for folder in added]
    if not folders:
        return StarRun()
    versions = Versions(spark, landing)
    # Rows that later versions added are left to later batches.
    whole = versions.at(found[-1][0])
    return merge_star(
        events_of(landed_rows(versions, folders)), warehouse, stream, number,
        lambda days: events_of(of_dates(landing_table(spark, landing, whole), days)),
        strict=strict, sketches=sketches)


def start_star_refresh(spark, landing: str, warehouse: str, checkpoint: str,
                       versions_per_trigger: int | None = None, strict: bool = False,
                       trigger: Mapping[str, object] | None = None,
                       sketches: bool = False) -> StreamingQuery:
    """Start refreshing the star from the landing table as rows arrive.

    Rows that break a constraint go to the quarantine and the stream goes on; only ``strict``
    stops it at the first one.
    """
    run = run_name(spark, checkpoint)

    def refresh(batch: DataFrame, batch_id: int) -> None:
        refresh_batch(batch, landing, warehouse, run, batch_id, strict, sketches)

    return (
        landing_stream(spark, landing, versions_per_trigger)
        .writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
