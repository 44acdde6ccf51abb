"""Counts of what became of the messages, taken while they pass."""

from __future__ import annotations

import contextlib
from collections import Counter
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from viewstar.functions.documents import DOCUMENT, ERROR, RAW

METRIC = "outcomes"
VALID, DEAD = "valid", "dead"


def count_routes(rows: DataFrame) -> DataFrame:
    """Observe messages in all and per route; no second pass over the data."""
    return rows.observe(
        METRIC, F.count(F.lit(1)).alias("messages"),
        *[F.count_if(F.col("route") == name).alias(name) for name in (DOCUMENT, RAW, ERROR)])


def count_valid(rows: DataFrame) -> DataFrame:
    """Observe messages in all, those passed on and the dead letters."""
    return rows.observe(
        METRIC, F.count(F.lit(1)).alias("messages"), F.count_if("valid").alias(VALID),
        F.count_if(~F.col("valid")).alias(DEAD))


def observed(seen: Observation) -> dict:
    """What an observation saw; nothing where the plan had no rows and was not run at all."""
    try:
        return dict(seen.get)
    except Py4JJavaError:
        return {}


def _add(total: Counter, progress) -> None:
    row = progress.observedMetrics.get(METRIC)
    if row is not None:
        total.update(row.asDict())


class OutcomeListener(StreamingQueryListener):
    """Totals over the whole life of the session's queries; add it with ``addListener``."""

    def __init__(self):
        self.total = Counter()
        self.failed: list[str] = []

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        _add(self.total, event.progress)

    def onQueryTerminated(self, event):
        if event.exception:
            self.failed.append(event.exception)


@contextlib.contextmanager
def counted(spark: SparkSession) -> Iterator[Counter]:
    """Totals over every batch of the streams that run inside, complete when it ends.

    A query's own reports go back a hundred batches only; the listener hears all of them.
    """
    listener = OutcomeListener()
    spark.streams.addListener(listener)
    try:
        yield listener.total
    finally:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        spark.streams.removeListener(listener)
