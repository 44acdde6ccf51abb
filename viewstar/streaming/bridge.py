"""Topic to topic: every JSON message is passed on, everything else is kept aside."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from viewstar.operators.ingest import first_messages, forwarded, next_positions, unread
from viewstar.staging import Staging, path_exists, subfolders
from viewstar.streaming.outcomes import DEAD, VALID, count_valid
from viewstar.versions import Versions

Send = Callable[[DataFrame, int | str], None]


def to_topic(topic: str, options: Mapping[str, str]) -> Send:
    """Send each batch to a topic. Needs Spark's Kafka connector on the class path."""
    def send(batch: DataFrame, _batch_id: int | str) -> None:
        (batch.select("key", "value").write.format("kafka").options(**options)
         .option("topic", topic).save())
    return send


def to_folder(path: str) -> Send:
    """Write each batch to a folder of its own; a repeated batch replaces itself.

    The folder is named by the run and the batch: batches count from nought again after a
    new checkpoint, and must not replace those of another run.
    """
    def send(batch: DataFrame, batch_id: int | str) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return send


def _pass_on(batch: DataFrame, send: Send, dead_letters: Send, name: str) -> None:
    """A batch is read once and feeds both outputs; what does not fit in memory goes to disk."""
    batch = batch.persist()
    try:
        send(batch.filter("valid").drop("valid"), name)
        dead_letters(batch.filter("NOT valid").drop("valid"), name)
    finally:
        batch.unpersist()


def bridge_batch(messages: DataFrame, send: Send, dead_letters: Send) -> dict[str, int]:
    """Pass on a bounded read of envelopes; returns how many messages took which way."""
    seen = Observation("bridge")
    rows = forwarded(messages)
    rows = rows.observe(seen, F.count(F.lit(1)).alias("messages"),
                        F.count_if("valid").alias(VALID), F.count_if(~F.col("valid")).alias(DEAD))
    _pass_on(rows, send, dead_letters, uuid.uuid4().hex)
    return dict(seen.get)


def bridge_next(envelope: DataFrame, send: Send, dead_letters: Send, ledger: str, at_most: int,
                start: Mapping[int, int] | None = None) -> dict[str, int]:
    """Pass on the next ``at_most`` messages after those of the runs before.

    The positions are kept in the versions of the folder ``ledger`` and committed after the
    messages were sent: a run that stops in between sends its messages again, and its dead
    letters replace themselves. ``start`` moves the position of partitions forward first.
    """
    spark = envelope.sparkSession
    versions = Versions(spark, ledger)
    base = versions.latest()
    held = base.ledger.get("positions", {}) if base else {}
    seen = Observation("bridge")
    with Staging(spark) as staging:
        taken = staging.table(first_messages(unread(envelope, held, start), at_most, staging),
                              "taken")
        # One row per topic partition.
        ends = {f"{row.topic}/{row.partition}": row.next_offset
                for row in next_positions(taken).collect()}
        if not ends:
            return {"messages": 0, VALID: 0, DEAD: 0}
        rows = forwarded(taken).observe(
            seen, F.count(F.lit(1)).alias("messages"), F.count_if("valid").alias(VALID),
            F.count_if(~F.col("valid")).alias(DEAD))
        _pass_on(rows, send, dead_letters, f"capped-{(base.number if base else 0) + 1}")
    versions.commit(base, {}, [], {"positions": held | ends})
    return dict(seen.get)


def run_name(spark: SparkSession, checkpoint: str) -> str:
    """A name that stays with a checkpoint: made when it is first used, read afterwards."""
    path = f"{checkpoint.rstrip('/')}/run"
    if path_exists(spark, path):
        name, = subfolders(spark, path)
        return name
    name = uuid.uuid4().hex
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hadoop)
    return name


def start_bridge(messages: DataFrame, send: Send, dead_letters: Send, checkpoint: str,
                 trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Start the bridge over a stream of envelopes; the checkpoint keeps the position.

    The first batch of a checkpoint names the run in the checkpoint's own folder, and a batch
    is known by that name and its number.
    """
    run = run_name(messages.sparkSession, checkpoint)

    def pass_on(batch: DataFrame, batch_id: int) -> None:
        _pass_on(batch, send, dead_letters, f"{run}-{batch_id}")

    return (
        count_valid(forwarded(messages)).writeStream.foreachBatch(pass_on)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
