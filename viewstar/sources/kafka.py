"""Topics as message envelopes. Needs Spark's Kafka connector on the class path."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

def kafka_options(brokers: str, security_protocol: str = "SASL_PLAINTEXT",
                  sasl_mechanism: str = "PLAIN", sasl_jaas_config: str | None = None
                  ) -> dict[str, str]:
    """Connection options; SASL ones only where the protocol asks for them.

    ``sasl_jaas_config`` comes from the caller's secret store, never from code.
    """
    options = {"kafka.bootstrap.servers": brokers,
               "kafka.security.protocol": security_protocol}
    if security_protocol != "PLAINTEXT":
        options["kafka.sasl.mechanism"] = sasl_mechanism
        if sasl_jaas_config:
            options["kafka.sasl.jaas.config"] = sasl_jaas_config
    return options


def topic_stream(spark: SparkSession, topic: str, options: Mapping[str, str],
                 per_trigger: int | None = None) -> DataFrame:
    """A topic from its earliest message; the query's checkpoint keeps the position."""
    reader = (spark.readStream.format("kafka").options(**options)
              .option("subscribe", topic).option("startingOffsets", "earliest"))
    if per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load()


def topic_table(spark: SparkSession, topic: str, options: Mapping[str, str],
                starting: Mapping[int, int] | None = None,
                ending: Mapping[int, int] | None = None) -> DataFrame:
    """A bounded read of a topic between two positions per partition."""
    return (
        spark.read.format("kafka").options(**options).option("subscribe", topic)
        .option("startingOffsets", _positions(topic, starting, "earliest"))
        .option("endingOffsets", _positions(topic, ending, "latest"))
        .load()
    )


def _positions(topic: str, offsets: Mapping[int, int] | None, default: str) -> str:
    if offsets is None:
        return default
    return json.dumps({topic: {str(p): o for p, o in sorted(offsets.items())}})
