"""Options of the connectors that need a server; none is contacted here."""

import json

from viewstar.sinks.jdbc import jdbc_write_options
from viewstar.sources.kafka import _positions, kafka_options
from viewstar.sources.landing import empty_events
from viewstar.sources.warehouse import jdbc_read_options
from viewstar.schemas import EVENT


def test_kafka_security_options():
    assert kafka_options("a:1,b:2", "PLAINTEXT") == {
        "kafka.bootstrap.servers": "a:1,b:2", "kafka.security.protocol": "PLAINTEXT"}
    secured = kafka_options("a:1", sasl_jaas_config="given by the caller")
    assert secured["kafka.sasl.mechanism"] == "PLAIN"
    assert secured["kafka.sasl.jaas.config"] == "given by the caller"


def test_positions():
    assert _positions("t", None, "earliest") == "earliest"
    assert json.loads(_positions("t", {1: 5, 0: 2}, "latest")) == {"t": {"0": 2, "1": 5}}


def test_jdbc_options():
    assert jdbc_read_options("u", "t", {"user": "x"}) == {
        "url": "u", "dbtable": "t", "user": "x"}
    parts = jdbc_read_options("u", "t", {}, "date_key", 20240101, 20241231, 12)
    assert (parts["partitionColumn"], parts["numPartitions"]) == ("date_key", "12")
    write = jdbc_write_options("u", "t", {}, truncate=True, cascade=True)
    assert (write["truncate"], write["cascadeTruncate"]) == ("true", "true")
    assert "truncate" not in jdbc_write_options("u", "t", {})
    assert jdbc_write_options("u", "t", {}, connections=5)["numPartitions"] == "5"


def test_empty_source_keeps_its_schema(spark):
    assert empty_events(spark).schema == EVENT and empty_events(spark).isEmpty()
