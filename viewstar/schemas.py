"""Schemas of the messages and of the star schema, with the constraints as data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

EVENT_FIELDS = ("local_time", "product_id", "store_id", "referrer_url", "device_id")
EVENT = T.StructType([T.StructField(name, T.StringType()) for name in EVENT_FIELDS])

# Largest key space given to one date by the generated fact key; the key of the last date
# that has a date key, 9999-12-31, still fits a BIGINT.
FACT_KEYS_PER_DATE = 10 ** 10


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    required: bool = False      # NOT NULL
    length: int | None = None   # longest text the warehouse column takes
    default: str | None = None  # SQL expression used where the frame has no such column


@dataclass(frozen=True)
class Table:
    name: str
    primary_key: str
    unique: tuple[str, ...]
    columns: tuple[Column, ...]
    # foreign key column -> dimension it points to
    references: tuple[tuple[str, str], ...] = ()

    @property
    def column_names(self) -> list[str]:
        return [column.name for column in self.columns]

    def struct(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"{c.name} {c.type}" for c in self.columns))


# The warehouse contract (names, types, lengths, defaults).
DIM_DATE = Table("dim_date", "date_key", ("date_key",), (
    Column("date_key", "int", required=True),
    Column("date", "date", required=True),
    Column("year", "int", required=True),
    Column("month", "int", required=True),
    Column("day", "int", required=True),
    Column("day_of_week", "int", required=True),
    Column("week_of_year", "int", required=True),
    Column("quarter", "int", required=True),
    Column("created_at", "timestamp_ntz", default="localtimestamp()"),
))
DIM_PRODUCT = Table("dim_product", "product_key", ("product_id",), (
    Column("product_key", "bigint", required=True),
    Column("product_id", "string", required=True, length=255),
    Column("product_name", "string", length=500),
    Column("category", "string", length=255),
    Column("price", "decimal(10,2)"),
    Column("is_active", "boolean", default="true"),
    Column("created_date", "date"),
    Column("updated_at", "timestamp_ntz", default="localtimestamp()"),
))
DIM_COUNTRY = Table("dim_country", "country_key", ("store_id",), (
    Column("country_key", "bigint", required=True),
    Column("store_id", "string", required=True, length=255),
    Column("country_name", "string", length=255),
    Column("country_code", "string", length=10),
    Column("region", "string", length=255),
    Column("continent", "string", length=255),
    Column("created_date", "date"),
    Column("updated_at", "timestamp_ntz", default="localtimestamp()"),
))
DIM_REFERRER = Table("dim_referrer", "referrer_key", ("referrer_url",), (
    Column("referrer_key", "bigint", required=True),
    Column("referrer_url", "string", required=True),
    Column("referrer_domain", "string", length=500),
    Column("referrer_type", "string", length=255),
    Column("is_paid_traffic", "boolean", default="false"),
    Column("created_date", "date"),
    Column("updated_at", "timestamp_ntz", default="localtimestamp()"),
))
DIM_DEVICE = Table("dim_device", "device_key", ("device_id",), (
    Column("device_key", "bigint", required=True),
    Column("device_id", "string", required=True, length=255),
    Column("device_type", "string", length=255),
    Column("browser_info", "string"),
    Column("os_info", "string", length=255),
    Column("is_mobile", "boolean"),
    Column("created_date", "date"),
    Column("updated_at", "timestamp_ntz", default="localtimestamp()"),
))
FACT_KEYS = ("date_key", "product_key", "country_key", "referrer_key", "device_key")
FACT_PRODUCT_VIEWS = Table("fact_product_views", "fact_key", FACT_KEYS, (
    Column("fact_key", "bigint", required=True),
    Column("date_key", "int", required=True),
    Column("product_key", "bigint", required=True),
    Column("country_key", "bigint"),
    Column("referrer_key", "bigint"),
    Column("device_key", "bigint"),
    Column("view_count", "int", required=True, default="0"),
    Column("unique_visitors", "int", required=True, default="0"),
    Column("view_duration_seconds", "int"),
    Column("avg_view_timestamp", "double"),
    Column("first_view_time", "timestamp_ntz"),
    Column("last_view_time", "timestamp_ntz"),
    Column("processed_at", "timestamp_ntz", default="localtimestamp()"),
    Column("data_source", "string", length=255, default="'kafka_mongodb'"),
    Column("batch_id", "string", length=255),
), references=(
    ("date_key", "dim_date"),
    ("product_key", "dim_product"),
    ("country_key", "dim_country"),
    ("referrer_key", "dim_referrer"),
    ("device_key", "dim_device"),
))

DIMENSIONS = (DIM_DATE, DIM_PRODUCT, DIM_COUNTRY, DIM_REFERRER, DIM_DEVICE)
TABLES = {table.name: table for table in (*DIMENSIONS, FACT_PRODUCT_VIEWS)}

# Natural key in the event -> (dimension, surrogate key).
NATURAL_KEYS = {
    "product_id": ("dim_product", "product_key"),
    "store_id": ("dim_country", "country_key"),
    "referrer_url": ("dim_referrer", "referrer_key"),
    "device_id": ("dim_device", "device_key"),
}
