"""The registered queries: (spark, folder of test tables) -> DataFrame."""

from __future__ import annotations

import contextlib
import datetime
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from registry import tables as t
from viewstar.functions.documents import (
    as_text, configure, decode_text, document_fields, document_schema, event_fields,
    nested_to_json, union_of_keys, with_document)
from viewstar.functions.times import event_date
from viewstar.functions.urls import url_country
from viewstar.operators import dimensions, facts, ingest, quality, sketches
from viewstar.operators.agents import with_families
from viewstar.operators.members import distinct_members
from viewstar.operators.numbering import (
    dense_keys, hash_collisions, hash_keys, incremental_keys, number_rows)
from viewstar.operators.quality import verify_star
from viewstar.operators.sketches import distinct_devices
from viewstar.plans import marts
from viewstar.plans.star import build_star, star_frames
from viewstar.schemas import (
    DIM_PRODUCT, ENVELOPE, EVENT_FIELDS, FACT_KEYS, FACT_PRODUCT_VIEWS, NATURAL_KEYS, TABLES)
from viewstar.sinks.documents import stored_documents
from viewstar.sources.dumps import collection_dump
from viewstar.sources.landing import (
    empty_events, events_of, key_registry, landed_documents, landing_table, latest_landed_day)
from viewstar.sources.warehouse import read_sketches, read_star, read_table
from viewstar.staging import Staging
from viewstar.streaming.bridge import bridge_next, start_bridge, to_folder
from viewstar.streaming.landing import compact, land_batch, land_next, start_landing
from viewstar.streaming.outcomes import counted
from viewstar.streaming.refresh import start_star_refresh

Query = Callable[[SparkSession, str], DataFrame]

# A message cap that ends within a partition of the test messages.
CAP = 5_000
# A length guard that some of the test addresses exceed.
URL_GUARD = 48


# --- star frames ---------------------------------------------------------------------

def star(spark: SparkSession, sf_dir: str, latest_only: bool = False) -> dict[str, DataFrame]:
    return star_frames(t.product_views(spark, sf_dir), Staging(spark), latest_only)


def shipped_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return star_frames(t.shipped_views(spark, sf_dir), Staging(spark))


def _dimension(name: str) -> Query:
    build = getattr(dimensions, name)

    def query(spark, sf_dir):
        return build(t.product_views(spark, sf_dir), Staging(spark)).drop("created_date")
    return query


def dim_date(spark, sf_dir):
    return dimensions.dim_date(dimensions.event_dates(t.product_views(spark, sf_dir)))


def dim_referrer_shipped(spark, sf_dir):
    return shipped_star(spark, sf_dir)["dim_referrer"].drop("created_date")


def dim_device_agents(spark, sf_dir):
    """Devices with the families of the user agent each one sent last."""
    views = t.product_views(spark, sf_dir).join(t.user_agents(spark, sf_dir), "event_id")
    # Event numbers stand in for times, which repeat.
    timed = views.withColumn("local_time", F.lpad(F.col("event_id").cast("string"), 20, "0"))
    return dimensions.dim_device(timed, Staging(spark)).drop("created_date")


def fact_spread_lookup(spark, sf_dir):
    """Every lookup takes the shuffle way, as for dimensions too large to broadcast."""
    staging = Staging(spark)
    grain = staging.table(facts.view_grain(t.product_views(spark, sf_dir)), "grain")
    dims = {table: dimensions.dimension(grain, natural, staging)
            for natural, (table, _) in NATURAL_KEYS.items()}
    return facts.fact_from_grain(grain, dims, broadcast_bytes=-1)


def fact_missing_members(spark, sf_dir):
    """The fact where two dimensions lack members."""
    staging = Staging(spark)
    views = t.product_views(spark, sf_dir)
    known = {
        "device_id": views.filter(F.col("local_time") < t.SECOND_BATCH),
        "referrer_url": views.filter(F.col("referrer_url").contains("g")),
    }
    dims = {table: dimensions.dimension(known.get(natural, views), natural, staging)
            for natural, (table, _) in NATURAL_KEYS.items()}
    dims["dim_date"] = dimensions.dim_date(dimensions.event_dates(views))
    return facts.fact_by_lookup(staging.table(facts.view_grain(views), "grain"), dims)


def fact_hash_keys(spark, sf_dir):
    """The fact without lookups; the hashed keys themselves show as null or not."""
    fact = facts.fact_from_hash_keys(facts.view_grain(t.product_views(spark, sf_dir)))
    return fact.select(
        *[c for c in fact.columns if c not in FACT_KEYS[1:]],
        *[F.col(f"{name}_key").isNull().alias(f"no_{name}")
          for name in ("product", "country", "referrer", "device")])


def fact_key(spark, sf_dir):
    staging = Staging(spark)
    grain = facts.keyed_grain(
        facts.view_grain(t.product_views(spark, sf_dir)), staging)
    dims = {table: dimensions.dimension(grain, natural, staging)
            for natural, (table, _) in NATURAL_KEYS.items()}
    return facts.fact_from_grain(grain, dims).select("fact_key", *FACT_KEYS)


# --- reports -------------------------------------------------------------------------

def _views_by_date_product(latest_only=False, with_distinct=False) -> Query:
    def query(spark, sf_dir):
        s = star(spark, sf_dir, latest_only)
        return marts.views_by_date_product(s["fact_product_views"], s["dim_date"],
                                           s["dim_product"], with_distinct)
    return query


def _top_countries(latest_only=False) -> Query:
    def query(spark, sf_dir):
        s = star(spark, sf_dir, latest_only)
        return marts.top_countries(s["fact_product_views"], s["dim_country"])
    return query


def _traffic_sources(latest_only=False) -> Query:
    def query(spark, sf_dir):
        s = star(spark, sf_dir, latest_only)
        return marts.traffic_sources(s["fact_product_views"], s["dim_referrer"])
    return query


def traffic_sources_shipped(spark, sf_dir):
    s = shipped_star(spark, sf_dir)
    return marts.traffic_sources(s["fact_product_views"], s["dim_referrer"])


def traffic_sources_approximate(spark, sf_dir):
    """Whether the sketched device counts lie within four standard errors."""
    s = star(spark, sf_dir)
    args = s["fact_product_views"], s["dim_referrer"]
    group = ["referrer_type", "referrer_domain"]
    rough = marts.traffic_sources(*args, approximate=True).select(
        *group, "total_views", F.col("unique_devices").alias("rough"))
    error = F.abs(F.col("rough") - F.col("unique_devices"))
    return rough.join(marts.traffic_sources(*args).drop("total_views"), group).select(
        *group, "total_views", (error <= 0.2 * F.col("unique_devices") + 1).alias("close"))


# --- sources and ingest --------------------------------------------------------------

def src_empty(spark, sf_dir):
    """Runs over events that no row passes leave a built star as it was, replace or not."""
    warehouse = Staging(spark).path("warehouse")
    events = as_text(t.product_views(spark, sf_dir).select(*EVENT_FIELDS))
    build_star(events, warehouse, latest_only=False)
    for none in (events.filter("product_id = 'none'"), empty_events(spark)):
        build_star(none, warehouse, latest_only=False)
        build_star(none, warehouse, replace=True)
    return natural_fact(spark, warehouse)


def ingest_bounded(spark, sf_dir):
    return ingest.first_messages(t.envelope(spark, sf_dir), CAP, Staging(spark)).select(
        *ingest.POSITION)


def ingest_resume(spark, sf_dir):
    return ingest.next_positions(
        ingest.first_messages(t.envelope(spark, sf_dir), CAP, Staging(spark)))


def ingest_capped_runs(spark, sf_dir):
    """What three capped runs land: each goes on where the one before ended."""
    path = Staging(spark).path("landing")
    for _ in range(3):
        land_next(t.envelope(spark, sf_dir), path, CAP // 5)
    return landing_table(spark, path).select(*ingest.POSITION)


def ingest_capped_to_the_end(spark, sf_dir):
    """Capped runs until nothing is left, and once more, land each message once."""
    path = Staging(configure(spark)).path("landing")
    messages = t.messages(spark, sf_dir)
    while land_next(messages, path, CAP)["messages"]:
        pass
    land_next(messages, path, CAP)
    return landing_table(spark, path).select("partition", "offset", "route")


def bridge_capped_runs(spark, sf_dir):
    """What three capped runs of the bridge pass on."""
    staging = Staging(configure(spark))
    sent, dead, ledger = (staging.path(name) for name in ("sent", "dead", "ledger"))
    for _ in range(3):
        bridge_next(t.envelope(spark, sf_dir), to_folder(sent), to_folder(dead), ledger,
                    CAP // 5)
    return spark.read.schema(FORWARDED).parquet(f"{sent}/*").select(*ingest.POSITION)


def landing_compacted(spark, sf_dir):
    """Twelve small batches, rewritten twice while they came."""
    path = Staging(configure(spark)).path("landing")
    messages = t.messages(spark, sf_dir)
    for part in range(12):
        land_batch(messages.filter(F.col("offset") % 12 == part), path)
        if part % 6 == 5:
            compact(spark, path, folders_per_date=4)
    return landing_table(spark, path).select("partition", "offset", "route")


def dump_scan(spark, sf_dir):
    """The stored documents, exported with wrapped ids and numbers, and read back."""
    staging = Staging(spark)
    landing, path = staging.path("landing"), staging.path("dump")
    land_batch(t.envelope(spark, sf_dir), landing)
    stored = stored_documents(landing_table(spark, landing))
    number = F.struct(F.col("device_id").alias("$numberLong"))
    stored.select(F.to_json(F.struct(
        F.struct(F.col("_id").alias("$oid")).alias("_id"), *EVENT_FIELDS[:4],
        F.when(F.col("device_id").isNotNull(), number).alias("device_id"), "json"))).write.text(path)
    return as_text(collection_dump(spark, path).select("_id", *EVENT_FIELDS))


def landing_scan(spark, sf_dir):
    path = Staging(spark).path("landing")
    land_batch(t.envelope(spark, sf_dir), path)
    return events_of(landing_table(spark, path)).select(*EVENT_FIELDS)


def landing_latest(spark, sf_dir):
    """The events of the report date, read off the folders of the landing table."""
    path = Staging(spark).path("landing")
    land_batch(t.envelope(spark, sf_dir), path)
    return facts.on_report_date(
        events_of(landing_table(spark, path)),
        day=latest_landed_day(spark, path)).select(*EVENT_FIELDS)


def landing_ids(spark, sf_dir):
    """The document ids of landed messages."""
    path = Staging(spark).path("landing")
    land_batch(t.envelope(spark, sf_dir), path)
    return landing_table(spark, path).select("_id", *ingest.POSITION)


def landing_counts(spark, sf_dir):
    """What a bounded run says of its messages, per route."""
    counts = land_batch(t.messages(configure(spark), sf_dir), Staging(spark).path("landing"))
    return spark.createDataFrame(
        [(k, n) for k, n in counts.items() if k != "messages"], "route string, messages long")


def warehouse_scan(spark, sf_dir):
    warehouse = Staging(spark).path("warehouse")
    build_star(t.product_views(spark, sf_dir), warehouse, strict=False)
    return read_table(spark, warehouse, "dim_referrer").select("referrer_key", "referrer_url")


# --- normalisation -------------------------------------------------------------------

def norm_decode(spark, sf_dir):
    broken = F.when(F.col("event_id") % 3 == 0, F.unhex(F.lit("FF"))).otherwise(
        F.unhex(F.lit("")))
    value = F.concat(F.col("event_type").cast("binary"), broken, F.col("props").cast("binary"))
    return t.table(spark, sf_dir, "events").select("event_id",
                                                   decode_text(value).alias("text"))


def norm_nested_json(spark, sf_dir):
    events = t.table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "k int").alias("props"),
        F.array("event_type", F.col("user_id").cast("string")).alias("tags"), "event_type")
    return nested_to_json(events)


def norm_null_to_empty(spark, sf_dir):
    return as_text(t.product_views(spark, sf_dir))


def norm_union_keys(spark, sf_dir):
    frames = [t.table(spark, sf_dir, name).select(*columns) for name, columns in (
        ("events", ("event_id", "event_type")), ("pages", ("page_id", "url")),
        ("conversations", ("conv_id", "role")))]
    union = union_of_keys(frames)
    return as_text(union, union.columns)


def norm_mixed_type(spark, sf_dir):
    documents = with_document(t.mixed_products(spark, sf_dir)).select(
        "event_id", document_fields("document").alias("fields"))
    return as_text(documents.select("event_id", "fields.product_id"), ("product_id",))


def _evolved(spark, sf_dir) -> str:
    """A landing table whose documents change from batch to batch: numbers first, then the rest."""
    path = Staging(configure(spark)).path("landing")
    for kinds in ((0,), (1, 4), (2, 3, 5)):
        land_batch(t.mixed_envelope(spark, sf_dir).filter((F.col("offset") % 6).isin(*kinds)),
                   path)
    return path


def norm_evolving_keys(spark, sf_dir):
    """Every value of a key that changed its type twice, and a key that came late."""
    landed = landed_documents(spark, _evolved(spark, sf_dir))
    return landed.select(
        F.col("offset").alias("event_id"),
        F.try_variant_get("fields.product_id", "$", "string").alias("product_id"),
        F.try_variant_get("fields.product_id", "$", "bigint").alias("whole_product_id"),
        F.col("fields.k").alias("k"))


def norm_key_registry(spark, sf_dir):
    """The registry after all batches."""
    found = key_registry(spark, _evolved(spark, sf_dir))
    return spark.createDataFrame(list(found.items()), "key string, type string")


def norm_discover(spark, sf_dir):
    """The schema that covers all documents of mixed shape."""
    return document_schema(with_document(t.mixed_products(spark, sf_dir)), "document")


def route_json(spark, sf_dir):
    return ingest.routed(t.messages(configure(spark), sf_dir)).select(
        "partition", "offset", "route")


def route_outcomes(spark, sf_dir):
    return ingest.route_counts(ingest.routed(t.messages(configure(spark), sf_dir)))


# --- predicates ----------------------------------------------------------------------

def filter_valid_date(spark, sf_dir):
    return facts.with_valid_date(t.times(spark, sf_dir)).select(
        "event_id", event_date("local_time").alias("date"))


def report_date_fallback(spark, sf_dir):
    """No event has a date: the report date is the given day."""
    none = t.times(spark, sf_dir).filter(event_date("local_time").isNull())
    return facts.report_date(none, F.lit("2024-06-30").cast("date"))


def seeded_report_date(spark, sf_dir):
    """Short forms count as their date; dates far ahead are no report date."""
    return facts.on_report_date(t.seeded_views(spark, sf_dir)).select("event_id", "local_time")


def seeded_landing_report_date(spark, sf_dir):
    """The same over a landing table."""
    path = Staging(spark).path("landing")
    land_batch(t.seeded_envelope(spark, sf_dir), path)
    landed = facts.on_report_date(
        events_of(landing_table(spark, path)), day=latest_landed_day(spark, path))
    return landed.select(*EVENT_FIELDS)


# --- URL and user-agent functions ----------------------------------------------------

def url_countries(spark, sf_dir):
    return t.country_urls(spark, sf_dir).select("page_id", url_country("url").alias("country"))


def ua_browser(spark, sf_dir):
    agents = t.user_agents(spark, sf_dir).withColumn(
        "user_agent", F.coalesce("user_agent", F.lit("")))
    return with_families(agents, Staging(spark)).select("event_id", "browser")


def ua_os(spark, sf_dir):
    return with_families(t.user_agents(spark, sf_dir), Staging(spark), system="os").select(
        "event_id", "os")


def ua_products(spark, sf_dir):
    """Rarer agents: bots, applications, clients, old systems."""
    return with_families(t.rare_agents(spark, sf_dir), Staging(spark)).select(
        "event_id", "browser", "system")


def ua_spread(spark, sf_dir):
    """The same families where the distinct agents are too many to be broadcast."""
    agents = t.rare_agents(spark, sf_dir)
    return with_families(agents, Staging(spark), broadcast_bytes=0).select(
        "event_id", "browser", "system")


# --- keys ----------------------------------------------------------------------------

def _order_members(spark, sf_dir):
    return t.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("natural_key")).distinct()


def key_dense(spark, sf_dir):
    return dense_keys(_order_members(spark, sf_dir), "natural_key", "key", Staging(spark))


def key_dense_within(spark, sf_dir):
    lines = t.table(spark, sf_dir, "lineitem").select(
        "l_shipdate", "l_orderkey", "l_linenumber")
    return number_rows(lines, ["l_orderkey", "l_linenumber"], "number", Staging(spark),
                       within=["l_shipdate"])


def key_hash(spark, sf_dir):
    """Each member with the number of members that share its key, which must be one."""
    keyed = hash_keys(_order_members(spark, sf_dir), "natural_key", "key")
    quality.strict(hash_collisions(keyed, "key"), "hash key")
    shared = keyed.groupBy("key").agg(F.count("*").alias("members"))
    return keyed.join(shared, "key").select("natural_key", "members")


def key_incremental(spark, sf_dir):
    staging = Staging(spark)
    views = t.product_views(spark, sf_dir)
    first = views.filter((F.col("local_time") < t.SECOND_BATCH) & (F.col("product_id") == "1"))
    stored = staging.table(
        dense_keys(distinct_members(first, "referrer_url"), "referrer_url", "referrer_key",
                   staging), "stored")
    new = incremental_keys(stored, distinct_members(views, "referrer_url"), "referrer_url",
                           "referrer_key", staging)
    return stored.unionByName(new)


# --- constraints ---------------------------------------------------------------------

def chk_unique(spark, sf_dir):
    return quality.duplicate_keys(t.broken_fact(spark, sf_dir),
                                  ["date_key", "product_key", "country_key", "device_key"])


def chk_not_null(spark, sf_dir):
    return quality.null_rows(t.broken_fact(spark, sf_dir), ["date_key", "product_key"]).select(
        "event_id", "date_key", "product_key")


def chk_fk(spark, sf_dir):
    lines = t.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") != 7, F.col("l_suppkey")).alias("suppkey"))
    known = t.table(spark, sf_dir, "supplier").filter("s_nationkey <> 7").select(
        F.col("s_suppkey").alias("suppkey"))
    return quality.orphan_rows(lines, known, "suppkey", Staging(spark)).select(
        "l_orderkey", "l_linenumber", "suppkey")


def chk_length(spark, sf_dir):
    documents = t.table(spark, sf_dir, "documents")
    return quality.long_rows(documents, "text", 255).select(
        "doc_id", F.char_length("text").cast("bigint").alias("length"))


def chk_narrowing(spark, sf_dir):
    rows = t.broken_fact(spark, sf_dir)
    broken = [
        quality.narrowing_rows(rows, column, data_type).select(
            "event_id", F.lit(column).alias("column_name"))
        for column, data_type in (("view_count", "int"), ("price", "decimal(10,2)"))]
    return broken[0].unionByName(broken[1])


def chk_url_guard(spark, sf_dir):
    pages = t.table(spark, sf_dir, "pages").select("page_id", "url")
    kept, long = quality.guard_length(pages, "url", URL_GUARD)
    return (kept.withColumn("quarantined", F.lit(False))
            .unionByName(long.withColumn("quarantined", F.lit(True)))
            .select("page_id", "quarantined"))


def chk_row_violations(spark, sf_dir):
    _, rejected = quality.split_by_constraints(
        t.broken_fact(spark, sf_dir).drop("price"), FACT_PRODUCT_VIEWS)
    return rejected.select("event_id", F.concat_ws("; ", "violations").alias("broken"))


def align_defaults(spark, sf_dir):
    products = dimensions.dim_product(t.product_views(spark, sf_dir), Staging(spark))
    return quality.align(products, DIM_PRODUCT).drop("created_date", "updated_at")


def align_fact(spark, sf_dir):
    fact = star(spark, sf_dir)["fact_product_views"]
    return quality.align(fact, FACT_PRODUCT_VIEWS).drop("fact_key", "processed_at")


# --- whole jobs ----------------------------------------------------------------------

def natural_fact(spark: SparkSession, warehouse: str) -> DataFrame:
    """The stored fact with natural keys in place of surrogate ones."""
    tables = read_star(spark, warehouse)
    fact = tables["fact_product_views"].join(
        tables["dim_date"].select("date_key", "date"), "date_key")
    for natural, (table, key) in NATURAL_KEYS.items():
        fact = fact.join(tables[table].select(key, natural), key, "left")
    return fact.select(
        "date", *NATURAL_KEYS, F.col("view_count").cast("bigint").alias("view_count"),
        F.col("unique_visitors").cast("bigint").alias("unique_visitors"), "last_view_time",
        "first_view_time", "avg_view_timestamp",
        F.col("view_duration_seconds").cast("bigint").alias("view_duration_seconds"))


def write_partition_overwrite(spark, sf_dir):
    """Two runs, the second with late events and new members; other dates stay."""
    warehouse = Staging(spark).path("warehouse")
    events = as_text(t.product_views(spark, sf_dir).select(*EVENT_FIELDS))
    early = events.filter(F.col("local_time") < t.SECOND_BATCH)
    build_star(early.filter("product_id <> '3'"), warehouse, latest_only=False)
    late = early.filter("product_id = '3'").select(event_date("local_time").alias("_day"))
    days = late.distinct()
    touched = early.join(days, event_date("local_time") == F.col("_day"), "left_semi")
    build_star(touched, warehouse, latest_only=False)
    build_star(events.filter(F.col("local_time") >= t.SECOND_BATCH), warehouse,
               latest_only=False)
    return natural_fact(spark, warehouse)


def write_replace(spark, sf_dir):
    """A run that empties the warehouse leaves nothing of the run before it."""
    warehouse = Staging(spark).path("warehouse")
    events = as_text(t.product_views(spark, sf_dir).select(*EVENT_FIELDS))
    build_star(events.filter("product_id <> '3'"), warehouse, latest_only=False)
    build_star(events, warehouse, latest_only=False, replace=True)
    return natural_fact(spark, warehouse)


def write_bucketed_dimensions(spark, sf_dir):
    """Two runs that write their dimensions in many buckets, not as many in both."""
    warehouse = Staging(spark).path("warehouse")
    events = as_text(t.product_views(spark, sf_dir).select(*EVENT_FIELDS))
    early = F.col("local_time") < t.SECOND_BATCH
    build_star(events.filter(early), warehouse, latest_only=False, bucket_members=4)
    build_star(events.filter(~early), warehouse, latest_only=False, bucket_members=2)
    return natural_fact(spark, warehouse)


def devices_between(spark, sf_dir):
    """Distinct devices per product over ten dates from kept sketches, held against the fact.

    Two runs keep the sketches; ``devices`` is the exact count, ``close`` says whether the
    estimate is within three standard errors.
    """
    warehouse = Staging(spark).path("warehouse")
    events = t.product_views(spark, sf_dir)
    first, last = datetime.date(2024, 1, 6), datetime.date(2024, 1, 15)
    for part in (F.col("local_time") < t.SECOND_BATCH, F.col("local_time") >= t.SECOND_BATCH):
        build_star(events.filter(part), warehouse, latest_only=False, strict=False, sketches=True)
    star = read_star(spark, warehouse)
    exact = star["fact_product_views"].filter(F.col("date_key").between(20240106, 20240115)).join(
        star["dim_product"].select("product_key", "product_id"), "product_key").groupBy(
        "product_id").agg(F.count_distinct("device_key").alias("devices"))
    rough = distinct_devices(read_sketches(spark, warehouse, first, last), star["dim_product"],
                             "dim_product", "product_id")
    error = F.abs(F.col("distinct_devices") - F.col("devices"))
    return exact.join(rough, "product_id").select(
        "product_id", "devices",
        (error <= 3 * sketches.ERROR * F.col("devices") + 1).alias("close"))


class Stopped(Exception):
    """A run that was stopped on purpose."""


def write_interrupted(spark, sf_dir):
    """Runs that are stopped before any of their steps leave the star as it was."""
    warehouse = Staging(spark).path("warehouse")
    events = as_text(t.product_views(spark, sf_dir).select(*EVENT_FIELDS))
    build_star(events, warehouse, latest_only=False)

    def stop_before(step: str):
        def before(name: str) -> None:
            if name == step:
                raise Stopped(name)
        return before

    for replace in (True, False):
        for step in ("members", "dim_device", "fact_product_views", "commit"):
            # New members, so that every dimension is written again.
            changed = events.filter("product_id = '1'").select("local_time", *[
                F.concat(name, F.lit("x")).alias(name) for name in NATURAL_KEYS])
            with contextlib.suppress(Stopped):
                build_star(changed, warehouse, latest_only=False, replace=replace,
                           before=stop_before(step))
                raise AssertionError(f"the run did not stop before {step}")
    return natural_fact(spark, warehouse)


def write_two_runs(spark, sf_dir):
    """Two runs at a time: one commits first, the other builds on it; keys stay unique."""
    warehouse = Staging(spark).path("warehouse")
    events = as_text(t.product_views(spark, sf_dir).select(*EVENT_FIELDS))
    parts = [events.filter(F.col("local_time") < t.SECOND_BATCH),
             events.filter(F.col("local_time") >= t.SECOND_BATCH)]
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda part: build_star(part, warehouse, latest_only=False), parts))
    verify_star(read_star(spark, warehouse), TABLES, Staging(spark))
    return natural_fact(spark, warehouse)


def write_seeded_dates(spark, sf_dir):
    """A strict run over the last date there is, dates beyond, short forms and garbage."""
    warehouse = Staging(spark).path("warehouse")
    events = as_text(t.seeded_views(spark, sf_dir).select(*EVENT_FIELDS))
    build_star(events, warehouse, latest_only=False, replace=True)
    return natural_fact(spark, warehouse)


def write_undated(spark, sf_dir):
    """The groups that a run sets aside because they have no date."""
    warehouse = Staging(spark).path("warehouse")
    events = as_text(t.seeded_views(spark, sf_dir).select(*EVENT_FIELDS))
    build_star(events, warehouse, latest_only=False, hash_keys=True)
    return spark.read.parquet(f"{warehouse}/quarantine/undated_views").select(
        *NATURAL_KEYS, "views")


def write_user_agents(spark, sf_dir):
    """Devices of a built star, with the families of the agents that came through landing."""
    staging = Staging(spark)
    path, warehouse = staging.path("landing"), staging.path("warehouse")
    land_batch(t.agent_envelope(spark, sf_dir), path)
    build_star(events_of(landing_table(spark, path)), warehouse, latest_only=False)
    return read_table(spark, warehouse, "dim_device").select(
        "device_id", "browser_info", "os_info")


def write_hash_keys(spark, sf_dir):
    """Two runs with hashed keys."""
    warehouse = Staging(spark).path("warehouse")
    events = as_text(t.product_views(spark, sf_dir).select(*EVENT_FIELDS))
    for part in (F.col("local_time") < t.SECOND_BATCH, F.col("local_time") >= t.SECOND_BATCH):
        build_star(events.filter(part), warehouse, latest_only=False, hash_keys=True)
    return natural_fact(spark, warehouse)


def _message_stream(spark, messages: DataFrame, staging: Staging) -> DataFrame:
    path = staging.path("messages")
    messages.write.parquet(path)
    return spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", 4).parquet(path)


def _bridge(spark, messages: DataFrame) -> tuple[str, str]:
    staging = Staging(configure(spark))
    sent, dead = staging.path("sent"), staging.path("dead")
    start_bridge(_message_stream(spark, messages, staging), to_folder(sent), to_folder(dead),
                 staging.path("checkpoint")).awaitTermination()
    return sent, dead


FORWARDED = T.StructType([
    T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()), T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType())])


def stream_bridge(spark, sf_dir):
    sent, _ = _bridge(spark, t.envelope(spark, sf_dir))
    messages = spark.read.schema(FORWARDED).parquet(f"{sent}/*")
    fields = event_fields(decode_text("value"), F.lit(True))
    return messages.select(*ingest.POSITION, fields.alias("f")).select(
        *ingest.POSITION, *[F.col("f")[name].alias(name) for name in EVENT_FIELDS])


def stream_dead_letters(spark, sf_dir):
    _, dead = _bridge(spark, t.messages(spark, sf_dir))
    return spark.read.schema(FORWARDED).parquet(f"{dead}/*").select("partition", "offset")


def _land(spark, messages: DataFrame) -> str:
    staging = Staging(configure(spark))
    path = staging.path("landing")
    start_landing(_message_stream(spark, messages, staging), path,
                  staging.path("checkpoint")).awaitTermination()
    return path


def stream_landing(spark, sf_dir):
    landed = landing_table(spark, _land(spark, t.envelope(spark, sf_dir)))
    return landed.select(*ingest.POSITION, "route", *EVENT_FIELDS, "event_date")


def stream_resume(spark, sf_dir):
    """Messages that come after a stop are taken up where the checkpoint left off, once."""
    staging = Staging(configure(spark))
    source, path = staging.path("messages"), staging.path("landing")
    checkpoint = staging.path("checkpoint")
    messages = t.messages(spark, sf_dir)
    for part in (F.col("offset") % 3 == 0, F.col("offset") % 3 != 0):
        messages.filter(part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", 4)
        start_landing(stream.parquet(source), path, checkpoint).awaitTermination()
    return landing_table(spark, path).select("partition", "offset", "route")


def stream_outcomes(spark, sf_dir):
    """Messages per route as the listener counted them over all batches of a stream."""
    with counted(spark) as total:
        _land(spark, t.messages(spark, sf_dir))
    return spark.createDataFrame(
        [(k, n) for k, n in total.items() if k != "messages"], "route string, messages long")


def stream_landing_mixed(spark, sf_dir):
    return landing_table(spark, _land(spark, t.messages(spark, sf_dir))).select(
        "partition", "offset", "route")


def stream_star_refresh(spark, sf_dir):
    staging = Staging(spark)
    landing = _land(spark, t.envelope(spark, sf_dir))
    warehouse = staging.path("warehouse")
    start_star_refresh(spark, landing, warehouse, staging.path("checkpoint")
                       ).awaitTermination()
    return natural_fact(spark, warehouse)


def stream_refresh_late(spark, sf_dir):
    """Batches that touch every date again and again: each is merged with the kept views."""
    staging = Staging(configure(spark))
    landing, warehouse = staging.path("landing"), staging.path("warehouse")
    checkpoint = staging.path("checkpoint")
    for part in range(3):
        land_batch(t.envelope(spark, sf_dir).filter(F.col("offset") % 3 == part), landing)
        start_star_refresh(spark, landing, warehouse, checkpoint,
                           versions_per_trigger=1).awaitTermination()
    return natural_fact(spark, warehouse)


def stream_refresh_violations(spark, sf_dir):
    """A stream with products that are too long: they are set aside and the rest goes on."""
    staging = Staging(configure(spark))
    landing, warehouse = staging.path("landing"), staging.path("warehouse")
    land_batch(t.long_envelope(spark, sf_dir), landing)
    start_star_refresh(spark, landing, warehouse, staging.path("checkpoint")
                       ).awaitTermination()
    return natural_fact(spark, warehouse)


def queries() -> dict[str, Query]:
    return {
        # sources and ingest
        "src_empty": src_empty,
        "ingest_bounded": ingest_bounded,
        "ingest_resume": ingest_resume,
        "ingest_capped_runs": ingest_capped_runs,
        "ingest_capped_to_the_end": ingest_capped_to_the_end,
        "bridge_capped_runs": bridge_capped_runs,
        "landing_compacted": landing_compacted,
        "topic_counts": lambda s, d: ingest.topic_counts(t.envelope(s, d)),
        "dump_scan": dump_scan,
        "landing_scan": landing_scan,
        "landing_latest": landing_latest,
        "landing_ids": landing_ids,
        "landing_counts": landing_counts,
        "warehouse_scan": warehouse_scan,
        # normalisation
        "norm_decode": norm_decode,
        "norm_nested_json": norm_nested_json,
        "norm_null_to_empty": norm_null_to_empty,
        "norm_union_keys": norm_union_keys,
        "norm_mixed_type": norm_mixed_type,
        "norm_discover": norm_discover,
        "norm_evolving_keys": norm_evolving_keys,
        "norm_key_registry": norm_key_registry,
        "route_json": route_json,
        "route_outcomes": route_outcomes,
        # predicates and the report date
        "filter_valid_date": filter_valid_date,
        "undated_events": lambda s, d: facts.undated(t.times(s, d)),
        "report_date": lambda s, d: facts.report_date(t.times(s, d)),
        "report_date_fallback": report_date_fallback,
        "seeded_report_date": seeded_report_date,
        "seeded_landing_report_date": seeded_landing_report_date,
        "filter_report_date": lambda s, d: facts.on_report_date(t.product_views(s, d)).select(
            "event_id", "local_time"),
        # dimensions
        "dim_date": dim_date,
        "dim_product": _dimension("dim_product"),
        "dim_country": _dimension("dim_country"),
        "dim_referrer": _dimension("dim_referrer"),
        "dim_device": _dimension("dim_device"),
        "dim_device_agents": dim_device_agents,
        "dim_referrer_shipped": dim_referrer_shipped,
        # facts
        "fact_latest": lambda s, d: star(s, d, latest_only=True)["fact_product_views"],
        "fact_all_dates": lambda s, d: star(s, d)["fact_product_views"],
        "fact_shipped": lambda s, d: shipped_star(s, d)["fact_product_views"],
        "fact_spread_lookup": fact_spread_lookup,
        "fact_missing_members": fact_missing_members,
        "fact_hash_keys": fact_hash_keys,
        "fact_key": fact_key,
        # reports
        "views_by_date_product": _views_by_date_product(),
        "views_by_date_product_distinct": _views_by_date_product(with_distinct=True),
        "views_by_date_product_latest": _views_by_date_product(latest_only=True),
        "top_countries": _top_countries(),
        "top_countries_latest": _top_countries(latest_only=True),
        "traffic_sources": _traffic_sources(),
        "traffic_sources_latest": _traffic_sources(latest_only=True),
        "traffic_sources_shipped": traffic_sources_shipped,
        "traffic_sources_approximate": traffic_sources_approximate,
        "devices_between": devices_between,
        "row_counts": lambda s, d: marts.row_counts(star(s, d)),
        # URL and user-agent functions
        "url_country": url_countries,
        "ua_browser": ua_browser,
        "ua_os": ua_os,
        "ua_products": ua_products,
        "ua_spread": ua_spread,
        # keys
        "key_dense": key_dense,
        "key_dense_within": key_dense_within,
        "key_hash": key_hash,
        "key_incremental": key_incremental,
        # constraints
        "chk_unique": chk_unique,
        "chk_not_null": chk_not_null,
        "chk_fk": chk_fk,
        "chk_length": chk_length,
        "chk_narrowing": chk_narrowing,
        "chk_url_guard": chk_url_guard,
        "chk_row_violations": chk_row_violations,
        "align_defaults": align_defaults,
        "align_fact": align_fact,
        # whole jobs
        "write_partition_overwrite": write_partition_overwrite,
        "write_replace": write_replace,
        "write_bucketed_dimensions": write_bucketed_dimensions,
        "write_interrupted": write_interrupted,
        "write_two_runs": write_two_runs,
        "write_hash_keys": write_hash_keys,
        "write_seeded_dates": write_seeded_dates,
        "write_undated": write_undated,
        "write_user_agents": write_user_agents,
        "stream_bridge": stream_bridge,
        "stream_dead_letters": stream_dead_letters,
        "stream_landing": stream_landing,
        "stream_resume": stream_resume,
        "stream_outcomes": stream_outcomes,
        "stream_landing_mixed": stream_landing_mixed,
        "stream_star_refresh": stream_star_refresh,
        "stream_refresh_late": stream_refresh_late,
        "stream_refresh_violations": stream_refresh_violations,
    }
