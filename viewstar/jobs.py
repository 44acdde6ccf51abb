"""The jobs as commands for spark-submit; master, memory and secrets come from its conf.

    spark-submit viewstar_job.py bridge --from-topic a --to-topic b --kafka brokers=… …
    spark-submit viewstar_job.py land   --topic b --landing …/landing --checkpoint …/ck
    spark-submit viewstar_job.py star   --landing …/landing --warehouse …/warehouse
    spark-submit viewstar_job.py refresh --landing … --warehouse … --checkpoint …/ck2
    spark-submit viewstar_job.py report --warehouse …/warehouse --name traffic_sources
    spark-submit viewstar_job.py devices --warehouse … --by product --from 2024-01-01 --to 2024-06-30
    spark-submit viewstar_job.py audit  --warehouse …/warehouse
    spark-submit viewstar_job.py export --warehouse …/warehouse --url jdbc:… --jdbc user=…
    spark-submit viewstar_job.py report --url jdbc:… --jdbc user=… --name top_countries
    spark-submit viewstar_job.py store  --landing …/landing --uri … --database d --collection c
    spark-submit viewstar_job.py star   --uri … --database d --collection c --warehouse …
    spark-submit viewstar_job.py keys   --landing …/landing
    spark-submit viewstar_job.py star   --dump …/events.json --warehouse …/warehouse
    spark-submit viewstar_job.py compact --landing …/landing
    spark-submit viewstar_job.py vacuum --folder …/warehouse --keep 10 --hours 48

``bridge`` and ``land`` take ``--at-most`` to stop after that many messages; the next such run goes
on where the last one ended. ``refresh`` sets rows aside that break a constraint; ``--strict`` stops at
the first.
"""

from __future__ import annotations

import argparse
import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from viewstar.functions.agents import RULE_SCHEMA, RULES, rules_of
from viewstar.functions.documents import as_text, configure
from viewstar.operators.quality import verify_star
from viewstar.operators.sketches import distinct_devices
from viewstar.plans import marts
from viewstar.plans.star import StarRun, build_star
from viewstar.schemas import TABLES
from viewstar.sinks.documents import to_document_store
from viewstar.sinks.jdbc import CONNECTIONS, write_jdbc_star
from viewstar.sources.dumps import collection_dump, dump_events
from viewstar.sources.kafka import topic_stream, topic_table
from viewstar.sources.landing import (
    document_store, events_of, key_registry, landing_table, latest_landed_day)
from viewstar.sources.warehouse import read_jdbc_star, read_sketches, read_star, read_table
from viewstar.staging import Staging
from viewstar.streaming.bridge import bridge_next, start_bridge, to_folder, to_topic
from viewstar.streaming.landing import compact, land_next, start_landing
from viewstar.streaming.outcomes import counted
from viewstar.streaming.refresh import start_star_refresh
from viewstar.versions import Versions


def run_bridge(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    options = dict(args.kafka)
    send, dead = to_topic(args.to_topic, options), to_folder(args.dead_letters)
    if args.at_most is not None:
        return bridge_next(topic_table(spark, args.from_topic, options), send, dead,
                           f"{args.checkpoint}/positions", args.at_most, dict(args.start))
    messages = topic_stream(spark, args.from_topic, options, args.per_trigger)
    with counted(spark) as total:
        start_bridge(messages, send, dead, args.checkpoint, _trigger(args)).awaitTermination()
    return dict(total)


def run_landing(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    if args.at_most is not None:
        return land_next(topic_table(spark, args.topic, dict(args.kafka)), args.landing,
                         args.at_most, dict(args.start))
    messages = topic_stream(spark, args.topic, dict(args.kafka), args.per_trigger)
    with counted(spark) as total:
        start_landing(messages, args.landing, args.checkpoint,
                      _trigger(args)).awaitTermination()
    return dict(total)


def run_compact(spark: SparkSession, args: argparse.Namespace) -> list[str]:
    return compact(spark, args.landing)


def run_keys(spark: SparkSession, args: argparse.Namespace) -> dict[str, str]:
    return key_registry(spark, args.landing)


def run_vacuum(spark: SparkSession, args: argparse.Namespace) -> list[str]:
    return Versions(spark, args.folder).vacuum(args.keep, args.hours)


def run_star(spark: SparkSession, args: argparse.Namespace) -> StarRun:
    if args.dump:
        events, day = dump_events(collection_dump(spark, args.dump)), None
    elif args.uri:
        events, day = as_text(document_store(
            spark, args.uri, args.database, args.collection)), None
    else:
        events = events_of(landing_table(spark, args.landing))
        day = None if args.all_dates else latest_landed_day(spark, args.landing)
    rules = rules_of(spark.read.json(args.agent_rules, RULE_SCHEMA)) if args.agent_rules else RULES
    return build_star(events, args.warehouse, latest_only=not args.all_dates,
                      replace=args.replace, strict=not args.quarantine,
                      hash_keys=args.hash_keys, batch_id=args.batch_id, day=day,
                      sketches=args.sketches, agent_rules=rules)


def run_audit(spark: SparkSession, args: argparse.Namespace) -> None:
    """Every key and reference of the whole warehouse; fails on the first that does not hold."""
    with Staging(spark) as staging:
        verify_star(read_star(spark, args.warehouse), TABLES, staging)


def run_export(spark: SparkSession, args: argparse.Namespace) -> None:
    write_jdbc_star(read_star(spark, args.warehouse), args.url, dict(args.jdbc), args.schema,
                    args.connections)


def run_store(spark: SparkSession, args: argparse.Namespace) -> None:
    send = to_document_store(args.uri, args.database, args.collection)
    send(landing_table(spark, args.landing), 0)


def run_refresh(spark: SparkSession, args: argparse.Namespace) -> None:
    start_star_refresh(spark, args.landing, args.warehouse, args.checkpoint,
                       strict=args.strict, trigger=_trigger(args),
                       sketches=args.sketches).awaitTermination()


def report(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    return report_of(read_star(spark, warehouse), name)


def report_of(star: dict[str, DataFrame], name: str) -> DataFrame:
    fact = star["fact_product_views"]
    reports = {
        "views_by_date_product": lambda: marts.views_by_date_product(
            fact, star["dim_date"], star["dim_product"]),
        "top_countries": lambda: marts.top_countries(fact, star["dim_country"]),
        "traffic_sources": lambda: marts.traffic_sources(fact, star["dim_referrer"]),
        "row_counts": lambda: marts.row_counts(star),
    }
    return reports[name]()


#: What distinct devices may be counted by: the dimension and its columns.
DEVICES_BY = {"product": ("dim_product", "product_id", "product_name"),
              "country": ("dim_country", "country_name", "region"),
              "referrer": ("dim_referrer", "referrer_type", "referrer_domain")}


def devices(spark: SparkSession, warehouse: str, by: str, first: datetime.date,
            last: datetime.date) -> DataFrame:
    """Distinct devices of some dates, from the sketches kept of them."""
    version = Versions(spark, warehouse).current()
    table, *columns = DEVICES_BY[by]
    return distinct_devices(read_sketches(spark, warehouse, first, last, version),
                            read_table(spark, warehouse, table, version), table, *columns)


def run_devices(spark: SparkSession, args: argparse.Namespace) -> None:
    _show(devices(spark, args.warehouse, args.by, args.first, args.last), args.output)


def run_report(spark: SparkSession, args: argparse.Namespace) -> None:
    star = (read_jdbc_star(spark, args.url, dict(args.jdbc), args.schema) if args.url
            else read_star(spark, args.warehouse))
    _show(report_of(star, args.name), args.output)


def _show(rows: DataFrame, output: str | None) -> None:
    if output:
        rows.write.mode("overwrite").parquet(output)
    else:
        print(*rows.columns, sep="\t")
        for row in rows.toLocalIterator():
            print(*row, sep="\t")


def _trigger(args: argparse.Namespace) -> dict[str, object]:
    return {"processingTime": args.every} if args.every else {"availableNow": True}


def _pair(text: str) -> tuple[str, str]:
    name, _, value = text.partition("=")
    return name, value


def _position(text: str) -> tuple[int, int]:
    partition, _, offset = text.partition("=")
    return int(partition), int(offset)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="viewstar")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name, run, required=(), flags=(), stream=False, topic=False):
        command = jobs.add_parser(name)
        command.set_defaults(run=run)
        for option in required:
            command.add_argument(f"--{option}", required=True)
        for flag in flags:
            command.add_argument(f"--{flag}", action="store_true")
        if stream:
            command.add_argument("--checkpoint", required=True)
            command.add_argument("--every", help="interval; without it the job stops at the end")
        if topic:
            command.add_argument("--kafka", type=_pair, action="append", default=[],
                                 metavar="OPTION=VALUE")
            command.add_argument("--per-trigger", type=int)
            command.add_argument("--at-most", type=int)
            command.add_argument("--start", type=_position, action="append", default=[],
                                 metavar="PARTITION=OFFSET")
        return command

    job("bridge", run_bridge, ("from-topic", "to-topic", "dead-letters"), stream=True,
        topic=True)
    job("land", run_landing, ("topic", "landing"), stream=True, topic=True)
    star = job("star", run_star, ("warehouse",),
               ("all-dates", "replace", "quarantine", "hash-keys", "sketches"))
    place = star.add_mutually_exclusive_group(required=True)
    place.add_argument("--landing")
    place.add_argument("--dump", help="files that a collection was exported to")
    place.add_argument("--uri", help="a document store, with --database and --collection")
    star.add_argument("--database")
    star.add_argument("--collection")
    star.add_argument("--batch-id")
    star.add_argument("--agent-rules", help="JSON lines of user-agent rules instead of ours")
    job("refresh", run_refresh, ("landing", "warehouse"), ("strict", "sketches"), stream=True)
    shown = job("report", run_report)
    place = shown.add_mutually_exclusive_group(required=True)
    place.add_argument("--warehouse")
    place.add_argument("--url", help="a database that export wrote to")
    shown.add_argument("--jdbc", type=_pair, action="append", default=[], metavar="OPTION=VALUE")
    shown.add_argument("--schema", default="public")
    shown.add_argument("--name", required=True, choices=(
        "views_by_date_product", "top_countries", "traffic_sources", "row_counts"))
    shown.add_argument("--output")
    counted_ = job("devices", run_devices, ("warehouse",))
    counted_.add_argument("--by", required=True, choices=tuple(DEVICES_BY))
    counted_.add_argument("--from", dest="first", type=datetime.date.fromisoformat, required=True)
    counted_.add_argument("--to", dest="last", type=datetime.date.fromisoformat, required=True)
    counted_.add_argument("--output")
    job("audit", run_audit, ("warehouse",))
    export = job("export", run_export, ("warehouse", "url"))
    export.add_argument("--jdbc", type=_pair, action="append", default=[],
                        metavar="OPTION=VALUE")
    export.add_argument("--schema", default="public")
    export.add_argument("--connections", type=int, default=CONNECTIONS)
    job("compact", run_compact, ("landing",))
    job("keys", run_keys, ("landing",))
    vacuum = job("vacuum", run_vacuum, ("folder",))
    vacuum.add_argument("--keep", type=int, default=10)
    vacuum.add_argument("--hours", type=float, default=48)
    job("store", run_store, ("landing", "uri", "database", "collection"))
    return top


def parsed(argv: Sequence[str] | None = None) -> argparse.Namespace:
    top = parser()
    args = top.parse_args(argv)
    if getattr(args, "at_most", None) is not None and (args.every or args.per_trigger):
        top.error("--at-most reads once; --every and --per-trigger are for streams")
    if getattr(args, "uri", None) and not (args.database and args.collection):
        top.error("--uri needs --database and --collection")
    return args


def main(argv: Sequence[str] | None = None) -> None:
    args = parsed(argv)
    spark = configure(SparkSession.builder.appName(f"viewstar {args.job}").getOrCreate())
    try:
        result = args.run(spark, args)
        if result is not None:
            print(result)
    finally:
        spark.stop()
