"""The commands, but for those that need a broker."""

import json
from glob import glob

import pytest

from test_star import FIRST, SECOND, views
from test_streaming import FIELDS, message
from viewstar import jobs
from viewstar.operators.quality import ConstraintViolation
from viewstar.schemas import ENVELOPE
from viewstar.sources.warehouse import read_star
from viewstar.streaming.landing import land_batch
from viewstar.versions import Versions


@pytest.fixture
def landing(spark, tmp_path):
    path = str(tmp_path / "landing")
    rows = [message(row, n) for n, row in enumerate([*FIRST, *SECOND, b"nope"])]
    land_batch(spark.createDataFrame(rows, ENVELOPE), path)
    return path


def run(spark, *argv):
    args = jobs.parser().parse_args(argv)
    return args.run(spark, args)


def test_star_and_reports(spark, landing, tmp_path):
    warehouse = str(tmp_path / "warehouse")
    done = run(spark, "star", "--landing", landing, "--warehouse", warehouse, "--all-dates",
               "--quarantine", "--batch-id", "b")
    assert done.written["fact_product_views"] == 4
    assert done.rejected["undated_views"] == 1 and done.rejected["fact_product_views"] == 0
    assert views(spark, warehouse) == [(20240101, 2), (20240102, 1), (20240103, 1),
                                       (20240103, 1)]
    counts = {r.table_name: r["count"]
              for r in jobs.report(spark, warehouse, "row_counts").collect()}
    # The text that was no JSON is a stored document with empty fields.
    assert counts == {"dim_date": 3, "dim_product": 4, "dim_country": 3, "dim_referrer": 3,
                      "dim_device": 4, "fact_product_views": 4}
    out = str(tmp_path / "out")
    run(spark, "report", "--warehouse", warehouse, "--name", "traffic_sources",
        "--output", out)
    rows = [tuple(r) for r in spark.read.parquet(out).orderBy("referrer_domain", "referrer_type"
                                                              ).collect()]
    assert rows == [("Direct", "", 2, 2), ("Other", "", 1, 1), ("Other", "a.b", 2, 1)]
    run(spark, "audit", "--warehouse", warehouse)
    for name in ("views_by_date_product", "top_countries"):
        assert jobs.report(spark, warehouse, name).count() > 0


def test_latest_date_is_the_default(spark, landing, tmp_path):
    warehouse = str(tmp_path / "warehouse")
    run(spark, "star", "--landing", landing, "--warehouse", warehouse, "--hash-keys")
    assert views(spark, warehouse) == [(20240103, 1), (20240103, 1)]


def test_report_prints_every_row(spark, landing, tmp_path, capsys):
    warehouse = str(tmp_path / "warehouse")
    run(spark, "star", "--landing", landing, "--warehouse", warehouse, "--all-dates")
    run(spark, "report", "--warehouse", warehouse, "--name", "row_counts")
    printed = capsys.readouterr().out.strip().splitlines()
    assert printed[0] == "table_name\tcount" and len(printed) == 7


def test_audit_finds_a_member_stored_twice(spark, landing, tmp_path):
    warehouse = str(tmp_path / "warehouse")
    run(spark, "star", "--landing", landing, "--warehouse", warehouse, "--all-dates")
    folder, = Versions(spark, warehouse).latest().folders("dim_country")
    path, = glob(f"{warehouse}/{folder}/buckets=*/bucket=*")
    spark.read.parquet(path).limit(1).write.mode("append").parquet(path)
    # A build that meets the member fails before it writes, the audit in any case.
    with pytest.raises(ConstraintViolation, match="stored twice"):
        run(spark, "star", "--landing", landing, "--warehouse", warehouse, "--all-dates")
    with pytest.raises(ConstraintViolation):
        run(spark, "audit", "--warehouse", warehouse)


def test_database_and_store_commands():
    export = jobs.parser().parse_args(
        ["export", "--warehouse", "w", "--url", "jdbc:x", "--jdbc", "user=u",
         "--connections", "4"])
    assert (export.run, dict(export.jdbc), export.connections) == (
        jobs.run_export, {"user": "u"}, 4)
    store = jobs.parser().parse_args(
        ["store", "--landing", "l", "--uri", "u", "--database", "d", "--collection", "c"])
    assert store.run is jobs.run_store
    capped = jobs.parser().parse_args(
        ["bridge", "--from-topic", "a", "--to-topic", "b", "--dead-letters", "d",
         "--checkpoint", "c", "--at-most", "100000", "--start", "0=5", "--start", "2=7"])
    assert (capped.at_most, dict(capped.start)) == (100_000, {0: 5, 2: 7})


def test_options_that_do_not_go_together():
    land = ["land", "--topic", "t", "--landing", "l", "--checkpoint", "c", "--at-most", "5"]
    assert jobs.parsed(land).at_most == 5
    for more in (["--every", "1 minute"], ["--per-trigger", "7"]):
        with pytest.raises(SystemExit):
            jobs.parsed(land + more)
    star = ["star", "--warehouse", "w"]
    for more in ([], ["--uri", "u"], ["--uri", "u", "--landing", "l"]):
        with pytest.raises(SystemExit):
            jobs.parsed(star + more)
    assert jobs.parsed(star + ["--uri", "u", "--database", "d", "--collection", "c"]).uri == "u"
    refresh = jobs.parsed(["refresh", "--landing", "l", "--warehouse", "w", "--checkpoint", "c"])
    assert refresh.strict is False


def test_star_and_report_from_servers_ask_for_the_right_tables(spark, events, monkeypatch,
                                                               tmp_path):
    """What is asked of the connectors; nothing is contacted."""
    warehouse, asked = str(tmp_path / "warehouse"), {}
    monkeypatch.setattr(jobs, "document_store", lambda s, *where: (
        asked.update(store=where), events(FIRST))[1])
    run(spark, "star", "--uri", "u", "--database", "d", "--collection", "c", "--warehouse",
        warehouse, "--all-dates")
    assert asked["store"] == ("u", "d", "c")
    star = read_star(spark, warehouse)

    def table(s, **options):
        asked[options["table"]] = (options["url"], options["properties"])
        return star[options["table"].removeprefix("public.")]
    monkeypatch.setattr("viewstar.sources.warehouse.read_jdbc_table", table)
    run(spark, "report", "--url", "jdbc:x", "--jdbc", "user=me", "--name", "row_counts")
    assert asked["public.fact_product_views"] == ("jdbc:x", {"user": "me"})


def test_compact_and_vacuum(spark, landing):
    run(spark, "compact", "--landing", landing)
    assert run(spark, "vacuum", "--folder", landing) == []


def test_stream_options():
    args = jobs.parser().parse_args([
        "land", "--topic", "t", "--landing", "l", "--checkpoint", "c", "--kafka",
        "kafka.bootstrap.servers=a:1", "--kafka", "kafka.sasl.jaas.config=x=y"])
    assert dict(args.kafka) == {"kafka.bootstrap.servers": "a:1",
                                "kafka.sasl.jaas.config": "x=y"}
    assert jobs._trigger(args) == {"availableNow": True}
    args.every = "1 minute"
    assert jobs._trigger(args) == {"processingTime": "1 minute"}
    assert json.loads(bytes(message(FIRST[0], 0)[1])) == dict(zip(FIELDS, FIRST[0]))
