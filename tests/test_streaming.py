import json

import pytest
from pyspark.sql import functions as F

from viewstar.operators.facts import on_report_date
from viewstar.operators.ingest import (
    first_messages, landed, last_offsets, next_positions, route_counts, topic_counts, up_to)
from viewstar.plans.star import build_star
from viewstar.schemas import ENVELOPE
from viewstar.sinks.documents import stored_documents
from viewstar.sources.landing import (
    events_of, landing_table, latest_landed_day, of_dates)
from viewstar.sources.warehouse import read_table
from viewstar.streaming import landing
from viewstar.streaming.bridge import bridge_batch, bridge_next, start_bridge, to_folder
from viewstar.streaming.landing import (
    append, compact, land_batch, land_next, start_landing)
from viewstar.streaming.outcomes import OutcomeListener, counted
from viewstar.streaming.refresh import start_star_refresh
from viewstar.versions import Conflict, Versions

from test_star import FIRST, LATE, SECOND, contents, verify, views

FIELDS = ("local_time", "product_id", "store_id", "referrer_url", "device_id")


def message(row, offset, partition=0):
    value = row if isinstance(row, bytes) else json.dumps(dict(zip(FIELDS, row))).encode()
    return (None, bytearray(value), "t", partition, offset, None, 0)


class Topic:
    """A folder of envelope files, read as a stream of one file per batch."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.sent = spark, str(folder), 0

    def send(self, rows):
        made = [message(row, self.sent + i) for i, row in enumerate(rows)]
        self.sent += len(made)
        self.spark.createDataFrame(made, ENVELOPE).coalesce(1).write.mode("append").parquet(
            self.folder)

    def stream(self):
        return (self.spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", 1)
                .parquet(self.folder))

    def table(self):
        return self.spark.read.schema(ENVELOPE).parquet(self.folder)


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


def run(query):
    query.awaitTermination()
    return query


def test_bridge_passes_json_once(spark, tmp_path, topic):
    def bridge():
        return run(start_bridge(topic.stream(), to_folder(str(tmp_path / "sent")),
                                to_folder(str(tmp_path / "dead")), str(tmp_path / "ck")))

    topic.send([FIRST[0], b"nope", b"[1, 2]"])
    topic.send([b"null"])
    bridge()
    bridge()
    sent = spark.read.parquet(str(tmp_path / "sent") + "/*").orderBy("offset").collect()
    dead = spark.read.parquet(str(tmp_path / "dead") + "/*").collect()
    assert [json.loads(bytes(r.value)) for r in sent] == [
        dict(zip(FIELDS, FIRST[0])), [1, 2], None]
    assert [r.key for r in sent] == [None] * 3
    assert [(r.offset, bytes(r.value)) for r in dead] == [(1, b"nope")]
    topic.send([SECOND[0]])
    bridge()
    assert spark.read.parquet(str(tmp_path / "sent") + "/*").count() == 4


def test_landing_equals_batch_and_restarts_clean(spark, tmp_path, topic):
    path, batch = str(tmp_path / "landing"), str(tmp_path / "batch")
    topic.send([*FIRST, b"nope"])
    topic.send([*SECOND, b"5"])
    with counted(spark) as total:
        run(start_landing(topic.stream(), path, str(tmp_path / "ck")))
    assert total == {"messages": 7, "doc": 5, "raw": 1, "error": 1}
    run(start_landing(topic.stream(), path, str(tmp_path / "ck")))
    assert land_batch(topic.table(), batch) == total
    got, want = (sorted(map(str, landing_table(spark, p).drop("document").collect()))
                 for p in (path, batch))
    assert got == want and len(got) == 7
    assert {r.route: r.messages for r in route_counts(landing_table(spark, path)).collect()
            } == {"doc": 5, "raw": 1, "error": 1}


def test_listener_counts_over_restarts(spark, tmp_path, topic):
    listener = OutcomeListener()
    spark.streams.addListener(listener)
    try:
        topic.send(FIRST)
        run(start_landing(topic.stream(), str(tmp_path / "l"), str(tmp_path / "ck")))
        topic.send([b"nope"])
        run(start_landing(topic.stream(), str(tmp_path / "l"), str(tmp_path / "ck")))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    assert dict(listener.total) == {"messages": 4, "doc": 3, "raw": 1, "error": 0}
    assert listener.failed == []


def test_landing_scan_prunes(spark, tmp_path, topic, plan):
    topic.send([*FIRST, *SECOND, b"nope"])
    path = str(tmp_path / "landing")
    land_batch(topic.table(), path)
    landing = landing_table(spark, path)
    days = [r[0] for r in landing.select("event_date").distinct().collect() if r[0]]
    one = events_of(of_dates(landing, [min(days)]))
    text = plan(one)
    assert "event_date" in text.split("PartitionFilters: ")[1].split("]")[0]
    assert "document" not in text and "text" not in text.split("ReadSchema")[1]
    assert one.count() == 2
    day = latest_landed_day(spark, path)
    assert day == max(days)
    report = on_report_date(events_of(landing), day=day)
    text = plan(report)
    # One scan, of one folder, and no subquery over the others.
    assert text.count("FileScan") == 1 and "ubquery" not in text
    assert str(day) in text.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert sorted(tuple(r) for r in report.select(*FIELDS).collect()) == sorted(SECOND)


def test_documents_to_store(spark, topic):
    topic.send([b"nope", b"5", b'{"a": 1}'])
    topic.send([FIRST[0]])
    stored = {r._id: r.asDict() for r in stored_documents(landed(topic.table())).collect()}
    got = {k: (r["raw"], r["json"] and json.loads(r["json"])) for k, r in stored.items()}
    assert got == {"t-0-0": ("nope", None), "t-0-2": (None, {"a": 1}),
                   "t-0-3": (None, dict(zip(FIELDS, FIRST[0])))}
    # The fields stand where the store's reader looks for them.
    assert tuple(stored["t-0-3"][f] for f in FIELDS) == FIRST[0]


def test_raw_documents_count_as_empty_events(spark, topic):
    topic.send([b"nope", b"5", FIRST[0]])
    rows = events_of(landed(topic.table())).select(*FIELDS).collect()
    got = sorted(tuple(r) for r in rows)
    assert got == [("",) * 5, FIRST[0]]
    nulls = events_of(landed(topic.table()), keep_nulls=True)
    assert sum(r.product_id is None for r in nulls.collect()) == 1


def test_star_refresh_equals_one_batch(spark, tmp_path, topic, events):
    landing, warehouse = str(tmp_path / "landing"), str(tmp_path / "warehouse")

    def refresh():
        run(start_landing(topic.stream(), landing, str(tmp_path / "ck1")))
        run(start_star_refresh(spark, landing, warehouse, str(tmp_path / "ck2"),
                               versions_per_trigger=1, strict=True))

    topic.send(FIRST)
    refresh()
    assert views(spark, warehouse) == [(20240101, 2), (20240102, 1)]
    topic.send(SECOND)
    topic.send([LATE])
    refresh()
    assert views(spark, warehouse) == [(20240101, 1), (20240101, 2), (20240102, 1),
                                       (20240103, 1), (20240103, 1)]
    verify(spark, warehouse)
    before = contents(spark, warehouse)
    refresh()
    assert contents(spark, warehouse) == before
    build_star(events([*FIRST, *SECOND, LATE]), str(tmp_path / "other"), latest_only=False)
    assert views(spark, str(tmp_path / "other")) == views(spark, warehouse)


def test_refresh_sets_undated_rows_aside(spark, tmp_path, topic):
    landing, warehouse = str(tmp_path / "landing"), str(tmp_path / "warehouse")
    topic.send([FIRST[0], b"nope"])
    run(start_landing(topic.stream(), landing, str(tmp_path / "ck1")))
    run(start_star_refresh(spark, landing, warehouse, str(tmp_path / "ck2")))
    assert views(spark, warehouse) == [(20240101, 1)]
    rejected = spark.read.parquet(f"{warehouse}/quarantine/undated_views").collect()
    assert [r.views for r in rejected] == [1] and rejected[0].batch.endswith("-0")


def test_poison_message_does_not_stop_a_strict_refresh(spark, tmp_path, topic):
    landing, warehouse = str(tmp_path / "landing"), str(tmp_path / "warehouse")
    for sent in ([b"nope", FIRST[0]], [("9999-12-31", "p", "s", "r", "d")],
                 [("300000-1-1", "p", "s", "r", "d"), FIRST[2]]):
        topic.send(sent)
        run(start_landing(topic.stream(), landing, str(tmp_path / "ck1")))
        run(start_star_refresh(spark, landing, warehouse, str(tmp_path / "ck2"), strict=True))
    assert views(spark, warehouse) == [(20240101, 1), (20240102, 1), (99991231, 1)]


def test_counts_over_more_batches_than_a_query_remembers(spark, tmp_path, topic):
    limit = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(limit, "3")
    try:
        for row in [*FIRST, *SECOND, b"nope", LATE]:
            topic.send([row])
        with counted(spark) as total:
            query = run(start_landing(topic.stream(), str(tmp_path / "l"), str(tmp_path / "c")))
    finally:
        spark.conf.unset(limit)
    assert len(query.recentProgress) <= 3
    assert total == {"messages": 7, "doc": 6, "raw": 1, "error": 0}


def test_bridge_counts_and_keeps_dead_letters_of_every_run(spark, tmp_path, topic):
    def bridge(checkpoint):
        with counted(spark) as total:
            run(start_bridge(topic.stream(), to_folder(str(tmp_path / "sent")),
                             to_folder(str(tmp_path / "dead")), str(tmp_path / checkpoint)))
        return dict(total)

    topic.send([FIRST[0], b"nope"])
    assert bridge("one") == {"messages": 2, "valid": 1, "dead": 1}
    bridge("two")
    assert spark.read.parquet(str(tmp_path / "dead") + "/*").count() == 2
    done = bridge_batch(topic.table(), to_folder(str(tmp_path / "sent")),
                        to_folder(str(tmp_path / "dead")))
    assert done == {"messages": 2, "valid": 1, "dead": 1}
    assert spark.read.parquet(str(tmp_path / "dead") + "/*").count() == 3


def test_files_and_tasks_of_a_date_grow_with_its_rows(spark, tmp_path):
    from glob import glob
    rows = [message((f"2024-01-{1 + n % 5:02d}T00:00:00", "p", "s", "r", "d"), n)
            for n in range(400)]
    frame = spark.createDataFrame(rows, ENVELOPE).repartition(32)
    land_batch(frame, str(tmp_path / "l"))
    for day in range(1, 6):
        files = glob(f"{tmp_path}/l/landing/run=*/event_date=2024-01-{day:02d}/*.parquet")
        assert len(files) == 1
    # One date of many rows, against a small advised size: as many files as its size asks for.
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k"}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        counts = []
        for size in (2_000, 16_000):
            one = [message(("2024-02-01T00:00:00", f"{n:0200d}", "s", "r", "d"), n)
                   for n in range(size)]
            path = tmp_path / f"one{size}"
            land_batch(spark.createDataFrame(one, ENVELOPE).repartition(32), str(path))
            counts.append(len(glob(f"{path}/landing/run=*/event_date=*/*.parquet")))
    finally:
        for name in conf:
            spark.conf.unset(name)
    assert counts[1] >= 3 * counts[0] and counts[1] > 8


def test_user_agents_reach_the_built_star(spark, tmp_path, topic):
    chrome = "Mozilla/5.0 (Windows NT 10.0) AppleWebKit/537.36 Chrome/120.0.0.0 Safari/537.36"
    topic.send([json.dumps(dict(zip(FIELDS, row)) | {"user_agent": agent}).encode()
                for row, agent in ((FIRST[0], "curl/8.0"), (FIRST[1], chrome),
                                   (FIRST[2], "no known product"))] + [SECOND[0]])
    path, warehouse = str(tmp_path / "l"), str(tmp_path / "w")
    land_batch(topic.table(), path)
    build_star(events_of(landing_table(spark, path)), warehouse, latest_only=False)
    got = {r.device_id: (r.browser_info, r.os_info)
           for r in read_table(spark, warehouse, "dim_device").collect()}
    assert got == {"d1": ("Chrome", "Windows"), "d2": ("Other", "Other"),
                   "d0": ("unknown", "unknown")}


@pytest.mark.parametrize("gap", [1, 2, 37, 5000])
def test_bounded_read_over_gaps(spark, staging, gap):
    """Offsets with gaps that grow: compaction leaves such partitions."""
    offsets = [n + gap * (n // 7) ** 2 for n in range(200)]
    messages = spark.createDataFrame(
        [message(b"1", o, p) for p in (0, 4) for o in offsets], ENVELOPE).repartition(3)
    for cap in (1, 3, 8, 100, 199, 200, 201, 333, 400, 1000):
        got = sorted((r.partition, r.offset)
                     for r in first_messages(messages, cap, staging).collect())
        assert got == [(p, o) for p in (0, 4) for o in offsets][:cap]


def test_bounded_read_does_not_move_messages(spark, staging, tmp_path, plan):
    rows = [message(b"x", offset) for offset in range(50)]
    spark.createDataFrame(rows, ENVELOPE).write.parquet(str(tmp_path / "m"))
    text = plan(first_messages(spark.read.parquet(str(tmp_path / "m")), 20, staging))
    assert "Exchange hashpartitioning" not in text and "rangepartitioning" not in text


def test_capped_runs_stay_small(spark, tmp_path, plan):
    """A run asks for its messages by plain bounds, in few jobs, however many runs there are."""
    source, path = str(tmp_path / "m"), str(tmp_path / "landing")
    spark.createDataFrame([message(b"1", n) for n in range(60)], ENVELOPE).write.parquet(source)
    messages = spark.read.parquet(source)
    text = plan(up_to(messages, {"t/0": 7}))
    assert "Join" not in text and "Exchange" not in text
    one = messages.withColumn("topic", F.lit("t")).withColumn("partition", F.lit(0))
    assert "LessThanOrEqual(offset,7)" in plan(up_to(one, {"t/0": 7}))
    for run in range(3):
        spark.sparkContext.setJobGroup(f"capped-{path}-{run}", "")
        assert land_next(messages, path, 20)["messages"] == 20
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"capped-{path}-{run}")
        assert len(jobs) <= 8
    spark.sparkContext.setJobGroup("", "")
    assert land_next(messages, path, 20)["messages"] == 0
    assert landed_offsets(spark, path) == [(0, n) for n in range(60)]


def test_short_runs_do_not_count_all_positions(spark, tmp_path, monkeypatch):
    """Within a partition a run reads the offsets it lands, in few jobs, and no other positions."""
    source, path = str(tmp_path / "m"), str(tmp_path / "landing")
    spark.createDataFrame([message(b"1", n, p) for p in (0, 1) for n in range(60)],
                          ENVELOPE).write.parquet(source)
    messages = spark.read.parquet(source)
    land_next(messages, path, 20)
    with monkeypatch.context() as patch:
        patch.setattr(landing, "last_offsets", None)
        for run in range(2):
            spark.sparkContext.setJobGroup(f"short-{path}-{run}", "")
            assert land_next(messages, path, 20)["messages"] == 20
            jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"short-{path}-{run}")
            assert len(jobs) <= 4
    spark.sparkContext.setJobGroup("", "")
    # The next partition is not known yet, so positions are counted; and it is one version.
    assert land_next(messages, path, 20)["messages"] == 20
    assert land_next(messages, path, 50)["messages"] == 40
    assert land_next(messages, path, 50)["messages"] == 0
    assert Versions(spark, path).latest().number == 5
    assert landed_offsets(spark, path) == [(p, n) for p in (0, 1) for n in range(60)]


def brute_run(rows, held, cap):
    """The rows of a capped run in plain Python, and the positions after it."""
    def place(row):
        return row[2] is not None, row[2] or "", row[3] is not None, row[3] or 0, row[4]
    unread_rows = sorted((r for r in rows if r[4] >= held.get((r[2], r[3]), 0)), key=place)
    last = {(r[2], r[3]): r[4] for r in unread_rows[:cap] if None not in r[2:4]}
    return ([r for r in unread_rows if r[4] <= last.get((r[2], r[3]), -1)],
            held | {name: offset + 1 for name, offset in last.items()})


@pytest.mark.parametrize("odd", [False, True])
def test_capped_runs_against_brute_force(spark, tmp_path, odd):
    """Gaps, repeated offsets, topics of odd names, messages that come late to early partitions."""
    path = str(tmp_path / "landing")

    def rows_of(topic, partition, offsets):
        return [(*message(b'{"a": 1}', n)[:2], topic, partition, n, *message(b"1", n)[5:])
                for n in offsets]
    rows = [*rows_of("a/b", 0, range(9)), *rows_of("a/b", 2, [0, 1, 4, 5, 6, 50, 51, 52, 53]),
            *rows_of("it's", 1, [0, 0, 1, 2, 3, 3, 3, 4, 5, 6, 7, 8])]
    late = [*rows_of("a/b", 0, range(9, 12)), *rows_of("a/b", 1, range(3))]
    odd_rows = [*rows_of(None, 0, [3]), *rows_of("a/b", None, [1])] if odd else []
    rows += odd_rows
    held, landed_rows = {}, []
    frame = spark.createDataFrame(rows, ENVELOPE)
    for run, cap in enumerate((3, 3, 3, 4, 4, 5, 4, 4, 4, 4, 30, 30)):
        if run == 6:
            rows += late
            frame = spark.createDataFrame(rows, ENVELOPE)
            # The version before the last one may be gone.
            Versions(spark, path).vacuum(keep=1, hours=-1)
        want, held = brute_run(rows, held, cap)
        landed_rows += want
        counts = land_next(frame, path, cap)
        assert counts == {"messages": len(want), "doc": len(want), "raw": 0, "error": 0}
        got = landing_table(spark, path).select("topic", "partition", "offset").collect()
        assert sorted(map(tuple, got)) == sorted(r[2:5] for r in landed_rows)
        assert Versions(spark, path).latest().ledger["positions"] == {
            f"{topic}/{partition}": end for (topic, partition), end in held.items()}
    assert len(landed_rows) == len(rows) - len(odd_rows)


def test_positions_without_topic_or_partition_do_not_land(spark, staging):
    rows = [message(b"1", 0), message(b"1", 1)]
    odd = [(*rows[0][:2], None, *rows[0][3:]), (*rows[0][:3], None, *rows[0][4:])]
    messages = spark.createDataFrame([*rows, *odd], ENVELOPE)
    assert last_offsets(messages, 10, staging) == {"t/0": 1}
    assert up_to(messages, {"t/0": 1}).count() == 2


def test_bounded_read(spark, staging):
    rows = [message(b"1", offset * 3, partition) for partition in range(3)
            for offset in range(10)]
    messages = spark.createDataFrame(rows, ENVELOPE).repartition(4)
    for cap in (0, 1, 10, 14, 30, 50):
        got = sorted((r.partition, r.offset)
                     for r in first_messages(messages, cap, staging).collect())
        assert got == sorted((r[3], r[4]) for r in rows)[:cap]
    taken = first_messages(messages, 14, staging)
    assert {r.partition: r.next_offset for r in next_positions(taken).collect()} == {
        0: 28, 1: 10}
    assert sorted(map(tuple, topic_counts(messages).collect())) == [
        ("t", p, 10, 0, 27) for p in range(3)]


def landed_offsets(spark, path):
    return sorted((r.partition, r.offset) for r in landing_table(spark, path).collect())


def test_capped_runs_land_each_message_once(spark, tmp_path, topic):
    path = str(tmp_path / "landing")
    topic.send([*FIRST, b"nope", *SECOND])
    assert land_next(topic.table(), path, 4) == {"messages": 4, "doc": 3, "raw": 1, "error": 0}
    assert landed_offsets(spark, path) == [(0, n) for n in range(4)]
    assert land_next(topic.table(), path, 4)["messages"] == 2
    assert land_next(topic.table(), path, 4)["messages"] == 0
    topic.send([LATE])
    assert land_next(topic.table(), path, 4)["messages"] == 1
    assert landed_offsets(spark, path) == [(0, n) for n in range(7)]
    assert land_next(topic.table(), str(tmp_path / "other"), 3, {0: 5})["messages"] == 2


def test_capped_run_that_fails_lands_nothing_and_is_repeated(spark, tmp_path, topic,
                                                             monkeypatch):
    path = str(tmp_path / "landing")
    topic.send([*FIRST])
    topic.send([*SECOND])
    land_next(topic.table(), path, 2)

    def refuse(self, name, text):
        raise OSError("no space")
    with monkeypatch.context() as patch:
        patch.setattr(Versions, "_create", refuse)
        with pytest.raises(OSError):
            land_next(topic.table(), path, 2)
    assert landed_offsets(spark, path) == [(0, 0), (0, 1)]
    land_next(topic.table(), path, 2)
    assert landed_offsets(spark, path) == [(0, n) for n in range(4)]
    # A run that was overtaken at the same position does not commit.
    with pytest.raises(Conflict):
        append(landed(topic.table()), path, {"positions": {"t/0": (2, 5)}})
    assert landed_offsets(spark, path) == [(0, n) for n in range(4)]


def test_capped_bridge_goes_on_and_repeats_what_it_could_not_note(spark, tmp_path, topic,
                                                                  monkeypatch):
    sent, dead, ledger = (str(tmp_path / n) for n in ("sent", "dead", "ledger"))

    def bridge():
        return bridge_next(topic.table(), to_folder(sent), to_folder(dead), ledger, 2)
    topic.send([FIRST[0], b"nope", FIRST[1]])
    with monkeypatch.context() as patch:
        patch.setattr(Versions, "_create", lambda *_: False)
        with pytest.raises(Conflict):
            bridge()
    assert bridge() == {"messages": 2, "valid": 1, "dead": 1}
    assert bridge() == {"messages": 1, "valid": 1, "dead": 0}
    assert bridge()["messages"] == 0
    # The dead letters of the repeated run replaced its own.
    assert spark.read.parquet(f"{dead}/*").count() == 1


def test_landing_batch_of_a_stream_is_taken_once(spark, tmp_path, topic):
    path = str(tmp_path / "landing")
    topic.send(FIRST)
    rows = landed(topic.table())
    for batch in (0, 0, 1, 0):
        append(rows, path, {"batches": {"stream": batch}})
    assert landing_table(spark, path).count() == 6
    append(rows, path, {"batches": {"another": 0}})
    assert landing_table(spark, path).count() == 9


def test_compaction_bounds_folders_and_loses_nothing(spark, tmp_path, topic):
    path = str(tmp_path / "landing")
    versions = Versions(spark, path)
    for n in range(24):
        rows = [message(FIRST[0], 2 * n), message(FIRST[2], 2 * n + 1)]
        land_batch(spark.createDataFrame(rows, ENVELOPE), path)
        if n % 6 == 5:
            assert compact(spark, path, 4) == ["2024-01-01", "2024-01-02"]
        assert max(map(len, versions.latest().partitions("landing").values())) <= 6
    assert landed_offsets(spark, path) == [(0, n) for n in range(48)]
    # A reader of an old version still finds its files; vacuum takes them later.
    old = versions.at(3)
    assert landing_table(spark, path, old).count() == 6
    assert versions.vacuum(keep=1) == []
    assert versions.vacuum(keep=1, hours=-1) != []
    assert landed_offsets(spark, path) == [(0, n) for n in range(48)]
    assert versions.numbers() == [versions.latest().number]


def test_compaction_beside_an_append_and_beside_another(spark, tmp_path, topic, monkeypatch):
    path = str(tmp_path / "landing")
    topic.send([FIRST[0]])
    for _ in range(3):
        land_batch(topic.table(), path)
    commit = Versions.commit_with

    def meanwhile(action):
        def overtaken(self, change):
            monkeypatch.setattr(Versions, "commit_with", commit)
            action()
            return commit(self, change)
        monkeypatch.setattr(Versions, "commit_with", overtaken)

    meanwhile(lambda: land_batch(topic.table(), path))
    compact(spark, path, 2)
    assert landing_table(spark, path).count() == 4
    meanwhile(lambda: compact(spark, path, 1))
    with pytest.raises(Conflict):
        compact(spark, path, 1)
    assert landing_table(spark, path).count() == 4


def test_followers_see_no_compacted_rows_twice(spark, tmp_path, topic):
    landing, warehouse = str(tmp_path / "landing"), str(tmp_path / "warehouse")

    def refresh():
        run(start_star_refresh(spark, landing, warehouse, str(tmp_path / "ck")))
    for row in FIRST:
        topic.send([row])
        land_batch(topic.table().filter(f"offset = {topic.sent - 1}"), landing)
    refresh()
    compact(spark, landing, 1)
    refresh()
    assert views(spark, warehouse) == [(20240101, 2), (20240102, 1)]


def test_late_event_reads_its_batch_and_kept_views_only(spark, tmp_path, topic, monkeypatch):
    """Neither the events of the date nor other dates' views are read again."""
    from viewstar.streaming import refresh as module
    landing, warehouse = str(tmp_path / "landing"), str(tmp_path / "warehouse")

    def refresh():
        run(start_star_refresh(spark, landing, warehouse, str(tmp_path / "ck")))
    topic.send([*FIRST, *SECOND])
    run(start_landing(topic.stream(), landing, str(tmp_path / "ck1")))
    refresh()
    folders = []
    read = Versions.read

    def noted(self, table, schema, names):
        folders.append((table, names))
        return read(self, table, schema, names)
    monkeypatch.setattr(Versions, "read", noted)
    monkeypatch.setattr(module, "landing_table", None)
    topic.send([LATE])
    run(start_landing(topic.stream(), landing, str(tmp_path / "ck1")))
    refresh()
    kept = [names for table, names in folders if table == "view_grain"]
    assert [[n.rpartition("/")[2] for n in names] for names in kept] == [["date_key=20240101"]]
    assert [len(names) for table, names in folders if table == "landing"] == [1]
    assert views(spark, warehouse) == [(20240101, 1), (20240101, 2), (20240102, 1),
                                       (20240103, 1), (20240103, 1)]


def test_refresh_of_a_star_that_a_batch_built(spark, tmp_path, topic):
    """Dates without kept views are combined once from all their events."""
    landing, warehouse = str(tmp_path / "landing"), str(tmp_path / "warehouse")

    def land_and_refresh(rows):
        topic.send(rows)
        run(start_landing(topic.stream(), landing, str(tmp_path / "ck1")))
        run(start_star_refresh(spark, landing, warehouse, str(tmp_path / "ck2")))
    land_and_refresh(FIRST)
    build_star(events_of(landing_table(spark, landing)), warehouse, latest_only=False)
    land_and_refresh([LATE, *SECOND])
    land_and_refresh([LATE])
    assert views(spark, warehouse) == [(20240101, 2), (20240101, 2), (20240102, 1),
                                       (20240103, 1), (20240103, 1)]
    verify(spark, warehouse)


def test_repeated_refresh_batch_changes_nothing(spark, tmp_path, topic):
    from viewstar.plans.star import merge_star
    warehouse = str(tmp_path / "warehouse")
    topic.send(FIRST)
    rows = events_of(landed(topic.table()))
    for batch, want in ((0, 2), (0, 2), (1, 4), (0, 4)):
        merge_star(rows, warehouse, "stream", batch, None)
        assert views(spark, warehouse)[0] == (20240101, want)


def test_violation_does_not_stop_a_refresh(spark, tmp_path, topic):
    landing, warehouse = str(tmp_path / "landing"), str(tmp_path / "warehouse")
    bad = ("2024-01-01T10:00:00", "x" * 400, "s1", "direct", "d1")
    for sent in ([FIRST[0], bad], [FIRST[1]], [bad, FIRST[2]]):
        topic.send(sent)
        run(start_landing(topic.stream(), landing, str(tmp_path / "ck1")))
        run(start_star_refresh(spark, landing, warehouse, str(tmp_path / "ck2")))
    assert views(spark, warehouse) == [(20240101, 2), (20240102, 1)]
    assert spark.read.parquet(f"{warehouse}/quarantine/dim_product").count() == 3
    with pytest.raises(Exception, match="too long"):
        run(start_star_refresh(spark, landing, str(tmp_path / "w2"), str(tmp_path / "ck3"),
                               strict=True))


@pytest.mark.parametrize("by_shuffle", [False, True])
def test_refresh_moves_views_once(spark, tmp_path, topic, monkeypatch, by_shuffle):
    """A batch's events meet the kept views in one shuffle, without a table of their own, and rows
    that lie by date are written where they are; those that a lookup moved are gathered."""
    import functools

    from viewstar.operators.facts import fact_from_grain
    from viewstar.plans import star
    from viewstar.staging import Staging

    hints, tables, frame = [], [], type(spark.range(1))
    hint, table = frame.hint, Staging.table
    monkeypatch.setattr(frame, "hint", lambda self, *args: (
        hints.append(args), hint(self, *args))[1])
    monkeypatch.setattr(Staging, "table", lambda self, df, label: (
        tables.append(label), table(self, df, label))[1])
    if by_shuffle:
        monkeypatch.setattr(star, "BROADCAST_BYTES", -1)
        monkeypatch.setattr(star, "fact_from_grain", functools.partial(
            fact_from_grain, broadcast_bytes=-1))
    landing, warehouse = str(tmp_path / "landing"), str(tmp_path / "warehouse")
    for sent in (FIRST, [LATE, *SECOND]):
        topic.send(sent)
        run(start_landing(topic.stream(), landing, str(tmp_path / "ck1")))
        run(start_star_refresh(spark, landing, warehouse, str(tmp_path / "ck2")))
    assert "members" in tables and "delta" not in tables
    assert hints.count(("rebalance", "date_key")) == (2 if by_shuffle else 0)
    whole = str(tmp_path / "whole")
    build_star(events_of(landing_table(spark, landing)), whole, latest_only=False)
    stored, built = [
        read_table(spark, path, "fact_product_views").select(
            "fact_key", "date_key", "view_count").sort("fact_key").collect()
        for path in (warehouse, whole)]
    assert stored == built
    verify(spark, warehouse)


def test_refresh_that_fails_beside_the_kept_views_leaves_nothing(spark, tmp_path, topic,
                                                                 monkeypatch):
    """The kept views are written beside other steps: none of them stays if another fails."""
    from viewstar.plans import star
    landing, warehouse = str(tmp_path / "landing"), str(tmp_path / "warehouse")

    def fails(*_):
        raise OSError("disk")
    monkeypatch.setattr(star, "write_fact", fails)
    topic.send(FIRST)
    run(start_landing(topic.stream(), landing, str(tmp_path / "ck1")))
    with pytest.raises(Exception, match="disk"):
        run(start_star_refresh(spark, landing, warehouse, str(tmp_path / "ck2")))
    assert not list((tmp_path / "warehouse").glob("*/run=*"))
    monkeypatch.undo()
    run(start_star_refresh(spark, landing, warehouse, str(tmp_path / "ck2")))
    verify(spark, warehouse)
    assert len(list((tmp_path / "warehouse").glob("view_grain/run=*"))) == 1
