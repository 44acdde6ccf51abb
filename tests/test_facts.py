import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from viewstar.operators import dimensions, facts
from viewstar.plans.star import star_frames
from viewstar.schemas import FACT_KEYS, NATURAL_KEYS


@pytest.fixture(scope="module")
def rows():
    """A third of all rows share every key; some fields are null, empty or late."""
    random.seed(11)
    start = datetime(2024, 3, 1)
    made = []
    for n in range(3000):
        time = (start + timedelta(seconds=random.randrange(4 * 86400))).isoformat()
        if n % 3 == 0:
            made.append((time[:10] + "T12:00:00", "p", "s", "https://google.com/", "d"))
        else:
            made.append((time, random.choice(["p", "q", "", None]),
                         random.choice(["s", "t", None]),
                         random.choice(["direct", "", None, "http://a.b/c"]),
                         random.choice(["d", "e", "f", None])))
    return made


def brute_force(rows):
    groups = defaultdict(list)
    for time, *naturals in rows:
        groups[(time[:10], *naturals)].append(datetime.fromisoformat(time))
    epoch = datetime(1970, 1, 1)
    return {
        key: (len(times), 0 if key[4] is None else 1, min(times), max(times),
              int((max(times) - min(times)).total_seconds()),
              sum((t - epoch).total_seconds() for t in times) / len(times))
        for key, times in groups.items()
    }


def with_naturals(star):
    fact = star["fact_product_views"].join(star["dim_date"], "date_key", "left")
    for natural, (table, key) in NATURAL_KEYS.items():
        fact = fact.join(star[table].select(key, natural), key, "left")
    return {
        (str(r.date), *[r[n] for n in NATURAL_KEYS]): (
            r.view_count, r.unique_visitors, r.first_view_time, r.last_view_time,
            r.view_duration_seconds, r.avg_view_timestamp)
        for r in fact.collect()
    }


def test_fact_equals_brute_force(staging, events, rows):
    assert with_naturals(star_frames(events(rows), staging)) == brute_force(rows)


def test_row_order_does_not_matter(staging, events, rows):
    shuffled = rows[:]
    random.Random(3).shuffle(shuffled)
    one = star_frames(events(rows), staging)
    two = star_frames(events(shuffled).repartition(13), staging)
    for name in one:
        drop = [c for c in ("created_date",) if c in one[name].columns]
        assert one[name].drop(*drop).exceptAll(two[name].drop(*drop)).isEmpty()
        assert one[name].count() == two[name].count()


def test_views_add_up_per_date(staging, events, rows):
    fact = star_frames(events(rows), staging)["fact_product_views"]
    totals = {r.date_key: r.n for r in fact.groupBy("date_key").agg(
        F.sum("view_count").alias("n")).collect()}
    want = defaultdict(int)
    for row in rows:
        want[int(row[0][:10].replace("-", ""))] += 1
    assert totals == dict(want)


def test_latest_date_only_with_all_members(staging, events, rows):
    star = star_frames(events(rows), staging, latest_only=True)
    last = max(row[0][:10] for row in rows)
    want = {k: v for k, v in brute_force(rows).items() if k[0] == last}
    assert with_naturals(star) == want
    assert star["dim_date"].count() == 4
    assert star["dim_device"].count() == 3


@pytest.mark.parametrize("limit", [1 << 30, -1])
def test_lookup_ways_agree(staging, events, rows, limit):
    grain = staging.table(facts.view_grain(events(rows)), "grain")
    dims = {table: staging.table(dimensions.dimension(grain, natural, staging), table)
            for natural, (table, _) in NATURAL_KEYS.items()}
    dims["dim_date"] = dimensions.dim_date(dimensions.event_dates(events(rows)))
    plain = facts.fact_from_grain(grain, dims, broadcast_bytes=limit)
    merged = facts.fact_by_lookup(grain, dims, broadcast_bytes=limit).select(*plain.columns)
    assert plain.count() == merged.count() == len(brute_force(rows))
    assert plain.exceptAll(merged).isEmpty()


def test_shuffle_lookups_move_keys_instead_of_texts(staging, events, rows, plan):
    """Small dimensions are looked up first, and no text goes on after its lookup."""
    grain = staging.table(facts.view_grain(events(rows)), "grain")
    dims = {table: staging.table(dimensions.dimension(grain, natural, staging), table)
            for natural, (table, _) in NATURAL_KEYS.items()}
    sizes = {table: 0 for table, _ in NATURAL_KEYS.values()} | {"dim_product": 2, "dim_device": 3}
    fact = facts.fact_from_grain(grain, dims, sizes, broadcast_bytes=1)
    moved = [line for line in plan(fact).splitlines() if " AS _on#" in line]
    # The device is looked up last: by then product and referrer are keys.
    assert len(moved) == 2 and "device_id#" in moved[0] and "product_key#" in moved[0]
    assert not any("referrer_url#" in line.partition("Project")[2] for line in moved)
    assert [name for name in facts.with_surrogate_keys(grain, dims, sizes, 1).columns
            if name in NATURAL_KEYS] == []


def test_groups_merge_where_members_are_missing(staging, events):
    df = events([("2024-01-01T00:00:10", "p", "s", "a", "d"),
                 ("2024-01-01T00:00:20", "p", "s", "b", "d"),
                 ("2024-01-01T00:00:30", "p", "s", "b", "e")])
    grain = staging.table(facts.view_grain(df), "grain")
    dims = {table: dimensions.dimension(df, natural, staging)
            for natural, (table, _) in NATURAL_KEYS.items()}
    dims["dim_date"] = dimensions.dim_date(dimensions.event_dates(df))
    for table in ("dim_referrer", "dim_device"):
        dims[table] = dims[table].limit(0)
    row = facts.fact_by_lookup(grain, dims).collect()
    assert [(r.referrer_key, r.device_key, r.view_count, r.unique_visitors,
             r.avg_view_timestamp, r.view_duration_seconds) for r in row] == [
        (None, None, 3, 2, 1704067220.0, 20)]


def test_undated_events_keep_their_views(staging, events):
    df = events([("garbage", "p", "s", "r", "d"), ("2024-01-01T25:00:00", "p", "s", "r", "d")])
    fact = star_frames(df, staging)["fact_product_views"].collect()
    assert sorted((r.date_key or 0, r.view_count, r.first_view_time, r.avg_view_timestamp,
                   r.view_duration_seconds) for r in fact) == [
        (0, 1, None, None, None), (20240101, 1, None, None, None)]
    assert [r.local_time for r in facts.undated(df).collect()] == ["garbage"]


def test_report_date(events, spark):
    def of(*texts):
        return facts.report_date(events([(x, *[None] * 4) for x in texts]),
                                 F.lit("2030-05-05").cast("date")).first()[0]
    assert of("2024-01-07T10:00:00", "2024-01-06 23:00:00", "zzz", "", None) == "2024-01-07"
    assert of("", None) == of() == "2030-05-05"
    today = facts.report_date(events([])).first()[0]
    assert today == str(spark.sql("SELECT current_date()").first()[0])


SEEDED = ["2024-01-07T10:00:00", "2024-1-7", "2024-01-07", "2024-01-06", "9999-12-31T00:00:00",
          "5000-01-01T00:00:00", "300000-1-1", "garbage", "", None]


def test_one_report_date_rule(spark, events, tmp_path):
    """Short forms belong to their date; the future and what is no date do not win."""
    frame = events([(x, "p", "s", "r", "d") for x in SEEDED])
    dated = frame.withColumn("event_date", facts.event_date("local_time"))
    dated.write.partitionBy("event_date").parquet(str(tmp_path / "landed"))
    stored = spark.read.parquet(str(tmp_path / "landed"))
    want = ["2024-01-07", "2024-01-07T10:00:00", "2024-1-7"]
    assert sorted(r[0] for r in facts.on_report_date(frame).collect()) == want
    assert sorted(r.local_time for r in facts.on_report_date(stored).collect()) == want
    assert facts.report_date(frame).first()[0] == "2024-01-07"


def test_any_date_has_a_key_or_none(staging, events):
    grain = facts.keyed_grain(
        facts.view_grain(events([(x, "p", "s", "r", "d") for x in SEEDED])), staging)
    got = {(str(r.date), r.fact_key) for r in grain.select("date", "fact_key").collect()}
    assert ("9999-12-31", 99991231 * 10 ** 10 + 1) in got
    assert {key for date, key in got if date == "None"} == {None}


def test_mean_time_is_exact(events):
    late = [("2024-01-01T00:00:01", "p", "s", "r", "d")] * 3
    row = facts.view_grain(events(late)).first()
    assert row.seconds == 3 * 1704067201 and isinstance(row.seconds, int)


def test_fact_key_is_stable_under_other_dates(staging, events, rows):
    every = facts.keyed_grain(facts.view_grain(events(rows)), staging)
    one = facts.keyed_grain(facts.view_grain(events(
        [r for r in rows if r[0] >= "2024-03-02" and r[0] < "2024-03-03"])), staging)
    assert one.exceptAll(every).isEmpty() and not one.isEmpty()
    numbers = sorted(r.fact_key for r in one.collect())
    assert numbers == [20240302 * 10 ** 10 + n for n in range(1, len(numbers) + 1)]
    assert every.select("fact_key").distinct().count() == every.count()


def test_hash_fact_has_the_same_groups(staging, events, rows, plan):
    df = events(rows)
    hashed = facts.fact_from_hash_keys(facts.view_grain(df))
    dense = star_frames(df, staging)["fact_product_views"]
    measures = [c for c in dense.columns if c not in FACT_KEYS[1:]]
    assert hashed.select(measures).exceptAll(dense.select(measures)).isEmpty()
    assert hashed.count() == dense.count()
    assert plan(hashed).count("Exchange") == 1 and "Join" not in plan(hashed)


def test_raw_events_shuffle_once_and_combine_first(events, rows, plan):
    text = plan(facts.view_grain(events(rows)))
    assert text.count("Exchange") == 1
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text
    assert "EvalPython" not in text


def test_events_as_views_merge_to_the_grain(events):
    """One row per event, merged, is the grain, whatever is null, undated or not a time."""
    rows = events([
        ("2024-01-01T10:00:00", "1", "s", "direct", "d"),
        ("2024-01-01T12:00:00", "1", "s", "direct", "d"),
        ("2024-01-01 garbage", "1", "s", "direct", "d"),
        ("2024-01-02 garbage", "1", None, "", None),
        ("garbage", None, None, None, None), (None, None, None, None, None)])
    grain = facts.view_grain(rows)
    merged = facts.merged_grain(facts.event_views(rows)).select(*grain.columns)
    assert [(f.name, f.dataType) for f in merged.schema] == [
        (f.name, f.dataType) for f in grain.schema]
    assert sorted(map(str, merged.collect())) == sorted(map(str, grain.collect()))
