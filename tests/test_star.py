import pytest

from viewstar.functions.documents import as_text
from viewstar.operators.quality import ConstraintViolation, verify_star
from viewstar.plans.star import build_star
from viewstar.schemas import NATURAL_KEYS, TABLES
from viewstar.sources.landing import empty_events
from viewstar.sources.warehouse import read_star, read_table
from viewstar.staging import Staging
from viewstar.versions import MissingTable, Versions

FIRST = [("2024-01-01T10:00:00", "p1", "s1", "http://a.b/", "d1"),
         ("2024-01-01T11:00:00", "p1", "s1", "http://a.b/", "d1"),
         ("2024-01-02T10:00:00", "p2", "s1", "direct", "d2")]
SECOND = [("2024-01-03T10:00:00", "p0", "s1", "direct", "d0"),
          ("2024-01-03T10:00:05", "p2", "s2", "", "d2")]
LATE = ("2024-01-01T12:00:00", "p0", "s1", "http://a.b/", "d1")
STAMPS = ("created_at", "created_date", "updated_at", "processed_at", "batch_id")


@pytest.fixture
def warehouse(tmp_path):
    return str(tmp_path / "warehouse")


def contents(spark, warehouse):
    spark.catalog.clearCache()
    return {name: sorted(map(str, df.drop(*STAMPS).collect()))
            for name, df in read_star(spark, warehouse).items()}


def verify(spark, warehouse):
    with Staging(spark) as staging:
        verify_star(read_star(spark, warehouse), TABLES, staging)


def keys(spark, warehouse):
    found = {}
    for natural, (table, key) in NATURAL_KEYS.items():
        for row in read_table(spark, warehouse, table).collect():
            found[(natural, row[natural])] = row[key]
    return found


def views(spark, warehouse):
    fact = read_table(spark, warehouse, "fact_product_views")
    return sorted((r.date_key, r.view_count) for r in fact.collect())


def test_counts_of_a_run(spark, events, warehouse):
    run = build_star(events(FIRST), warehouse, latest_only=False)
    assert run.written == {"dim_date": 2, "dim_product": 2, "dim_country": 1,
                           "dim_referrer": 2, "dim_device": 2, "fact_product_views": 2}
    assert set(run.rejected.values()) == {0}
    verify(spark, warehouse)


def test_latest_only_by_default(spark, events, warehouse):
    build_star(events(FIRST), warehouse)
    assert views(spark, warehouse) == [(20240102, 1)]
    assert read_table(spark, warehouse, "dim_date").count() == 2


def test_rerun_changes_nothing(spark, events, warehouse):
    build_star(events(FIRST), warehouse, latest_only=False)
    before = contents(spark, warehouse)
    run = build_star(events(FIRST[::-1]).repartition(5), warehouse, latest_only=False)
    assert contents(spark, warehouse) == before
    assert run.written["dim_product"] == 0


def test_runs_accumulate_and_keep_keys(spark, events, warehouse):
    build_star(events(FIRST), warehouse, latest_only=False)
    old = keys(spark, warehouse)
    build_star(events(SECOND), warehouse, latest_only=False)
    new = keys(spark, warehouse)
    assert old.items() <= new.items()
    assert new[("product_id", "p0")] == 3 and new[("referrer_url", "")] == 3
    assert views(spark, warehouse) == [(20240101, 2), (20240102, 1), (20240103, 1),
                                       (20240103, 1)]
    verify(spark, warehouse)


def test_late_event_refreshes_its_date_only(spark, events, warehouse):
    build_star(events(FIRST + SECOND), warehouse, latest_only=False)
    build_star(events([*FIRST[:2], LATE]), warehouse, latest_only=False)
    assert views(spark, warehouse) == [(20240101, 1), (20240101, 2), (20240102, 1),
                                       (20240103, 1), (20240103, 1)]
    verify(spark, warehouse)


def test_replace_leaves_this_run_only(spark, events, warehouse):
    build_star(events(FIRST), warehouse, latest_only=False)
    build_star(events(SECOND), warehouse, latest_only=False, replace=True)
    assert views(spark, warehouse) == [(20240103, 1), (20240103, 1)]
    assert sorted(keys(spark, warehouse)) == [
        ("device_id", "d0"), ("device_id", "d2"), ("product_id", "p0"), ("product_id", "p2"),
        ("referrer_url", ""), ("referrer_url", "direct"), ("store_id", "s1"),
        ("store_id", "s2")]
    verify(spark, warehouse)


def test_nothing_is_touched_without_events(spark, events, warehouse):
    build_star(events(FIRST), warehouse, latest_only=False)
    before = contents(spark, warehouse)
    for replace in (False, True):
        assert build_star(empty_events(spark), warehouse, replace=replace).written == {}
    assert contents(spark, warehouse) == before


BROKEN = [*FIRST, ("garbage", "p1", "s1", "direct", "d1"),
          ("2024-01-02T10:00:00", None, "s1", "direct", "d2"),
          ("2024-01-02T10:00:00", "x" * 256, "s1", "direct", "d2"),
          ("2024-01-02T10:00:00", "y" * 256, "s1", "direct", "d2")]


def test_strict_run_fails_and_writes_no_fact(spark, events, warehouse):
    with pytest.raises(Exception, match="product_id: too long"):
        build_star(events(BROKEN), warehouse, latest_only=False)
    # Nothing was committed, and a star that is not there is no empty star.
    for read in (lambda: views(spark, warehouse), lambda: read_star(spark, warehouse)):
        with pytest.raises(MissingTable):
            read()


def test_failed_replace_leaves_the_warehouse(spark, events, warehouse):
    import os
    build_star(events(FIRST), warehouse, latest_only=False)
    before, folders = contents(spark, warehouse), sorted(os.listdir(warehouse))
    with pytest.raises(Exception, match="product_id: too long"):
        build_star(events(BROKEN), warehouse, latest_only=False, replace=True)
    assert contents(spark, warehouse) == before
    assert [f for f in sorted(os.listdir(warehouse)) if f != "quarantine"] == folders


def test_no_date_stops_a_strict_run(spark, events, warehouse):
    odd = [("9999-12-31T00:00:00", "p1", "s1", "direct", "d1"),
           ("300000-1-1", "p1", "s1", "direct", "d1"), ("2024-1-5", "p1", "s1", "direct", "d1"),
           (None, "p1", "s1", "direct", "d1"), ("nope", "p1", "s1", "direct", "d1")]
    for hash_keys in (False, True):
        run = build_star(events([*FIRST, *odd]), f"{warehouse}{hash_keys}", latest_only=False,
                         hash_keys=hash_keys)
        assert run.rejected["undated_views"] == 1
        assert views(spark, f"{warehouse}{hash_keys}") == [
            (20240101, 2), (20240102, 1), (20240105, 1), (99991231, 1)]
        rows = spark.read.parquet(f"{warehouse}{hash_keys}/quarantine/undated_views").collect()
        assert [r.views for r in rows] == [3]
    # Garbage in the far future is no report date.
    build_star(events([*FIRST, *odd]), warehouse)
    assert views(spark, warehouse) == [(20240105, 1)]


def test_runs_without_a_name_keep_each_others_quarantine(spark, events, warehouse):
    for _ in range(2):
        build_star(events(BROKEN), warehouse, latest_only=False, strict=False)
    assert spark.read.parquet(f"{warehouse}/quarantine/undated_views").count() == 2


def test_broken_rows_go_to_quarantine(spark, events, warehouse):
    run = build_star(events(BROKEN), warehouse, latest_only=False, strict=False, batch_id="b1")
    # Both long products lose their key, as does the null one: their views fall together.
    assert {k: n for k, n in run.rejected.items() if n} == {
        "undated_views": 1, "dim_product": 2, "fact_product_views": 1}
    assert views(spark, warehouse) == [(20240101, 2), (20240102, 1)]
    rejected = spark.read.parquet(f"{warehouse}/quarantine/fact_product_views")
    assert [(r.date_key, r.view_count, r.batch) for r in rejected.collect()] == [
        (20240102, 3, "b1")]
    before = contents(spark, warehouse)
    build_star(events(BROKEN), warehouse, latest_only=False, strict=False, batch_id="b1")
    assert contents(spark, warehouse) == before
    assert spark.read.parquet(f"{warehouse}/quarantine/fact_product_views").count() == 1
    assert spark.read.parquet(f"{warehouse}/quarantine/undated_views").count() == 1
    verify(spark, warehouse)


def test_long_urls_can_be_set_aside(spark, events, warehouse):
    rows = [*FIRST, ("2024-01-02T11:00:00", "p2", "s1", "http://" + "u" * 50, "d2")]
    run = build_star(events(rows), warehouse, latest_only=False, strict=False, url_limit=40)
    assert run.rejected["dim_referrer"] == 1
    fact = read_table(spark, warehouse, "fact_product_views").filter("referrer_key IS NULL")
    assert fact.count() == 1
    urls = spark.read.parquet(f"{warehouse}/quarantine/dim_referrer").collect()
    assert [u.violations for u in urls] == [["referrer_url: over the limit"]]


def test_hash_keys_give_the_same_star(spark, events, warehouse, tmp_path):
    for rows in (FIRST, SECOND, [*FIRST[:2], LATE]):
        build_star(events(rows), warehouse, latest_only=False, hash_keys=True)
        build_star(events(rows), str(tmp_path / "dense"), latest_only=False)
    assert views(spark, warehouse) == views(spark, str(tmp_path / "dense"))
    assert sorted(keys(spark, warehouse)) == sorted(keys(spark, str(tmp_path / "dense")))
    verify(spark, warehouse)
    with pytest.raises(ConstraintViolation, match="dense keys"):
        build_star(events(SECOND), str(tmp_path / "dense"), hash_keys=True)
    with pytest.raises(ConstraintViolation, match="holds hash keys"):
        build_star(events(SECOND), warehouse)


def test_broken_members_with_hash_keys(spark, events, warehouse):
    build_star(events(BROKEN), warehouse, latest_only=False, strict=False, hash_keys=True)
    assert views(spark, warehouse) == [(20240101, 2), (20240102, 1)]
    verify(spark, warehouse)


def test_empty_text_is_a_member(spark, events, warehouse):
    df = as_text(events([("2024-01-02T10:00:00", None, None, None, None)]))
    build_star(df, warehouse)
    assert [r.product_name for r in read_table(spark, warehouse, "dim_product").collect()] == [
        "Product "]
    assert [r.referrer_type for r in read_table(spark, warehouse, "dim_referrer").collect()
            ] == ["Other"]


def test_staged_tables_are_removed(spark, events, warehouse):
    from viewstar.staging import path_exists, shared_folder
    root = f"{shared_folder(spark)}/viewstar"
    import os
    before = set(os.listdir(root)) if path_exists(spark, root) else set()
    build_star(events(FIRST), warehouse)
    assert set(os.listdir(root)) == before


def test_shared_folder_must_be_named_on_a_cluster(spark):
    from viewstar.staging import shared_folder

    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, name, default=None):
            return self.values.get(name, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf({k.replace("_", "."): v for k, v in values.items()})

    assert shared_folder(Session(spark_checkpoint_dir="hdfs://x/y/")) == "hdfs://x/y"
    local = shared_folder(Session(spark_master="local[2]"))
    assert local == shared_folder(Session(spark_master="local"))
    with pytest.raises(RuntimeError):
        shared_folder(Session(spark_master="yarn"))
