"""Dimensions in buckets: what a small run opens, and that it finds what a scan finds."""

import pytest
from pyspark.sql import functions as F

from viewstar.operators import buckets
from viewstar.plans.star import build_star
from viewstar.sources.warehouse import read_members, read_table
from viewstar.versions import Versions

from test_star import keys, verify


def test_bucket_counts():
    assert [buckets.bucket_count(n, 10) for n in (0, 1, 10, 11, 20, 21, 40, 41, 10**9)] == [
        1, 1, 1, 2, 2, 4, 4, 8, buckets.MOST]


@pytest.fixture
def stored(spark, events, tmp_path):
    """400 products in two runs of different bucket counts."""
    warehouse = str(tmp_path / "warehouse")
    for day, low, high, each in (("01", 0, 300, 10), ("02", 300, 400, 20)):
        rows = [(f"2024-01-{day}T10:00:00", f"p{n}", "s", "r", f"d{n % 7}")
                for n in range(low, high)]
        build_star(events(rows), warehouse, latest_only=False, bucket_members=each)
    return warehouse


def members(spark, names):
    return spark.createDataFrame([("product_id", name) for name in names],
                                 "kind string, member string")


def test_a_small_run_opens_its_buckets_only(spark, stored):
    version = Versions(spark, stored).latest()
    names = ["p5", "p311", "unknown"]
    numbers = buckets.touched(members(spark, names), "kind", "member")["product_id"]
    assert len(numbers) == 3
    some = read_members(spark, stored, "dim_product", version, numbers)
    whole = read_table(spark, stored, "dim_product")
    found = {r.product_id for r in some.collect()}
    assert {"p5", "p311"} <= found and len(found) < 120
    scan = some._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in scan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    files = [df.select(F.input_file_name()).distinct().count() for df in (some, whole)]
    assert files[0] <= 6 and files[1] >= 38


def test_pruned_reads_equal_the_scan(spark, stored):
    version = Versions(spark, stored).latest()
    whole = {r.product_id: r.product_key for r in read_table(spark, stored, "dim_product").collect()}
    assert len(whole) == 400
    for names in ([], ["p1"], [f"p{n}" for n in range(0, 400, 9)], list(whole)):
        numbers = buckets.touched(members(spark, names), "kind", "member").get("product_id", ())
        got = {r.product_id: r.product_key
               for r in read_members(spark, stored, "dim_product", version, numbers).collect()}
        assert {n: got[n] for n in names} == {n: whole[n] for n in names}
        assert got.items() <= whole.items()


def test_later_runs_keep_keys_over_buckets(spark, events, stored):
    before = keys(spark, stored)
    rows = [("2024-01-03T10:00:00", f"p{n}", "s", "r", "d1") for n in range(380, 420)]
    build_star(events(rows), stored, latest_only=False, bucket_members=3)
    after = keys(spark, stored)
    assert before.items() <= after.items() and len(after) == len(before) + 20
    verify(spark, stored)


def test_hash_keys_over_buckets(spark, events, tmp_path):
    warehouse = str(tmp_path / "hashed")
    rows = [("2024-01-01T10:00:00", f"p{n}", "s", "r", "d") for n in range(100)]
    for part in (rows[:60], rows[40:]):
        build_star(events(part), warehouse, latest_only=False, hash_keys=True, bucket_members=5)
    verify(spark, warehouse)
    assert read_table(spark, warehouse, "dim_product").count() == 100
