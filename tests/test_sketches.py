"""Distinct devices from kept sketches: how near, over which dates, and what is not counted."""

import datetime

import pytest

from viewstar import jobs
from viewstar.operators import sketches
from viewstar.plans.star import build_star, merge_star
from viewstar.sources.warehouse import read_sketches
from viewstar.versions import MissingTable

DAY = datetime.date(2024, 1, 1), datetime.date(2024, 1, 2), datetime.date(2024, 1, 3)


def test_estimates_over_many_devices(spark):
    """Enough devices to miss: half of them come on both dates."""
    fact = spark.range(150_000).selectExpr(
        "CAST(20240101 + (id div 50000) AS INT) AS date_key", "1L AS product_key", "id % 2 AS country_key",
        "CAST(NULL AS BIGINT) AS referrer_key", "id % 60000 AS device_key")
    kept = sketches.device_sketches(fact)
    assert {r.dimension for r in kept.collect()} == {"dim_product", "dim_country"}
    dims = {"dim_product": spark.createDataFrame([(1, "p")], "product_key long, name string"),
            "dim_country": spark.createDataFrame([(0, "a"), (1, "b")],
                                                 "country_key long, name string")}
    for table, exact in (("dim_product", {"p": 60_000}), ("dim_country", {"a": 30_000, "b": 30_000})):
        got = {r.name: r.distinct_devices for r in sketches.distinct_devices(
            kept, dims[table], table, "name").collect()}
        assert got.keys() == exact.keys()
        for name, count in exact.items():
            # Within three standard errors, and not exact: the sketch is really used.
            assert 0 < abs(got[name] - count) <= 3 * sketches.ERROR * count
    # A sum over the dates would be far off.
    daily = [sketches.distinct_devices(kept.filter(f"date_key = {day}"), dims["dim_product"],
                                       "dim_product", "name").first().distinct_devices
             for day in (20240101, 20240102, 20240103)]
    assert all(abs(n - 50_000) <= 3 * sketches.ERROR * 50_000 for n in daily)


def rows(day, devices, product="p1"):
    return [(f"2024-01-{day:02d}T10:00:00", product, "s1", "direct", f"d{n}") for n in devices]


def counts(spark, warehouse, first, last, by="product"):
    return {r[0]: r.distinct_devices
            for r in jobs.devices(spark, warehouse, by, first, last).collect()}


def test_dates_products_and_late_batches(spark, events, tmp_path):
    warehouse = str(tmp_path / "warehouse")
    build_star(events(rows(1, range(5)) + rows(2, range(3, 9)) + rows(2, [1], "p2")), warehouse,
               latest_only=False, sketches=True)
    assert counts(spark, warehouse, *DAY[:2]) == {"p1": 9, "p2": 1}
    assert counts(spark, warehouse, DAY[0], DAY[0]) == {"p1": 5}
    merge_star(events(rows(1, [20, 21, 3])), warehouse, "s", 0,
               lambda days: events(rows(1, range(5)) + rows(1, [20, 21, 3])), sketches=True)
    assert counts(spark, warehouse, *DAY[:2]) == {"p1": 11, "p2": 1}
    assert list(counts(spark, warehouse, *DAY[:2], by="country").values()) == [11]
    # A run that keeps none leaves its dates without, and asking for them is an error.
    build_star(events(rows(3, [1])), warehouse, latest_only=False)
    assert counts(spark, warehouse, *DAY[:2]) == {"p1": 11, "p2": 1}
    with pytest.raises(MissingTable, match="20240103"):
        read_sketches(spark, warehouse, DAY[0], DAY[2])


def test_command(spark, events, tmp_path, capsys):
    warehouse = str(tmp_path / "warehouse")
    build_star(events(rows(1, range(4))), warehouse, sketches=True)
    args = jobs.parsed(["devices", "--warehouse", warehouse, "--by", "product", "--from",
                        "2024-01-01", "--to", "2024-01-31"])
    args.run(spark, args)
    assert capsys.readouterr().out.strip().splitlines()[1].split("\t")[-1] == "4"
