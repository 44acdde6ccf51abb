import random

import pytest
from pyspark.sql import functions as F

from viewstar.operators import lookup as L


@pytest.fixture
def frames(spark):
    """A third of the rows hold one key, a sixth none, and some keys have no member."""
    random.seed(5)
    rows = []
    for n in range(6000):
        kind = n % 6
        value = "hot" if kind < 2 else None if kind == 2 else "" if kind == 3 else str(
            random.randrange(500))
        rows.append((n, value))
    members = ["hot", ""] + [str(n) for n in range(0, 500, 2)]
    dim = [(m, k) for k, m in enumerate(members, 1)]
    return (spark.createDataFrame(rows, "id int, m string"),
            spark.createDataFrame(dim, "m string, k bigint"), rows, dict(dim))


@pytest.mark.parametrize("limit", [L.BROADCAST_BYTES, -1])
def test_lookup_is_exact(frames, limit):
    fact, dim, rows, keys = frames
    got = L.lookup(fact, dim, "m", "k", broadcast_bytes=limit)
    assert got.columns == ["id", "m", "k"]
    assert sorted(got.collect()) == [(i, m, keys.get(m)) for i, m in rows]


@pytest.mark.parametrize("share", [2, 3, 100])
def test_spread_lookup_at_any_share(frames, share):
    fact, dim, rows, keys = frames
    pairs = dim.select(F.col("m").alias("_natural"), "k")
    got = L.spread_lookup(fact, pairs, "m", "k", fact, share)
    assert sorted(got.collect()) == [(i, m, keys.get(m)) for i, m in rows]


def test_hot_values_are_bounded(frames):
    fact = frames[0]
    assert sorted(r.m for r in L.hot_values(fact, "m", 7).collect()) == ["", "hot"]
    assert L.hot_values(fact, "m", 2).isEmpty()
    for share in (3, 50, 1000):
        assert L.hot_values(fact, "m", share).count() <= share


def test_spread_rows_reach_all_partitions(spark, frames):
    fact, dim, *_ = frames
    pairs = dim.select(F.col("m").alias("_natural"), "k")
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    old = {name: spark.conf.get(name) for name in names}
    spark.conf.set(names[0], "-1")
    spark.conf.set(names[1], "false")
    try:
        joined = L.spread_lookup(fact, pairs, "m", "k", fact, 10)
        text = joined._jdf.queryExecution().executedPlan().toString()
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
    assert "SortMergeJoin [_on#" in text
    assert len(sizes) == 8 and max(sizes) < 2 * 6000 / 8


def test_size_decides(frames, plan):
    fact, dim, *_ = frames
    assert L.measured_size(dim, "m") == 252 * L.ROW_BYTES + 3 + 5 * 1 + 45 * 2 + 200 * 3
    small = plan(L.lookup(fact, dim, "m", "k", size=L.BROADCAST_BYTES))
    large = plan(L.lookup(fact, dim, "m", "k", size=L.BROADCAST_BYTES + 1))
    assert "_on#" not in small and "_on#" in large


def test_shuffle_lookup_that_nobody_asks_for_is_left_out(frames, plan):
    """The dimension is known to have one row per key, so its join adds no row."""
    fact, dim, rows, _ = frames
    both = L.lookup(fact, dim, "m", "k", broadcast_bytes=-1)
    assert "_target#" in plan(both)
    assert "_target#" not in plan(both.select("id"))
    assert both.select("id").count() == len(rows)
