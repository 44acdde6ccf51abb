import random

import pytest
from pyspark.sql import Window, functions as F

from viewstar.operators.members import all_members, distinct_members
from viewstar.operators.numbering import (
    dense_keys, hash_collisions, hash_key, hash_keys, incremental_keys, number_groups,
    number_rows)
from viewstar.operators.quality import ConstraintViolation, strict


def test_dense_keys_are_ranks(spark, staging):
    members = [str(n) for n in range(5000)] + ["", "é", "z", "Z"]
    df = spark.createDataFrame([(m,) for m in members], "m string").repartition(7)
    got = {r.m: r.k for r in dense_keys(df, "m", "k", staging).collect()}
    ranked = sorted(members, key=lambda m: m.encode())
    assert got == {m: n for n, m in enumerate(ranked, 1)}


@pytest.mark.parametrize("hot", [0, 3])
def test_numbers_within_groups_equal_row_number(spark, staging, hot):
    """One group holds most rows: its numbers still come from several partitions."""
    random.seed(hot)
    rows = [(random.choice([hot] * 8 + [1, 2, None]), n if n % 11 else None, n)
            for n in range(4000)]
    df = spark.createDataFrame(rows, "g int, a int, b int").repartition(9)
    got = number_rows(df, ["a", "b"], "n", staging, within=["g"])
    window = Window.partitionBy("g").orderBy("a", "b")
    want = df.withColumn("n", F.row_number().over(window).cast("bigint"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_hot_group_is_spread(spark, staging):
    df = spark.range(200_000).select(F.lit(1).alias("g"), F.col("id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        number_rows(df, ["id"], "n", staging, within=["g"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    placed = spark.read.parquet(f"{staging.root}/placed-n-*")
    parts = placed.groupBy("_part").count().collect()
    assert len(parts) == 8 and max(r["count"] for r in parts) < 60_000


def test_no_window_over_rows(spark, staging, plan):
    """The window sees the counts, which an aggregate makes, and never the rows."""
    from viewstar.operators.numbering import _offsets, _place
    assert "Window" not in plan(number_rows(spark.range(100), ["id"], "n", staging))
    counts = plan(_offsets(_place(spark.range(100), ["id"]), ()))
    assert counts.index("Window") < counts.index("HashAggregate(keys=[_part")


def test_number_groups(spark, staging):
    rows = [("a", str(n)) for n in range(300)] + [("b", "x"), ("b", "yy")]
    df = spark.createDataFrame(rows, "kind string, member string")
    groups = number_groups(df, "kind", ["a", "b", "none"], "member", "n", staging)
    assert {r.member: r.n for r in groups["b"].rows.collect()} == {"x": 1, "yy": 2}
    ranked = sorted(str(n) for n in range(300))
    assert {r.member: r.n for r in groups["a"].rows.collect()} == {
        m: i for i, m in enumerate(ranked, 1)}
    assert [(g.count, g.text_bytes) for g in groups.values()] == [(300, 790), (2, 3), (0, 0)]
    assert groups["none"].rows.columns == ["member", "n"]


def test_old_keys_never_move(spark, staging):
    stored = spark.createDataFrame([("b", 1), ("d", 2), ("x", 7)], "m string, k bigint")
    members = spark.createDataFrame([("a",), ("b",), ("c",), ("x",)], "m string")
    new = incremental_keys(stored, members, "m", "k", staging)
    assert {r.m: r.k for r in new.collect()} == {"a": 8, "c": 9}


def test_first_members_start_at_one(spark, staging):
    stored = spark.createDataFrame([], "m string, k bigint")
    members = spark.createDataFrame([("b",), ("a",)], "m string")
    new = incremental_keys(stored, members, "m", "k", staging)
    assert {r.m: r.k for r in new.collect()} == {"a": 1, "b": 2}


def test_hash_keys(spark):
    df = spark.createDataFrame([("a",), ("b",)], "m string")
    keyed = hash_keys(df, "m", "k")
    again = hash_keys(df.repartition(3), "m", "k")
    assert sorted(keyed.collect()) == sorted(again.collect())
    assert hash_collisions(keyed, "k").isEmpty()
    assert spark.createDataFrame([(None,)], "m string").select(hash_key("m")).first()[0] is None
    with pytest.raises(ConstraintViolation):
        strict(hash_collisions(keyed.withColumn("k", F.lit(1)), "k"), "hash key")


def test_members(spark):
    df = spark.createDataFrame([("a", "1"), ("a", None), ("", "1")], "p string, q string")
    assert sorted(r[0] for r in distinct_members(df, "p").collect()) == ["", "a"]
    pairs = sorted(tuple(r) for r in all_members(df, ("p", "q")).collect())
    assert pairs == [("p", ""), ("p", "a"), ("q", "1")]


def test_members_need_one_scan_and_one_shuffle(spark, tmp_path, plan):
    spark.range(10).selectExpr("cast(id as string) p", "cast(id as string) q", "id unused"
                               ).write.parquet(str(tmp_path / "t"))
    text = plan(all_members(spark.read.parquet(str(tmp_path / "t")), ("p", "q")))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    assert "unused" not in text
