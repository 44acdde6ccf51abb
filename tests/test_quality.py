import pytest
from pyspark.sql import functions as F

from viewstar.operators import quality as Q
from viewstar.schemas import (
    DIM_DEVICE, DIM_PRODUCT, DIM_REFERRER, FACT_PRODUCT_VIEWS, TABLES)

FACT = ("date_key int, product_key bigint, country_key bigint, referrer_key bigint, "
        "device_key bigint, view_count bigint")


@pytest.fixture
def bad_fact(spark):
    return spark.createDataFrame([
        (20240101, 1, 1, 1, 1, 5),
        (20240101, 1, 1, 1, 1, 6),           # duplicate
        (20240101, 2, None, 1, 1, 5),
        (20240101, 2, None, 1, 1, 5),        # duplicate with a null part: allowed
        (20240102, None, 1, 1, 1, 5),        # no product
        (20240102, 3, 99, 1, 1, 5),          # orphan country
        (20240102, 4, 1, 1, 1, 2 ** 31),     # too large
    ], FACT)


KEYS = FACT_PRODUCT_VIEWS.unique


def test_duplicates(bad_fact):
    assert [tuple(r) for r in Q.duplicate_keys(bad_fact, KEYS).collect()] == [
        (20240101, 1, 1, 1, 1, 2)]


def test_nulls(bad_fact):
    assert [r.date_key for r in Q.null_rows(bad_fact, ["date_key", "product_key"]).collect()
            ] == [20240102]


def test_orphans(spark, staging, bad_fact):
    dim = spark.createDataFrame([(1,)], "country_key bigint")
    found = Q.orphan_rows(bad_fact, dim, "country_key", staging).collect()
    assert [r.country_key for r in found] == [99]


def test_narrowing(bad_fact):
    found = Q.narrowing_rows(bad_fact, "view_count", "int").collect()
    assert [r.view_count for r in found] == [2 ** 31]


def test_strict_names_an_example(bad_fact):
    with pytest.raises(Q.ConstraintViolation, match="primary key"):
        Q.strict(Q.duplicate_keys(bad_fact, KEYS), "primary key")
    Q.strict(bad_fact.filter("view_count < 0"), "none")


def test_one_pass_finds_every_break(bad_fact):
    kept, rejected = Q.split_by_constraints(bad_fact, FACT_PRODUCT_VIEWS)
    assert kept.count() == 5 and kept.columns == bad_fact.columns
    assert sorted(r.violations for r in rejected.collect()) == [
        ["product_key: null"], ["view_count: does not fit"]]


def test_enforce_fails_the_job(bad_fact):
    checked = bad_fact.withColumn("violations", Q.violations(bad_fact, FACT_PRODUCT_VIEWS))
    with pytest.raises(Exception, match="fact_product_views"):
        Q.enforce(checked, FACT_PRODUCT_VIEWS).count()
    good = checked.filter("size(violations) = 0")
    assert Q.enforce(good, FACT_PRODUCT_VIEWS).count() == 5


def test_lengths(spark):
    df = spark.createDataFrame([("x" * 255,), ("é" * 255,), ("x" * 256,), (None,)],
                               "product_id string")
    assert [len(r[0]) for r in Q.long_rows(df, "product_id", 255).collect()] == [256]
    kept, long = Q.guard_length(df, "product_id", 255)
    assert (kept.count(), long.count()) == (3, 1)


def test_align_fills_defaults_and_types(spark):
    df = spark.createDataFrame([("p", 1)], "product_id string, product_key int")
    row = Q.align(df, DIM_PRODUCT)
    assert row.columns == DIM_PRODUCT.column_names
    assert row.schema["price"].dataType.simpleString() == "decimal(10,2)"
    got = row.first()
    assert (got.product_key, got.is_active, got.price, got.category) == (1, True, None, None)
    assert got.updated_at is not None


def test_defaults_of_the_contract(spark):
    one = spark.createDataFrame([(1,)], "x int")
    referrer = Q.align(one, DIM_REFERRER).first()
    assert referrer.is_paid_traffic is False
    device = Q.align(one, DIM_DEVICE).first()
    assert (device.is_mobile, device.os_info) == (None, None)
    fact = Q.align(one, FACT_PRODUCT_VIEWS).first()
    assert (fact.view_count, fact.unique_visitors, fact.data_source, fact.batch_id) == (
        0, 0, "kafka_mongodb", None)


def test_verify_star(spark, staging):
    tables = {name: spark.createDataFrame([], table.struct()) for name, table in TABLES.items()}
    Q.verify_star(tables, TABLES, staging)
    orphan = Q.align(spark.createDataFrame([(20240101, 5)], "date_key int, product_key bigint"),
                     FACT_PRODUCT_VIEWS).withColumn("fact_key", F.lit(1).cast("bigint"))
    with pytest.raises(Q.ConstraintViolation, match="date_key reference"):
        Q.verify_star({**tables, "fact_product_views": orphan}, TABLES, staging)


def test_orphan_check_moves_no_rows(spark, staging, tmp_path, plan):
    spark.range(100).selectExpr("id AS k", "cast(id AS string) AS payload").write.parquet(
        str(tmp_path / "f"))
    fact = spark.read.parquet(str(tmp_path / "f"))
    orphans = Q.orphan_rows(fact, spark.range(50).selectExpr("id AS k"), "k", staging)
    text = plan(orphans)
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    assert orphans.count() == 50
