"""Exported collections: wrapped values, splits, broken lines."""

import json

from viewstar import jobs
from viewstar.schemas import EVENT_FIELDS
from viewstar.sources.dumps import collection_dump, dump_events

from test_star import FIRST, SECOND, views


def exported(path, documents, array=False):
    lines = [json.dumps(d) for d in documents]
    path.write_text("[" + ",\n".join(lines) + "]\n" if array else "\n".join(lines) + "\n")
    return str(path)


def test_wrapped_values(spark, tmp_path):
    path = exported(tmp_path / "d.json", [
        {"_id": {"$oid": "65a"}, "product_id": {"$numberLong": "12"}, "store_id": {"$numberInt": "3"},
         "local_time": {"$date": "2024-01-05T10:00:00Z"}, "device_id": 7, "referrer_url": None},
        {"_id": 5, "local_time": {"$date": {"$numberLong": "1704067201500"}}, "product_id": {"a": 1}},
        {"_id": "x", "product_id": {"$numberDecimal": "1.50"}, "raw": "nope"}])
    rows = {r._id: r for r in collection_dump(spark, path).collect()}
    assert set(rows) == {"65a", "5", "x"}
    one = rows["65a"]
    assert (one.product_id, one.store_id, one.local_time, one.device_id, one.referrer_url) == (
        "12", "3", "2024-01-05T10:00:00Z", "7", None)
    assert rows["5"].local_time == "2024-01-01T00:00:01" and rows["5"].product_id == '{"a":1}'
    assert (rows["x"].product_id, rows["x"].raw) == ("1.50", "nope")


def test_a_document_over_a_split_is_read_once(spark, tmp_path):
    documents = [{"_id": n, "product_id": "p" * (n * 37 % 900), "local_time": "é" * (n % 50)}
                 for n in range(400)]
    for array in (False, True):
        path = exported(tmp_path / f"{array}.json", documents, array)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            dump = collection_dump(spark, path)
            parts = dump.rdd.getNumPartitions()
            got = sorted((int(r._id), r.product_id, r.local_time) for r in dump.collect())
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert parts > 20
        assert got == [(d["_id"], d["product_id"], d["local_time"]) for d in documents]


def test_lines_that_are_no_documents(spark, tmp_path):
    path = tmp_path / "d.json"
    path.write_text('[\n{"_id": 1},\n\n{"_id": 2}\n]\n{"_id": 3\n[1, 2]\n')
    rows = collection_dump(spark, str(path)).collect()
    assert sorted(r._id for r in rows if r.broken is None) == ["1", "2"]
    assert sorted(r.broken for r in rows if r.broken) == ["[1, 2]", '{"_id": 3']
    (tmp_path / "empty.json").write_text("")
    assert collection_dump(spark, str(tmp_path / "empty.json")).count() == 0


def test_star_from_a_dump(spark, tmp_path):
    path = exported(tmp_path / "d.json", [
        {"_id": {"$oid": str(n)}} | dict(zip(EVENT_FIELDS, row))
        for n, row in enumerate([*FIRST, *SECOND])])
    assert dump_events(collection_dump(spark, path)).count() == 5
    warehouse = str(tmp_path / "warehouse")
    args = jobs.parsed(["star", "--dump", path, "--warehouse", warehouse, "--all-dates"])
    args.run(spark, args)
    assert views(spark, warehouse) == [(20240101, 2), (20240102, 1), (20240103, 1), (20240103, 1)]
