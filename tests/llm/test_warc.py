"""Archives written and read back; predicates that the reader takes; broken input."""

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, StringContains

from viewstar.llm import warc
from viewstar.llm.queries import op4_warc
from llm_cases import SMALL, small  # noqa: F401

PAGE = "page_id long, url string, html string"
ROWS = [(5, "http://a/5", "same"), (3, "http://b/3\r\nX: y", "same"), (9, "http://a/9", "same"),
        (1, None, None), (2, "u", ""), (7, "http://a/7", "é 中\r\n\r\nWARC/1.1\r\n\r\n"),
        (None, "n", "same"), (None, "n", "alone"), (8, "big", "x" * 300_000), (8, "big", "x" * 300_000)]


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload.encode()).digest()).decode()


@pytest.fixture
def archive(spark, staging):
    path = staging.path("warc")
    warc.write_pages(spark.createDataFrame(ROWS, PAGE).repartition(3), path, staging)
    return path


def test_records_of_pages(spark, archive):
    got = sorted(((r["id"], r["payload_length"], r["payload_digest"], r["record_type"], r["to"])
                  for r in warc.read_warc(spark, archive, verify=True).select(
                      "*", warc.page_id("record_id").alias("id"),
                      warc.page_id("refers_to").alias("to")).collect()), key=str)
    want = []
    for page_id, _, html in ROWS:
        html = html or ""
        ids = [p for p, _, h in ROWS if (h or "") == html and p is not None]
        first = min(ids, default=None)
        revisit = first is not None and page_id != first
        want.append((page_id, len(html.encode()), "sha1:" + digest(html),
                     "revisit" if revisit else "response", first if revisit else None))
    assert got == sorted(want, key=str)


def test_payloads_come_back_whole(spark, archive):
    got = warc.read_warc(spark, archive, "record_type = 'response'").select(
        warc.page_id("record_id").alias("id"), F.col("payload").cast("string").alias("text"),
        "target_uri").collect()
    texts = {r["id"]: r["text"] for r in got}
    assert texts[7] == ROWS[5][2] and texts[3] == "same" and texts[8] == "x" * 300_000
    assert {r["id"]: r["target_uri"] for r in got}[3] == "http://b/3X: y"


def test_small_payloads_are_all_responses(spark, staging):
    path = staging.path("warc")
    warc.write_pages(spark.createDataFrame(ROWS, PAGE), path, staging, min_bytes=5)
    kinds = warc.read_warc(spark, path).groupBy("record_type").count().collect()
    # The repeated long page has one id, so neither of its rows revisits the other.
    assert {r[0]: r[1] for r in kinds} == {"response": len(ROWS)}


def test_predicates_reach_the_reader(archive):
    reader = warc.PushingReader({"path": archive, "payload": "false"})
    rest = list(reader.pushFilters([
        EqualTo(("record_type",), "response"), GreaterThan(("content_length",), 5),
        StringContains(("target_uri",), "a/")]))
    assert [type(f) for f in rest] == [GreaterThan]
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert [r["target_uri"] for r in rows] == ["http://a/7"] and rows[0]["payload"] is None
    chosen = warc.PushingReader({"path": archive})
    assert not list(chosen.pushFilters([In(("record_type",), ("warcinfo", "request"))]))
    assert not [b for p in chosen.partitions() for b in chosen.read(p)]


def test_pushed_predicates_stay_with_their_frame(spark, archive):
    every = warc.read_warc(spark, archive)
    revisits = warc.read_warc(spark, archive, "record_type = 'revisit'")
    big = warc.read_warc(spark, archive, "target_uri = 'big'")
    for _ in range(2):
        assert (every.count(), revisits.count(), big.count()) == (10, 4, 2)
        assert revisits.where("refers_to LIKE '%:3'").count() == 3
        assert revisits.unionByName(big).count() == 6
    assert spark.conf.get(warc.PUSHDOWN, "false") == "false"


def test_other_archives_and_partitions(tmp_path):
    def record(kind, block, extra=""):
        return (f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:x:1>\r\n{extra}"
                f"Content-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"

    body = record("warcinfo", b"software: x\r\n") + record(
        "resource", b"abc", "WARC-Target-URI: http://x/\r\n folded\r\n")
    (tmp_path / "a.warc").write_bytes(body)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(body[:len(body) // 2]) + gzip.compress(
        body[len(body) // 2:]))
    (tmp_path / "_skipped").write_bytes(b"junk")
    reader = warc.WarcReader({"path": str(tmp_path), "partitionBytes": "10"})
    parts = reader.partitions()
    assert [len(p.paths) for p in parts] == [1, 1]
    for part in parts:
        info, resource = [r for b in reader.read(part) for r in b.to_pylist()]
        assert (info["record_type"], info["payload"]) == ("warcinfo", b"software: x\r\n")
        assert resource["payload"] == b"abc" and resource["target_uri"] == "http://x/ folded"
    assert [len(p.paths) for p in warc.WarcReader({"path": str(tmp_path)}).partitions()] == [2]


@pytest.mark.parametrize("content", [
    b"HTTP/1.1 200 OK\r\n\r\n", b"WARC/1.1\r\nWARC-Type: response\r\n\r\n",
    b"WARC/1.1\r\nContent-Length: 90\r\n\r\nshort", b"WARC/1.1\r\nContent-Le",
    b"WARC/1.1\r\nWARC-Payload-Digest: sha1:AAAA\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"])
def test_broken_records_are_errors(tmp_path, content):
    (tmp_path / "x.warc").write_bytes(content)
    reader = warc.WarcReader({"path": str(tmp_path / "x.warc"), "verify": "true"})
    with pytest.raises(ValueError):
        [b for p in reader.partitions() for b in reader.read(p)]


def test_whole_query(spark, small):
    got = {r["page_id"]: r for r in op4_warc(spark, SMALL).collect()}
    pages = small("pages").collect()
    assert len(got) == len(pages)
    for row in pages:
        found = got[row["page_id"]]
        assert found["payload_bytes"] == len(row["html"].encode())
        assert found["payload_digest"] == digest(row["html"])
        assert (found["record_type"], found["refers_to"]) == ("response", None)


def test_empty_table(spark, staging):
    path = staging.path("warc")
    warc.write_pages(spark.createDataFrame([], PAGE), path, staging)
    assert warc.read_warc(spark, path).count() == 0


def test_line_separators_in_addresses_change_no_header(spark, staging):
    rows = [(1, "http://a/\u2028WARC-Type: revisit", "x"), (2, "http://a/\u0085b", "y"),
            (3, "http://a/\u2029WARC-Record-ID: <urn:viewstar:page:9>", "z")]
    path = staging.path("warc")
    warc.write_pages(spark.createDataFrame(rows, PAGE), path, staging)
    got = warc.read_warc(spark, path, "record_type = 'response'", verify=True).select(
        warc.page_id("record_id").alias("id"), "target_uri").collect()
    assert sorted(map(tuple, got)) == [(n, uri) for n, uri, _ in rows]


def test_the_first_of_a_repeated_header_counts():
    head = b"WARC/1.1\r\nWARC-Type: response\r\n more\r\nwarc-type: revisit\r\n odd\r\nA: 1\n\r\n"
    assert warc.parse_headers(head) == {"warc-type": "response more", "a": "1"}


@pytest.mark.parametrize("options", [{"payload": True}, {"payload": False},
                                     {"payload": False, "where": "record_type = 'other'"}])
@pytest.mark.parametrize("zipped", [False, True])
def test_a_record_cut_short_is_an_error_however_it_is_read(spark, tmp_path, options, zipped):
    whole = (b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x>\r\n"
             b"Content-Length: 1000\r\n\r\nabc")
    path = tmp_path / ("a.warc.gz" if zipped else "a.warc")
    path.write_bytes(gzip.compress(whole) if zipped else whole)
    with pytest.raises(Exception, match="cut short"):
        warc.read_warc(spark, str(path), **options).collect()
