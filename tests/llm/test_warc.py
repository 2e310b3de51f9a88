"""WARC round trips, with payloads made of record boundaries."""

import base64
import hashlib

import pytest

from retort.llm import warc
from retort.session import scratch_path

FAKE = warc.MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 3\r\n\r\nabc"
CUT = warc.GAP + warc.MAGIC
ROWS = [(1, "u", None), (2, "u", ""), (3, "u", "\r\n"), (4, "u", "x\r\n\r\nWARC/1.0"), (5, "u", warc.GAP + FAKE + warc.GAP), (6, "u", CUT * 3),
        (7, "u", "\r\nWARC/1.0\r\n" * 3), (8, "u", "x" + CUT + "y"), (9, "u\nv", warc.GAP + FAKE + warc.GAP + FAKE + "\r\n\r\nWARC/1.0"), (10, None, "same"),
        (11, "u", "same"), (12, "u", "same"), (13, "u", FAKE), (14, "u", warc.MAGIC), (15, "u", "é" * 300), (16, "u", warc.GAP), (17, "u", "z\r\n" * 7),
        (18, "u", "\r\n\r\nWARC/1.0"), (19, "u", "WARC/1.0\r\n"), (20, "u", ("p" * 300 + CUT) * 9), (21, "u", "end\r\n\r\n"), (22, "u", "W" * 40 + "WARC/1.")]


def brute(rows):
    best = {}
    for i, html in rows:
        best[html or ""] = max(i, best.get(html or "", i))
    out = []
    for i, html in rows:
        data = (html or "").encode()
        first = best[html or ""]
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if first == i else "revisit", None if first == i else first))
    return sorted(out)


@pytest.fixture
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(k) for k in keys]
    yield lambda n: [spark.conf.set(k, v) for k, v in zip(keys, (n, "1"))]
    for k, v in zip(keys, old):
        spark.conf.set(k, v)


@pytest.mark.parametrize("files,split", [(1, "128m"), (2, "701"), (2, "83")])
def test_magic_inside_payloads(spark, small_splits, files, split):
    path = scratch_path(spark, "test-archive")
    warc.write_archive(spark.createDataFrame(ROWS, "page_id long, url string, html string").coalesce(files), path)
    small_splits(split)
    records = warc.read_archive(spark, path, with_payload=split == "701")
    assert sorted(map(tuple, warc.digest(warc.resolved(records)).collect())) == brute([(i, h) for i, _, h in ROWS])
    if split == "701":
        bodies = {r.record_id: bytes(r.payload).decode() for r in records.where("record_type = 'response'").collect()}
        for i, _, html in ROWS:
            if f"<urn:page:{i}>" in bodies:
                assert bodies[f"<urn:page:{i}>"] == (html or "")


def test_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = scratch_path(spark, "test-archive")
    warc.write_archive(pages, path)
    got = sorted(map(tuple, warc.digest(warc.resolved(warc.read_archive(spark, path))).collect()))
    assert got == brute([(r.page_id, r.html) for r in pages.collect()])


def test_null_ids_repeated_rows_and_empty_tables(spark):
    schema = "page_id long, url string, html string, digest string, id string"
    rows = [(None, None, "a", "x", "y"), (1, "u", "a", "x", "y"), (1, "u", "a", "x", "y"), (None, "u", "b", "x", "y")]
    path = scratch_path(spark, "test-archive")
    warc.write_archive(spark.createDataFrame(rows, schema), path)
    got = warc.digest(warc.resolved(warc.read_archive(spark, path))).collect()
    assert sorted(((r.page_id, r.record_type, r.refers_to) for r in got), key=str) == [(1, "response", None), (1, "response", None), (None, "response", None), (None, "revisit", 1)]
    path = scratch_path(spark, "test-archive")
    warc.write_archive(spark.createDataFrame([], schema), path)
    assert warc.read_archive(spark, path).count() == 0


def test_chain_ends_at_a_broken_record(spark):
    path = scratch_path(spark, "test-archive")
    good = f"{warc.MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: 2\r\n\r\nok"
    cut = f"{warc.MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:2>\r\nContent-Length: 99\r\n\r\nshort"
    spark.createDataFrame([(good,), (cut,)], "value string").coalesce(1).write.option("lineSep", warc.GAP).text(path)
    assert [r.record_id for r in warc.read_archive(spark, path).collect()] == ["<urn:page:1>"]
