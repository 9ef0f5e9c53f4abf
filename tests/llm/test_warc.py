import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from ranklake.llm import warc
from ranklake.session import scratch_path

TRICKY = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
ROWS = [
    (1, "http://a/ b\r\nX: y", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "http://c", None), (4, "http://d", ""),
    (5, "http://e", TRICKY), (6, "http://é", "é" * 5000), (7, "http://f", "\n" * 50), (None, "http://g", "<p>one</p>"),
    (8, "http://h", "x" * 300_000), (9, "http://i", TRICKY),
]


def plain(rows, least=0):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        keep = max(same, default=None)
        revisit = len(data) >= least and keep is not None and i != keep and len([1 for _, _, h in rows if (h or "") == (html or "")]) > 1
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "revisit" if revisit else "response", keep if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least,compression", [(0, "none"), (0, "gzip"), (100, "none")])
def test_round_trip(spark, least, compression):
    pages = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, digest string")
    folder = scratch_path(spark, "warc")
    warc.write_archives(pages, folder, least=least, compression=compression)
    found = warc.page_records(spark, folder)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(ROWS, least)
    payloads = {r.record_id: bytes(r.payload) for r in warc.read_archives(spark, folder).where("record_type = 'response'").collect()}
    assert payloads["<urn:page:6>"] == ("é" * 5000).encode() and payloads["<urn:page:9>"] == TRICKY.encode()


def test_predicates_reach_the_reader(spark, monkeypatch):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    folder = scratch_path(spark, "warc")
    warc.write_archives(pages, folder)
    some = warc.read_archives(spark, folder).where("record_id IN ('<urn:page:4>', '<urn:page:6>') AND record_type = 'response'")
    assert sorted(r.record_id for r in some.collect()) == ["<urn:page:4>", "<urn:page:6>"]
    started = warc.read_archives(spark, folder, payload=False).where(F.col("target_uri").startswith("http://a"))
    assert [(r.target_uri, r.payload) for r in started.collect()] == [("http://a/%20b%0D%0AX:%20y", None)]

    reader = warc.WarcReader({"path": folder})
    kept = list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), warc.EqualTo(("content_length",), 3)]))
    assert reader.tests == [("warc-type", "in", ("revisit",))] and kept == [warc.EqualTo(("content_length",), 3)]


def test_skipped_blocks_are_not_read(tmp_path):
    import io

    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 1000000\r\n\r\n" + b"x" * 1_000_000 + b"\r\n\r\n"

    class Counted(io.BytesIO):
        got = 0

        def read(self, n=-1):
            Counted.got += n
            return super().read(n)

    reader = warc.WarcReader({"path": str(tmp_path)})
    reader.tests = [("warc-type", "in", ("revisit",))]
    assert list(reader.records(Counted(record * 3))) == [] and Counted.got == 0


def test_bundles_of_files(tmp_path):
    for i in range(5):
        (tmp_path / f"part-{i}.txt").write_bytes(b"x" * 10)
    (tmp_path / "_SUCCESS").write_bytes(b"")
    plan = warc.WarcReader({"path": str(tmp_path), "splitBytes": "20"}).partitions()
    assert [len(p.paths) for p in plan] == [2, 2, 1]


def test_empty_table(spark):
    folder = scratch_path(spark, "warc")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert warc.page_records(spark, folder).collect() == []
