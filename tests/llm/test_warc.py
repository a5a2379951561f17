import gzip
import hashlib
import io
import os

import pytest
from compare import spark_rows, sql_rows

from tidewell.llm import common, queries, warc

PAGES = "page_id long, url string, html string"


@pytest.fixture
def pages(spark):
    big = "<p>" + "ä" * 700
    rows = [(i, f"http://x/{i}", big) for i in range(1, 6)] + [(6, None, None), (7, "http://y\r\nEvil: 1", ""), (8, "u", "short"), (9, "u", "short"), (None, "z", big), (10, "w", "WARC/1.1\r\n\x1f\u008b\x08" * 300)]
    return spark.createDataFrame(rows, PAGES)


@pytest.mark.parametrize("split", [37, 1000, 1 << 20])
def test_round_trip_by_any_split(spark, pages, split):
    folder = common.scratch(spark, "warc")
    archives = warc.write(pages.coalesce(2), folder)
    rows = warc.read(archives, split, payloads=True).collect()
    assert len(rows) == 11
    by = {r["page_id"]: r for r in rows}
    assert by[5]["record_type"] == "response" and all(by[i]["refers_to"] == 5 for i in (1, 2, 3, 4, None))
    assert by[8]["record_type"] == by[9]["record_type"] == "response"
    for r in pages.collect():
        raw = (r["html"] or "").encode()
        got = by[r["page_id"]]
        assert (got["payload_bytes"], got["payload_digest"]) == (len(raw), hashlib.sha1(raw).hexdigest())
        assert got["payload"] == (raw if got["record_type"] == "response" else None)


def test_archives_are_plain_gzip(spark, pages):
    path = warc.write(pages.coalesce(1), common.scratch(spark, "warc")).first()["path"]
    with gzip.open(path.removeprefix("file:")) as f:
        assert f.read().count(b"WARC/1.1\r\nWARC-Type: ") == 11
    assert warc.listed(spark, path).first()["bytes"] == os.path.getsize(path.removeprefix("file:"))


def test_noise_between_members_is_passed_over():
    record = warc.record(1, "u", b"x" * 50, "00" * 20, 50, "response", None)
    noise = warc.MAGIC + os.urandom(40) + gzip.compress(b"no record") + warc.MAGIC[:2]
    data = noise + gzip.compress(record) + noise + gzip.compress(record)
    for cut in range(0, len(data), 13):
        found = list(warc.read_range(io.BytesIO(data), 0, cut)) + list(warc.read_range(io.BytesIO(data), cut, len(data)))
        assert found == [record, record]


def test_magic_across_blocks(monkeypatch):
    record = gzip.compress(warc.record(1, "u", b"x" * 50, "00" * 20, 50, "response", None))
    monkeypatch.setattr(warc, "READ", 16)
    for shift in range(18):
        assert len(list(warc.read_range(io.BytesIO(b"." * shift + record), 0, 10_000))) == 1


def test_empty_table(spark):
    archives = warc.write(spark.createDataFrame([], PAGES), common.scratch(spark, "warc"))
    assert warc.read(archives).count() == 0


def test_query_equals_its_sql(spark, sf_dir):
    assert spark_rows(queries.op6_warc(spark, sf_dir)) == sql_rows(queries.SQL["op6_warc"], sf_dir)
