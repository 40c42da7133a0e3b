import hashlib

import pytest
import zstandard
from pyspark.sql import functions as F

from basket_marts.llm import warc

PAGES = [
    (1, "http://a/", "x" * 1000),
    (5, "http://b/", "x" * 1000),
    (3, None, "x" * 1000),
    (4, "http://d/", "short"),
    (2, "http://e/", "short"),
    (6, "http://f/\r\nX: y", None),
    (None, "http://g/", "x" * 1000),
    (7, "http://h/", ""),
    (8, "http://i/", "é" * 500),
    (9, "http://j/", "é" * 500),
    (9, "http://j/", "é" * 500),
    (10, "http://k/", "z" * 600_000),
]


@pytest.fixture(scope="module")
def pages(spark):
    frame = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    return frame.withColumn("payload", F.lit(1)).withColumn("size", F.lit("s")).repartition(3)


@pytest.fixture(scope="module")
def archive(pages, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warc"))
    return warc.write_archives(pages, path), path


def expected():
    largest = {}
    for page_id, _, html in PAGES:
        if page_id is not None:
            largest[html] = max(largest.get(html, page_id), page_id)
    for page_id, _, html in PAGES:
        data = (html or "").encode()
        other = largest.get(html)
        revisit = len(data) >= 1000 and other is not None and (page_id is None or page_id < other)
        kind = ("revisit", other) if revisit else ("response", None)
        yield (page_id, len(data), hashlib.sha1(data).hexdigest(), *kind)


def test_read_back(archive):
    index, path = archive
    rows = warc.read_records(index, path, with_payload=True).collect()
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(found, key=str) == sorted(expected(), key=str)
    payloads = {r.page_id: r.payload for r in rows if r.record_type == "response"}
    for page_id, _, html in PAGES:
        if page_id in payloads:
            assert payloads[page_id] == (html or "").encode()


def test_one_record_is_read_through_the_index(archive):
    index, path = archive
    row = warc.read_records(index.where("page_id = 4"), path, with_payload=True).collect()
    assert [(r.page_id, r.url, bytes(r.payload)) for r in row] == [(4, "http://d/", b"short")]


def test_any_zstandard_reader_can_read_a_bundle(archive):
    index, path = archive
    for bundle in {r.bundle for r in index.collect()}:
        with open(f"{path}/{bundle}", "rb") as file:
            data = zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True).read()
        assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")
        assert b"\r\nX: y" not in data


def test_frames_stand_alone(tmp_path):
    with open(tmp_path / "bundle", "wb") as file:
        writer = warc.BundleWriter(file)
        places = [writer.add(bytes([65 + i]) * 100_000) for i in range(10)]
        writer.close()
    import pyarrow as pa

    reader = warc.BundleReader(pa.OSFile(str(tmp_path / "bundle")))
    assert len(reader.entries) == 5
    for i, (frame, offset) in reversed(list(enumerate(places))):
        assert reader.frame(frame)[offset : offset + 100_000] == bytes([65 + i]) * 100_000


def test_no_rows(spark, tmp_path):
    none = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.round_trip(none, str(tmp_path)).collect() == []
