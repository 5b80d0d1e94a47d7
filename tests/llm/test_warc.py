import gzip
import hashlib
import uuid
from pathlib import Path

import pytest

from daytally.llm.warc import parse, read_index, read_records, record, round_trip, write_archives

SCHEMA = "page_id long, url string, html string"
BIG = "<p>é</p>" * 20
ROWS = [
    (3, "http://a/3", BIG), (1, "http://a/1", BIG), (2, None, BIG), (4, "http://a/4", "short"), (5, "u", "short"), (6, "u\r\nX: y", None),
    (7, "u", ""), (None, "u", BIG), (None, "u", BIG + "x"), (8, "u", "\r\n\r\nWARC/1.1\r\n" * 30), (9, "u", "z" * 3_000_000), (9, "u", "q" * 200),
    (10, "u", "q" * 200), (11, "u", "q" * 99), (12, "u", "q" * 99), (1, "again", BIG),
]


@pytest.fixture
def folder(tmp_path):
    return f"file://{tmp_path}/warc-{uuid.uuid4().hex}"


def test_round_trip_tells_responses_and_revisits(spark, folder):
    got = sorted(map(tuple, round_trip(spark.createDataFrame(ROWS, SCHEMA).repartition(3), folder).collect()), key=repr)

    def row(page_id, html, refers_to=None):
        data = (html or "").encode()
        kind = "response" if refers_to is None else "revisit"
        return (page_id, len(data), hashlib.sha256(data).hexdigest(), kind, refers_to)

    firsts = {BIG: 1, "q" * 200: 9}
    want = [row(i, h, firsts[h] if h in firsts and firsts[h] != i else None) for i, _, h in ROWS]
    assert got == sorted(want, key=repr)


def test_records_come_back_as_they_were_written(spark, folder):
    index = write_archives(spark.createDataFrame(ROWS, SCHEMA), folder)
    got = read_records(index.where("page_id >= 4"), folder).collect()
    assert {(r.page_id, bytes(r.payload or b"").decode()) for r in got if r.record_type == "response"} == {
        (i, h or "") for i, _, h in ROWS if (i or 0) >= 4 and (i, h) != (10, "q" * 200)
    }
    assert {(r.page_id, r.refers_to, r.payload) for r in got if r.record_type == "revisit"} == {(10, 9, None)}
    assert {r.url for r in got if r.page_id == 6} == {"u%0D%0AX: y"}
    assert read_records(index.where("false"), folder).collect() == []


def test_index_points_at_whole_gzip_members(spark, folder):
    write_archives(spark.createDataFrame(ROWS, SCHEMA).coalesce(1), folder, "2020-01-01T00:00:00Z")
    for row in read_index(spark, folder).collect():
        data = Path(folder.removeprefix("file://"), row.archive).read_bytes()[row.offset : row.offset + row.length]
        fields, _ = parse(gzip.decompress(data))
        assert fields["warc-date"] == "2020-01-01T00:00:00Z"
        assert fields["warc-payload-digest"] == f"sha256:{row.payload_digest}"


def test_archives_outside_the_index_do_no_harm(spark, folder):
    index = write_archives(spark.createDataFrame(ROWS, SCHEMA), folder)
    Path(folder.removeprefix("file://"), "lost.warc.gz").write_bytes(b"\x1f\x8b half")
    assert read_records(index, folder).count() == len(ROWS)


def test_empty_table_and_other_columns(spark, folder):
    assert round_trip(spark.createDataFrame([], SCHEMA), folder).collect() == []
    more = spark.createDataFrame([(1, "u", "x", "y", 2)], SCHEMA + ", digest string, first long")
    assert round_trip(more, folder + "2").count() == 1


def test_record_has_the_fields_of_the_standard():
    fields, payload = parse(record(5, "http://x/", b"\0\r\n\r\n", "ab", None, False, "2020-01-01T00:00:00Z"))
    assert payload == b"\0\r\n\r\n"
    assert {"warc-type", "warc-record-id", "warc-date", "content-length", "warc-target-uri", "content-type"} <= set(fields)
    with pytest.raises(ValueError):
        parse(b"HTTP/1.1 200 OK\r\n\r\n")
