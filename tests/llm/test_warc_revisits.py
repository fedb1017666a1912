from __future__ import annotations

import base64
import gzip
import hashlib

import pytest
from compare import compare, duck
from llm_helpers import SF_DIR

from kessan.llm import queries, warc_revisits


def test_query_against_sql(spark):
    name = "op4_warc_revisits"
    ok, note = compare(spark, duck(SF_DIR), SF_DIR, name, queries.QUERIES[name], queries.SQL[name])
    assert ok, note


ROWS = [
    (1, "http://a/1", "same"), (2, "http://a/2", "same"), (9, None, "same"), (3, "http://a/3", "WARC/1.1\r\n\r\n<p>\r\n\r\n"),
    (4, "http://a/4\r\nX: y", None), (5, "", ""), (6, "http://a/é", "é" * 70_000), (6, "http://a/é", "é" * 70_000),
    (7, "http://a/7", "own"), (7, "http://a/7", "other"), (None, "http://a/none", "same"),
]


@pytest.fixture
def pages(spark):
    # More columns, with names that the operator uses inside.
    rows = [(*r, "x", 1) for r in ROWS]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string, id long")


def test_round_trip_and_headers(spark, pages, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    warc_revisits.write_archives(warc_revisits.responses(pages, "2024-01-01T00:00:00Z"), source)
    back = warc_revisits.read_archives(spark, source).collect()
    assert sorted((r["id"], r["payload"]) for r in back) == sorted((i, t or "") for i, _, t in ROWS if i is not None)
    warc_revisits.resolve_revisits(spark, source, target)
    found = {}
    for path in (tmp_path / "b").glob("part-*.gz"):
        for warc, http, payload in warc_revisits.parse_records(path.read_bytes()):
            found.setdefault(warc["warc-record-id"], []).append((warc, http, payload))
    by_id = lambda i: found[f"<urn:record:{i}>"]
    assert sum(map(len, found.values())) == len(ROWS) - 1
    warc, http, payload = by_id(1)[0]
    assert warc["warc-type"] == "revisit" and payload == b"" and http["content-length"] == "4"
    assert warc["warc-refers-to"] == "<urn:record:9>" and warc["warc-profile"] == warc_revisits.PROFILE
    assert by_id(9)[0][2] == b"same" and "warc-target-uri" not in by_id(9)[0][0]
    assert by_id(3)[0][2].decode() == ROWS[3][2]
    assert by_id(4)[0][0]["warc-target-uri"] == "http://a/4%0D%0AX: y"
    assert [by_id(4)[0][0]["warc-type"], by_id(5)[0][0]["warc-type"]] == ["revisit", "response"]
    assert [r[0]["warc-type"] for r in by_id(6)] == ["response", "response"]
    assert sorted(r[2] for r in by_id(7)) == [b"other", b"own"]
    for records in found.values():
        for warc, _, payload in records:
            if warc["warc-type"] == "response":
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                assert warc["warc-payload-digest"] == f"sha1:{digest}"


def test_small_payloads_stay(spark, pages, tmp_path):
    rows = warc_revisits.archive_pages(pages, "2024-01-01T00:00:00Z", least_bytes=5).collect()
    assert all(r["type"] == "response" for r in rows)


def test_empty_table_and_members(spark, pages):
    assert warc_revisits.archive_pages(pages.limit(0), "2024-01-01T00:00:00Z").count() == 0
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 6\r\n\r\nH\r\n\r\nab"
    record = record.replace(b"Length: 6", b"Length: 7") + b"\r\n\r\n"
    twice = gzip.compress(record) + gzip.compress(record)
    assert [p for _, _, p in warc_revisits.parse_records(twice)] == [b"ab", b"ab"]
    with pytest.raises(ValueError):
        list(warc_revisits.parse_records(record[:-1] + b"x"))


def foreign(kind, record_id, block, content_type="application/http; msgtype=response", *more):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{record_id}>", "WARC-Date: 2020-02-02T00:00:00Z", *more]
    lines += [f"Content-Type: {content_type}"] if content_type else []
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def test_archives_of_other_writers(spark, tmp_path):
    """A member per record, other record types, uuids, no HTTP length, payloads that are no text, wrong digests."""
    image, http = bytes(range(256)) * 300, b"HTTP/1.0 200 OK\r\nServer: x\r\n\r\n"
    wrong = "WARC-Payload-Digest: sha1:AAAA"
    records = [
        foreign("warcinfo", "0", b"software: x\r\n", "application/warc-fields"),
        foreign("request", "1", b"GET / HTTP/1.0\r\n\r\n", "application/http; msgtype=request", "WARC-IP-Address: 10.0.0.1"),
        foreign("response", "a", http + image, "application/http;msgtype=response", "WARC-Target-URI: http://x/a", wrong),
        foreign("response", "b", http + image, "application/http;msgtype=response", "WARC-Target-URI: http://x/b"),
        foreign("resource", "c", image, "image/png"),
        foreign("response", "d", b"dns", "text/dns"),
        foreign("revisit", "e", http, "application/http; msgtype=response", "WARC-Refers-To: <urn:uuid:old>", "WARC-Profile: http://p", wrong),
    ]
    source, target = tmp_path / "other", tmp_path / "without"
    source.mkdir()
    (source / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    warc_revisits.resolve_revisits(spark, str(source), str(target))
    found = {}
    for path in target.glob("part-*.gz"):
        for warc, http_fields, payload in warc_revisits.parse_records(path.read_bytes()):
            found[warc["warc-record-id"].removeprefix("<urn:uuid:").rstrip(">")] = (warc, http_fields, payload)
    assert sorted(found) == ["0", "1", "a", "b", "c", "d", "e"]
    digest = "sha1:" + base64.b32encode(hashlib.sha1(image).digest()).decode()
    assert found["0"][0]["warc-type"] == "warcinfo" and found["0"][2] == b"software: x\r\n"
    assert found["0"][0]["content-type"] == "application/warc-fields"
    assert found["1"][0]["warc-ip-address"] == "10.0.0.1"
    assert found["a"][0]["warc-type"] == "revisit" and found["a"][0]["warc-refers-to"] == "<urn:uuid:b>" and found["a"][2] == b""
    assert found["a"][0]["warc-payload-digest"] == digest and found["a"][0]["warc-refers-to-target-uri"] == "http://x/b"
    assert found["b"][0]["warc-type"] == "response" and found["b"][2] == image and found["b"][1] == {"server": "x"}
    assert found["c"][0]["warc-type"] == "resource" and found["c"][2] == image
    assert found["d"][2] == b"dns" and found["e"][0]["warc-refers-to"] == "<urn:uuid:old>"
    assert found["e"][0]["warc-profile"] == "http://p" and found["e"][0]["warc-payload-digest"] == "sha1:AAAA"
    rows = {r["record_id"]: r for r in warc_revisits.read_archives(spark, str(target)).collect()}
    assert rows["urn:uuid:b"]["payload"] is None and bytes(rows["urn:uuid:b"]["content"]) == image
    assert rows["urn:uuid:d"]["payload"] == "dns" and rows["urn:uuid:d"]["id"] is None
    # Once more changes nothing but the order.
    again = tmp_path / "again"
    warc_revisits.resolve_revisits(spark, str(target), str(again))
    read = lambda path: sorted(map(str, warc_revisits.read_archives(spark, str(path)).collect()))
    assert read(again) == read(target)


def test_archives_cut_short_are_errors():
    whole = gzip.compress(foreign("response", "a", b"HTTP/1.0 200 OK\r\n\r\n" + b"x" * 1000))
    assert len(list(warc_revisits.parse_records(whole))) == 1
    for data in (whole[:-9], gzip.decompress(whole)[:-1], gzip.decompress(whole)[:40]):
        with pytest.raises(ValueError):
            list(warc_revisits.parse_records(data))
