"""WARC round trip."""

import gzip
import hashlib

import pytest

from rankforge.llm import warc
from rankforge.session import shared_path

PAGES = [
    (1, "http://h/a?b=1", "x" * 200), (2, None, "x" * 200), (None, "u\r\nX-Evil: y", "x" * 200), (1, "u", "x" * 200),
    (5, "http://h", "\r\n\r\nWARC/1.1\r\n"), (5, "http://h", "\r\n\r\nWARC/1.1\r\n"), (None, None, None), (7, "", ""),
    (8, "z", "é" * 60), (3, "z", "é" * 60), (9, "long", "word " * 60000), (10, "s", "y" * 99), (11, "s", "y" * 99),
]
SCHEMA = "page_id long, url string, html string"


def expected(rows):
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 100:
            old = first.get(b)
            first[b] = i if old is None else old if i is None else min(i, old)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        f = first.get(b)
        revisit = len(b) >= 100 and i != f
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", f if revisit else None))
    return sorted(out, key=str)


def test_round_trip_equals_plain_python(spark):
    df = spark.createDataFrame([(*r, 0) for r in PAGES], SCHEMA + ", payload_digest int")
    assert sorted((tuple(r) for r in warc.round_trip(df).collect()), key=str) == expected(PAGES)


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).collect() == []


def test_captures_are_nested_rows_with_payload(spark):
    path = shared_path(spark, "test", "warc")
    warc.write_captures(spark.createDataFrame(PAGES, SCHEMA), path, captures_per_file=2)
    found = warc.assemble(warc.read_records(spark, path)).collect()
    assert len(found) == len(PAGES) and all(r.n_records == 3 and r.request and r.metadata.fields for r in found)
    payloads = sorted(bytes(r.response.payload) for r in found if r.response.record_type == "response")
    assert sum(p == b"x" * 200 for p in payloads) == 2 and "é".encode() * 60 in payloads   # page 1 twice
    assert all(r.response.digest_valid for r in found if r.response.record_type == "response")
    assert all("\n" not in (r.request.target_uri or "") for r in found)


def test_reads_members_and_two_hops(spark, tmp_path):
    def record(kind, rid, body, **more):
        head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{rid}>", *[f"{k.replace('_', '-')}: <{v}>" for k, v in more.items()],
                f"Content-Length: {len(body)}"]
        return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + body + b"\r\n\r\n"

    parts = [record("warcinfo", "w", b"software: test"),
             record("response", "a", b"HTTP/1.1 200 OK\r\n\r\nhello"),
             record("request", "b", b"GET / HTTP/1.1\r\n\r\n", WARC_Concurrent_To="a"),
             record("metadata", "c", b"page-id: 4\r\n", WARC_Concurrent_To="b"),
             record("response", "d", b"no header end")]
    (tmp_path / "x.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts[:3]))
    (tmp_path / "y.warc").write_bytes(b"".join(parts[3:]))
    got = {r.capture_id: r for r in warc.assemble(warc.read_records(spark, str(tmp_path))).collect()}
    a = got["<a>"]
    assert (a.n_records, bytes(a.response.payload), a.request.record_id, a.metadata.fields["page-id"]) == (3, b"hello", "<b>", "4")
    assert got["<d>"].request is None and got["<d>"].response.payload_bytes == 0
    assert got["<w>"].response is None


def test_a_broken_archive_fails():
    good = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    assert len(list(warc._records(good + good))) == 2
    with pytest.raises(ValueError):
        list(warc._records(good[:-8]))
    with pytest.raises(ValueError):
        list(warc._records(b"nonsense\r\n\r\n"))


def test_files_are_cut_by_bytes(spark):
    """Pages of many sizes: no file holds more than the limit, or one capture; nothing is lost."""
    import glob

    rows = [(i, "http://h", chr(97 + i % 26) * (50 << (i % 11))) for i in range(160)]
    path = shared_path(spark, "test", "warc-bytes")
    warc.write_captures(spark.createDataFrame(rows, SCHEMA).coalesce(1), path, captures_per_file=32, file_bytes=32 * 400)
    files = glob.glob(f"{path.replace('file:', '')}/*.gz")
    assert len(files) > 10
    for f in files:
        data = gzip.open(f).read()
        assert len(data) <= 32 * 400 + 32 * 2000 or data.count(b"WARC-Type: request") == 1
    read = warc.read_records(spark, path)
    assert read.count() == 3 * len(rows) and read.where("NOT digest_valid").count() == 0
