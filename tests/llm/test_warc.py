import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from tradeflow.llm import arc_warc as aw


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


ROWS = [
    (5, "http://a.example/x y", "<p>one</p>"), (3, "http://a.example/2", "<p>one</p>"), (9, None, None), (1, "", ""), (4, "http://b.example/é\n", "line\r\n\r\nWARC/1.1\r\n\n"),
    (8, "http://c.example", "HTTP/1.1 200 OK\r\n\r\nnested"), (7, "http://d.example", "漢" * 40_000), (6, "http://d.example", "<p>one</p>"),
]


def test_round_trip_of_awkward_pages(spark):
    got = {r.page_id: r for r in aw.convert(pages(spark, ROWS)).collect()}
    assert len(got) == len(ROWS)
    first = {}
    for i, _, html in sorted(ROWS, key=lambda r: r[0]):
        first.setdefault(html or "", i)
    for i, _, html in ROWS:
        r = got[i]
        assert (r.payload_bytes, r.payload_digest) == (len((html or "").encode()), sha(html))
        owner = first[html or ""]
        assert (r.record_type, r.refers_to) == (("response", None) if owner == i else ("revisit", owner))
        assert r.date == "2026-04-01T12:00:00Z" and r.record_id.startswith("<urn:uuid:")
    assert got[5].url == "http://a.example/x%20y" and got[9].url == "about:blank"


def test_small_payloads_are_all_responses(spark):
    got = aw.convert(pages(spark, ROWS), min_bytes=5).collect()
    assert {r.page_id for r in got if r.record_type == "revisit"} == {5, 6}


def test_repeats_null_keys_and_empty_tables(spark):
    rows = [(2, "u", "x"), (2, "u", "x"), (None, "u", "x"), (None, "v", "y"), (3, "u", "x")]
    got = sorted((r.page_id is None, r.page_id, r.record_type, r.refers_to) for r in aw.convert(pages(spark, rows)).collect() if r.page_id)
    assert got == [(False, 2, "response", None), (False, 2, "response", None), (False, 3, "revisit", 2)]
    kinds = sorted(r.record_type for r in aw.convert(pages(spark, rows)).collect() if r.page_id is None)
    assert kinds == ["response", "revisit"]
    assert aw.convert(pages(spark, [])).count() == 0


def test_files_hold_version_blocks_of_both_versions(spark, monkeypatch):
    monkeypatch.setattr(aw, "FILE_RECORDS", 3)
    docs = pages(spark, [(k, f"u{k}", f"text {k}") for k in range(20)]).coalesce(1)
    folder = aw.write_arc(docs, "page_id", "url", "html", F.when(F.col("page_id") % 2 == 0, 1).otherwise(2))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(folder).collect()
    assert len(files) >= 8
    for f in files:
        data = aw._inflate(bytes(f.content))
        assert data.startswith(b"filedesc://") and (b"/v1/" in f.path.encode()) == (b"Result-code" not in data)
    assert sorted(r.page_id for r in aw.parse_arc(spark, folder).collect()) == list(range(20))


def test_old_arc_by_hand():
    one = b"filedesc://x.arc 0.0.0.0 19960923142103 text/plain 76\n1 0 org\nURL IP-address Archive-date Content-type Archive-length\nnotes here...\n\n"
    one = one.replace(b" 76\n", b" %d\n" % len(one.split(b"\n", 1)[1][:-2])) + b"http://x.example/a b 127.0.0.1 19961104142103 text/html 5\nhello\n"
    two = b"filedesc://y.arc 0.0.0.0 19960923142103 text/plain 200 - - 0 y.arc 8\n2 0 orgX\nhttp://y.example 127.0.0.1 19961104142103 text/html 200 fac - 0 y.arc 6\na\nb\nc\n\n"
    assert [(r["url"], r["block"]) for r in aw.arc_records(one)] == [("http://x.example/a b", b"hello")]
    assert [(r["checksum"], r["block"]) for r in aw.arc_records(two)] == [("fac", b"a\nb\nc\n")]


def test_damaged_archives_are_refused():
    with pytest.raises(ValueError, match="cut off"):
        list(aw.arc_records(b"http://x 1.1.1.1 19961104142103 text/html 50\nshort\n"))
    with pytest.raises(ValueError, match="declared length"):
        list(aw.warc_records(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabcdef\r\n\r\n"))


def test_short_dates_are_filled_up(spark):
    df = spark.createDataFrame([("2001",), ("20010203040506",), ("200102",)], "d string")
    assert [r.x for r in df.select(aw._warc_date(F.col("d")).alias("x")).collect()] == ["2001-01-01T00:00:00Z", "2001-02-03T04:05:06Z", "2001-02-01T00:00:00Z"]


def test_payloads_in_other_encodings_round_trip(spark, tmp_path):
    """Records written by other tools: Latin-1 bodies with and without an HTTP header, and a binary one."""
    bodies = ["caf\u00e9 \u00fcber".encode("latin-1"), bytes(range(256)) * 3, "plain".encode(), "caf\u00e9 \u00fcber".encode("latin-1")]
    records = []
    for k, body in enumerate(bodies):
        head = b"" if k == 2 else b"HTTP/1.1 200 OK\r\nX-Page-Id: %d\r\nContent-Length: %d\r\n\r\n" % (k, len(body))
        block = head + body
        records.append(b"http://x.example/%d 127.0.0.1 19961104142103 text/html %d\n%s\n" % (k, len(block), block))
    opening = b"1 0 org\nURL IP-address Archive-date Content-type Archive-length\n"
    folder = tmp_path / "arc"
    folder.mkdir()
    (folder / "part-0.arc").write_bytes(b"filedesc://x.arc 0.0.0.0 19960923142103 text/plain %d\n%s\n" % (len(opening), opening) + b"".join(records))
    warc = aw.write_warc(aw.parse_arc(spark, str(folder)))
    got = {r.url[-1]: r for r in aw.read_warc(spark, warc).collect()}
    assert len(got) == 4
    for k, body in enumerate(bodies):
        assert (got[str(k)].payload_bytes, got[str(k)].payload_digest) == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode())
    assert (got["3"].record_type, got["3"].refers_to) == ("revisit", 0)
