"""Converter of legacy ARC archives to WARC.

An ARC file starts with a version block whose first line declares the version; its header fields differ
between version 1 (``URL IP-address Archive-date Content-type Archive-length``) and version 2 (which adds
result code, checksum, location, offset and file name). Records follow as one header line, exactly the declared
number of bytes, and a line break; bytes are never searched for record borders. Every record becomes a WARC
``response`` with a record id derived from its content and place, a timestamp from its archive date, and block
and payload digests; records whose payload an earlier one (smallest key) already holds become ``revisit``.

Files are written by Spark's text sink below the session's shared folder, gzip-compressed, and read back as
binary files, so both sides run on any store that Spark reaches. Payloads travel as bytes, whatever their encoding is. A file
holds ``FILE_RECORDS`` records, which a task has in memory together.

Defined cases: a null payload is empty; blanks and control characters in a URL are percent-encoded and a null
URL is ``about:blank``; rows with a null key are kept, sort last and never lend their key to others; of repeated
rows with one key and payload every row is kept, all with that key's type; an empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.session import fresh_path

# The header fields of the two ARC versions, and the date all generated records carry.
ARC_FIELDS = {
    1: ("url", "ip", "date", "mime", "length"),
    2: ("url", "ip", "date", "mime", "result", "checksum", "location", "offset", "filename", "length"),
}
ARC_DATE = "20260401120000"
#: Records of one written archive file; further ones go to the next file.
FILE_RECORDS = 1_000
#: HTTP header that carries a page's key through the archives.
KEY_HEADER = "X-Page-Id"


def _encoded_url(url: Column) -> Column:
    """The URL with blanks and control characters percent-encoded, so a header line stays one line."""
    out = F.coalesce(url, F.lit("about:blank"))
    for code in (*range(0x21), 0x7F):
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(out == "", "about:blank").otherwise(out)


def write_arc(pages: DataFrame, key: str, url: str, payload: str, version_of: Column, label: str = "arc") -> str:
    """Writes one ARC record for each row, files of one version each, and returns their folder.

    ``version_of`` gives 1 or 2. Each file's first block is its version block.
    """
    spark = pages.sparkSession
    body = F.coalesce(pages[payload], F.lit(""))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        F.when(pages[key].isNotNull(), F.concat(F.lit(f"{KEY_HEADER}: "), pages[key].cast("string"), F.lit("\r\n"))).otherwise(""),
        F.lit("Content-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    rows = pages.select(_encoded_url(pages[url]).alias("url"), head.alias("head"), body.alias("body"), version_of.alias("version"))
    folder = fresh_path(spark, label)
    for version in ARC_FIELDS:
        size = (F.octet_length("head") + F.octet_length("body")).cast("string")
        middle = "" if version == 1 else " 200 - - 0 -"
        line = F.concat("url", F.lit(f" 0.0.0.0 {ARC_DATE} text/html{middle} "), size, F.lit("\n"))
        own = rows.filter(F.col("version") == version).select(F.concat(line, "head", "body").alias("value"))
        title = " ".join({1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"), 2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length")}[version])
        block = f"{version} 0 converter\n{title}\n"
        fields = "" if version == 1 else "200 - - 0 - "
        opening = f"filedesc://{label}.arc 0.0.0.0 {ARC_DATE} text/plain {fields}{len(block)}\n{block}"
        _write_files(own, f"{folder}/v{version}", "\n", opening)
    return folder


def _write_files(records: DataFrame, path: str, between: str, opening: str = "") -> None:
    """One string column as files of ``FILE_RECORDS`` records, each followed by ``between``, each file begun with ``opening``."""
    if opening:
        # The low 33 bits of this id number the rows of a partition, and every FILE_RECORDS-th row starts a file.
        number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        first = number % FILE_RECORDS == 0
        records = records.select(F.when(first, F.concat(F.lit(opening + between), "value")).otherwise(F.col("value")).alias("value"))
    records.write.option("maxRecordsPerFile", FILE_RECORDS).option("lineSep", between).option("compression", "gzip").text(path)


def _inflate(data: bytes) -> bytes:
    """Contents of a gzip file of one or more members; other data as it is."""
    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data:
        member = zlib.decompressobj(31)
        out.append(member.decompress(data) + member.flush())
        data = member.unused_data
    return b"".join(out)


def arc_records(data: bytes) -> Iterator[dict]:
    """Records of an ARC file, by its version's header fields and the declared lengths."""
    at, fields = 0, ARC_FIELDS[1]
    while at < len(data):
        stop = data.index(b"\n", at)
        line = data[at:stop].decode("utf-8", "replace").rstrip("\r")
        if not line:  # blank lines between records
            at = stop + 1
            continue
        opening = line.startswith("filedesc://")
        length = int(line.rsplit(" ", 1)[1])
        block = data[stop + 1 : stop + 1 + length]
        if len(block) < length:
            raise ValueError(f"record of {length} bytes is cut off after {len(block)}")
        at = stop + 1 + length
        if opening:
            fields = ARC_FIELDS[int(block.split(b" ", 1)[0])]
        else:
            parts = line.rsplit(" ", len(fields) - 1)  # a URL may hold blanks in old files
            if len(parts) != len(fields):
                raise ValueError(f"header line has {len(parts)} of {len(fields)} fields")
            yield dict(zip(fields, parts, strict=True)) | {"block": block}


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _http(block: bytes) -> tuple[bytes, bytes]:
    """Header part (with its blank line) and body of an HTTP message; a block without one is all body."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    head, blank, body = block.partition(b"\r\n\r\n")
    return head + blank, body


def _key(head: bytes) -> int | None:
    found = re.search(rb"\r\n" + KEY_HEADER.encode() + rb": (-?\d+)\r\n", head)
    return int(found[1]) if found else None


def _binary(spark, folder: str, pattern: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder).select("content")


def parse_arc(spark, folder: str) -> DataFrame:
    """``page_id, url, date, mime, head, payload, payload_digest`` of all ARC records below ``folder``; head and payload are bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = []
                for record in arc_records(_inflate(content)):
                    head, body = _http(record["block"])
                    rows.append((_key(head), urllib.parse.quote(record["url"], safe=":/?#[]@!$&'()*+,;=%~-._"), record["date"], record["mime"], head, body, base32_sha1(body), len(body)))
                out = pd.DataFrame(rows, columns=["page_id", "url", "date", "mime", "head", "payload", "payload_digest", "payload_bytes"])
                yield out.astype({"page_id": "Int64", "payload_bytes": "int64"})

    schema = "page_id long, url string, date string, mime string, head binary, payload binary, payload_digest string, payload_bytes long"
    return _binary(spark, folder, "part-*").mapInPandas(run, schema)


def _warc_date(date: Column) -> Column:
    """``YYYY-MM-DDThh:mm:ssZ`` of an ARC date; shorter dates are filled up to their first instant."""
    full = F.concat(date, F.substring(F.lit("19700101000000"), F.length(date) + 1, F.lit(14)))
    return F.regexp_replace(full, r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2}).*$", "$1-$2-$3T$4:$5:$6Z")


def _record_id(*parts: Column) -> Column:
    """A name-based identifier in UUID form."""
    hexed = F.sha1(F.concat_ws("\u0001", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(F.substring(hexed, 1, 32), r"^(.{8})(.{4}).(.{3}).(.{3})(.{12})$", "$1-$2-5$3-8$4-$5"), F.lit(">"))


def write_warc(records: DataFrame, min_bytes: int = 0, label: str = "warc") -> str:
    """Writes ``parse_arc``'s records as WARC files and returns their folder.

    Of records with equal payloads of at least ``min_bytes`` bytes, the one with the smallest ``page_id`` is the
    response and the others revisit it. First keys of repeated payloads are found by a pre-aggregated count and
    joined back, so a payload that a third of all records share is no hot task.
    """
    spark = records.sparkSession
    large = records.filter(F.col("payload_bytes") >= min_bytes)
    shared = (
        large.groupBy(F.col("payload_digest").alias("digest")).agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 AND first IS NOT NULL").select("digest", "first")
    )
    match = (records["payload_digest"] == shared["digest"]) & (records["payload_bytes"] >= min_bytes) & ~records["page_id"].eqNullSafe(shared["first"])
    rows = records.join(shared, match, "left").drop("digest")
    revisit = F.col("first").isNotNull()
    block = F.when(revisit, F.col("head")).otherwise(F.concat("head", "payload"))
    rows = rows.withColumn("block", block)
    fields = [
        ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        ("WARC-Record-ID", _record_id(F.lit("record"), F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.col("url"), F.col("payload_digest"))),
        ("WARC-Date", _warc_date(F.col("date"))),
        ("WARC-Target-URI", F.col("url")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        ("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        ("WARC-Refers-To-Page", F.col("first").cast("string")),
        ("Content-Type", F.when(F.octet_length("head") > 0, "application/http; msgtype=response").otherwise(F.col("mime"))),
        ("Content-Length", F.octet_length("block").cast("string")),
    ]
    lines = F.concat_ws("\r\n", F.lit("WARC/1.1"), *[F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), v)) for k, v in fields])
    folder = fresh_path(spark, label)
    # The cast keeps bytes as they are, also those that are no UTF-8, and so does the text sink.
    _write_files(rows.select(F.concat(lines, F.lit("\r\n\r\n"), F.col("block").cast("string")).alias("value")), folder, "\r\n\r\n")
    return folder


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record, by declared lengths."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("no record at the expected place")
        head = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        start = stop + 4
        end = start + int(head["content-length"])
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError("declared length does not reach the record's end")
        yield head, data[start:end]
        at = end + 4


def read_warc(spark, folder: str) -> DataFrame:
    """``page_id, record_id, url, date, payload_bytes, payload_digest, record_type, refers_to`` of all WARC records.

    A response's digest is recomputed from its payload and must equal the stored one.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = []
                for head, block in warc_records(_inflate(content)):
                    http, body = _http(block)
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    said = re.search(rb"\r\nContent-Length: (\d+)\r\n", http, re.I)
                    size = int(said[1]) if said else len(body)
                    if head["warc-type"] == "response" and (base32_sha1(body) != digest or len(body) != size):
                        raise ValueError(f"payload of {head['warc-record-id']} does not match its digest")
                    refers = head.get("warc-refers-to-page")
                    rows.append((_key(http), head["warc-record-id"], head["warc-target-uri"], head["warc-date"], size, digest, head["warc-type"], None if refers is None else int(refers)))
                names = ["page_id", "record_id", "url", "date", "payload_bytes", "payload_digest", "record_type", "refers_to"]
                yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "payload_bytes": "int64", "refers_to": "Int64"})

    schema = "page_id long, record_id string, url string, date string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return _binary(spark, folder, "part-*").mapInPandas(run, schema)


def convert(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0) -> DataFrame:
    """Rows to ARC files of both versions, ARC to WARC, and the WARC files read back."""
    spark = pages.sparkSession
    version = F.when(F.xxhash64(pages[url]) % 2 == 0, 1).otherwise(2)
    arc = write_arc(pages, key, url, payload, version)
    warc = write_warc(parse_arc(spark, arc), min_bytes)
    return read_warc(spark, warc)
