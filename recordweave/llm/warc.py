"""WARC archives as seekable Zstandard bundles.

Each task packs its pages into bundles. A bundle is a row of independent Zstandard frames, each with a few records,
and ends with a skippable frame that holds the seek table (compressed and plain size of every frame). Beside the bytes
stands an index from record identifier to frame and offset within the frame, so one record costs one small frame.

Of pages with equal payloads the one with the largest page_id is stored as `response`; the others are `revisit`
records that refer to it. Null html is an empty payload. Rows that repeat a page_id and its payload are alike: where
the id is the largest, all are responses. A null page_id is never referred to and its row is a response. Null urls
have no WARC-Target-URI. An empty table gives no bundle.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordweave.llm.common import stage, table

FRAME = 256 << 10
BUNDLE = 16 << 20
LEVEL = 3
#: Payloads of at least so many bytes are stored once.
LEAST_BYTES = 0
#: More repeated payloads than this are joined by a salted shuffle, not broadcast.
BROADCAST_DIGESTS = 500_000
SALTS = 32
#: Fixed values of the seekable format.
SKIPPABLE_MAGIC, SEEK_MAGIC = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BUNDLES = "bundle_id string, data binary, frames int, index array<struct<record_id:string,frame:int,offset:int,length:int>>"
RECORDS = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def record_id(page_id: int | None) -> str:
    return "<urn:page:>" if page_id is None else f"<urn:page:{page_id}>"


def page_of(identifier: str | None) -> int | None:
    return int(identifier[10:-1]) if identifier and len(identifier) > 11 else None


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP head, with the length of the payload, and no payload."""
    revisit = refers_to is not None
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    if revisit:
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, offset: int) -> tuple[dict, bytes, int, int]:
    """(headers, payload, length named by the HTTP head, end) of the record at offset."""
    split = data.index(b"\r\n\r\n", offset)
    first, *lines = data[offset:split].decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record here")
    headers = dict(line.split(": ", 1) for line in lines)
    start = split + 4
    end = start + int(headers["Content-Length"])
    body = data.index(b"\r\n\r\n", start) + 4
    length = int(data[start:body].decode().split("Content-Length: ")[1].split("\r\n")[0])
    return headers, data[body:end], length, end + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    entries = b"".join(struct.pack("<II", *s) for s in sizes)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + 9) + entries + struct.pack("<IBI", len(sizes), 0, SEEK_MAGIC)


def read_seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, plain size) of each frame, from the footer alone."""
    n, _, magic = struct.unpack("<IBI", data[-9:])
    if magic != SEEK_MAGIC:
        raise ValueError("no seek table")
    at, out = 0, []
    for c, p in struct.iter_unpack("<II", data[-9 - 8 * n : -9]):
        out.append((at, c, p))
        at += c
    return out


def read_frame(data: bytes, frame: int) -> bytes:
    at, c, p = read_seek_table(data)[frame]
    return zstandard.ZstdDecompressor().decompress(data[at : at + c], max_output_size=max(p, 1))


def with_references(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, html, sha1 (hex) and refers_to: the page that holds the same payload, null for responses."""
    body = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    rows = pages.select("page_id", "url", "html", F.when(F.length(body) >= least, F.sha1(body)).alias("sha1"))
    twice = rows.filter("sha1 is not null and page_id is not null").groupBy("sha1").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).filter("n > 1").select("sha1", "keeper")
    twice = stage(twice, "warc-digests")
    if twice.count() <= BROADCAST_DIGESTS:
        joined = rows.join(F.broadcast(twice), "sha1", "left")
    else:
        salted = twice.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")).join(salted, ["sha1", "salt"], "left")
    return joined.select("page_id", "url", "html", F.when(F.col("page_id") != F.col("keeper"), F.col("keeper")).alias("refers_to"))


def write_bundles(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Bundles with seek table and index; pages needs page_id, url, html and refers_to."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, made = TaskContext.get().partitionId(), 0
        data, sizes, index, frame = [], [], [], bytearray()
        squeeze = zstandard.ZstdCompressor(level=LEVEL)

        def end_frame() -> None:
            if frame:
                data.append(squeeze.compress(bytes(frame)))
                sizes.append((len(data[-1]), len(frame)))
                frame.clear()

        def bundle() -> pd.DataFrame:
            nonlocal made
            end_frame()
            out = pd.DataFrame({"bundle_id": [f"{task:06d}-{made:06d}"], "data": [b"".join(data) + seek_table(sizes)], "frames": [len(sizes)], "index": [list(index)]})
            made += 1
            for x in (data, sizes, index):
                x.clear()
            return out

        for b in batches:
            for page_id, url, html, refers in zip(b.page_id, b.url, b.html, b.refers_to):
                page_id, refers = (None if pd.isna(x) else int(x) for x in (page_id, refers))
                payload = (html or "").encode("utf-8", "surrogatepass")
                record = build_record(page_id, url, payload, base64.b32encode(hashlib.sha1(payload).digest()).decode(), refers, date)
                index.append({"record_id": record_id(page_id), "frame": len(sizes), "offset": len(frame), "length": len(record)})
                frame += record
                if len(frame) >= FRAME:
                    end_frame()
                    if sum(s[0] for s in sizes) >= BUNDLE:
                        yield bundle()
        if index:
            yield bundle()

    wide = pages.select(F.col("page_id").cast("long"), "url", "html", F.col("refers_to").cast("long"))
    return wide.mapInPandas(pack, BUNDLES)


def read_bundles(bundles: DataFrame) -> DataFrame:
    """Every record of the bundles, frame by frame; payloads of responses are checked against their digests."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for data in b.data:
                for k in range(len(read_seek_table(data))):
                    yield pd.DataFrame(_records(read_frame(data, k)), columns=RECORDS_NAMES).astype({"page_id": "Int64", "refers_to": "Int64"})

    return bundles.select("data").mapInPandas(unpack, RECORDS)


RECORDS_NAMES = [c.split()[0] for c in RECORDS.split(", ")]


def _records(plain: bytes) -> list[tuple]:
    at, out = 0, []
    while at < len(plain):
        headers, payload, length, at = parse_record(plain, at)
        kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
        if kind == "response" and (len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
            raise ValueError(f"payload of {headers['WARC-Record-ID']} is damaged")
        out.append((page_of(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), kind, length, digest, page_of(headers.get("WARC-Refers-To")), payload))
    return out


def fetch(bundles: DataFrame, record_ids: DataFrame) -> DataFrame:
    """Records named by record_ids (one column record_id): the index picks bundle, frame and offset; one frame is read."""
    entries = bundles.select("bundle_id", F.explode("index").alias("e")).select("bundle_id", "e.*")
    wanted = entries.join(record_ids.select("record_id").distinct(), "record_id")
    grouped = wanted.groupBy("bundle_id").agg(F.collect_list(F.struct("frame", "offset")).alias("at"))

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for data, at in zip(b.data, b["at"]):
                for place in at:
                    frame = read_frame(data, place["frame"])
                    headers, payload, length, _ = parse_record(frame, place["offset"])
                    row = (page_of(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), headers["WARC-Type"], length, headers["WARC-Payload-Digest"].removeprefix("sha1:"), page_of(headers.get("WARC-Refers-To")), payload)
                    yield pd.DataFrame([row], columns=RECORDS_NAMES).astype({"page_id": "Int64", "refers_to": "Int64"})

    return bundles.join(grouped, "bundle_id").select("data", "at").mapInPandas(pick, RECORDS)


def export_files(bundles: DataFrame, folder: str) -> None:
    """Write each bundle as `<bundle_id>.warc.zst` to a folder that all executors share (a mounted path)."""

    def save(rows) -> None:
        for r in rows:
            part = f"{folder}/.{r.bundle_id}.{TaskContext.get().taskAttemptId()}"
            with open(part, "wb") as f:
                f.write(r.data)
            os.replace(part, f"{folder}/{r.bundle_id}.warc.zst")

    bundles.select("bundle_id", "data").foreachPartition(save)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundles = stage(write_bundles(with_references(table(spark, sf_dir, "pages"))), "warc-bundles")
    return read_bundles(bundles).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Digests are spelled from the 160 bits of SHA-1, five at a time.
SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), m AS (SELECT h, max(page_id) AS top, count(*) AS copies FROM p GROUP BY h),
d AS (SELECT *, array_to_string(list_transform(string_split(sha1(h), ''), lambda x: ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111'][strpos('0123456789abcdef', x)]), '') AS bits FROM m)
SELECT page_id, CAST(strlen(d.h) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + 16 * CAST(bits[5 * i + 1] AS INT) + 8 * CAST(bits[5 * i + 2] AS INT) + 4 * CAST(bits[5 * i + 3] AS INT) + 2 * CAST(bits[5 * i + 4] AS INT) + CAST(bits[5 * i + 5] AS INT) AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to
FROM p JOIN d ON p.h = d.h
"""
