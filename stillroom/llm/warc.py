"""WARC archives of page captures: written by tasks, read back, and assembled into one nested row per capture.

A capture is a request, a response and a metadata record; request and metadata name the response in WARC-Concurrent-To.
Of captures with equal payloads of at least ``revisit_from`` bytes, the one with the largest page_id keeps the payload;
the others are revisit records that refer to it. Each record is a gzip member of its own.

Reading gives a row for each record. Assembly follows the concurrent-to identifiers, in whichever direction and over at
most one record in between, to the response they belong to; a request or metadata record that leads to none makes a
capture without a response.

Defined results: null html is an empty payload; a null url is archived as ``about:blank``, white space and control
characters in it percent-encoded; a null page_id is left out of the metadata and never the largest, so that only a
capture whose equals have null ids as well refers to nothing; rows that repeat page_id and payload are archived each.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stillroom.llm.common import partitions_of, stored
from stillroom.llm.rawfiles import make_folder, reading, writing

SHARD_BYTES = 256 << 20
READ_BYTES = 1 << 20
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the public namespace of URLs
RECORD = "record_id string, warc_type string, concurrent_to array<string>, refers_to string, target_uri string, date string, fields string, payload_bytes long, payload_digest string"


def record_id(kind: str, *parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, '|'.join(map(str, (kind, *parts))))}>"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n"
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def capture(page_id: int | None, url: str | None, html: str | None, sha1: str, copy: int, source: int | None, date: str) -> list[bytes]:
    """The three records of a page. source: the page_id of the response that a revisit refers to."""
    payload = (html or "").encode()
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "about:blank"
    own, digest = record_id("response", page_id, sha1, copy), f"sha1:{digest_of(payload)}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    both = [("WARC-Date", date), ("WARC-Target-URI", uri)]
    if source is None:
        main = record([("WARC-Type", "response"), ("WARC-Record-ID", own), *both, ("WARC-Payload-Digest", digest), ("Content-Type", "application/http;msgtype=response")], http + payload)
    else:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        main = record([("WARC-Type", "revisit"), ("WARC-Record-ID", own), *both, ("WARC-Profile", profile), ("WARC-Refers-To", record_id("response", source, sha1, 0)), ("WARC-Payload-Digest", digest), ("Content-Type", "application/http;msgtype=response")], http)
    host, path = re.match(r"(?:[^:/?#]*://)?([^/?#]*)([^#]*)", uri).groups()
    asked = record([("WARC-Type", "request"), ("WARC-Record-ID", record_id("request", page_id, sha1, copy)), *both, ("WARC-Concurrent-To", own), ("Content-Type", "application/http;msgtype=request")], f"GET {path or '/'} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode())
    about = f"page-id: {page_id}\r\n" if page_id is not None else "\r\n"
    meta = record([("WARC-Type", "metadata"), ("WARC-Record-ID", record_id("metadata", page_id, sha1, copy)), *both, ("WARC-Concurrent-To", own), ("Content-Type", "application/warc-fields")], about.encode())
    return [asked, main, meta]


def write_archives(pages: DataFrame, folder: str, revisit_from: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Archives all of ``pages`` (page_id, url, html). Returns a row for each file: name, records."""
    html = F.coalesce(pages["html"], F.lit(""))
    rows = pages.select(pages["page_id"].cast("long"), pages["url"], pages["html"], F.sha1(html.cast("binary")).alias("sha1"))
    seen = rows.groupBy("sha1", "page_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length(F.coalesce("html", F.lit("")))).alias("size"))
    seen = stored(seen, "payloads")
    several = seen.filter(F.col("size") >= revisit_from).groupBy("sha1").agg(F.max("page_id").alias("top"), F.sum("n").alias("n")).filter("n > 1").select("sha1", "top")
    if seen.filter("n > 1").isEmpty():
        rows = rows.withColumn("copy", F.lit(0))
    else:
        rows = rows.withColumn("copy", F.row_number().over(W.partitionBy("page_id", "sha1").orderBy("url")) - 1)
    several = stored(several, "equal-payloads")
    rows = rows.join(several, "sha1", "left")
    source = F.when(F.col("page_id").eqNullSafe(F.col("top")), F.lit(None)).otherwise(F.col("top"))
    rows = rows.select("page_id", "url", "html", "sha1", "copy", source.alias("source"))
    make_folder(folder)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, k, number = TaskContext.get().partitionId(), 0, lambda x: None if pd.isna(x) else int(x)
        waiting = (r for b in batches for r in zip(b["page_id"].astype("Int64"), b["url"], b["html"], b["sha1"], b["copy"], b["source"].astype("Int64"), strict=True))
        row = next(waiting, None)
        while row is not None:
            name, size, records = f"capture-{part:06d}-{k:04d}.warc.gz", 0, 0
            with writing(f"{folder}/{name}") as out:
                while row is not None and size < SHARD_BYTES:
                    page_id, url, text, sha1, copy, source = row
                    for one in capture(number(page_id), url, text, sha1, int(copy), number(source), date):
                        member = gzip.compress(one, 4, mtime=0)
                        out.write(member)
                        size += len(member)
                        records += 1
                    row = next(waiting, None)
            yield pd.DataFrame({"name": [name], "records": [records]})
            k += 1

    return stored(rows.mapInPandas(write, "name string, records long"), "archive-files")


def members(source) -> Iterator[bytes]:
    """The decompressed gzip members of an open file, one by one."""
    rest, unpress, parts = b"", zlib.decompressobj(31), []
    while True:
        data = rest or source.read(READ_BYTES)
        if not data:
            if parts and b"".join(parts):
                raise ValueError("the archive ends within a record")
            return
        parts.append(unpress.decompress(data))
        rest = unpress.unused_data
        if unpress.eof:
            yield b"".join(parts)
            unpress, parts = zlib.decompressobj(31), []


def parse(data: bytes) -> tuple[dict, bytes | None]:
    """The row of a record, and the payload it holds."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = [line.split(": ", 1) for line in head.decode().split("\r\n")[1:]]
    fields = {k.lower(): v for k, v in lines}
    block = rest[: int(fields["content-length"])]
    if len(rest) != len(block) + 4:
        raise ValueError(f"the record {fields.get('warc-record-id')} is not whole")
    kind, payload, size, digest, text = fields["warc-type"], None, None, None, None
    if kind in ("response", "revisit"):
        text, _, body = block.partition(b"\r\n\r\n")
        size = int(re.search(rb"(?i)\r\ncontent-length: *([0-9]+)", b"\r\n" + text)[1])
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        if kind == "response":
            payload = body
            if len(body) != size or digest_of(body) != digest:
                raise ValueError(f"the payload of {fields['warc-record-id']} is not what was archived")
    else:
        text = block
    return {
        "record_id": fields["warc-record-id"], "warc_type": kind, "concurrent_to": [v for k, v in lines if k.lower() == "warc-concurrent-to"], "refers_to": fields.get("warc-refers-to"),
        "target_uri": fields.get("warc-target-uri"), "date": fields.get("warc-date"), "fields": text.decode(), "payload_bytes": size, "payload_digest": digest,
    }, payload


def read_records(spark: SparkSession, folder: str, files: DataFrame, with_payload: bool = False) -> DataFrame:
    """A row for each record of the named files; a response's payload is checked against its digest."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in RECORD.split(", ")] + ["payload"] * with_payload
        for batch in batches:
            for name in batch["name"]:
                with reading(f"{folder}/{name}") as source:
                    rows, size = [], 0
                    for data in members(source):
                        row, payload = parse(data)
                        rows.append(row | ({"payload": payload} if with_payload else {}))
                        size += len(data) if with_payload else 1000
                        if size > 16 << 20:
                            yield typed(rows, columns)
                            rows, size = [], 0
                    if rows:
                        yield typed(rows, columns)

    def typed(rows: list[dict], columns: list[str]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=columns).astype({"payload_bytes": "Int64"})

    spread = files.select("name").repartition(partitions_of(spark), "name")
    return spread.mapInPandas(read, RECORD + ", payload binary" * with_payload)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row for each capture: capture_id, response, requests and metadata (structs of the records' columns).

    records: as ``read_records`` gives them, stored, since they are read several times.
    """
    is_main = F.col("warc_type").isin("response", "revisit")
    named = records.select("record_id", is_main.alias("main"), F.explode("concurrent_to").alias("other"))
    links = named.select(F.col("record_id").alias("a"), F.col("other").alias("b")).unionByName(named.select(F.col("other").alias("a"), F.col("record_id").alias("b"))).distinct()
    mains = records.filter(is_main).select(F.col("record_id").alias("capture"))
    sides = records.filter(~is_main)
    near = links.join(mains, links["b"] == mains["capture"]).groupBy("a").agg(F.min("capture").alias("capture"))
    near = near.withColumnRenamed("a", "member")
    far = links.join(near, links["b"] == near["member"]).groupBy("a").agg(F.min("capture").alias("capture_far")).withColumnRenamed("a", "member_far")
    placed = sides.join(near, sides["record_id"] == near["member"], "left").join(far, sides["record_id"] == far["member_far"], "left")
    capture = F.coalesce("capture", "capture_far", F.array_min("concurrent_to"), "record_id")
    whole = F.struct(*records.columns)
    grouped = placed.select(capture.alias("of"), F.col("warc_type").alias("kind"), whole.alias("record")).groupBy("of").agg(
        F.sort_array(F.collect_list(F.when(F.col("kind") == "request", F.col("record")))).alias("requests"),
        F.sort_array(F.collect_list(F.when(F.col("kind") != "request", F.col("record")))).alias("metadata"),
    )
    main = records.filter(is_main).select(F.col("record_id").alias("main_id"), whole.alias("response"))
    empty = F.array().cast(grouped.schema["requests"].dataType)
    return main.join(grouped, F.col("main_id") == F.col("of"), "full").select(
        F.coalesce("main_id", "of").alias("capture_id"), "response", F.coalesce("requests", empty).alias("requests"), F.coalesce("metadata", empty).alias("metadata")
    )


def captures(assembled: DataFrame) -> DataFrame:
    """A row for each capture with a response: page_id (from its metadata), payload_bytes, payload_digest, record_type
    and refers_to (the page_id of the capture a revisit refers to). assembled: stored."""
    number = F.regexp_extract(F.array_join(F.transform("metadata", lambda m: m["fields"]), "\n"), r"page-id: (-?[0-9]+)", 1)
    rows = assembled.filter("response IS NOT NULL").select("capture_id", F.when(number != "", number).cast("long").alias("page_id"), "response")
    pages = rows.select(F.col("capture_id").alias("target"), F.col("page_id").alias("target_page"))
    out = rows.select("page_id", "response.*").join(pages, F.col("refers_to") == F.col("target"), "left")
    return out.select("page_id", "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), F.col("target_page").alias("refers_to"))
