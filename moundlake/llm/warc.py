"""WARC archives: writing with segmentation, reading with reassembly.

``write_archive`` turns each page into a record. The block of a response is an HTTP message whose body
is the page's payload in chunked transfer framing. A block longer than ``segment_bytes`` is cut into a first
``response`` record and ``continuation`` records that name it as their origin; the last one states the total length.
Of equal payloads of at least 100 bytes the one with the smallest id is a response, the others are
``revisit`` records that refer to it. The archive is a folder of gzip files of at most ``FILE_RECORDS`` records on
shared storage, written by Spark's own text writer (a record is one value, its closing line break the separator).

``read_archive`` parses the files by Content-Length (any payload bytes are safe), groups continuation records by their
origin, orders them by segment number, verifies that the numbers run from 1 without gaps and that the lengths add up to the stated
total, and decodes the chunked framing. Records that fail, and bytes between records that are none, are returned with ``complete`` false
and no payload; the records after them are read.

Only segments are shuffled (a group is one page); whole records are decoded where they are read. Equal payloads
are found on digests; the page table meets only the list of revisits.

Defined results: a null html is an empty payload; a null id gives a record without that header (it comes back
null) and sorts last among equal payloads; repeated rows are separate records told apart by their place in the input;
an empty table gives an empty archive and no rows; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from moundlake.llm.common import drop_table, put_down, shared_path, table, with_locator

LEAST_REVISIT = 100
SEGMENT_BYTES, CHUNK_BYTES = 16_384, 4_096
FILE_RECORDS = 4_096
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing of a body."""
    parts = [b"%x\r\n%s\r\n" % (len(piece), piece) for at in range(0, len(payload), size) if (piece := payload[at:at + size])]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """The body without its framing; None where the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return None
        digits = body[at:end].split(b";")[0].strip()
        if not re.fullmatch(rb"[0-9A-Fa-f]+", digits):  # no signs, no underscores
            return None
        n, at = int(digits, 16), end + 2
        if n == 0:
            return b"".join(out)
        if body[at + n:at + n + 2] != b"\r\n":
            return None
        out.append(body[at:at + n])
        at += n + 2


def payload_of(block: bytes) -> bytes | None:
    """The payload of an HTTP message."""
    head, mark, body = block.partition(b"\r\n\r\n")
    if not mark:
        return None
    coded = any(line.lower().replace(b" ", b"") == b"transfer-encoding:chunked" for line in head.split(b"\r\n")[1:])
    return unchunked(body) if coded else body


def record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record without the last of its two closing line breaks (the writer's separator)."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers if v is not None)
    return f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n"


def response_records(rid: str, page: str | None, uri: str | None, payload: bytes, digest: str, segment_bytes: int, date: str) -> list[bytes]:
    block = HTTP_HEAD + chunked(payload)
    about = [("WARC-Date", date), ("WARC-Target-URI", uri), ("X-Page-Id", page), ("WARC-Payload-Digest", f"sha256:{digest}"),
             ("Content-Type", "application/http; msgtype=response")]
    if len(block) <= segment_bytes:
        return [record([("WARC-Type", "response"), ("WARC-Record-ID", f"<{rid}>"), *about], block)]
    cuts = range(0, len(block), segment_bytes)
    out = []
    for k, at in enumerate(cuts, 1):
        piece = block[at:at + segment_bytes]
        if k == 1:
            head = [("WARC-Type", "response"), ("WARC-Record-ID", f"<{rid}>"), *about, ("WARC-Segment-Number", "1")]
        else:
            head = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{rid}-{k}>"), ("WARC-Date", date), ("WARC-Target-URI", uri),
                    ("WARC-Segment-Origin-ID", f"<{rid}>"), ("WARC-Segment-Number", str(k)),
                    ("WARC-Segment-Total-Length", str(len(block)) if k == len(cuts) else None)]
        out.append(record(head, piece))
    return out


def _one_line(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def write_archive(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, id_col: str = "page_id",
                  url_col: str = "url", html_col: str = "html", date: str | None = None) -> None:
    """Write one record per page (and its continuations) below ``path``, dated ``date`` (UTC, as 2024-01-31T00:00:00Z; the time of
    the call where none is given)."""
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    located = with_locator(pages).select(
        F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"), F.col("_llm_file").alias("file"), F.col("_llm_row").alias("row"))
    place = F.concat(F.lit("urn:x-row:"), F.lower(F.hex(F.xxhash64("file"))), F.lit("-"), F.col("row"))
    digests = put_down(located.select("page_id", place.alias("rid"), F.octet_length("html").alias("n"),
                                      F.sha2(F.col("html").cast("binary"), 256).alias("digest")), "page-digests")
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "rid")
    firsts = digests.where(F.col("n") >= LEAST_REVISIT).groupBy("digest").agg(
        F.min(order).alias("first"), F.count(F.lit(1)).alias("many")).where("many > 1").select("digest", F.col("first.rid").alias("of"))
    revisits = put_down(digests.where(F.col("n") >= LEAST_REVISIT).join(put_down(firsts, "page-firsts"), "digest")
                        .where("rid != of").select("rid", "of"), "revisits")
    work = located.select("page_id", "url", "html", place.alias("rid"), F.sha2(F.col("html").cast("binary"), 256).alias("digest")) \
        .join(revisits, "rid", "left")
    work = work.select(F.col("page_id").cast("string").alias("page_id"), "url", F.when(F.col("of").isNull(), F.col("html")).alias("html"),
                       "rid", "digest", "of")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                out: list[bytes] = []
                part = batch.iloc[at:at + 512]
                for page, url, html, rid, digest, of in zip(*(part[c] for c in part.columns)):
                    uri = None if url is None else _one_line(url)
                    if of is None:
                        out += response_records(rid, page, uri, html.encode(), digest, segment_bytes, date)
                    else:
                        out.append(record([("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{rid}>"), ("WARC-Date", date), ("WARC-Target-URI", uri),
                                           ("X-Page-Id", page), ("WARC-Payload-Digest", f"sha256:{digest}"),
                                           ("WARC-Refers-To", f"<{of}>"), ("WARC-Profile", PROFILE)], b""))
                yield pd.DataFrame({"value": out})

    records = work.mapInPandas(run, "value binary").select(F.col("value").cast("string"))
    records.write.option("lineSep", "\r\n").option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)
    drop_table(digests)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """Headers (lower-case names) and block of every record of an uncompressed archive file. The block is None where the record is
    broken: no valid Content-Length, fewer bytes than it states, or no line break after them. Bytes that are no record come back as one
    broken record without headers; reading goes on at the next line that starts one."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        headers: dict[str, str] = {}
        if end >= 0 and data.startswith(b"WARC/", at):
            lines = data[at:end].decode("utf-8", errors="replace").split("\r\n")[1:]
            headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
            length = headers.get("content-length", "")
            if re.fullmatch(r"[0-9]{1,18}", length):
                start, stop = end + 4, end + 4 + int(length)
                if data.startswith(b"\r\n", stop):
                    yield headers, data[start:stop]
                    at = stop
                    while data.startswith(b"\r\n", at):
                        at += 2
                    continue
        yield headers, None
        after = data.find(b"\r\nWARC/", at + 1)
        at = len(data) if after < 0 else after + 2


def _gunzip(data: bytes) -> bytes:
    """All members of a gzip file; a file that is not compressed is returned as it is. A cut-off member gives the bytes it still holds, a
    damaged one a byte that is no record, so that the file comes back with a broken one."""
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        try:
            out.append(member.decompress(data) + member.flush())
        except zlib.error:  # damaged: what comes before this member stays
            out.append(b"\x00")
            break
        data = member.unused_data
    return b"".join(out) if out else data


def read_records(spark: SparkSession, path: str, segments: bool) -> DataFrame:
    """Records of an archive: type, rid, origin, segment, total, page, url, digest, refers, block.

    ``segments`` chooses the records of segmented blocks, or all others."""
    bare = lambda v: v[1:-1] if v and v[0] == "<" else v

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["type", "rid", "origin", "segment", "total", "page", "url", "digest", "refers", "block"]
        for batch in batches:
            for content in batch["content"]:
                rows = []
                for h, block in parse_records(_gunzip(content)):
                    if ("warc-segment-number" in h) != segments:
                        continue
                    rows.append((h.get("warc-type"), bare(h.get("warc-record-id")), bare(h.get("warc-segment-origin-id")),
                                 h.get("warc-segment-number"), h.get("warc-segment-total-length"), h.get("x-page-id"),
                                 h.get("warc-target-uri"), (h.get("warc-payload-digest") or "").removeprefix("sha256:") or None,
                                 bare(h.get("warc-refers-to")), block))  # a broken record has no block
                    if len(rows) >= 512:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    text = "type string, rid string, origin string, segment string, total string, page string, url string, digest string, refers string"
    return files.mapInPandas(run, text + ", block binary")


def reassemble(segments: DataFrame) -> DataFrame:
    """One row per origin with the whole block, or a null block where numbers or lengths do not add up."""
    first = F.col("type") != "continuation"
    parts = segments.withColumn("origin", F.when(first, F.col("rid")).otherwise(F.col("origin"))).withColumn("k", F.col("segment").cast("int"))
    about = F.max(F.when(first, F.struct("type", "page", "url", "digest")))
    whole = parts.groupBy("origin").agg(
        about.alias("about"), F.max(F.col("total").cast("long")).alias("total"),
        F.sort_array(F.collect_list(F.struct("k", "block"))).alias("parts"))  # the segments of one page
    numbers = F.transform("parts", lambda p: p["k"])
    size = F.aggregate("parts", F.lit(0).cast("long"), lambda s, p: s + F.octet_length(p["block"]))
    good = F.col("about").isNotNull() & (numbers == F.sequence(F.lit(1), F.size("parts"))) & (size == F.col("total")) \
        & ~F.exists("parts", lambda p: p["block"].isNull())
    block = F.concat_ws("", F.transform("parts", lambda p: F.hex(p["block"])))
    return whole.select(F.col("about.type").alias("type"), F.col("origin").alias("rid"), F.col("about.page").alias("page"),
                        F.col("about.url").alias("url"), F.col("about.digest").alias("digest"),
                        F.lit(None).cast("string").alias("refers"), F.when(good, F.unhex(block)).alias("block"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """type, rid, page, url, digest (as stated), refers, payload, complete of every page's record."""
    names = ["type", "rid", "page", "url", "digest", "refers", "block"]
    try:
        whole, parts = read_records(spark, path, False).select(*names), reassemble(read_records(spark, path, True)).select(*names)
    except AnalysisException:  # an archive without any file
        empty = ", ".join(f"{n} string" for n in names[:-1])
        return spark.createDataFrame([], empty + ", payload binary, complete boolean")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            payload = [None if b is None or t == "revisit" else payload_of(b) for t, b in zip(batch["type"], batch["block"])]
            done = [p is not None or (t == "revisit" and b is not None) for t, b, p in zip(batch["type"], batch["block"], payload)]
            yield batch.drop(columns="block").assign(payload=payload, complete=done)

    return whole.union(parts).mapInPandas(run, ", ".join(f"{n} string" for n in names[:-1]) + ", payload binary, complete boolean")


def round_trip(pages: DataFrame, path: str, **options) -> DataFrame:
    """Write ``pages`` below ``path``, read the archive and resolve the revisits: page_id, payload_bytes, payload_digest,
    record_type, refers_to, complete."""
    spark = pages.sparkSession
    write_archive(pages, path, **options)
    kind = pages.schema[options.get("id_col", "page_id")].dataType.simpleString()
    slim = put_down(read_archive(spark, path).select(
        "type", "rid", F.col("page").cast(kind).alias("page_id"), "refers", F.octet_length("payload").cast("long").alias("n"),
        F.sha2("payload", 256).alias("seen"), "digest", (F.col("complete") & F.coalesce(F.sha2("payload", 256) == F.col("digest"), F.lit(True))).alias("complete")), "archive-read")
    responses, revisits = slim.where("type = 'response'"), slim.where("type = 'revisit'")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "complete"]
    plain = responses.select("page_id", F.col("n").alias("payload_bytes"), F.col("seen").alias("payload_digest"),
                             F.col("type").alias("record_type"), F.lit(None).cast(kind).alias("refers_to"), "complete")
    of = responses.select(F.col("rid").alias("refers"), F.col("page_id").alias("refers_to"), F.col("n").alias("payload_bytes"),
                          F.col("seen").alias("there"))
    again = revisits.join(of, "refers", "left").select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to",
        F.coalesce(F.col("digest") == F.col("there"), F.lit(False)).alias("complete"))
    return plain.select(*names).union(again.select(*names))


def op7_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages`` through an archive with segmented records and back (contract of operator 7)."""
    return round_trip(table(spark, sf_dir, "pages"), shared_path(spark, "warc"))


ORACLE_OP7 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT html, min(page_id) AS first FROM p WHERE strlen(html) >= 100 GROUP BY html)
SELECT page_id, strlen(p.html)::BIGINT AS payload_bytes, sha256(p.html) AS payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to, TRUE AS complete
FROM p LEFT JOIN f ON p.html = f.html
"""
