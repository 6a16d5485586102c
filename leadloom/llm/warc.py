"""WARC archives: records with chunked payloads, cut into segments, and their reassembly.

Writing: one record for each page. Of pages with equal payloads the one with the
largest id becomes a response, the others revisits that refer to it. A response
block is an HTTP message in chunked transfer framing; blocks longer than
``SEGMENT_BYTES`` are cut into a first record and continuation records.

Reading: archives are parsed into records by declared lengths. Records of one
piece are decoded on the spot; the others are grouped by the record that they
continue, put in the order of their segment numbers, checked against the total
length, and decoded. Revisits get their payload from the response they refer to.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.sources.scratch import new_folder

SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
# records of one archive file, which is read as a whole
FILE_RECORDS = 4000
_DATE = "2024-01-01T00:00:00Z"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _chunked(payload: bytes) -> bytes:
    out = [
        b"%x\r\n%b\r\n" % (len(payload[i : i + CHUNK_BYTES]), payload[i : i + CHUNK_BYTES])
        for i in range(0, len(payload), CHUNK_BYTES)
    ]
    return b"".join([*out, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes | None:
    """Payload of a body in chunked transfer framing; None if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return None
        size = body[at:end].split(b";")[0].strip()
        if not re.fullmatch(rb"[0-9a-fA-F]+", size):
            return None
        size, at = int(size, 16), end + 2
        if size == 0:
            # trailers may follow, then an empty line
            return b"".join(out) if body[at:].startswith(b"\r\n") or b"\r\n\r\n" in body[at:] else None
        if body[at + size : at + size + 2] != b"\r\n":
            return None
        out.append(body[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes | None:
    """Payload of an HTTP message; None if it is broken."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        return None
    if re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head.replace(b"\r\n", b"\n")):
        return unchunked(body)
    return body


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block


def _id_of(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>"


def records_of(page_id, url: str, payload: bytes, refers_to, segment: int) -> list[bytes]:
    """The records of one page: a revisit, a response, or a response and its continuations."""
    digest = sha1_base32(payload)
    own = _id_of(page_id, digest)
    uri = re.sub(r"[\r\n]", " ", url or "") or "about:blank"
    common = [("WARC-Target-URI", uri), ("WARC-Date", _DATE)]
    named = [] if page_id is None else [("X-Page-Id", str(page_id))]
    full = [("WARC-Payload-Digest", f"sha1:{digest}"), *named]
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n".encode()
    if refers_to is not None:
        fields = [("WARC-Type", "revisit"), ("WARC-Record-ID", own), *common, *full]
        fields += [("WARC-Refers-To", _id_of(refers_to, digest)), ("X-Refers-To-Page-Id", str(refers_to))]
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
        return [_record([*fields, ("Content-Type", "application/http; msgtype=response")], http)]
    block = http + _chunked(payload)
    first = [("WARC-Type", "response"), ("WARC-Record-ID", own), *common, *full]
    first.append(("Content-Type", "application/http; msgtype=response"))
    if len(block) <= segment:
        return [_record(first, block)]
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    out = [_record([*first, ("WARC-Segment-Number", "1")], parts[0])]
    for k, part in enumerate(parts[1:], start=2):
        fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{own} {k}')}>")]
        fields += [*common, ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", str(k))]
        if k == len(parts):
            fields.append(("WARC-Segment-Total-Length", str(len(block))))
        out.append(_record(fields, part))
    return out


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_revisit_bytes: int = 0,
    segment: int = SEGMENT_BYTES,
) -> None:
    """One WARC record for each row of ``pages``, in gzipped files under ``path``.

    The payload is the html in UTF-8, null is empty. Of rows with equal payloads of
    at least ``min_revisit_bytes`` bytes the one with the largest id is a response,
    as are rows that repeat its id; the others are revisits of it. Null ids are
    smaller than others; where all ids are null, all are responses.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    )
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    first = rows.groupBy("digest").agg(F.max("page_id").alias("best"))
    # one row for each payload on the right; a payload that many pages have is a skewed join, which Spark splits
    known = rows.join(first, "digest")
    again = (F.octet_length("html") >= min_revisit_bytes) & F.col("best").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("best"))
    known = known.select("page_id", "url", "html", F.when(again, F.col("best")).alias("refers_to"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                out += records_of(page_id, url, html.encode(), refers_to, segment)
            for i in range(0, len(out), 1000):
                yield pa.RecordBatch.from_arrays([pa.array(out[i : i + 1000], pa.binary())], ["record"])

    made = known.mapInArrow(make, "record binary")
    # the cast keeps the bytes as they are; two line ends close a record
    text = made.select(F.col("record").cast("string").alias("value"))
    (
        text.write.option("lineSep", "\r\n\r\n")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", FILE_RECORDS)
        .text(path)
    )


def _parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record of an archive; stops at what is no record."""
    at = 0
    while True:
        while data[at : at + 2] == b"\r\n":
            at += 2
        if not data.startswith(b"WARC/", at):
            return
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        fields = {}
        for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
            key, _, value = line.partition(":")
            fields[key.strip().lower()] = value.strip()
        length = fields.get("content-length", "")
        if not length.isdigit():
            return
        begin = end + 4
        at = begin + int(length)
        yield fields, data[begin:at]


def _inflated(data: bytes) -> bytes:
    """Contents of a gzip file of any number of members; other data as they are."""
    out = []
    while data[:2] == b"\x1f\x8b":
        one = zlib.decompressobj(31)
        out.append(one.decompress(data))
        data = one.unused_data
    return b"".join(out) or data


_RECORD = (
    "record_id string, type string, page_id long, uri string, digest string, refers_to string, refers_to_page long, "
    "origin string, number int, total long, whole boolean, payload_bytes long, payload_digest string, block binary"
)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under ``path``.

    ``whole`` says that a response came in one piece and its payload was decoded;
    its length and digest are given then, and ``block`` is left out. Each file is
    read by one task; the writer bounds the records of a file.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema(
            [("record_id", pa.string()), ("type", pa.string()), ("page_id", pa.int64()), ("uri", pa.string()),
             ("digest", pa.string()), ("refers_to", pa.string()), ("refers_to_page", pa.int64()), ("origin", pa.string()),
             ("number", pa.int32()), ("total", pa.int64()), ("whole", pa.bool_()), ("payload_bytes", pa.int64()),
             ("payload_digest", pa.string()), ("block", pa.binary())]
        )
        number = lambda text: int(text) if text and re.fullmatch(r"-?\d+", text) else None
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for f, block in _parsed(_inflated(content.as_py())):
                    kind, segment = f.get("warc-type"), number(f.get("warc-segment-number"))
                    payload = payload_of(block) if kind == "response" and segment is None else None
                    whole = payload is not None
                    rows.append(
                        (f.get("warc-record-id"), kind, number(f.get("x-page-id")), f.get("warc-target-uri"),
                         f.get("warc-payload-digest"), f.get("warc-refers-to"), number(f.get("x-refers-to-page-id")),
                         f.get("warc-segment-origin-id"), segment, number(f.get("warc-segment-total-length")), whole,
                         len(payload) if whole else None, sha1_base32(payload) if whole else None,
                         block if segment is not None else None)
                    )
                    if len(rows) >= 500:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows), kinds)], schema=kinds)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows), kinds)], schema=kinds)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(parse, _RECORD)


def reassemble(records: DataFrame) -> DataFrame:
    """``(record_id, payload_bytes, payload_digest, payload)`` of every record that came in segments.

    Segments are grouped by the record that they continue and put in order. Where
    a number is missing, the total length differs or the framing is broken, the
    payload is null; a segment that is there twice counts once.
    """

    def join(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for groups in columns:
            out = []
            for group in groups:
                parts = {int(s["number"]): s for s in group}
                block = b"".join(parts[k]["block"] for k in sorted(parts))
                totals = {s["total"] for s in parts.values()} - {None}
                whole = sorted(parts) == list(range(1, len(parts) + 1)) and totals == {len(block)}
                payload = payload_of(block) if whole else None
                none = payload is None
                out.append((None if none else len(payload), None if none else sha1_base32(payload), payload))
            frame = pd.DataFrame(out, columns=["payload_bytes", "payload_digest", "payload"], dtype=object)
            yield frame.astype({"payload_bytes": "Int64"})

    cut = records.where("number IS NOT NULL").withColumn("first", F.coalesce("origin", "record_id"))
    groups = cut.groupBy("first").agg(F.collect_list(F.struct("number", "total", "block")).alias("parts"))
    udf = F.pandas_udf(join, "payload_bytes long, payload_digest string, payload binary")
    return groups.withColumn("made", udf("parts")).select(F.col("first").alias("record_id"), "made.*")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, uri, payload_bytes, payload_digest, record_type, refers_to)`` for every response and revisit.

    A revisit has the length and digest of the response it refers to. Payloads
    that cannot be put together have neither.
    """
    records = read_records(spark, path)
    heads = records.where("type IN ('response', 'revisit')").drop("block")
    joined = reassemble(records).select(
        "record_id", F.col("payload_bytes").alias("joined_bytes"), F.col("payload_digest").alias("joined_digest")
    )
    responses = heads.where("type = 'response'").join(joined, "record_id", "left").select(
        "record_id",
        "page_id",
        "uri",
        F.coalesce("payload_bytes", "joined_bytes").alias("payload_bytes"),
        F.coalesce("payload_digest", "joined_digest").alias("payload_digest"),
    )
    aims = responses.select(
        F.col("record_id").alias("refers_to"),
        F.col("payload_bytes").alias("aim_bytes"),
        F.col("payload_digest").alias("aim_digest"),
    ).dropDuplicates(["refers_to"])
    revisits = heads.where("type = 'revisit'").drop("payload_bytes", "payload_digest").join(aims, "refers_to", "left")
    same = F.col("digest") == F.concat(F.lit("sha1:"), F.col("aim_digest"))
    out = responses.select(
        "page_id", "uri", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to"),
    )
    return out.unionByName(
        revisits.select(
            "page_id", "uri", F.when(same, F.col("aim_bytes")).alias("payload_bytes"),
            F.when(same, F.col("aim_digest")).alias("payload_digest"), F.lit("revisit").alias("record_type"),
            F.col("refers_to_page").alias("refers_to"),
        )
    )


def query(spark, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return read_pages(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
