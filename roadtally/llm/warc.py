"""WARC archives: segmented, chunk-framed records written by Spark and reassembled on reading."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadtally.llm.columns import narrow

LEAST_REVISIT_BYTES = 100
SEGMENT_BYTES = 64 * 1024
CHUNK_BYTES = 8 * 1024
# With segments of at most SEGMENT_BYTES this bounds a file, which one task reads as a whole.
RECORDS_PER_FILE = 512
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LINE, GAP = b"\r\n", b"\r\n\r\n"

_RECORD = (
    "record_id string, record_type string, page_id {kind}, url string, payload_digest string, "
    "refers_to {kind}, segment int, total long, block binary"
)


def assign_revisits(pages: DataFrame) -> DataFrame:
    """Add ``payload_digest`` and ``refers_to`` to ``page_id, url, html``.

    Among pages of equal payload of at least 100 bytes the smallest page_id is the response, the
    others refer to it. A page without page_id refers to nothing and is referred to by none.
    Only ids and digests are grouped; the texts are joined once, by page.
    """
    digest = F.sha2(F.encode("html", "UTF-8"), 256)
    known = pages.select("page_id", digest.alias("payload_digest")).where(
        F.col("page_id").isNotNull() & (F.octet_length("html") >= LEAST_REVISIT_BYTES)
    )
    firsts = (
        known.groupBy("payload_digest")
        .agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("_last"))
        .where(F.col("refers_to") < F.col("_last"))
        .drop("_last")
    )
    copies = (
        known.join(firsts, "payload_digest")
        .where(F.col("page_id") > F.col("refers_to"))
        .groupBy("page_id", "payload_digest")
        .agg(F.min("refers_to").alias("refers_to"))
    )
    return pages.withColumn("payload_digest", digest).join(copies, ["page_id", "payload_digest"], "left")


def _chunked(payload: bytes) -> bytes:
    parts = []
    for k in range(0, len(payload), CHUNK_BYTES):
        part = payload[k : k + CHUNK_BYTES]
        parts += [f"{len(part):x}".encode(), LINE, part, LINE]
    return b"".join([*parts, b"0", GAP])


def _unchunked(body: bytes) -> bytes:
    parts, at = [], 0
    while True:
        end = body.index(LINE, at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        at = end + 2
        if body[at + size : at + size + 2] != LINE:
            raise ValueError("a chunk does not end where its size says")
        parts.append(body[at : at + size])
        at += size + 2


def _header(fields: dict[str, object]) -> bytes:
    lines = [f"{k}: {str(v).replace(chr(13), ' ').replace(chr(10), ' ')}" for k, v in fields.items() if v is not None]
    return LINE.join(["WARC/1.1".encode(), *[x.encode() for x in lines]])


def _records(page_id, url, html, digest, refers_to, date: str) -> Iterator[bytes]:
    """The record of a page, or its segments; each without the blank lines that end it."""
    payload = (html or "").encode()
    own = f"<urn:uuid:{uuid.uuid4()}>"
    http = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8"]
    fields: dict[str, object] = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": own,
        "WARC-Date": date,
        "WARC-Target-URI": url or "about:blank",
        "WARC-Page-ID": page_id,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Type": "application/http; msgtype=response",
    }
    if refers_to is not None:
        fields |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To-Page-ID": refers_to}
        block = LINE.join([*http, f"Content-Length: {len(payload)}".encode()]) + GAP
    else:
        block = LINE.join([*http, b"Transfer-Encoding: chunked"]) + GAP + _chunked(payload)
    parts = [block[k : k + SEGMENT_BYTES] for k in range(0, len(block), SEGMENT_BYTES)]
    for number, part in enumerate(parts, 1):
        if number > 1:
            fields = {
                "WARC-Type": "continuation",
                "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
                "WARC-Date": date,
                "WARC-Segment-Origin-ID": own,
            }
        if len(parts) > 1:
            fields["WARC-Segment-Number"] = number
            if number == len(parts):
                fields["WARC-Segment-Total-Length"] = len(block)
        fields["Content-Length"] = len(part)
        yield _header(fields) + GAP + part


def write_warc(
    pages: DataFrame, path: str, id_col: str, url_col: str, html_col: str, date: str = "2000-01-01T00:00:00Z"
) -> None:
    """Write a record for every page as gzip files below ``path``, in parallel.

    A null html is an empty payload, a null url ``about:blank``. Blocks over ``SEGMENT_BYTES`` are
    cut into continuation records. Repeated pages are written each time. No pages write no record.
    """
    known = narrow(pages, page_id=id_col, url=url_col, html=html_col).withColumn("html", F.coalesce("html", F.lit("")))

    def run(batches):
        for batch in batches:
            rows = zip(*[batch.column(k).to_pylist() for k in range(5)])
            for row in rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(_records(*row, date)), pa.binary())], ["value"])

    columns = ["page_id", "url", "html", "payload_digest", "refers_to"]
    (
        assign_revisits(known)
        .select(*columns)
        .mapInArrow(run, "value binary")
        .select(F.col("value").cast("string"))
        .write.option("lineSep", GAP.decode())
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(path)
    )


def _parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(content):
        end = content.index(GAP, at)
        first, *lines = content[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record begins at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines)
        begin = end + 4
        stop = begin + int(fields["Content-Length"])
        if content[stop : stop + 4] != GAP:
            raise ValueError(f"the record at byte {at} does not end where its length says")
        yield fields, content[begin:stop]
        at = stop + 4


def _scan(spark: SparkSession, path: str, kind: str, segmented: bool) -> DataFrame:
    """Raw records; either those that came in segments or the others."""
    shape = _RECORD.format(kind=kind)

    def number(x):
        return None if x is None else int(x) if kind in ("bigint", "int") else x

    def run(batches):
        for batch in batches:
            for content in filter(None, batch.column(0).to_pylist()):
                rows = []
                for fields, block in _parse(zlib.decompress(content, 31)):
                    if ("WARC-Segment-Number" in fields) != segmented:
                        continue
                    digest = fields.get("WARC-Payload-Digest")
                    segment, total = fields.get("WARC-Segment-Number"), fields.get("WARC-Segment-Total-Length")
                    rows.append(
                        {
                            "record_id": fields.get("WARC-Segment-Origin-ID", fields["WARC-Record-ID"]),
                            "record_type": fields["WARC-Type"],
                            "page_id": number(fields.get("WARC-Page-ID")),
                            "url": fields.get("WARC-Target-URI"),
                            "payload_digest": digest and digest.removeprefix("sha256:"),
                            "refers_to": number(fields.get("WARC-Refers-To-Page-ID")),
                            "segment": segment and int(segment),
                            "total": total and int(total),
                            "block": block,
                        }
                    )
                yield pa.RecordBatch.from_pylist(rows, schema)

    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(spark.createDataFrame([], shape).schema)
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, shape)


def _payloads(records: DataFrame, kind: str) -> DataFrame:
    """Take the HTTP block apart; a revisit has no payload of its own, but its length."""
    shape = f"page_id {kind}, url string, record_type string, payload_digest string, refers_to {kind}, payload_bytes long, payload binary"
    names = ["page_id", "url", "record_type", "payload_digest", "refers_to"]

    def run(batches):
        for batch in batches:
            sizes, payloads = [], []
            for block, kind_ in zip(batch.column("block").to_pylist(), batch.column("record_type").to_pylist()):
                head, body = block.split(GAP, 1)
                http = dict(x.lower().split(b": ", 1) for x in head.split(LINE)[1:])
                if http.get(b"transfer-encoding") == b"chunked":
                    body = _unchunked(body)
                revisit = kind_ == "revisit"
                payloads.append(None if revisit else body)
                sizes.append(int(http[b"content-length"]) if revisit else len(body))
            own = [batch.column(n) for n in names] + [pa.array(sizes, pa.int64()), pa.array(payloads, pa.binary())]
            yield pa.RecordBatch.from_arrays(own, [*names, "payload_bytes", "payload"])

    return records.select(*names, "block").mapInArrow(run, shape)


def read_warc(spark: SparkSession, path: str, kind: str = "bigint") -> DataFrame:
    """Pages of an archive: ``page_id, url, record_type, payload_digest, refers_to, payload_bytes,
    payload``.

    Records in segments are grouped by the origin's identifier, ordered by segment number and
    joined; a missing segment or another total length than announced is an error. Only those
    records are shuffled. The digest of a response is that of the decoded payload and must equal
    the one in its header; a revisit has its header's digest and no payload.
    """
    segments = _scan(spark, path, kind, segmented=True)
    joined = segments.groupBy("record_id").agg(
        *[F.max(c).alias(c) for c in ("page_id", "url", "payload_digest", "refers_to", "total")],
        F.max(F.when(F.col("segment") == 1, F.col("record_type"))).alias("record_type"),
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"),
    )
    wrong = (F.element_at("parts.segment", -1) != F.size("parts")) | (F.length("block") != F.col("total"))
    joined = joined.withColumn("block", F.unhex(F.array_join(F.transform("parts.block", F.hex), ""))).withColumn(
        "block",
        F.when(F.coalesce(wrong, F.lit(True)), F.raise_error(F.lit("a segmented record is not complete"))).otherwise(F.col("block")),
    )
    columns = ["page_id", "url", "record_type", "payload_digest", "refers_to", "block"]
    pages = _payloads(_scan(spark, path, kind, segmented=False).select(*columns), kind).unionByName(
        _payloads(joined.select(*columns), kind)
    )
    own = F.sha2("payload", 256)
    checked = F.when(F.col("payload").isNull() | (own == F.col("payload_digest")), F.col("payload_digest")).otherwise(
        F.raise_error(F.lit("a payload does not have the digest of its record"))
    )
    return pages.withColumn("payload_digest", checked)
