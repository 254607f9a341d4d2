"""WARC archives of pages, and their assembly into captures.

Writing: every page becomes a transaction of three records, a request, a response and a
metadata record; request and metadata name the response in ``WARC-Concurrent-To``. Of pages
with equal payloads the one with the largest id keeps its payload; the others become revisit
records that name it in ``WARC-Refers-To``, unless the payload is smaller than ``min_payload``
bytes. Archives are gzip files below a folder, written by Spark's text writer.

Reading: each file is read as a stream of lines by one task, which cuts records by their
Content-Length and holds one record at a time. The records of a transaction are joined through
their concurrent-to identifiers, and each capture comes out as one nested row.

A null payload is empty. A null page id stands behind all others, so such a page is a revisit
of any page that has an id; of several, all with the payload are responses. Exact repeats of
a row are captures of their own with equal identifiers, and each comes back once. A null url
is written as the record's own identifier. Line feeds and other control characters in urls
are percent-encoded, so that they can't end a header. An empty table leaves no captures.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticelake.llm.common import let

MIN_PAYLOAD = 0
_EOL = "\r\n"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(digest: Column) -> Column:
    """Upper-case base 32 of a SHA-1 in hex: its 160 bits are 32 digits of five."""

    def four(digest: Column, i: Column) -> Column:
        n = F.conv(F.substring(digest, i * 5 + 1, F.lit(5)), 16, 10).cast("int")
        digits = [F.substring(F.lit(_BASE32), F.shiftright(n, b).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for b in (15, 10, 5, 0)]
        return F.concat(*digits)

    groups = F.sequence(F.lit(0), F.lit(7))
    return let(digest, lambda d: F.array_join(F.transform(groups, lambda i: four(d, i)), ""))


def _record(kind: Column | str, rid: Column, headers: list[tuple[str, Column]], content_type: str, block: Column) -> Column:
    """The text of a record but for its last line feed, which the writer adds."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: <"), rid, F.lit(">"))]
    # A header whose value is null is left out.
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in headers]
    lines.append(F.concat(F.lit(f"Content-Type: {content_type}{_EOL}Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws(_EOL, *lines), F.lit(_EOL * 2), block, F.lit(_EOL + "\r"))


def _uri(text: Column) -> Column:
    """Without what could end a header line."""
    plain = F.regexp_replace(text, "%", "%25")
    for code in (*range(33), 127):
        plain = F.replace(plain, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(text.rlike(r"[\x00-\x20\x7F]"), plain).otherwise(text)


def transactions(pages: DataFrame, date: str, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """``record``: the text of each record of ``page_id, url, html``."""
    html = F.coalesce(F.col("html"), F.lit(""))
    captured = pages.select(
        F.col("page_id").cast("string").alias("id"),
        F.col("page_id").alias("page_id"),
        "url",
        html.alias("html"),
        F.sha1(F.encode(html, "UTF-8")).alias("sha1"),
    )
    # The first holder of each payload: a partial aggregate, so a payload of a third of all pages is no burden.
    firsts = captured.groupBy("sha1").agg(F.max("page_id").alias("first_id"))
    known = captured.join(firsts, "sha1").withColumn("digest", base32(F.col("sha1")))
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first_id")), F.lit(False)) & (
        F.octet_length("html") >= min_payload
    )

    def name(kind: str, page: Column) -> Column:
        return F.concat_ws(":", F.lit("urn:page"), F.coalesce(page.cast("string"), F.lit("null")), F.col("digest"), F.lit(kind))

    rid = name("capture", F.col("page_id"))
    status = "HTTP/1.1 200 OK" + _EOL + "Content-Type: text/html; charset=utf-8" + _EOL + "Content-Length: "
    reply_head = F.concat(F.lit(status), F.octet_length("html").cast("string"), F.lit(_EOL * 2))
    when = ("WARC-Date", F.lit(date))
    with_all = known.select("*", revisit.alias("revisit"), rid.alias("rid"), F.coalesce(_uri(F.col("url")), rid).alias("uri"))
    uri, to = ("WARC-Target-URI", F.col("uri")), ("WARC-Concurrent-To", F.concat(F.lit("<"), F.col("rid"), F.lit(">")))
    refers = F.when(F.col("revisit"), F.concat(F.lit("<"), name("capture", F.col("first_id")), F.lit(">")))
    profile = F.when(F.col("revisit"), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    get = F.concat(F.lit("GET "), F.col("uri"), F.lit(" HTTP/1.1" + _EOL * 2))
    facts = F.concat(F.lit("page-id: "), F.coalesce(F.col("id"), F.lit("")), F.lit(_EOL))
    records = F.array(
        _record("request", name("request", F.col("page_id")), [when, uri, to], "application/http;msgtype=request", get),
        _record(
            F.when(F.col("revisit"), "revisit").otherwise("response"),
            F.col("rid"),
            [when, uri, ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))), ("WARC-Refers-To", refers), ("WARC-Profile", profile)],
            "application/http;msgtype=response",
            F.concat(reply_head, F.when(F.col("revisit"), "").otherwise(F.col("html"))),
        ),
        _record("metadata", name("metadata", F.col("page_id")), [when, uri, to], "application/warc-fields", facts),
    )
    return with_all.select(F.explode(records).alias("record"))


def write_archives(records: DataFrame, path: str, records_per_file: int = 300_000) -> None:
    """Gzip archives of whole records below ``path``."""
    writer = records.write.option("lineSep", "\n").option("compression", "gzip")
    writer.option("maxRecordsPerFile", records_per_file).text(path)


RECORD = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("concurrent_to", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("payload", T.BinaryType()),
    ]
)


def _header_lines(raw: bytes) -> list[tuple[str, str]]:
    pairs = (line.partition(":") for line in raw.decode("utf-8", "replace").split(_EOL) if ":" in line)
    return [(k.strip().lower(), v.strip()) for k, _, v in pairs]


def parse_record(head: bytes, block: bytes) -> dict:
    """A record's fields; the payload of an HTTP block is what follows its head."""
    pairs = _header_lines(head)
    named = dict(pairs)
    bare = lambda key: named[key].strip("<>") if key in named else None
    payload, kind = block, named.get("warc-type")
    size, digest = len(block), None
    if named.get("content-type", "").startswith("application/http"):
        http_head, _, payload = block.partition(b"\r\n\r\n")
        size = len(payload)
        if kind == "revisit":
            said = dict(_header_lines(http_head)).get("content-length", "")
            size = int(said) if said.isdigit() else None
    if kind == "revisit":
        digest = named.get("warc-payload-digest", "").removeprefix("sha1:") or None
    elif kind == "response":
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return {
        "type": kind,
        "record_id": bare("warc-record-id"),
        "concurrent_to": bare("warc-concurrent-to"),
        "refers_to": bare("warc-refers-to"),
        "target_uri": named.get("warc-target-uri"),
        "payload_digest": digest,
        "payload_bytes": size,
        "headers": pairs,
        "payload": payload,
    }


def cut_records(lines: Iterator[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """Head and block of each record of a stream of lines without their line feeds."""
    for line in lines:
        if not line.startswith(b"WARC/"):
            continue
        head, length = [], 0
        for line in lines:
            line = line.removesuffix(b"\r")
            if not line:
                break
            head.append(line)
            key, _, value = line.partition(b":")
            if key.lower() == b"content-length":
                length = int(value)
        parts, have = [], 0
        while have < length:
            part = next(lines, None)
            if part is None:
                break
            parts.append(part)
            have += len(part) + 1
        block = b"\n".join(parts)
        # The line feed that ended the last line belongs to the block only if its length says so.
        yield b"\r\n".join(head), (block + b"\n")[:length]


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records below ``path``. A gzip file isn't split, so its lines come in order to one task."""
    arrow = pa.schema(
        [
            *[(n, pa.string()) for n in RECORD.names[:6]],
            ("payload_bytes", pa.int64()),
            ("headers", pa.map_(pa.string(), pa.string())),
            ("payload", pa.binary()),
        ]
    )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = (line.as_py() for b in batches for line in b.column(0).cast(pa.binary()))
        rows, size = [], 0
        for head, block in cut_records(lines):
            rows.append(parse_record(head, block))
            size += len(block)
            if len(rows) == 1000 or size > 16 << 20:
                yield pa.RecordBatch.from_pylist(rows, arrow)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, arrow)

    return spark.read.option("lineSep", "\n").text(path).mapInArrow(records, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``response`` (or revisit), ``request`` and ``metadata``."""

    def about(kind: str) -> DataFrame:
        chosen = records.where(F.col("type") == kind).dropDuplicates(["concurrent_to"])
        return chosen.select(F.col("concurrent_to").alias("_id"), F.struct("record_id", "headers", "payload").alias(kind))

    replies = records.where(F.col("type").isin("response", "revisit"))
    both = replies.select(F.col("record_id").alias("_id"), F.struct(*RECORD.names).alias("response"))
    return both.join(about("request"), "_id", "left").join(about("metadata"), "_id", "left").drop("_id")
