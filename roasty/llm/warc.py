"""WARC archives of web pages: segmented, chunk-coded records written and
read back by Spark tasks.

A page becomes a ``response`` record whose block is an HTTP message with a
chunk-coded body. A block above ``segment_bytes`` is cut: the first record
holds segment 1, ``continuation`` records the rest, each naming the first one
as its origin. Pages with equal payloads store it once: the others are
``revisit`` records. Reading splits files at record ends, puts the segments
of an origin together by number, checks the total length, takes the chunk
framing off and checks the payload's digest.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roasty.llm.common import stored
from roasty.session import scratch_path

#: Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
CRLF = b"\r\n"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Files are split where a record starts. A longer mark that begins with the
#: line ends before it would overlap itself, and Hadoop's line reader misses
#: such a mark where it straddles two of its buffers.
BETWEEN = VERSION.decode()

#: Payloads of at least so many bytes are stored once.
REVISIT_BYTES = 1000

RECORD = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("digest", T.StringType()),
        T.StructField("refers_to_record", T.StringType()),
        T.StructField("origin", T.StringType()),
        T.StructField("segment", T.IntegerType()),
        T.StructField("total_length", T.LongType()),
        T.StructField("length_ok", T.BooleanType()),
        T.StructField("block", T.BinaryType()),
    ]
)


def record_id(page_id: int | None, digest: str) -> str:
    """The same for each writer, so that a revisit can name its response."""
    return uuid.uuid5(uuid.NAMESPACE_OID, f"{page_id}:{digest}").urn


def chunked(payload: bytes, chunk_bytes: int) -> bytes:
    """The payload in HTTP chunks. A chunk ends inside any version line in the
    payload: the mark that starts a record never occurs within one."""
    parts, at, n = [], 0, len(payload)
    while at < n:
        end = min(at + chunk_bytes, n)
        mark = payload.find(VERSION[:8], at, min(end + 7, n))
        if 0 <= mark and mark + 5 < end:
            end = mark + 5
        parts += [b"%x\r\n" % (end - at), payload[at:end], CRLF]
        at = end
    parts.append(b"0\r\n\r\n")
    return b"".join(parts)


def unchunked(body: bytes) -> bytes | None:
    """The payload of a chunk-coded body; None if the framing is broken."""
    parts, at = [], 0
    while True:
        eol = body.find(CRLF, at)
        if eol < 0:
            return None
        try:
            size = int(body[at:eol].split(b";")[0].strip() or b"x", 16)
        except ValueError:
            return None
        at = eol + 2
        if size == 0:
            return b"".join(parts)
        if size < 0 or body[at + size : at + size + 2] != CRLF:
            return None
        parts.append(body[at : at + size])
        at += size + 2


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """A record but for its last line end, which the file writer adds. A value
    that ends like a version line gets a blank, which is not of the value, so
    that the mark that starts a record never occurs in a head."""
    lines = [f"{k}: {v}" for k, v in fields if v is not None]
    head = "".join(line + (" \r\n" if line.endswith(BETWEEN.rstrip()) else "\r\n") for line in lines)
    return b"".join([VERSION, head.encode(), b"Content-Length: %d\r\n\r\n" % len(block), block, CRLF])


def _line(value: str | None) -> str | None:
    """A header value has no line ends."""
    return None if value is None else re.sub(r"[\r\n]+", " ", value)


def page_records(
    page_id: int | None, url: str | None, payload: bytes, response_of: tuple[int | None] | None,
    segment_bytes: int, chunk_bytes: int, date: str,
) -> list[bytes]:
    """The records of a page; ``response_of`` holds the page that stores the
    payload if this one revisits it."""
    sha = hashlib.sha1(payload)
    own = record_id(page_id, sha.hexdigest())
    common = [
        ("WARC-Target-URI", _line(url)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(sha.digest()).decode()),
        ("X-Page-Id", page_id),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if response_of is not None:
        to = record_id(response_of[0], sha.hexdigest())
        fields = [("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{own}>"), ("WARC-Profile", REVISIT_PROFILE),
                  ("WARC-Refers-To", f"<{to}>"), *common]
        return [_record(fields, HTTP_HEAD + CRLF)]
    block = b"".join([HTTP_HEAD, b"Transfer-Encoding: chunked\r\n\r\n", chunked(payload, chunk_bytes)])
    first = [("WARC-Type", "response"), ("WARC-Record-ID", f"<{own}>"), *common]
    if len(block) <= segment_bytes:
        return [_record(first, block)]
    out = [_record([*first, ("WARC-Segment-Number", 1)], block[:segment_bytes])]
    starts = range(segment_bytes, len(block), segment_bytes)
    for k, at in enumerate(starts, 2):
        fields = [
            ("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{uuid.uuid5(uuid.NAMESPACE_OID, f'{own}:{k}').urn}>"),
            ("WARC-Segment-Origin-ID", f"<{own}>"), ("WARC-Segment-Number", k), ("WARC-Date", date),
            ("WARC-Segment-Total-Length", len(block) if at == starts[-1] else None),
        ]
        out.append(_record(fields, block[at : at + segment_bytes]))
    return out


def parse_records(raw: bytes) -> Iterator[dict]:
    """The records in ``raw``: usually one; more if a record's end was not
    seen, which its length tells."""
    while raw:
        r = parse_record(raw)
        if r is None:
            return
        end = r.pop("end")
        yield r
        at = raw.find(VERSION, end)
        raw = raw[at:] if at >= 0 else b""


def parse_record(raw: bytes) -> dict | None:
    """The fields of RECORD, and the place where its block ends, from the
    bytes after a record's start; None if there is no record."""
    skipped = len(VERSION) if raw.startswith(VERSION) else 0
    raw = raw[skipped:]
    head, mark, rest = raw.partition(b"\r\n\r\n")
    if not mark:
        return None
    h = {}
    for line in head.decode("utf-8", "replace").split("\r\n"):
        k, colon, v = line.partition(":")
        if colon:
            h[k.strip().lower()] = v.strip()
    if "warc-type" not in h:
        return None
    size = int(h["content-length"]) if h.get("content-length", "").isdigit() else -1
    number = lambda k: int(h[k]) if re.fullmatch(r"-?\d+", h.get(k, "")) else None
    ident = lambda k: h[k].strip("<>") if k in h else None
    digest = h.get("warc-payload-digest", "")
    if digest.startswith("sha1:"):
        try:
            digest = base64.b32decode(digest[5:]).hex()
        except ValueError:
            digest = ""
    return {
        "record_id": ident("warc-record-id"), "type": h["warc-type"], "target_uri": h.get("warc-target-uri"),
        "page_id": number("x-page-id"), "digest": digest or None, "refers_to_record": ident("warc-refers-to"),
        "origin": ident("warc-segment-origin-id"), "segment": number("warc-segment-number"),
        "total_length": number("warc-segment-total-length"), "length_ok": 0 <= size <= len(rest),
        "block": rest[: max(size, 0)], "end": skipped + len(head) + len(mark) + max(size, 0),
    }


def duplicates(pages: DataFrame) -> DataFrame:
    """``digest, response_page`` of payloads that several pages share: one row
    a payload, pre-aggregated before the shuffle."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    return (
        pages.select(F.sha1(payload).alias("digest"), F.octet_length(payload).alias("n"), "page_id")
        .filter(F.col("n") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.max("page_id").alias("response_page"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n")
    )


def write(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    segment_bytes: int = 16 << 10, chunk_bytes: int = 4 << 10, date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Writes ``pages`` as gzipped WARC files, one a task, to the folder
    ``path``. Null html is an empty payload; a null url leaves its header out;
    of pages with equal payloads of ``REVISIT_BYTES`` or more, those with the
    largest id are responses, the others (null ids too) revisit it. Rows that
    repeat id and payload give equal records. Other columns are ignored."""
    own = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html")
    )
    shared = stored(duplicates(own), "warc-shared")
    payload = F.coalesce(F.col("html"), F.lit(""))
    # ``shared`` is a written table, so its size picks the join: sent to all
    # tasks while small, else by shuffle on the payload's digest.
    rows = own.join(shared, F.sha1(payload) == F.col("digest"), "left").select(
        "page_id", "url", F.encode(payload, "UTF-8").alias("payload"),
        (F.col("digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_page"))).alias("revisits"),
        "response_page",
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, size = [], 0
            for page_id, url, body, revisits, page in zip(*[c.to_pylist() for c in b.columns], strict=True):
                of = (page,) if revisits else None
                made = page_records(page_id, url, body, of, segment_bytes, chunk_bytes, date)
                out += made
                size += sum(map(len, made))
                if size >= 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    records = rows.mapInArrow(build, "record binary").select(F.col("record").cast("string").alias("value"))
    # The fastest level: less time for somewhat larger archives.
    records.write.option("lineSep", "\r\n").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def read_records(spark: SparkSession, path: str, wanted: Callable[[dict], bool] | None = None) -> DataFrame:
    """The records of the archives at ``path``, one a row (columns of RECORD);
    with ``wanted`` only those that it holds for."""
    raw = spark.read.option("lineSep", BETWEEN).text(path).select(F.col("value").cast("binary").alias("raw"))
    schema = pa.schema([(f.name, {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}[f.dataType.simpleString()]) for f in RECORD])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [r for raw in b.column(0).to_pylist() for r in parse_records(raw) if wanted is None or wanted(r)]
            yield pa.RecordBatch.from_pylist(rows, schema)

    return raw.mapInArrow(parse, RECORD)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per page stored in the archives at ``path``: ``page_id, url,
    record_id, type, refers_to_record, digest, payload, complete``.

    ``payload`` is the decoded body, null for a revisit; ``complete`` tells
    whether all segments are there (numbers without a gap, total length as
    stated), the framing is sound and the payload has the digest the record
    names. Records that repeat a segment count once."""
    pages = ("response", "revisit")
    whole = read_records(spark, path, lambda r: r["type"] in pages and r["segment"] is None)
    # Only pages that were cut have continuations. Their records are written,
    # so that the archives are read once for both sides of the join.
    segments = stored(
        read_records(spark, path, lambda r: r["type"] == "continuation" or r["type"] in pages and r["segment"] is not None), "warc-segments"
    )
    # A group is one page's.
    rest = (
        segments.filter("type = 'continuation'")
        .groupBy(F.col("origin").alias("rest_of"))
        .agg(F.array_sort(F.collect_set(F.struct("segment", "block", "length_ok"))).alias("segments"), F.max("total_length").alias("total"))
    )
    whole = whole.select("*", F.lit(None).cast("array<struct<segment:int,block:binary,length_ok:boolean>>").alias("segments"), F.lit(None).cast("long").alias("total"))
    cut = segments.filter("type IN ('response', 'revisit')").join(rest, F.col("record_id") == F.col("rest_of"), "left").drop("rest_of")
    joined = whole.unionByName(cut).select(
        "page_id", F.col("target_uri").alias("url"), "record_id", "type", "refers_to_record", "digest", "segment", "length_ok", "block", "segments", "total"
    )
    out_type = "page_id long, url string, record_id string, type string, refers_to_record string, digest string, payload binary, complete boolean"
    out_schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_id", pa.string()), ("type", pa.string()),
                            ("refers_to_record", pa.string()), ("digest", pa.string()), ("payload", pa.binary()), ("complete", pa.bool_())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                segments = r["segments"] or []
                ok = r["length_ok"] and all(s["length_ok"] for s in segments)
                block = b"".join([r["block"], *[s["block"] for s in segments]])
                if r["segment"] is not None:
                    numbers = [r["segment"], *[s["segment"] for s in segments]]
                    ok = ok and numbers == list(range(1, len(numbers) + 1)) and r["total"] == len(block)
                head, _, body = block.partition(b"\r\n\r\n")
                payload = None
                if r["type"] == "response":
                    payload = unchunked(body) if re.search(rb"(?i)\r\ntransfer-encoding:\s*chunked", head) else body
                    ok = ok and payload is not None and hashlib.sha1(payload).hexdigest() == r["digest"]
                out.append({k: r[k] for k in ("page_id", "url", "record_id", "type", "refers_to_record", "digest")} | {"payload": payload, "complete": bool(ok)})
            yield pa.RecordBatch.from_pylist(out, out_schema)

    return joined.mapInArrow(decode, out_type)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Writes ``pages`` to a new folder of the shared scratch space, reads the
    archives back and returns per page: ``page_id, payload_bytes,
    payload_digest, record_type, refers_to, url, complete``; of a revisit,
    size and id come from the response it refers to. An empty table gives an
    empty result."""
    spark = pages.sparkSession
    path = scratch_path(spark, f"llm/warc-{uuid.uuid4().hex}")
    write(pages, path, **options)
    digest = F.when(F.col("payload").isNotNull(), F.sha1("payload")).otherwise(F.col("digest"))
    # Payloads go no further than this: what is joined below is a row a page.
    got = stored(read(spark, path).select(
        "page_id", "url", "record_id", "type", "refers_to_record", digest.alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("n"), "complete",
    ), "warc-read")
    # A response that is stored twice, by repeated rows, is one target.
    targets = got.filter("type = 'response'").groupBy(F.col("record_id").alias("target")).agg(
        F.max("page_id").alias("target_page"), F.max("n").alias("target_n")
    )
    revisits = got.filter("type = 'revisit'").join(targets, F.col("refers_to_record") == F.col("target"), "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "complete"]
    return (
        got.filter("type = 'response'")
        .select("*", F.col("n").alias("payload_bytes"), F.col("type").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
        .select(*columns)
        .unionByName(
            revisits.select("*", F.col("target_n").alias("payload_bytes"), F.col("type").alias("record_type"), F.col("target_page").alias("refers_to"))
            .select(*columns)
        )
    )
