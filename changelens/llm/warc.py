"""WARC archives: written with segments and revisits, read back by segment reassembly.

Writing.  A page's block (HTTP head and chunked payload) larger than
``SEGMENT_BYTES`` is cut in segments: the first stands in the page's own record,
each other one in a ``continuation`` record that names the origin record and
its place, and the last names the total length.  Of equal payloads of at least
``MIN_REVISIT`` bytes one is stored, the others become ``revisit`` records that
refer to it.  Archives are gzip files of records in turn, written by Spark.

Reading.  An archive is streamed by one task as pieces between double line
breaks, which are the ends of heads and records; lengths decide what is head
and what is block, so memory is bounded by one record.  Segments are dealt to
tasks by origin identifier and sorted by number there; one payload at a time is
put together, its total length verified and its chunks decoded.  Records that
are not segmented never shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changelens.llm.common import join_on, table, with_row_number
from changelens.session import prepare_python, stage_path, stage_table

#: Bytes of a block that one record holds, of one chunk, and of a payload worth a revisit record.
SEGMENT_BYTES = 1 << 14
CHUNK_BYTES = 1 << 12
MIN_REVISIT = 100
#: Bytes of rows that a Python worker passes on at once.
OUT_BYTES = 4 << 20

END = b"\r\n\r\n"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked" + END
REVISIT_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + END
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = pa.schema([
    ("file", pa.string()), ("place", pa.int64()), ("type", pa.string()), ("record_id", pa.string()), ("url", pa.string()),
    ("page_id", pa.int64()), ("segment", pa.int64()), ("origin", pa.string()), ("total", pa.int64()), ("digest", pa.string()),
    ("refers_to", pa.string()), ("http", pa.bool_()), ("whole", pa.bool_()), ("block", pa.binary())])
RECORD_DDL = (
    "file string, place long, type string, record_id string, url string, page_id long, segment long, origin string, "
    "total long, digest string, refers_to string, http boolean, whole boolean, block binary")
PAYLOAD_DDL = (
    "type string, record_id string, url string, page_id long, digest string, refers_to string, status string, payload binary")
PAYLOAD = [f.split()[0] for f in PAYLOAD_DDL.split(", ")]


# --- bytes ------------------------------------------------------------------

def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing of a payload."""
    parts = [b"%x\r\n%b\r\n" % (len(c), c) for c in (payload[i : i + size] for i in range(0, len(payload), size))]
    return b"".join([*parts, b"0" + END])


CHUNK_HEAD = re.compile(rb"([0-9A-Fa-f]+)[ \t]*(?:;[^\r\n]*)?\r\n")


def dechunked(body: bytes) -> bytes | None:
    """The payload of a chunked body, or None where the framing is broken.

    Extensions of chunks and trailers are skipped; bytes behind the end break it.
    """
    at, parts = 0, []
    while (head := CHUNK_HEAD.match(body, at)) is not None:
        n, at = int(head[1], 16), head.end()
        if n == 0:
            while (end := body.find(b"\r\n", at)) > at:  # trailers
                at = end + 2
            return b"".join(parts) if end == at and end + 2 == len(body) else None
        if body[at + n : at + n + 2] != b"\r\n":
            return None
        parts.append(body[at : at + n])
        at += n + 2
    return None


def fields_of(head: bytes) -> dict[str, str]:
    """Named fields by lower-case name; a line that starts with white space goes on the one before."""
    out, name = {}, None
    for line in head.split(b"\r\n")[1:]:
        if line[:1] in (b" ", b"\t") and name:
            out[name] += " " + line.strip().decode("utf-8", "replace")
        else:
            left, _, right = line.partition(b":")
            name = left.strip().decode("utf-8", "replace").lower()
            out[name] = right.strip().decode("utf-8", "replace")
    return out


def http_payload(block: bytes) -> tuple[bytes | None, str]:
    """(payload, status) of an HTTP message: the body behind the head, without chunk framing."""
    if not block:
        return b"", "complete"
    head, end, body = block.partition(END)
    if not end:
        return None, "no head"
    if "chunked" not in fields_of(head).get("transfer-encoding", "").lower():
        return body, "complete"
    payload = dechunked(body)
    return payload, "broken chunks" if payload is None else "complete"


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """A record without the line breaks that end it; fields without a value are left out."""
    lines = [f"{k}: {v}" for k, v in [*fields, ("Content-Length", len(block))] if v is not None]
    return ("WARC/1.1\r\n" + "\r\n".join(lines)).encode() + END + block


def segments(fields: list[tuple[str, object]], record_id: str, block: bytes, size: int) -> Iterator[bytes]:
    """The records of one block: one, or a first segment and its continuations."""
    if len(block) <= size:
        yield record(fields, block)
        return
    yield record([*fields, ("WARC-Segment-Number", 1)], block[:size])
    n = -(-len(block) // size)
    for i in range(2, n + 1):
        yield record([
            ("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{record_id}:{i}>"), ("WARC-Segment-Origin-ID", f"<{record_id}>"),
            ("WARC-Segment-Number", i), ("WARC-Segment-Total-Length", len(block) if i == n else None)],
            block[(i - 1) * size : i * size])


class Records:
    """Takes the pieces of one file in order; gives its records."""

    def __init__(self, file: str) -> None:
        self.file, self.place = file, 0
        self.held = bytearray()
        self.head: dict[str, str] | None = None

    def row(self, head: dict[str, str], block: bytes, whole: bool) -> tuple:
        bare = lambda k: head[k].strip("<> ") if k in head else None
        number = lambda k: int(head[k]) if head.get(k, "").lstrip("-").isdigit() else None
        self.place += 1
        return (
            self.file, self.place, head.get("warc-type"), bare("warc-record-id"), head.get("warc-target-uri"), number("page-id"),
            number("warc-segment-number"), bare("warc-segment-origin-id"), number("warc-segment-total-length"),
            head.get("warc-payload-digest"), bare("warc-refers-to"), head.get("content-type", "").startswith("application/http"),
            whole, block)

    def feed(self, piece: bytes) -> Iterator[tuple]:
        self.held += piece
        self.held += END
        while True:
            if self.head is None:
                start = len(self.held) - len(self.held.lstrip(b"\r\n"))
                if (end := self.held.find(END, start)) < 0:
                    return
                text = bytes(self.held[start:end])
                del self.held[: end + len(END)]
                head = fields_of(text)
                if not text.startswith(b"WARC/") or not head.get("content-length", "").isdigit():
                    yield self.row({}, text, False)  # no head: told as a damaged record
                    continue
                self.head = head
            n = int(self.head["content-length"])
            if len(self.held) < n + len(END):
                return
            block, head = bytes(self.held[:n]), self.head
            del self.held[:n]
            self.head = None
            yield self.row(head, block, True)

    def close(self) -> Iterator[tuple]:
        """What is left at the end of the file: a record that was cut off."""
        if self.head is not None:
            yield self.row(self.head, bytes(self.held[: -len(END)]), False)
        elif rest := bytes(self.held).strip(b"\r\n"):
            yield self.row({}, rest, False)


def batched(rows: Iterator[tuple], schema: pa.Schema, size) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about ``OUT_BYTES``, where ``size`` gives the bytes of a row."""
    held, n = [], 0
    make = lambda: pa.RecordBatch.from_arrays(
        [pa.array(c, t.type) for c, t in zip(zip(*held, strict=True) if held else [[]] * len(schema), schema, strict=True)], schema=schema)
    for r in rows:
        held.append(r)
        n += size(r) + 200
        if n > OUT_BYTES:
            yield make()
            held, n = [], 0
    yield make()


# --- writing ----------------------------------------------------------------

def record_id(key: Column) -> Column:
    h = F.md5(F.to_json(F.struct(key.alias("k"))))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat_ws("-", F.concat(F.lit("urn:uuid:"), part(1, 8)), part(9, 4), part(13, 4), part(17, 4), part(21, 12))


def first_of_payload(pages: DataFrame, key: str, min_revisit: int) -> DataFrame:
    """(key, page_id, url, digest, record_id, and for a revisit the id of the record it refers to), staged and narrow.

    The minimum of each payload is a partial aggregate, so a payload that a
    third of all pages share is one row from each task.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    slim = stage_table(pages.select(
        key, F.col("page_id").cast("long"), F.col("url").cast("string"), F.sha2(html, 256).alias("digest"),
        F.octet_length(html).cast("long").alias("n_bytes"), record_id(F.col(key)).alias("record_id")), "warc-pages")
    order = F.struct(F.col("page_id").isNull().alias("no_id"), F.col("page_id"), F.col("record_id").alias("record_id"))
    firsts = (
        slim.where(F.col("n_bytes") >= min_revisit).groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n"))
        .where("n > 1").select("digest", F.col("first.record_id").alias("first_id")))
    found = join_on(slim, firsts, ["digest"], "left", "merge")
    return stage_table(
        found.withColumn("refers_to", F.when(
            (F.col("n_bytes") >= min_revisit) & (F.col("first_id") != F.col("record_id")), F.col("first_id"))).drop("first_id"),
        "warc-kinds")


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES,
                   min_revisit: int = MIN_REVISIT, records_per_file: int = 1 << 14) -> None:
    """Write a record for every row of ``pages`` (page_id, url, html) as gzip archives in the folder ``path``.

    Of equal payloads the smallest page_id (null last; of rows that repeat it
    one) is a response and the others revisit it; payloads under ``min_revisit``
    bytes are responses.  Defined cases: null html is an empty payload; a null
    page_id or url is left out of the record; control characters and blanks of a
    url are percent-encoded; rows that repeat are records of their own; other
    columns are not read; an empty table writes archives without records.
    """
    prepare_python(pages.sparkSession)
    pages = pages.select("page_id", "url", "html")
    rows, key = with_row_number(pages, "warc-rows")
    kinds = first_of_payload(rows, key, min_revisit)
    again = kinds.where("refers_to IS NOT NULL")
    stored = join_on(rows, again.select(key), [key], "left_anti", "merge").select(
        F.lit("response").alias("type"), record_id(F.col(key)).alias("record_id"), F.col("page_id").cast("long"),
        F.col("url").cast("string"), F.lit(None).cast("string").alias("digest"), F.lit(None).cast("string").alias("refers_to"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    slim = again.select(F.lit("revisit").alias("type"), "record_id", "page_id", "url", "digest", "refers_to",
                        F.lit(None).cast("binary").alias("payload"))

    def made(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        import hashlib
        from urllib.parse import quote

        for b in it:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                kind, rid, page_id, url, digest, refers_to, payload = r
                digest = digest or hashlib.sha256(payload).hexdigest()
                uri = None if url is None else "".join(quote(c) if c <= " " or "\x7f" <= c <= "\xa0" else c for c in url)
                fields = [
                    ("WARC-Type", kind), ("WARC-Record-ID", f"<{rid}>"), ("WARC-Date", "1970-01-01T00:00:00Z"),
                    ("WARC-Target-URI", uri), ("Page-ID", page_id), ("Content-Type", "application/http; msgtype=response"),
                    ("WARC-Payload-Digest", f"sha256:{digest}")]
                if kind == "revisit":
                    yield (record([*fields, ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{refers_to}>")], REVISIT_HEAD),)
                else:
                    for out in segments(fields, rid, HTTP_HEAD + chunked(payload, chunk_bytes), segment_bytes):
                        yield (out,)

    schema = pa.schema([("record", pa.binary())])
    records = stored.unionByName(slim).mapInArrow(lambda it: batched(made(it), schema, lambda r: len(r[0])), "record binary")
    # a string column is written byte for byte, and every record ends with two line breaks
    records.select(F.col("record").cast("string")).write.option("lineSep", END.decode()).option("compression", "gzip").option(
        "maxRecordsPerFile", records_per_file).text(path)


# --- reading ----------------------------------------------------------------

def read_records(spark: SparkSession, path: str, segmented: bool | None = None) -> DataFrame:
    """The records of the gzip archives in ``path`` (schema ``RECORD_DDL``), segmented ones or others only on request.

    ``whole`` is false for a record that is cut off, or for bytes where a head
    is missing (then without type).  An archive that is not compressed could be
    cut between tasks, which would lose records: it is refused.
    """
    prepare_python(spark)
    pieces = spark.read.schema("value string").option("lineSep", END.decode()).text(path)
    at = pieces.metadataColumn("_metadata")
    pieces = pieces.select(
        at["file_path"].alias("file"), at["file_block_start"].alias("start"), F.col("value").cast("binary").alias("piece"))

    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now = None
        for b in it:
            for file, start, piece in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if start or not file.endswith(".gz"):
                    raise ValueError(f"{file} is not a gzip archive")
                if now is None or now.file != file:
                    if now is not None:
                        yield from now.close()
                    now = Records(file)
                yield from now.feed(piece)
        if now is not None:
            yield from now.close()

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a block can only be put together once its segments meet: others are told by their missing number
        kept = (r for r in rows(it) if segmented is None or segmented == (r[6] is not None))
        yield from batched(kept, RECORD, lambda r: len(r[-1]))

    return pieces.mapInArrow(batches, RECORD_DDL)


def _payload(kind: str | None, http: bool, whole: bool, block: bytes) -> tuple[str, bytes | None]:
    if not whole:
        return "cut off", None
    if kind == "revisit":
        return "complete", None
    if not http:
        return "complete", block
    payload, status = http_payload(block)
    return status, payload


PAYLOAD_SCHEMA = pa.schema([(c, RECORD.field(c).type) for c in PAYLOAD[:-2]] + [("status", pa.string()), ("payload", pa.binary())])
_AT = {c: i for i, c in enumerate(RECORD.names)}
_KEPT = [_AT[c] for c in PAYLOAD[:-2]]


def _lists(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in it:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def reassembled(rows: Iterator[tuple]) -> Iterator[tuple]:
    """One payload for each origin of ``rows``, which come sorted by origin and segment number.

    Numbers must go from 1 without gaps, the last segment must name the total
    length and that must be right.  A segment that repeats one byte for byte
    counts once.
    """
    first, parts, last, fault, total, origin = None, [], 0, None, None, None

    def done() -> Iterator[tuple]:
        block = b"".join(parts)
        status = fault or ("missing segment" if first is None or total is None else None) or (
            "wrong length" if total != len(block) else None)
        head = first or (None,) * len(RECORD.names)
        payload = None
        if status is None:
            status, payload = _payload(head[_AT["type"]], head[_AT["http"]], True, block)
        out = [head[i] for i in _KEPT]
        out[1] = origin
        yield (*out, status, payload)

    for r in rows:
        key, number, block = r[_AT["origin"]] or r[_AT["record_id"]], r[_AT["segment"]], r[_AT["block"]]
        if last and key != origin:
            yield from done()
            first, parts, last, fault, total = None, [], 0, None, None
        if last and number == last:
            if block != parts[-1]:
                fault = fault or "conflicting segments"
            continue
        if number != last + 1:
            fault = fault or "missing segment"
        if not r[_AT["whole"]]:
            fault = fault or "cut off"
        if number == 1:
            first = r
        origin, last = key, number
        parts.append(block)
        total = r[_AT["total"]] if r[_AT["total"]] is not None else total
    if last:
        yield from done()


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record that is no continuation (schema ``PAYLOAD_DDL``): whole payloads.

    ``status`` is ``complete``, or says why ``payload`` is null: ``missing
    segment`` (the first one or the last one with the total length included),
    ``conflicting segments``, ``wrong length``, ``broken chunks``, ``no head``,
    ``cut off``.  Revisits are complete and have no payload of their own.
    """
    size = lambda r: len(r[-1] or b"")

    def single(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((*[r[i] for i in _KEPT], *_payload(r[2], r[11], r[12], r[13])) for r in _lists(it))
        return batched(rows, PAYLOAD_SCHEMA, size)

    def joined(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batched(reassembled(_lists(it)), PAYLOAD_SCHEMA, size)

    origin = F.coalesce("origin", "record_id")
    cut = read_records(spark, path, True).repartition(origin).sortWithinPartitions(origin, "segment", "file", "place")
    return read_records(spark, path, False).mapInArrow(single, PAYLOAD_DDL).unionByName(cut.mapInArrow(joined, PAYLOAD_DDL))


def captures(spark: SparkSession, path: str) -> DataFrame:
    """One row for each response and revisit of the archives: page_id, url, status, payload_bytes,
    payload_digest, record_type, refers_to (the page_id of the response that a revisit repeats).

    A revisit takes length and digest from the record it refers to; where that
    is missing, or its own digest is another, ``status`` says so.
    """
    read = stage_table(payloads(spark, path).select(
        "type", "record_id", "page_id", "url", "digest", "refers_to", "status",
        F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest")), "warc-read")
    told = F.regexp_extract(F.lower("digest"), "^sha256:([0-9a-f]{64})$", 1)
    responses = read.where("type = 'response' OR type IS NULL").withColumn("status", F.when(
        (F.col("status") == "complete") & (F.col("digest").isNotNull()) & (told != F.col("payload_digest")), "wrong digest").otherwise(F.col("status")))
    again = read.where("type = 'revisit'").drop("payload_bytes", "payload_digest", "status")
    source = responses.where("record_id IS NOT NULL").select(
        F.col("record_id").alias("source_id"), F.col("page_id").alias("source_page"), F.col("status").alias("source_status"),
        "payload_bytes", "payload_digest")
    status = F.when(F.col("source_status").isNull(), "missing origin").when(told != F.col("payload_digest"), "wrong digest").otherwise(F.col("source_status"))
    columns = ["page_id", "url", "status", "payload_bytes", "payload_digest"]
    return responses.select(*columns, F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to")).unionByName(
        join_on(again, source, {"refers_to": "source_id"}, "left", "merge").withColumn("status", status).select(
            *columns, F.lit("revisit").alias("record_type"), F.col("source_page").alias("refers_to")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return captures(spark, path).drop("url", "status")


SQL = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS low FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= {MIN_REVISIT} AND page_id <> low THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {MIN_REVISIT} AND page_id <> low THEN low END AS refers_to
FROM f
"""
