"""WARC archives: written in segments with chunked bodies, read back by reassembly.

Writing.  A page is a ``response`` record: an HTTP head and the payload in chunked transfer framing.  Of pages with equal
payloads of at least ``REVISIT_FROM`` bytes, the first by id is the response and the others are ``revisit`` records that
name it and carry no body.  A block above ``segment`` bytes is cut: its record is segment 1, ``continuation`` records with
the origin's identifier and their number follow, and the last one declares the total length.  Every record is a gzip
member of its own.  Spark's text writer puts the members into files, so tasks may be repeated and any store that Spark
writes to will do; the separator it wants between rows is the empty gzip member, which unpacks to nothing.

Reading.  Files, plain or gzip with one or many records a member, are parsed by tasks into records.  Whole records are
decoded where they are parsed.  Segments are grouped by origin identifier across files, put in order by number and
checked: numbers 1 to k without a gap or repetition, and the declared total length; then the joined block's chunks are
decoded.  Only segments are shuffled, and a group is one page.  What fails a check, or whose payload does not have its
declared digest, has a text in ``problem`` and no payload.

A file is read into one task, as archive files are; ``records_per_file`` and ``segment`` bound those written here (64 MB at
most at the defaults).  One page is one row in any case.

Defined results: a null page is an empty payload; empty and short payloads are responses, equal or not; very long pages are
cut into segments; null ids come last in the order of ids, so a row without an id is the response only if no row of its
payload has one; rows that repeat an id are records each, ordered by payload digest and address; an empty table writes an
archive without records; other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import slices, stored

REVISIT_FROM = 100
CHUNK = 8_192
SEGMENT = 65_536
RECORDS_PER_FILE = 1_024
FEED = 32_768
# An empty gzip member: magic, deflate, no flags, no time, unknown system, an empty block, checksum and length zero.
EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff\x03\x00" + bytes(8)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
PAGES = "_row long, page_id long, uri string, payload binary, first long"
RECORDS = "record_id string, record_type string, page_id long, uri string, refers_to string, origin string, segment int, total long, declared string, body binary, problem string"
FIELDS = [field.split()[0] for field in RECORDS.split(", ")]
ARROW = pa.schema(
    [(c, {"page_id": pa.int64(), "segment": pa.int32(), "total": pa.int64(), "body": pa.binary()}.get(c, pa.string())) for c in FIELDS]
)


# --- framing -----------------------------------------------------------------


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """The payload in chunked transfer framing."""
    out = []
    for at in range(0, len(payload), size):
        piece = payload[at : at + size]
        out += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are skipped, broken framing is a ValueError."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        head = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]+", head):
            raise ValueError("chunk size missing")
        size, at = int(head, 16), end + 2
        if not size:
            break
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk of wrong length")
        out.append(body[at : at + size])
        at += size + 2
    while (end := body.find(b"\r\n", at)) > at:
        at = end + 2
    if end < 0 or end + 2 != len(body):
        raise ValueError("chunked body does not end")
    return b"".join(out)


def http_payload(block: bytes) -> bytes:
    """The payload of an HTTP response block."""
    end = block.find(b"\r\n\r\n")
    if not block.startswith(b"HTTP/") or end < 0:
        raise ValueError("no HTTP head")
    fields = dict(_field(line) for line in block[:end].split(b"\r\n")[1:])
    body = block[end + 4 :]
    if b"chunked" in fields.get(b"transfer-encoding", b"").lower():
        return dechunked(body)
    if int(fields.get(b"content-length", len(body))) != len(body):
        raise ValueError("body of wrong length")
    return body


def _field(line: bytes) -> tuple[bytes, bytes]:
    name, _, value = line.partition(b":")
    return name.strip().lower(), value.strip()


# --- writing -----------------------------------------------------------------


def record_id(archive: str, row: int, segment: int = 1) -> str:
    name = hashlib.sha256(f"{archive} {row} {segment}".encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=name[:16], version=4)}>"


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in [*fields, ("Content-Length", len(block))] if value is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def records_of(archive: str, date: str, segment: int, row: int, page_id: int | None, uri: str | None, payload: bytes, first: int | None) -> Iterator[bytes]:
    """The records of one page, one or several."""
    address = f"urn:page:{row}" if uri is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri)
    own, digest = record_id(archive, row), hashlib.sha256(payload).hexdigest()
    about = [("WARC-Date", date), ("WARC-Target-URI", address), ("Page-Id", page_id)]
    kind = ("Content-Type", "application/http; msgtype=response")
    if first is not None:
        refers = [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(archive, first))]
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", own), *about, *refers, ("WARC-Payload-Digest", f"sha256:{digest}"), kind], HTTP_HEAD)
        return
    block = HTTP_HEAD + chunked(payload)
    cuts = range(0, len(block), segment)
    for number, at in enumerate(cuts, 1):
        here = [("WARC-Segment-Number", number)] if len(cuts) > 1 else []
        if number == 1:
            fields = [("WARC-Type", "response"), ("WARC-Record-ID", own), *about, ("WARC-Payload-Digest", f"sha256:{digest}"), kind, *here]
        else:
            ends = [("WARC-Segment-Total-Length", len(block))] if number == len(cuts) else []
            fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", record_id(archive, row, number)), *about, ("WARC-Segment-Origin-ID", own), *here, *ends]
        yield _record(fields, block[at : at + segment])


def numbered(pages: DataFrame, key: str, uri: str, html: str) -> DataFrame:
    """(_row, page_id, uri, payload) with ``_row`` unique and in the order of ids, nulls last."""
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"),
        F.col(uri).cast("string").alias("uri"),
        F.coalesce(F.col(html).cast("string").cast("binary"), F.lit(b"")).alias("payload"),
    )
    repeated = rows.groupBy("page_id").count().filter(F.col("page_id").isNull() | (F.col("count") > 1))
    if repeated.isEmpty():
        return rows.select(F.col("page_id").alias("_row"), "*")
    order = [F.col("page_id").asc_nulls_last(), F.sha2("payload", 256), F.col("uri")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(placed.select(F.monotonically_increasing_id().alias("_row"), "*"))


def revisits(rows: DataFrame, least: int = REVISIT_FROM) -> DataFrame:
    """(_row, first) of the rows whose payload an earlier row holds.

    Digests are counted map-side first, so a frequent payload is one row a task; only ids and digests are shuffled.
    """
    large = rows.filter(F.octet_length("payload") >= least).select("_row", F.sha2("payload", 256).alias("digest"))
    firsts = large.groupBy("digest").agg(F.min("_row").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return large.join(firsts.select("digest", "first"), "digest").filter("_row <> first").select("_row", "first")


def write_archive(
    pages: DataFrame, path: str, key: str = "page_id", uri: str = "url", html: str = "html",
    date: datetime | None = None, segment: int = SEGMENT, records_per_file: int = RECORDS_PER_FILE, least: int = REVISIT_FROM,
) -> None:
    """Write the pages' records into gzip files below ``path``."""
    archive = uuid.uuid4().hex
    stamp = (date or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = numbered(pages, key, uri, html)
    whole = rows.join(stored(revisits(rows, least)), "_row", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "payload"):
            for page in zip(*[batch.column(c).to_pylist() for c in ("_row", "page_id", "uri", "payload", "first")]):
                members = (gzip.compress(r, 4, mtime=0) for r in records_of(archive, stamp, segment, *page))
                for member in members:
                    yield pa.RecordBatch.from_arrays([pa.array([member], pa.binary())], ["member"])

    members = whole.select(*[field.split()[0] for field in PAGES.split(", ")]).mapInArrow(run, "member binary")
    options = {"lineSep": EMPTY_MEMBER.decode("latin-1"), "encoding": "ISO-8859-1", "maxRecordsPerFile": records_per_file}
    members.select(F.col("member").cast("string").alias("value")).write.options(**options).text(path)


# --- reading -----------------------------------------------------------------


def unpacked(content: bytes) -> Iterator[bytes]:
    """The pieces of a file's bytes, gzip members unpacked one after the other."""
    if not content.startswith(b"\x1f\x8b"):
        yield content
        return
    at, view = 0, memoryview(content)
    while at < len(content):
        member, out = zlib.decompressobj(31), []
        while not member.eof and at < len(content):
            out.append(member.decompress(view[at : at + FEED]))
            at += FEED
        at = min(at, len(content)) - len(member.unused_data)
        yield b"".join(out)


def parsed(content: bytes) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    """(fields, block) of the records of a file; what is no record is a ValueError."""
    left = b""
    for piece in unpacked(content):
        left, at = left + piece, 0
        while at < len(left):
            head = left.find(b"\r\n\r\n", at)
            if head < 0:
                break
            first, *lines = left[at:head].split(b"\r\n")
            fields = dict(_field(line) for line in lines)
            if not first.startswith(b"WARC/") or not fields.get(b"content-length", b"").isdigit():
                raise ValueError("no record head")
            end = head + 4 + int(fields[b"content-length"])
            if end + 4 > len(left):
                break
            if left[end : end + 4] != b"\r\n\r\n":
                raise ValueError("record of wrong length")
            yield fields, left[head + 4 : end]
            at = end + 4
        left = left[at:]
    if left:
        raise ValueError("file ends inside a record")


def decoded(block: bytes, declared: str | None) -> tuple[bytes | None, str | None]:
    """(payload, None) of a whole block, or (None, what is wrong with it)."""
    try:
        payload = http_payload(block)
    except ValueError as error:
        return None, str(error)
    if declared and declared.startswith("sha256:") and hashlib.sha256(payload).hexdigest() != declared.removeprefix("sha256:"):
        return None, "payload digest differs"
    return payload, None


def _row(fields: dict[bytes, bytes], block: bytes) -> dict:
    text = {name.decode("latin-1"): value.decode("utf-8", "replace") for name, value in fields.items()}
    number = lambda name: int(text[name]) if re.fullmatch(r"-?\d+", text.get(name, "")) else None
    row = {
        "record_id": text.get("warc-record-id"), "record_type": text.get("warc-type"), "page_id": number("page-id"),
        "uri": text.get("warc-target-uri"), "refers_to": text.get("warc-refers-to"), "origin": text.get("warc-segment-origin-id"),
        "segment": number("warc-segment-number"), "total": number("warc-segment-total-length"),
        "declared": text.get("warc-payload-digest"), "body": block, "problem": None,
    }
    if row["segment"] is None and row["record_type"] == "response":
        row["body"], row["problem"] = decoded(block, row["declared"])
    elif row["segment"] is None:
        row["body"] = None
    return row


def _parse(segmented: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                try:
                    for fields, block in parsed(content.as_py()):
                        if (b"warc-segment-number" in fields) == segmented:
                            rows.append(_row(fields, block))
                            held += len(block)
                        if held > FEED * 64:
                            yield pa.RecordBatch.from_pylist(rows, ARROW)
                            rows, held = [], 0
                except (ValueError, zlib.error) as error:
                    if not segmented:  # a file is parsed twice, its fault told once
                        rows.append({"record_type": "unreadable", "problem": str(error)})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, ARROW)

    return run


def _join(group: pa.Table) -> pa.Table:
    g = group.sort_by("segment").to_pylist()
    first, last = g[0], g[-1]
    row = {**first, "record_id": first["record_id"] if first["origin"] is None else first["origin"], "origin": None, "segment": None}
    block = b"".join(r["body"] for r in g)
    if [r["segment"] for r in g] != list(range(1, len(g) + 1)) or last["total"] is None or first["origin"] is not None:
        row["body"], row["problem"] = None, "segment missing or repeated"
    elif last["total"] != len(block):
        row["body"], row["problem"] = None, "total length differs"
    else:
        row["body"], row["problem"] = decoded(block, first["declared"])
    return pa.Table.from_pylist([row], ARROW)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, record_type, page_id, uri, refers_to, declared, payload, problem), one row a page; revisits have no payload."""
    files = spark.read.format("binaryFile").load(path).select("content")
    whole = files.mapInArrow(_parse(False), RECORDS)
    segments = files.mapInArrow(_parse(True), RECORDS)
    joined = segments.groupBy(F.coalesce("origin", "record_id")).applyInArrow(_join, RECORDS)
    return whole.unionByName(joined).select(
        "record_id", "record_type", "page_id", "uri", "refers_to", "declared", F.col("body").alias("payload"), "problem"
    )


def page_digests(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of an archive; a page with a problem fails the job.

    A revisit takes size and digest from the response it names, and must have declared that digest.
    """
    records = read_archive(spark, path)
    found = stored(
        records.select(
            "record_id", "record_type", "page_id", "refers_to", "declared", "problem",
            F.octet_length("payload").cast("long").alias("payload_bytes"),
            F.sha2("payload", 256).alias("payload_digest"),
        )
    )
    own = found.filter("record_type <> 'revisit'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"), "problem"
    )
    to = found.filter("record_type = 'response'").select(
        F.col("record_id").alias("to_id"), F.col("page_id").alias("to_page"), "payload_bytes", "payload_digest"
    )
    again = found.filter("record_type = 'revisit'").select("page_id", "record_type", "refers_to", "declared")
    again = again.join(to, F.col("refers_to") == F.col("to_id"), "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.col("to_page").alias("refers_to"),
        F.when(~F.coalesce(F.col("declared") == F.concat(F.lit("sha256:"), "payload_digest"), F.lit(False)), F.lit("revisit of another payload")).alias("problem"),
    )
    every = own.unionByName(again)
    checked = F.when(F.col("problem").isNotNull(), F.raise_error(F.concat(F.lit("archive: "), "problem"))).otherwise(F.col("record_type"))
    return every.withColumn("record_type", checked).drop("problem")
