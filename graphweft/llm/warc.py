"""WARC archives: a writer, and a salvage reader that goes on behind damage.

Writing: payloads that occur in several rows are stored once (response); the others refer
to it (revisit). A task packs its records into archives of about ``ARCHIVE_BYTES``, and
Spark's own text writer puts each into a file, bytes unchanged, with a fixed ending: an
empty gzip member for compressed archives, where each record is a gzip member; for
plain ones the blank lines that end a record. So archives can lie wherever Spark can
write, and their size is bounded by ``ARCHIVE_BYTES`` and one record.

Reading: a record counts only if its member unpacks with the right checksum, it begins
with a version line (of any version), its block is as long as it says and its digests agree: the block
digest with the block, the payload digest with the payload. Where the block is an HTTP message the payload
is what follows its headers (which become ``http_head``), as stored or with the chunks of its transfer
joined, since writers differ. Digests are hexadecimal or base32; those of an unknown algorithm are
not checked, nor are payload digests that tell of other bytes: in revisits, cut-off and segmented records.
A block that agrees with its own digest is as it was written, so a payload digest cannot refuse it.
After a failed check the reader searches all the rest for the next position where a gzip member or
version line starts a record that passes, takes up there, and reports the bytes between as a gap.
Neither the start of an archive nor its name says which of the two it holds. A member that
unpacks is read to its end: all its records count, and what does not parse in it is a gap with
the member's place. It is unpacked as a whole, so memory holds the archive and one member.
An archive is read as a whole by one task, so the reader refuses files above
``MAX_ARCHIVE_BYTES``, the usual size of a WARC file.

Null payloads count as empty. Rows with equal ids and payloads are records of their own. A
null id is written as an empty one, read back as null, and never referred to. An empty
table gives an archive folder without records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"  # fixed value
RECORD_END = b"\r\n\r\n"
VERSION = b"WARC/"
VERSION_LINE = re.compile(rb"WARC/\d+\.\d+[ \t]*\r\n")
DIGESTS = ("md5", "sha1", "sha256", "sha384", "sha512")  # fixed value: those that are checked
HTTP_HEAD = ":http"  # key of the HTTP headers among those of the record; no header name holds a colon
GZIP = b"\x1f\x8b\x08"
MIN_SHARED = 100  # payloads below are never referred to
ARCHIVE_BYTES = 16 << 20
MAX_ARCHIVE_BYTES = 1 << 30
LEVEL = 6

RECORD = "archive string, offset long, length long, type string, id string, uri string, date string, refers_to string, digest string, payload_bytes long, payload binary, http_head string"
SALVAGED = f"{RECORD}, problem string"


def plan_records(rows: DataFrame, id_col: str, payload: Column, min_shared: int = MIN_SHARED) -> DataFrame:
    """``rows`` with ``_payload, _bytes, _digest, _refers_to``: who stores a payload and who refers to it."""
    full = rows.withColumn("_payload", F.coalesce(payload.cast("binary"), F.lit(b""))).withColumn("_bytes", F.length("_payload").cast("long")).withColumn("_digest", F.sha2("_payload", 256))
    first = (
        full.where(F.col("_bytes") >= min_shared).groupBy("_digest").agg(F.min(id_col).alias("_first"), F.count("*").alias("_n")).where("_n > 1 and _first is not null").drop("_n")
    )
    joined = full.join(first, "_digest", "left")  # one row per shared digest; adaptive execution splits a hot one
    return joined.withColumn("_refers_to", F.when(F.col("_first") < F.coalesce(F.col(id_col), F.col("_first") + 1), F.col("_first"))).drop("_first")


def _record(ident: str | None, uri: str | None, payload: bytes, size: int, digest: str, refers_to: str | None, date: str) -> bytes:
    revisit = refers_to is not None
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:row:{'' if ident is None else ident}>"),
        ("WARC-Target-URI", re.sub(r"[\r\n]", " ", uri or "")),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(size)),
        *([("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:row:{refers_to}>")] if revisit else []),
        ("Content-Type", "application/octet-stream"),
        ("Content-Length", str(0 if revisit else size)),
    ]
    return VERSION + b"1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + (b"" if revisit else payload)


def _member(record: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def write_archives(rows: DataFrame, path: str, id_col: str, payload: Column, uri_col: str | None = None, compressed: bool = True, date: str = "1970-01-01T00:00:00Z") -> None:
    """One record per row into new archives below ``path``."""
    planned = plan_records(rows, id_col, payload).select(
        F.col(id_col).cast("string").alias("id"), (F.col(uri_col) if uri_col else F.lit(None).cast("string")).alias("uri"),
        F.when(F.col("_refers_to").isNull(), F.col("_payload")).alias("payload"), "_bytes", "_digest", F.col("_refers_to").cast("string").alias("refers_to"),
    )

    ending = EMPTY_MEMBER if compressed else RECORD_END

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for batch in batches:
            for ident, uri, body, length, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                record = _record(ident, uri, body or b"", length, digest, refers_to, date)
                out.append(_member(record + RECORD_END) if compressed else record)
                size += len(out[-1])
                if size >= ARCHIVE_BYTES:
                    yield _packed(out, compressed)
                    out, size = [], 0
        if out:
            yield _packed(out, compressed)

    packed = planned.mapInArrow(pack, "archive binary").select(F.col("archive").cast("string").alias("value"))
    packed.write.option("encoding", "ISO-8859-1").option("lineSep", ending.decode("latin-1")).option("maxRecordsPerFile", 1).text(path)


def _packed(records: list[bytes], compressed: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([(b"" if compressed else RECORD_END).join(records)], pa.binary())], ["archive"])


def _agrees(digest: str, *forms: bytes) -> bool:
    """Is ``digest`` (algorithm:value) that of one of the forms? Unknown algorithms are not checked."""
    kind, _, value = digest.partition(":")
    kind, value = kind.strip().lower().replace("-", ""), value.strip()
    if kind not in DIGESTS:
        return True
    for form in forms:
        own = hashlib.new(kind, form)
        if value.lower() == own.hexdigest() or value.upper().rstrip("=") == base64.b32encode(own.digest()).decode().rstrip("="):
            return True
    return False


def _unchunked(body: bytes) -> bytes | None:
    """The chunks of an HTTP body joined; None if it is not made of chunks."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = re.fullmatch(rb"[ \t]*([0-9A-Fa-f]{1,15})[ \t]*(;.*)?", body[at:end], re.DOTALL) if end >= 0 else None
        if not size:
            return None
        n, at = int(size[1], 16), end + 2
        if n == 0:
            return b"".join(out)
        if at + n > len(body):
            return None
        out.append(body[at : at + n])
        at += n + 2


def _headers(text: bytes) -> dict[str, str] | None:
    """Names in lower case with their values, folded lines joined; None if a line is no header."""
    head: dict[str, str] = {}
    name = None
    for line in text.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and name is not None:
            head[name] = f"{head[name]} {line.strip()}".strip()
            continue
        name, colon, value = line.partition(":")
        if not colon:
            return None
        name = name.strip().lower()
        head[name] = value.strip()
    return head


def _parse(block: bytes) -> tuple[dict[str, str], bytes] | str:
    """Headers and payload of one record without its end, or what is wrong with it."""
    version = VERSION_LINE.match(block)
    if not version:
        return "no version line"
    end = block.find(RECORD_END, version.end() - 2)
    if end < 0:
        return "no end of headers"
    head = _headers(block[version.end() : end])
    if head is None:
        return "bad header line"
    if not head.get("content-length", "").isdigit():
        return "no length"
    body = block[end + 4 :]
    if len(body) < int(head["content-length"]):
        return "block too short"
    body = body[: int(head["content-length"])]
    own = head.get("warc-block-digest", "")
    if own and not _agrees(own, body):
        return "block digest differs"
    sure = own.partition(":")[0].strip().lower().replace("-", "") in DIGESTS
    forms = (body,)
    if head.get("content-type", "").lower().startswith("application/http"):
        stop = body.find(RECORD_END)
        if stop >= 0:
            head[HTTP_HEAD] = body[:stop].decode("utf-8", "replace")
            body = body[stop + 4 :]
            chunks = _unchunked(body) if re.search(r"(?im)^transfer-encoding:.*chunked", head[HTTP_HEAD]) else None
            forms = (body,) if chunks is None else (body, chunks)
    elsewhere = head.get("warc-type", "").lower() == "revisit" or "warc-truncated" in head or "warc-segment-number" in head
    if not sure and not elsewhere and not _agrees(head.get("warc-payload-digest", ""), *forms):
        return "payload digest differs"
    return head, body


def _plain_at(data: bytes, at: int) -> tuple[int, dict[str, str], bytes] | str:
    """The record of a plain archive at a position: where it ends, headers, payload."""
    end = data.find(RECORD_END, at)
    if not VERSION_LINE.match(data, at) or end < 0:
        return "no version line"
    length = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", data[at:end])
    if not length:
        return "no length"
    stop = end + 4 + int(length[1])
    if data[stop : stop + 4] != RECORD_END:
        return "no end of record"
    found = _parse(data[at:stop])
    return found if isinstance(found, str) else (stop + 4, *found)


def _record_at(data: bytes, at: int) -> tuple[int, list[tuple]] | str:
    """The same in the form ``_walk`` takes."""
    found = _plain_at(data, at)
    return found if isinstance(found, str) else (found[0], [(*found[1:], None)])


def _member_at(data: bytes, at: int) -> tuple[int, bytes] | str:
    """The gzip member at a position: where it ends, what it holds."""
    if not data.startswith(GZIP, at):
        return "no gzip member"
    unpacker = zlib.decompressobj(31)
    view, block, pos = memoryview(data), [], at
    try:
        while not unpacker.eof and pos < len(data):
            block.append(unpacker.decompress(view[pos : pos + (1 << 16)]))
            pos += 1 << 16
    except zlib.error as e:
        return f"gzip: {e}"
    if not unpacker.eof:
        return "gzip member cut off"
    return min(pos, len(data)) - len(unpacker.unused_data), b"".join(block)


def _packed_at(data: bytes, at: int) -> tuple[int, list[tuple]] | str:
    """The gzip member at a position: where it ends, its records and gaps (headers, payload, problem); one without any record is a problem."""
    member = _member_at(data, at)
    if isinstance(member, str):
        return member
    stop, whole = member
    inside = [
        (head, body, problem and f"{problem}: bytes {begin} to {begin + n} of the unpacked member")
        for begin, n, head, body, problem in _walk(whole, _record_at, (VERSION,))
    ]
    if whole and not any(head is not None for head, _, _ in inside):
        return inside[0][2]
    return stop, inside


def _any_at(data: bytes, at: int) -> tuple[int, list[tuple]] | str:
    """What starts at a position, a gzip member or a plain record."""
    return _packed_at(data, at) if data.startswith(GZIP, at) else _record_at(data, at)


def _walk(data: bytes, read: Callable[[bytes, int], tuple[int, list[tuple]] | str], marks: tuple[bytes, ...]) -> Iterator[tuple]:
    """What ``read`` finds from mark to mark, as ``salvage`` yields it."""
    at, bad, problem = 0, None, ""
    ahead = dict.fromkeys(marks, -1)  # next place of each mark; searched for only once passed
    while at < len(data):
        found = read(data, at)
        if not isinstance(found, str) and not found[1] and bad is not None and found[0] < len(data) and not data.startswith(marks, found[0]):
            found = "empty gzip member in a gap"  # bytes of a damaged payload
        if isinstance(found, str):
            if bad is None:
                bad, problem = at, found
            for mark, place in ahead.items():
                if place <= at:
                    place = data.find(mark, at + 1)
                    ahead[mark] = place if place >= 0 else len(data)
            at = min(ahead.values())
            continue
        if bad is not None:
            yield bad, at - bad, None, None, problem
            bad = None
        stop, inside = found
        for row in inside:
            yield at, stop - at, *row
        at = stop
    if bad is not None:
        yield bad, len(data) - bad, None, None, problem


def salvage(data: bytes) -> Iterator[tuple]:
    """Records (offset, length, headers, payload, None) and gaps (offset, length, None, None, problem) in order.

    Records and gaps inside a gzip member have the place of the member.
    """
    return _walk(data, _any_at, (GZIP, VERSION))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records and gaps of all archives below ``path``, columns as in ``SALVAGED``; ``problem`` is set for gaps."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(
        "path", F.when(F.col("length") <= MAX_ARCHIVE_BYTES, F.col("content")).otherwise(F.raise_error(F.lit("archive too large for one task"))).alias("content")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name, out, held = batch.column(0)[i].as_py(), [], 0
                for offset, length, head, body, problem in salvage(batch.column(1)[i].as_py()):
                    if head is None:
                        out.append((name, offset, length, *[None] * 9, problem))
                    else:
                        size = head.get("x-payload-length", "")
                        out.append((
                            name, offset, length, head.get("warc-type"), head.get("warc-record-id"), head.get("warc-target-uri"), head.get("warc-date"),
                            head.get("warc-refers-to"), head.get("warc-payload-digest"), int(size) if size.isdigit() else len(body), body, head.get(HTTP_HEAD), None,
                        ))
                        held += len(body)
                    if held > ARCHIVE_BYTES or len(out) > 5000:
                        yield _batch(out)
                        out, held = [], 0
                if out:
                    yield _batch(out)

    return files.mapInArrow(read, SALVAGED)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 6, pa.int64(), pa.binary(), pa.string(), pa.string()]
    names = [c.split()[0] for c in SALVAGED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def row_id(urn: Column) -> Column:
    """The id inside ``<urn:row:…>``; null if empty."""
    return F.nullif(F.regexp_extract(urn, r"^<urn:row:(.*)>$", 1), F.lit(""))


SQL = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first, count(*) AS n FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest
"""
