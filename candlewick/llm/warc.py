"""WARC archives: a writer with revisit records, and a reader that salvages damaged files."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.tables import whole, written

#: Payloads from this size are stored once; bytes of an archive, about.
LEAST_BYTES, ARCHIVE_BYTES = 100, 16 << 20
END = "\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(key: Column, digest: Column) -> Column:
    """A name made from page id and payload, so that a repeated task writes the same record."""
    mark = F.md5(F.concat_ws("/", F.coalesce(key.cast("string"), F.lit("none")), digest))
    return F.format_string("<urn:uuid:%s-%s-%s-%s-%s>", *[F.substring(mark, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def _field(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit("\r\n"))


def write_warc(
    pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", key: str = "page_id", url: str = "url",
    html: str = "html", least_bytes: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Writes one record for each row into uncompressed archives of about ``archive_bytes`` under ``path``.

    Of equal payloads of at least ``least_bytes``, the row with the smallest id is a response and the others are
    revisit records that name it; all others are responses. A null payload is empty, a null URL is
    ``urn:unknown``, line breaks in a URL are escaped. A null id is written as ``none``: it comes after any other id.
    Rows that repeat id and payload are written alike. An empty table gives no record. Other columns are not read.
    Archives are written by Spark's text writer with the end of a record as line separator, so they appear with
    their task's commit. Payloads are not shuffled when the list of revisits is small enough to be broadcast.
    """
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"), F.regexp_replace(F.coalesce(url, F.lit("urn:unknown")), r"[\r\n]", "%0A").alias("url"),
        whole(html).alias("payload"),
    ).withColumns({"n": F.octet_length("payload"), "digest": F.sha2("payload", 256)})
    marks = written(rows.select("page_id", "n", "digest"), "payload-digests")
    firsts = marks.filter(F.col("n") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("rows"))
    again = marks.join(firsts.filter("rows > 1"), "digest").filter(~F.col("page_id").eqNullSafe(F.col("first")))
    revisits = written(again.select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), F.col("first").alias("refers_to")).distinct(), "revisits")
    count, size = marks.agg(F.count("*"), F.sum("n")).first()
    told = rows.join(revisits, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
    # A group without any id has a null first: its rows are told apart by nothing, all are responses.
    again = F.col("refers_to").isNotNull()
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\n"), _field("Content-Type", "text/html; charset=utf-8"), _field("Content-Length", F.col("n").cast("string")), F.lit("\r\n"))
    block = F.when(again, head).otherwise(F.concat(head, F.col("payload")))
    told = told.withColumn("block", block)
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        _field("WARC-Type", F.when(again, "revisit").otherwise("response")),
        _field("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Date", date),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _field("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2("block", 256))),
        _field("X-Page-Id", F.coalesce(F.col("page_id").cast("string"), F.lit("none"))),
        F.when(again, F.concat(
            _field("WARC-Profile", REVISIT), _field("WARC-Refers-To", _record_id(F.col("refers_to"), F.col("digest"))),
            _field("X-Refers-To-Page", F.col("refers_to").cast("string")),
        )).otherwise(""),
        _field("Content-Type", "application/http;msgtype=response"),
        _field("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"), F.col("block"),
    )
    per_file = max(1, archive_bytes * count // max(1, size or 0)) if count else 1
    told.select(record.alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", per_file).text(path)


@dataclass(frozen=True)
class Record:
    """``member`` is the start of the gzip member that holds more than this record: ``start`` and ``stop`` then are that
    place plus offsets in the member's content."""

    start: int
    stop: int
    fields: dict[str, str]
    http_head: bytes
    payload: bytes
    member: int | None = None


@dataclass(frozen=True)
class Gap:
    start: int
    stop: int
    reason: str
    member: int | None = None


class Damaged(ValueError):
    """A place where no whole record stands; the end of the damaged record, if known, and what its member still gives."""

    def __init__(self, reason: str, stop: int = 0, records: Iterable[Record] = ()):
        super().__init__(reason)
        self.stop, self.records = stop, list(records)


_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_CANDIDATE = re.compile(rb"WARC/1\.[01]\r\n|\x1f\x8b\x08")


def _plain(data: bytes, start: int) -> tuple[int, dict[str, str], bytes]:
    """End, header fields and block of the record whose version line stands at ``start``."""
    if not _VERSION.match(data, start):
        raise Damaged("no version line")
    head_end = data.find(b"\r\n\r\n", start)
    if head_end < 0:
        raise Damaged("the header does not end")
    fields = {}
    for line in data[start:head_end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("a header line without a colon")
        fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    if not fields.get("content-length", "").isdecimal():
        raise Damaged("no content length")
    at = head_end + 4
    stop = at + int(fields["content-length"])
    if stop > len(data) or data[stop : stop + 4] != b"\r\n\r\n":
        raise Damaged("the record does not end where its length says")
    return stop + 4, fields, data[at:stop]


def _member(data: bytes, start: int) -> tuple[int, bytes]:
    """End and content of the gzip member at ``start``; its checksum and length are checked.

    A damaged member still gives the records that stand whole before the fault: with right digests, or, where the
    member is only cut short, by their form as in a plain archive.
    """
    opened = zlib.decompressobj(31)
    try:
        content = opened.decompress(memoryview(data)[start:])
    except zlib.error as error:
        raise Damaged(f"gzip member: {error}", records=_before_fault(_inflated(data, start), start, True)) from error
    if not opened.eof:
        raise Damaged("gzip member is cut short", records=_before_fault(content, start, False))
    return len(data) - len(opened.unused_data), content


def _inflated(data: bytes, start: int, step: int = 4096) -> bytes:
    """What the damaged member at ``start`` gives up to the byte where decompression fails."""
    opened, out, view = zlib.decompressobj(31), [], memoryview(data)
    for at in range(start, len(data), step):
        before, part = opened.copy(), view[at : at + step]
        try:
            out.append(opened.decompress(part))
        except zlib.error:
            try:
                out.extend(before.decompress(part[i : i + 1]) for i in range(len(part)))
            except zlib.error:
                break
    return b"".join(out)


def _before_fault(content: bytes, start: int, proof: bool) -> Iterator[Record]:
    found = (x for x in salvage(content, members=False) if isinstance(x, Record))
    return (_moved(x, start) for x in found if not proof or _proven(x))


def _moved(x: Record | Gap, start: int) -> Record | Gap:
    return replace(x, start=start + x.start, stop=start + x.stop, member=start)


#: Digest algorithms with the bytes of their values.
_ALGORITHMS = {"md5": 16, "sha1": 20, "sha256": 32, "sha384": 48, "sha512": 64}


def _digest_of(field: str) -> tuple[str, bytes | None] | None:
    """Algorithm and value of a digest in base 16, 32 or 64; no value if unreadable, nothing for an unknown algorithm."""
    kind, _, value = field.partition(":")
    kind, value = kind.strip().lower().replace("-", ""), value.strip().rstrip("=")
    if kind not in _ALGORITHMS:
        return None
    size, pad = _ALGORITHMS[kind], "=" * 8
    try:
        if len(value) == 2 * size:
            return kind, bytes.fromhex(value)
        if len(value) == -(-8 * size // 5):
            return kind, base64.b32decode(value + pad[: -len(value) % 8], casefold=True)
        if len(value) == -(-4 * size // 3):
            return kind, base64.b64decode(value + pad[: -len(value) % 4], altchars=b"-_" if set("-_") & set(value) else None, validate=True)
    except ValueError:
        pass
    return kind, None


def _agrees(field: str, *forms: bytes) -> bool:
    wanted = _digest_of(field)
    return wanted is None or any(hashlib.new(wanted[0], data, usedforsecurity=False).digest() == wanted[1] for data in forms)


def _own_payload(fields: dict[str, str]) -> bool:
    """Whether the payload digest is one of this record's own bytes: not for a revisit or a segment of a longer record."""
    return fields.get("warc-type") not in ("revisit", "continuation") and "warc-segment-number" not in fields


def _proven(record: Record) -> bool:
    """Whether a checked record has a digest of a known algorithm."""
    own = ["warc-block-digest", *["warc-payload-digest"] * _own_payload(record.fields)]
    return any(_digest_of(record.fields.get(name, "")) for name in own)


def _unchunked(body: bytes) -> bytes | None:
    """A body without its chunked transfer coding, or nothing if it has none."""
    out, at = [], 0
    while line := re.compile(rb"([0-9A-Fa-f]{1,8})[^\r\n]*\r\n").match(body, at):
        size = int(line[1], 16)
        if not size:
            return b"".join(out)
        out.append(body[line.end() : line.end() + size])
        at = line.end() + size + 2
    return None


def _checked(data: bytes, start: int) -> Record:
    """The plain record at ``start``, with right digests."""
    stop, fields, block = _plain(data, start)
    if not _agrees(fields.get("warc-block-digest", ""), block):
        raise Damaged("block digest", stop)
    http = fields.get("content-type", "").startswith("application/http")
    http_head, _, payload = block.partition(b"\r\n\r\n") if http else (b"", b"", block)
    if _own_payload(fields) and not _agrees(field := fields.get("warc-payload-digest", ""), payload):
        # Some writers take the digest after removing the transfer coding.
        chunked = re.search(rb"(?im)^transfer-encoding:.*chunked", http_head)
        plain = _unchunked(payload) if chunked else None
        if plain is None or not _agrees(field, plain):
            raise Damaged("payload digest", stop)
    return Record(start, stop, fields, http_head, payload)


def _found(data: bytes, start: int, members: bool) -> tuple[int, Iterator[Record | Gap]]:
    """End of what stands at ``start``, a plain record or a gzip member, and its records and gaps."""
    if not members or data[start : start + 3] != b"\x1f\x8b\x08":
        record = _checked(data, start)
        return record.stop, iter([record])
    stop, content = _member(data, start)
    inside = salvage(content, members=False)
    first = next(inside, None) or Gap(0, 0, "gzip member is empty")
    if first.stop < len(content):
        return stop, (_moved(x, start) for x in chain([first], inside))
    if isinstance(first, Gap):
        raise Damaged(first.reason, stop)
    return stop, iter([replace(first, start=start, stop=stop)])


def salvage(data: bytes, members: bool = True) -> Iterator[Record | Gap]:
    """All whole records of an archive, plain or of gzip members, and the byte ranges between them that hold none.

    A member may hold any number of records; each lies in one member. After a failed check the search goes on at the
    next version line or member that is a whole record with right digests (of any usual algorithm; a record without
    a digest is known by its form). A version line inside a payload is passed over, unless the record around it is
    damaged and the line starts a record with right digests itself; only where damage hides that record's end can a
    record without a digest be taken from its payload. Records out of a damaged member follow the gap that covers it.
    """
    at = 0
    while at < len(data):
        try:
            stop, inside = _found(data, at, members)
        except Damaged as error:
            fault, rescued = error, error.records
        else:
            yield from inside
            at = stop
            continue
        until, stop, inside = len(data), len(data), iter(())
        for place in (_CANDIDATE if members else _VERSION).finditer(data, at + 1):
            try:
                end, items = _found(data, place.start(), members)
            except Damaged as error:
                rescued += error.records
                continue
            first = next(items)
            if place.start() < fault.stop and not (isinstance(first, Record) and _proven(first)):
                continue
            # Stored blocks of a damaged member show its records a second time.
            if isinstance(first, Record) and any((first.fields, first.payload) == (r.fields, r.payload) for r in rescued):
                continue
            until, stop, inside = place.start(), end, chain([first], items)
            break
        yield Gap(at, until, str(fault))
        yield from rescued
        yield from inside
        at = stop


READ = (
    "file string, start long, stop long, gap string, page_id long, url string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, payload binary, member long"
)


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records and gaps of all archives under ``path``, one row each: ``file``, ``start``, ``stop`` (bytes), then

    for a record ``page_id``, ``url``, ``record_type``, ``refers_to`` (page id), ``payload_bytes`` and
    ``payload_digest`` of the full payload, and ``payload`` (null for a revisit, and without ``payloads``);
    for a quarantined gap ``gap``, the check that failed. ``member`` is the start of a gzip member that holds more than
    the row's record; ``start`` and ``stop`` then are that place plus offsets in its content. An archive is held in
    memory by one task, with the content of one member.
    """
    schema = pa.schema([
        ("file", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("gap", pa.string()), ("page_id", pa.int64()),
        ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("payload", pa.binary()), ("member", pa.int64()),
    ])

    def number(text: str | None) -> int | None:
        return int(text) if text and re.fullmatch(r"-?\d+", text) else None

    def row(name: str, x: Record | Gap) -> tuple:
        if isinstance(x, Gap):
            return (name, x.start, x.stop, x.reason, *[None] * 7, x.member)
        kind, f = x.fields.get("warc-type"), x.fields
        again = kind == "revisit"
        told, value = _digest_of(f.get("warc-payload-digest", "")) or ("", None)
        full = re.search(rb"(?im)^content-length:\s*(\d+)", x.http_head) if again else None
        return (
            name, x.start, x.stop, None, number(f.get("x-page-id")), f.get("warc-target-uri"), kind, number(f.get("x-refers-to-page")),
            (int(full[1]) if full else None) if again else len(x.payload),
            (value.hex() if value and told == "sha256" else None) if again else hashlib.sha256(x.payload).hexdigest(),
            x.payload if payloads and not again else None, x.member,
        )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows, size = [], 0
                for x in salvage(content.as_py()):
                    rows.append(row(name, x))
                    size += (x.stop - x.start) if payloads else 256
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{txt,warc,gz}").load(path)
    return files.filter("length > 0").select("path", "content").mapInArrow(records, READ)


def digests(records: DataFrame) -> DataFrame:
    return records.filter("gap is null").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
