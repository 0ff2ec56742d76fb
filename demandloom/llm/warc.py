"""WARC archives: a writer with revisit records, and a reader that salvages damaged files.

Archives are files in the shared folder, each record a gzip member of its own. The reader checks every
record (member checksum, header, length, block digest). After a failed check it searches for the next
valid member or version line, goes on from there and logs the bytes in between as a gap. A sound member
may hold many records: those that fail are gaps inside it, the others are kept. Every byte is searched
once for each mark, so a file full of damage takes time in proportion to its size.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import application_folder, stage
from ._tables import map_rows

# A file is closed once it is this long.
ARCHIVE_BYTES = 32 << 20
# Payloads of this length or more are stored once.
MIN_PAYLOAD = 0
READ_BYTES = 1 << 20
# A member that unpacks to this much or more is damaged: no Spark value can hold it.
MAX_RECORD = 1 << 31
# Marks of members and records.
MEMBER, VERSION, LINE_END = b"\x1f\x8b\x08", b"WARC/1.", b"\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = ("archive string, kind string, start long, length long, inner_start long, inner_length long, "
          "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_bytes long, "
          "payload binary, reason string")


def base32_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_value(text: str) -> str:
    """Without line ends and other controls, which would break the header."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record_bytes(page, url: str | None, payload: bytes, refers_to, date: str) -> bytes:
    """One record: a response with its payload, or a revisit that refers to an earlier page."""
    digest = base32_digest(payload)
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             b"Content-Length: %d\r\n\r\n" % len(payload))
    if refers_to is None:
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if page is None else page}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_value(url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT}"]
    head += ["Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{digest}",
             f"WARC-Block-Digest: sha1:{base32_digest(block)}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def with_revisits(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """``page_id, url, payload, refers_to``: of equal payloads the smallest page is the response.

    A null html is an empty payload. Rows that repeat the smallest page are responses too; pages without
    an id come last. Only payloads that occur more than once are looked up.
    """
    named = pages.select("page_id", "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    named = named.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload")})
    first = (named.groupBy("digest", "size").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
             .filter((F.col("n") > 1) & (F.col("size") >= min_payload)).drop("n"))
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))
    return (named.join(first, ["digest", "size"], "left")
            .select("page_id", "url", "payload", F.when(later, F.col("first")).alias("refers_to")))


def write_archives(pages: DataFrame, min_payload: int = MIN_PAYLOAD, archive_bytes: int = ARCHIVE_BYTES,
                   date: str = "2000-01-01T00:00:00Z", before: bytes = b"") -> DataFrame:
    """Write ``pages(page_id, url, html)``; returns ``archive, records, bytes``, one row per file.

    ``before`` is put in front of every member, as damage that a reader has to step over.
    A task that is run again writes files of its own, and only those of the attempt that Spark counts are
    listed. An empty table writes nothing.
    """
    folder = f"{application_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        task = TaskContext.get()
        name = f"{task.partitionId()}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        out, files, records, size = None, 0, 0, 0
        for page, url, payload, refers_to in rows:
            if out is None:
                path = f"{base}/{name}-{files}.warc.gz"
                out, records, size = store.open_output_stream(path, compression=None), 0, 0
                files += 1
            packer = zlib.compressobj(6, zlib.DEFLATED, 31)
            member = before + packer.compress(record_bytes(page, url, payload, refers_to, date)) + packer.flush()
            out.write(member)
            records, size = records + 1, size + len(member)
            if size >= archive_bytes:
                out.close()
                yield f"{folder}/{name}-{files - 1}.warc.gz", records, size
                out = None
        if out is not None:
            out.close()
            yield f"{folder}/{name}-{files - 1}.warc.gz", records, size

    written = map_rows(with_revisits(pages, min_payload), work, "archive string, records long, bytes long")
    return stage(written, "warc-manifest")


class Damaged(Exception):
    """A record that fails a check; ``end`` is where the next one may start, if that is known."""

    def __init__(self, reason: str, end: int | None = None):
        super().__init__(reason)
        self.reason, self.end = reason, end


@dataclass
class Window:
    """Bytes of a file at any place, read in steps."""

    file: object
    size: int
    at: int = 0
    held: bytes = field(default=b"", repr=False)
    places: dict[bytes, int] = field(default_factory=dict, repr=False)

    def read(self, start: int, count: int) -> bytes:
        end = min(start + count, self.size)
        if start < self.at or end > self.at + len(self.held):
            self.file.seek(start)
            self.at, self.held = start, self.file.read(max(count, READ_BYTES))
        return self.held[start - self.at:end - self.at]

    def find(self, mark: bytes, start: int) -> int:
        """The next place of ``mark``, or the end; ``start`` must not fall, so no byte is searched twice."""
        at = self.places.get(mark, -1)
        while at < start:
            held = self.at + len(self.held) - start if start >= self.at else 0
            part = self.read(start, held if held > len(mark) else READ_BYTES)
            found = part.find(mark)
            if found >= 0:
                at = start + found
            elif start + len(part) >= self.size:
                at = self.size
            else:
                start += len(part) - len(mark) + 1
        self.places[mark] = at
        return at


def _parse(record: bytes) -> tuple:
    """Fields of one whole record, checked."""
    head, cut, rest = record.partition(b"\r\n\r\n")
    lines = head.split(LINE_END)
    if not cut or not lines[0].startswith(VERSION):
        raise Damaged("no record header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("bad header line")
        fields[name.strip().lower()] = value.strip().decode("utf-8", "replace")
    try:
        length = int(fields[b"content-length"])
    except (KeyError, ValueError):
        raise Damaged("no content length") from None
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise Damaged("wrong content length")
    if not fields.get(b"warc-type") or not fields.get(b"warc-record-id"):
        raise Damaged("no type or id")
    block = rest[:length]
    claimed = fields.get(b"warc-block-digest", "")
    if claimed.startswith("sha1:") and claimed[5:] != base32_digest(block):
        raise Damaged("wrong block digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", http)
    kind = fields.get(b"warc-type", "")
    digest = fields.get(b"warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and digest and digest != base32_digest(payload):
        raise Damaged("wrong payload digest")
    return (fields.get(b"warc-record-id"), kind, fields.get(b"warc-target-uri"),
            fields.get(b"warc-refers-to"), digest, int(sizes[1]) if sizes else len(payload),
            payload if kind == "response" else None)


def _member(window: Window, start: int, max_record: int) -> tuple[bytes, int]:
    """The unpacked member at ``start`` and where it ends."""
    unpack, out, size, at = zlib.decompressobj(31), [], 0, start
    while not unpack.eof:
        part = window.read(at, 1 << 16)
        if not part:
            raise Damaged("cut off member")
        try:
            out.append(unpack.decompress(part))
        except zlib.error as error:
            raise Damaged(f"bad member: {error}") from None
        at += len(part)
        size += len(out[-1])
        if size >= max_record:
            raise Damaged("member too large")
    return b"".join(out), at - len(unpack.unused_data)


def _record_size(head: bytes, cut: int) -> int:
    """The whole size of a record whose header ends at ``cut``."""
    sizes = re.search(rb"(?i)\r\ncontent-length:[ \t]*(\d+)[ \t]*\r\n", head[:cut + 2])
    if not sizes:
        raise Damaged("no content length")
    return cut + 4 + int(sizes[1]) + 4


def _plain(window: Window, start: int) -> tuple[bytes, int]:
    """The uncompressed record at ``start`` and where it ends; its header may have any length."""
    count = 1 << 16
    while True:
        head = window.read(start, count)
        cut = head.find(b"\r\n\r\n")
        if cut >= 0:
            break
        # A false mark is given up at its first line that can't be part of a header.
        version, *lines = head.split(LINE_END)
        if len(version) > 80 or not all(b":" in line for line in lines[:-1]) or len(head) < count:
            raise Damaged("no record header")
        count *= 4
    total = _record_size(head, cut)
    if start + total > window.size:
        raise Damaged("cut off record")
    return window.read(start, total), start + total


def _records(data: bytes) -> Iterator[tuple]:
    """Records and gaps inside an unpacked member, in order: ``(start, end, fields or None, reason or None)``."""
    at, gap, reason = 0, None, ""
    while at < len(data):
        try:
            if not data.startswith(VERSION, at):
                raise Damaged("no record header")
            cut = data.find(b"\r\n\r\n", at)
            if cut < 0:
                raise Damaged("no record header")
            end = at + _record_size(data[at:cut + 2], cut - at)
            if end > len(data):
                raise Damaged("wrong content length")
            fields = _parse(data[at:end])
        except Damaged as damage:
            if gap is None:
                gap, reason = at, damage.reason
            found = data.find(VERSION, at + 1)
            at = found if found >= 0 else len(data)
            continue
        if gap is not None:
            yield gap, at, None, reason
            gap = None
        yield at, end, fields, None
        at = end
    if gap is not None:
        yield gap, len(data), None, reason


def read_records(file, size: int, max_record: int = MAX_RECORD) -> Iterator[tuple]:
    """Records and gaps of one archive in order.

    ``(start, end, inner_start, inner_end, fields or None, reason or None)``: bytes of the file and, where
    a member holds more than one whole record, bytes of the unpacked member. A member without a sound
    record is a gap of the file. Text between members and a member that isn't WARC are gaps too.
    """
    window, at = Window(file, size), 0
    gap, reason = None, ""
    while at < size:
        mark = window.read(at, len(VERSION))
        try:
            if mark.startswith(MEMBER):
                data, end = _member(window, at, max_record)
                found = _records(data)
            elif mark == VERSION:
                data, end = _plain(window, at)
                found = iter([(0, len(data), _parse(data), None)])
            else:
                raise Damaged("neither a member nor a version line")
            first = []  # a gap at most, and the first sound record
            while not first or first[-1][2] is None:
                first.append(next(found, None))
                if first[-1] is None:  # a whole member without one: the next member follows it
                    raise Damaged(first[0][3] if first[0] else "member holds no record", end)
        except Damaged as damage:
            if gap is None:
                gap, reason = at, damage.reason
            at = damage.end or min(window.find(MEMBER, at + 1), window.find(VERSION, at + 1))
            continue
        if gap is not None:
            yield gap, at, None, None, None, reason
            gap = None
        for begin, stop, fields, why in chain(first, found):
            inner = (None, None) if stop - begin == len(data) else (begin, stop)
            yield at, end, *inner, fields, why
        at = end
    if gap is not None:
        yield gap, size, None, None, None, reason


def read_archive(file, size: int) -> Iterator[tuple]:
    """``(start, end, fields or None, reason or None)`` of ``read_records``."""
    return ((start, end, fields, reason) for start, end, _, _, fields, reason in read_records(file, size))


def read_archives(archives: DataFrame, tasks: int | None = None, max_record: int = MAX_RECORD) -> DataFrame:
    """All records and gaps of the files in column ``archive``; ``kind`` is ``record`` or ``gap``.

    ``start, length`` are bytes of the file; ``inner_start, inner_length`` bytes of the unpacked member, for
    members that hold more than one whole record (else null). Files are dealt out evenly and read in
    steps, so a task holds one member at a time. A file without a byte has no rows.
    """
    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        for (archive,) in rows:
            store, path = fs.FileSystem.from_uri(archive)
            size = store.get_file_info(path).size
            with store.open_input_file(path) as file:
                for start, end, begin, stop, fields, reason in read_records(file, size, max_record):
                    kind = "gap" if fields is None else "record"
                    inner = (None, None) if begin is None else (begin, stop - begin)
                    yield (archive, kind, start, end - start, *inner, *(fields or [None] * 7), reason)

    named = archives.select("archive")
    return map_rows(named.repartition(tasks or max(1, named.count())), work, RECORD)


def page_of(name):
    """The page id in a record id of this writer."""
    return F.regexp_extract(name, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
