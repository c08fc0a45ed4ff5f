"""WARC archives of pages, each record a Zstandard frame of its own under the file's dictionary.

A file starts with a skippable frame that holds the dictionary, so it can be read by
itself. Payloads that occur more than once are stored once; their other records say
which one they revisit.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.session import materialise, scratch_path, send_code_with_tasks
from skyledger.sources.archives import open_path, spread_members

send_code_with_tasks(__name__)

#: The skippable frame a dictionary is kept in, the version line of a record
#: and the profile of a record that repeats a payload.
DICTIONARY_FRAME = 0x184D2A5D
VERSION = b"WARC/1.1\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: A file is closed beyond this size, and a task goes on in another one.
FILE_BYTES = 1 << 30
#: Records held back at the start of a file to build its dictionary from: at most so many
#: bytes and records. Each is a sample by its first bytes; the records themselves are whole.
SAMPLE_BYTES, SAMPLE_RECORDS, SAMPLE_PART = 4 << 20, 2000, 16 << 10
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
READ_BYTES, DROP_BYTES = 1 << 18, 1 << 20

RECORDS = "path string, offset bigint, length bigint, record_id string, page_id bigint"
PAGES = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
    "url string, path string, intact boolean"
)


def open_archive(path: str):
    """Binary output stream for a path as Spark prints it. The bytes are written as they
    are: by default the file system would compress what is named ``.zst`` once more."""
    from pyarrow import fs

    if "://" in path and not path.startswith("file:"):
        system, inner = fs.FileSystem.from_uri(path.replace("s3a:", "s3:", 1))
    else:
        system, inner = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    system.create_dir(inner.rpartition("/")[0], recursive=True)
    return system.open_output_stream(inner, compression=None)


def payload_digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32, as WARC headers carry it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_first_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Add ``record_id`` to each row and, where it repeats another's payload, the record
    ``first_record`` of page ``first_page`` that holds it.

    Of rows with equal payloads of at least ``least_bytes`` bytes the one with the largest
    page_id holds it, one of them where that is repeated. Rows are stored first, as ids
    given to them must not change. Payloads that occur once, nearly all, take no part in
    the join, and the others only by their SHA-256.
    """
    rows = pages.withColumns({
        "record_id": F.expr("uuid()"),
        "payload_key": F.sha2(F.col("html").cast("binary"), 256),
        "payload_bytes": F.octet_length("html").cast("bigint"),
    })
    stored = materialise(rows, "pages")
    groups = stored.filter(F.col("payload_bytes") >= least_bytes).groupBy("payload_key").agg(
        F.max(F.struct("page_id", "record_id")).alias("first"), F.count("*").alias("_rows")
    )
    repeated = groups.filter("_rows > 1").select(
        "payload_key", F.col("first.page_id").alias("first_page"), F.col("first.record_id").alias("first_record")
    )
    found = stored.join(materialise(repeated, "repeated-payloads"), "payload_key", "left")
    other = F.col("first_record") != F.col("record_id")
    return found.withColumns({
        "first_page": F.when(other, F.col("first_page")), "first_record": F.when(other, F.col("first_record")),
    }).drop("payload_key")


def record_bytes(
    record_id: str, page_id: int | None, url: str | None, payload: bytes, first_page: int | None, first_record: str | None, date: str
) -> bytes:
    """One record. A response holds the page; a revisit only the page's HTTP header, which
    states the length of the full payload."""
    block = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode()
    fields = {
        "WARC-Type": "response" if first_record is None else "revisit",
        "WARC-Record-ID": f"<urn:uuid:{record_id}>",
        "WARC-Date": date,
        # Blanks, control characters and line breaks must not end a header line.
        "WARC-Target-URI": quote(url or "about:blank", safe="%/:=&?~#+!$,;'@()*[]|"),
        "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
    }
    if page_id is not None:
        fields["X-Page-ID"] = page_id
    if first_record is None:
        block += payload
    else:
        fields |= {"WARC-Profile": SAME_PAYLOAD, "WARC-Refers-To": f"<urn:uuid:{first_record}>"}
        if first_page is not None:
            fields["X-Refers-To-Page-ID"] = first_page
    fields |= {"Content-Type": "application/http;msgtype=response", "Content-Length": len(block)}
    header = "".join(f"{name}: {value}\r\n" for name, value in fields.items())
    return VERSION + header.encode() + b"\r\n" + block + b"\r\n\r\n"


def file_record(date: str) -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    header = (
        f"WARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {date}\r\n"
        f"Content-Type: application/warc-fields\r\nContent-Length: {len(block)}\r\n\r\n"
    )
    return VERSION + header.encode() + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from the first bytes of records; empty where they are too few or too
    small for one that would save more than it takes."""
    import zstandard

    samples = [r[:SAMPLE_PART] for r in records]
    size = min(size, sum(map(len, samples)) // 10)
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


class ArchiveFile:
    """One file being written: dictionary first, then a frame per record."""

    def __init__(self, path: str, samples: list[bytes], date: str, level: int):
        import zstandard

        self.path, self.size = path, 0
        self.out = open_archive(path)
        dictionary = build_dictionary(samples)
        if dictionary:
            self._write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.packer = zstandard.ZstdCompressor(level=level, dict_data=known, write_checksum=True)
        self.add(file_record(date))

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, record: bytes) -> tuple[int, int]:
        """Offset and length of the record's frame."""
        offset = self.size
        self._write(self.packer.compress(record))
        return offset, self.size - offset


def write_archives(
    found: DataFrame, folder: str, date: str, file_bytes: int = FILE_BYTES, level: int = LEVEL
) -> DataFrame:
    """Write the records of :func:`with_first_records` and list them, once: ``path, offset,
    length, record_id, page_id``, with which a record can be read alone.

    Each attempt of a task writes files with names of their own and only those in the
    stored list count, so a lost or repeated task leaves no double records.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_bytes, out = [], 0, None

        def listed(rows):
            """Write the rows' records; the list of where they are."""
            nonlocal out
            if out is None:
                out = ArchiveFile(f"{folder}/{uuid.uuid4().hex}.warc.zst", [r for _, _, r in rows], date, level)
            places = [(out.path, *out.add(record), record_id, page) for record_id, page, record in rows]
            if out.size >= file_bytes:
                out.out.close()
                out = None
            types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*places), types)]
            return pa.RecordBatch.from_arrays(columns, ["path", "offset", "length", "record_id", "page_id"])

        for batch in batches:
            names = ["record_id", "page_id", "url", "html", "first_page", "first_record"]
            columns = [batch.column(name) for name in names]
            for place in range(batch.num_rows):
                record_id, page, url, html, first_page, first = (c[place].as_py() for c in columns)
                record = record_bytes(record_id, page, url, html.encode(), first_page, first, date)
                held.append((record_id, page, record))
                held_bytes += len(record)
                if held_bytes >= SAMPLE_BYTES or len(held) >= SAMPLE_RECORDS:
                    yield listed(held)
                    held, held_bytes = [], 0
        if held:
            yield listed(held)
        if out is not None:
            out.out.close()

    names = ["record_id", "page_id", "url", "html", "first_page", "first_record"]
    return materialise(found.select(*names).mapInArrow(work, RECORDS), "archive-records")


def dictionary_of(handle) -> bytes:
    """The dictionary at the head of an open file; the file is left at its first record."""
    head = handle.read(8)
    if len(head) == 8:
        magic, size = struct.unpack("<II", head)
        if magic == DICTIONARY_FRAME:
            dictionary = handle.read(size)
            if len(dictionary) < size:
                raise EOFError("the archive ends within its dictionary")
            return dictionary
    handle.seek(0)
    return b""


def unpacker(dictionary: bytes):
    import zstandard

    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdDecompressor(dict_data=known)


class Frames:
    """The content of an open file's frames, one after the other. Unlike a plain stream
    reader it takes notice of a file that ends within a frame."""

    def __init__(self, handle, dictionary: bytes):
        self.handle, self.unpacker, self.frame, self.rest = handle, unpacker(dictionary), None, b""

    def read(self) -> bytes:
        """More content; nothing at the end of the file."""
        while True:
            data = self.rest or self.handle.read(READ_BYTES)
            if not data:
                if self.frame is not None:
                    raise EOFError("the archive ends within a frame")
                return b""
            self.frame = self.frame or self.unpacker.decompressobj()
            found, self.rest = self.frame.decompress(data), b""
            if self.frame.eof:
                self.rest, self.frame = self.frame.unused_data, None
            if found:
                return found


class Records:
    """The records of a stream of bytes, one after the other: header fields and block."""

    def __init__(self, stream):
        self.stream, self.data, self.at = stream, bytearray(), 0

    def _fill(self) -> bool:
        more = self.stream.read()
        self.data += more
        return bool(more)

    def _take(self, size: int) -> bytes:
        while len(self.data) - self.at < size:
            if not self._fill():
                raise EOFError("the archive ends within a record")
        taken = bytes(self.data[self.at : self.at + size])
        self.at += size
        if self.at > DROP_BYTES:
            del self.data[: self.at]
            self.at = 0
        return taken

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        while True:
            while (end := self.data.find(b"\r\n\r\n", self.at)) < 0:
                if not self._fill():
                    if self.at < len(self.data):
                        raise EOFError("the archive ends within a header")
                    return
            header = self._take(end + 4 - self.at)
            if not header.startswith(VERSION):
                raise ValueError("not a WARC record")
            lines = header[len(VERSION) : -4].decode().split("\r\n")
            fields = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
            block = self._take(int(fields["content-length"]))
            if self._take(4) != b"\r\n\r\n":
                raise ValueError("a record does not end where its length says")
            yield fields, block


def read_record(path: str, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """One record by its place, without reading the records before it."""
    with open_path(path) as handle:
        dictionary = dictionary_of(handle)
        handle.seek(offset)
        frame = io.BytesIO(handle.read(length))
    return next(iter(Records(Frames(frame, dictionary))))


def page_row(fields: dict[str, str], block: bytes, path: str) -> tuple:
    """What a record says of its page. ``intact`` says whether a response's payload has the
    length and digest that its headers state."""
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [line.split(b":")[1] for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
    size, digest = int(sizes[0]), fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    intact = kind != "response" or (len(payload) == size and payload_digest(payload) == digest)
    page, first = (None if x is None else int(x) for x in map(fields.get, ("x-page-id", "x-refers-to-page-id")))
    return page, size, digest, kind, first, fields["warc-target-uri"], path, intact


def read_archives(files: DataFrame) -> DataFrame:
    """A row per response or revisit in the archives named by ``path``.

    A task reads a file from its head, some records at a time. The names are stored and
    counted first, as so few small rows would otherwise be read by one task.
    """
    names, kinds = zip(*[field.split(" ") for field in PAGES.split(", ")])
    types = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, k in zip(zip(*rows), kinds)], list(names))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                with open_path(path) as handle:
                    for fields, block in Records(Frames(handle, dictionary_of(handle))):
                        if fields["warc-type"] in ("response", "revisit"):
                            rows.append(page_row(fields, block, path))
                        if len(rows) == SAMPLE_RECORDS:
                            yield batch_of(rows)
                            rows = []
                if rows:
                    yield batch_of(rows)

    return spread_members(files.select("path"), "archive-files").mapInArrow(work, PAGES)


def archive_pages(
    pages: DataFrame,
    folder: str | None = None,
    least_bytes: int = 0,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    date: str | None = None,
    file_bytes: int = FILE_BYTES,
    level: int = LEVEL,
) -> DataFrame:
    """Write a record per row of ``pages`` below ``folder`` and read the archives back:
    ``page_id, payload_bytes, payload_digest, record_type, refers_to, url, path, intact``.

    A null payload is empty; empty ones are equal to each other. A row without page_id
    keeps its record, without the page's header field, and counts as the smallest. Equal
    rows give a record each, one of them a response. A missing url is ``about:blank``;
    signs that would break a header line are percent-encoded. A page of any length is one
    record, held whole by the task that writes or reads it. Records of a file too small
    for a dictionary are compressed without one. Other columns are not read; an empty
    table gives an empty table.
    """
    spark: SparkSession = pages.sparkSession
    rows = pages.select(
        F.col(f"`{page_id}`").cast("bigint").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("html"),
    )
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    found = with_first_records(rows, least_bytes)
    written = write_archives(found, folder or scratch_path(spark, "archives"), date, file_bytes, level)
    return read_archives(written.select("path").distinct())
