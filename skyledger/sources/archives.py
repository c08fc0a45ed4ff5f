"""Zip archives of delimited files.

Spark finds the archives and spreads their members over tasks. A task unpacks the
bytes of its member into part files of bounded size, cut where a record ends and each
under the member's header line; it does not look at values. Spark's delimited reader
then parses the parts, so one large member is parsed by many tasks and there is one
parser, whose rules for bad bytes, short rows and quotes hold everywhere.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.schema import ARCHIVE_FIELDS, text_schema
from skyledger.session import materialise, scratch_path, send_code_with_tasks
from skyledger.sources.headers import MissingColumnsError, header_names, positions, scan_by_position
from skyledger.sources.paths import file_system, open_path, spread_members
from skyledger.sources.tables import source_guard

send_code_with_tasks(__name__)

__all__ = [
    "Unpacked", "find_archives", "list_members", "open_path", "read_unpacked", "spread_members", "unpack_members",
]

#: Bytes of a part file, after which it is closed at the next end of a record.
PART_BYTES = 64 << 20
CHUNK_BYTES = 1 << 20
#: A member whose first record is longer than this has no header.
HEADER_BYTES = 1 << 20

MEMBERS = (
    "archive string, member string, member_id string, offset bigint, packed_bytes bigint, bytes bigint, crc bigint, "
    "method int, encrypted boolean, error string"
)
CATALOGUE = "archive string, member string, member_id string, header string, header_key string, parts bigint, bytes bigint, error string"


def find_archives(spark: SparkSession, root: str, suffix: str = ".zip") -> DataFrame:
    """Paths and sizes of the archives below ``root``, at any depth.

    The suffix is case-sensitive. Only the listing is read: the content column
    of the file source is pruned.
    """
    with source_guard(root):
        files = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", f"*{suffix}")
            .option("recursiveFileLookup", "true")
            .load(root)
        )
    return files.select(F.col("path").alias("archive"), F.col("length").alias("bytes"))


def _message(error: Exception) -> str:
    return f"{type(error).__name__}: {error}"


def member_key(archive: str, position: int) -> str:
    """A name for a member that is the same in every attempt to read it."""
    return hashlib.sha256(f"{position}:{archive}".encode()).hexdigest()[:32]


def list_members(
    archives: DataFrame, member_suffix: str = ".csv", opener: Callable = open_path
) -> DataFrame:
    """One row per member to read, with its place in the archive, from the archive's directory.

    An archive that can not be opened, or has no such member, gives one row with
    ``error`` set and no member. The directory is read here only: a task that unpacks a
    member goes straight to its place.
    """
    names = [field.split(" ")[0] for field in MEMBERS.split(", ")]

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive in batch["archive"]:
                try:
                    with opener(archive) as handle, zipfile.ZipFile(handle) as packed:
                        found = [
                            (
                                archive, info.filename, member_key(archive, position), info.header_offset,
                                info.compress_size, info.file_size, info.CRC, info.compress_type,
                                bool(info.flag_bits & 1), None,
                            )
                            for position, info in enumerate(packed.infolist())
                            if info.filename.endswith(member_suffix)
                        ]
                    if not found:
                        raise ValueError(f"no {member_suffix} member")
                except Exception as error:
                    found = [(archive, *[None] * (len(names) - 2), _message(error))]
                yield pd.DataFrame(found, columns=names, dtype=object)

    return archives.select("archive").mapInPandas(members, MEMBERS)


def member_bytes(handle, entry: dict) -> Iterator[bytes]:
    """The unpacked bytes of a member, in chunks; its size and checksum are verified."""
    if entry["encrypted"]:
        raise zipfile.BadZipFile("the member is encrypted")
    if entry["method"] not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        raise NotImplementedError(f"packing method {entry['method']}")
    handle.seek(entry["offset"])
    local = handle.read(30)
    if len(local) < 30 or local[:4] != b"PK\x03\x04":
        raise zipfile.BadZipFile("no member where the directory says")
    handle.seek(entry["offset"] + 30 + sum(struct.unpack("<HH", local[26:30])))
    unpack = zlib.decompressobj(-15) if entry["method"] == zipfile.ZIP_DEFLATED else None
    left, size, crc = entry["packed_bytes"], 0, 0
    while left:
        data = handle.read(min(CHUNK_BYTES, left))
        if not data:
            raise EOFError("the archive ends within a member")
        left -= len(data)
        while data:
            found = unpack.decompress(data, CHUNK_BYTES) if unpack else data
            data = unpack.unconsumed_tail if unpack else b""
            size, crc = size + len(found), zlib.crc32(found, crc)
            if found:
                yield found
    if unpack:
        found = unpack.flush()
        size, crc = size + len(found), zlib.crc32(found, crc)
        if found:
            yield found
    if size != entry["bytes"] or crc != entry["crc"] or (unpack and not unpack.eof):
        raise zipfile.BadZipFile(f"bad size or CRC-32 of {entry['member']}")


class RecordEnds:
    """Finds where records of a delimited file end, chunk by chunk: line breaks outside quotes.

    A quote opens a value only at the value's start, and within quotes a doubled quote is
    a sign. Chunks whose quotes are all in pairs at the borders of values, as writers leave
    them, are settled by counting; others sign by sign.
    """

    def __init__(self, delimiter: bytes = b","):
        self.borders = np.zeros(256, dtype=bool)
        self.borders[list(delimiter + b"\n\r")] = True
        #: Within quotes; the last sign; whether that sign is a quote that closed a value.
        self.quoted, self.last, self.closed = False, 10, False

    def of(self, chunk: bytes) -> np.ndarray:
        """Places just behind the line feeds that end records."""
        data = np.frombuffer(chunk, dtype=np.uint8)
        breaks = np.flatnonzero(data == 10)
        quotes = np.flatnonzero(data == 34)
        if len(quotes):
            inside = self._inside(data, quotes, breaks)
        else:
            inside, self.closed = np.full(len(breaks), self.quoted), False
        if len(data):
            self.last = int(data[-1])
        return breaks[~inside] + 1

    def _inside(self, data: np.ndarray, quotes: np.ndarray, breaks: np.ndarray) -> np.ndarray:
        before = np.where(quotes > 0, data[quotes - 1], self.last)
        after = np.append(data, 10)[quotes + 1]
        opening = np.arange(len(quotes)) % 2 == (1 if self.quoted else 0)
        ordered = np.where(opening, self.borders[before] | (before == 34), self.borders[after] | (after == 34))
        across = quotes[-1] == len(data) - 1 or (quotes[0] == 0 and self.last == 34)
        if ordered.all() and not across:
            inside = (np.searchsorted(quotes, breaks) % 2 == 1) != self.quoted
            self.quoted ^= bool(len(quotes) % 2)
            self.closed = False
            return inside
        return self._inside_by_sign(data, quotes, breaks)

    def _inside_by_sign(self, data: np.ndarray, quotes: np.ndarray, breaks: np.ndarray) -> np.ndarray:
        states, quoted, closed = [self.quoted], self.quoted, self.closed
        for place in quotes.tolist():
            previous = int(data[place - 1]) if place else self.last
            # A quote right behind the one that closed a value makes a sign of both.
            opens = not quoted and (self.borders[previous] or (previous == 34 and closed))
            closed, quoted = quoted, opens
            states.append(quoted)
        self.quoted, self.closed = quoted, closed and quotes[-1] == len(data) - 1
        return np.array(states)[np.searchsorted(quotes, breaks)]


class PartFiles:
    """The part files of one member. Names follow from the member, and a file appears under
    its name only when it is complete, so a repeated task leaves the same files again."""

    def __init__(self, folder: str, name: str, header: bytes, part_bytes: int):
        self.folder, self.name, self.header, self.part_bytes = folder, name, header, part_bytes
        self.count, self.out, self.size = 0, None, 0

    def write(self, data: bytes) -> None:
        if self.out is None:
            self.system, place = file_system(self.folder)
            self.path, self.hidden = f"{place}/{self.name}-{self.count:06d}.csv", f"{place}/.{uuid.uuid4().hex}"
            self.system.create_dir(place, recursive=True)
            self.out = self.system.open_output_stream(self.hidden, compression=None)
            self.out.write(self.header)
            self.size = 0
        self.out.write(data)
        self.size += len(data)

    def add(self, chunk: bytes, ends: np.ndarray) -> None:
        """Write a chunk, closing the file at the first record end beyond its size."""
        at = 0
        while at < len(chunk):
            later = ends[np.searchsorted(ends, at + max(self.part_bytes - (self.size if self.out else 0), 1)) :]
            if not len(later):
                break
            self.write(chunk[at : later[0]])
            at = int(later[0])
            self.close()
        if at < len(chunk):
            self.write(chunk[at:])

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.system.move(self.hidden, self.path)
            self.out, self.count = None, self.count + 1


def _unpack(entry: dict, folder: str, fields, part_bytes: int, opener: Callable) -> dict:
    """Write one member's parts; what the catalogue says of it."""
    ends, start, header, parts, size, returns = RecordEnds(), b"", None, None, 0, False
    with opener(entry["archive"]) as handle:
        for chunk in member_bytes(handle, entry):
            if not size:
                returns = b"\r" in chunk and b"\n" not in chunk
            size += len(chunk)
            if returns:  # lines that end in carriage returns alone
                chunk = chunk.replace(b"\r", b"\n")
            found = ends.of(chunk)
            if header is None:
                shift = len(start)
                start += chunk
                if not len(found):
                    if len(start) > HEADER_BYTES:
                        raise MissingColumnsError("the first record is too long for a header")
                    continue
                chunk, found = start, found + shift
                header, chunk, found = chunk[: found[0]], chunk[found[0] :], found[1:] - found[0]
                key, parts = _open_parts(entry, folder, header, fields, part_bytes)
            parts.add(chunk, found)
    if header is None:
        header = start
        key, parts = _open_parts(entry, folder, header, fields, part_bytes)
    if not parts.count and parts.out is None:
        parts.write(b"")
    parts.close()
    text = header.decode("utf-8", "replace").strip("\r\n")
    return {"header": text, "header_key": key, "parts": parts.count, "bytes": size}


def _open_parts(entry: dict, folder: str, header: bytes, fields, part_bytes: int) -> tuple[str, PartFiles]:
    line = header.rstrip(b"\r\n")
    positions(header_names(line.decode("utf-8", "replace")), fields)
    key = hashlib.sha256(line).hexdigest()[:16]
    return key, PartFiles(f"{folder}/h={key}", entry["member_id"], header if header != line else line + b"\n", part_bytes)


@dataclass
class Unpacked:
    """Members as part files below ``folder``, one subfolder per distinct header, and the
    stored catalogue of them."""

    folder: str
    members: DataFrame
    fields: tuple


def unpack_members(
    members: DataFrame,
    fields=ARCHIVE_FIELDS,
    part_bytes: int = PART_BYTES,
    opener: Callable = open_path,
    folder: str | None = None,
) -> Unpacked:
    """Unpack each member of :func:`list_members` into part files and catalogue them.

    The catalogue has ``archive, member, member_id, header, header_key, parts, bytes, error``.
    A member that is damaged, empty, or lacks one of ``fields`` has an error; it may leave
    parts, which :func:`skyledger.operators.outcomes.rows_of_good_archives` passes over.
    """
    fields = tuple(fields)
    folder = folder or scratch_path(members.sparkSession, "unpacked")
    names = [field.split(" ")[0] for field in CATALOGUE.split(", ")]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for entry in batch.astype(object).where(batch.notna(), None).to_dict("records"):
                row = dict.fromkeys(names) | {n: entry[n] for n in ("archive", "member", "member_id", "error")}
                if row["error"] is None:
                    try:
                        sizes = ("offset", "packed_bytes", "bytes", "crc", "method")
                        whole = entry | {n: int(entry[n]) for n in sizes}
                        row |= _unpack(whole, folder, fields, part_bytes, opener)
                    except Exception as error:
                        row["error"] = _message(error)
                yield pd.DataFrame([row], columns=names, dtype=object)

    return Unpacked(folder, materialise(members.mapInPandas(work, CATALOGUE), "member-catalogue"), fields)


def read_unpacked(unpacked: Unpacked) -> DataFrame:
    """Text rows of all parts: ``member_id`` and the fields, found by each member's header.

    One scan per distinct header, whose columns Spark reads by position; all are united by
    name. Parts are whole files to a task, as a value may hold line breaks.
    """
    spark = unpacked.members.sparkSession
    headers = unpacked.members.filter("error IS NULL").groupBy("header_key").agg(F.min("header").alias("header")).collect()
    united = None
    for row in sorted(headers):
        rows = scan_by_position(
            spark, f"{unpacked.folder}/h={row.header_key}", header_names(row.header), unpacked.fields, multi_line=True,
            extra=[F.substring("_metadata.file_name", 1, 32).alias("member_id")],
        )
        united = rows if united is None else united.unionByName(rows)
    if united is None:
        united = spark.createDataFrame([], text_schema(["member_id", *unpacked.fields]))
    return united.select("member_id", *[F.col(f"`{c}`") for c in unpacked.fields])
