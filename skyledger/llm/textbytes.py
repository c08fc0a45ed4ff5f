"""Vectorised words of many texts at once, on their UTF-8 bytes.

Texts are handled in chunks of bounded size. A chunk is one byte array with a line
break after every text, so words never run from one text into the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from skyledger.session import send_code_with_tasks

send_code_with_tasks(__name__)

#: Bytes of text worked on together; intermediate arrays take some ten to forty times as much.
CHUNK_BYTES = 1 << 20
HASH_BYTES = 1 << 17
#: Places of a word whose terms are looked up instead of computed.
TERM_PLACES = 64

#: White space between words, and odd multipliers of the polynomial hashes.
WHITE_SPACE = b" \t\n\x0b\x0c\r"
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93


def byte_table(members: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


IS_SPACE = byte_table(WHITE_SPACE)


def chunks_of(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts add up to ``limit`` bytes, or that hold one text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def utf8_texts(column: pa.Array) -> list[bytes]:
    """The texts as bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


class Words:
    """The words of several texts: places in ``data`` and the number of their text."""

    def __init__(self, texts: list[bytes], is_space: np.ndarray = IS_SPACE):
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        self.text_starts = np.concatenate(([0], np.cumsum(lengths)[:-1])) if texts else lengths
        space = is_space[self.data]
        edges = np.flatnonzero(space[1:] != space[:-1]) + 1
        if len(space) and not space[0]:
            edges = np.concatenate(([0], edges))
        self.starts, self.ends = edges[::2], edges[1::2]
        #: Words of text i are those from first[i] up to first[i + 1].
        self.first = np.append(np.searchsorted(self.starts, self.text_starts), len(self.starts))
        self.counts = np.diff(self.first)

    def sum_hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, of the sum of a mixed term per place and byte.

        Polynomials modulo 2**64 meet for certain pairs of long words whatever the base is;
        terms that follow no rule leave chance meetings only.
        """
        terms, found, at = place_terms(), np.empty(len(self.starts), dtype=np.uint64), 0
        while at < len(found):
            low = self.starts[at]
            stop = max(at + 1, int(np.searchsorted(self.ends, low + HASH_BYTES, side="right")))
            data = self.data[low : self.ends[stop - 1]]
            starts, ends = self.starts[at:stop] - low, self.ends[at:stop] - low
            # Blanks between words get places of the word before; no sum contains them.
            place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
            code = place * 256 + data
            if len(place) and place.max() >= TERM_PLACES:
                term = mixed(code.astype(np.uint64) * np.uint64(BYTE_BASE) + np.uint64(WORD_BASE))
            else:
                term = terms[code]
            total = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum(term, out=total[1:])
            found[at:stop] = mixed(total[ends] - total[starts] + (ends - starts).astype(np.uint64))
            at = stop
        return found

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes, block by block of words."""
        found = np.empty(len(self.starts), dtype=np.uint64)
        at = 0
        while at < len(found):
            low = self.starts[at]
            stop = max(at + 1, int(np.searchsorted(self.ends, low + HASH_BYTES, side="right")))
            data = self.data[low : self.ends[stop - 1]]
            place, back = powers(BYTE_BASE, len(data))
            total = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * back, out=total[1:])
            starts, ends = self.starts[at:stop] - low, self.ends[at:stop] - low
            found[at:stop] = mixed((total[ends] - total[starts]) * place[starts])
            at = stop
        return found


#: What a worker keeps between chunks. A plain dictionary, as a function that caches by
#: itself would be sent by its module's name, which executors need not know.
KEPT: dict = {}


def place_terms() -> np.ndarray:
    """A random-looking 64-bit number for each of the first places of a word and each byte."""
    if "terms" not in KEPT:
        KEPT["terms"] = mixed(np.arange(TERM_PLACES * 256, dtype=np.uint64) * np.uint64(BYTE_BASE) + np.uint64(WORD_BASE))
    return KEPT["terms"]


def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    if (base, size) in KEPT:
        return KEPT[base, size]
    ups = np.full(size, base, dtype=np.uint64)
    downs = np.full(size, pow(base, -1, 1 << 64), dtype=np.uint64)
    ups[0] = downs[0] = 1
    if len(KEPT) >= 8:
        KEPT.clear()
    KEPT[base, size] = np.cumprod(ups), np.cumprod(downs)
    return KEPT[base, size]


def powers(base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64."""
    size = 1 << max(16, count.bit_length())
    up, down = _powers(base, size)
    return up[:count], down[:count]


def spark_hash(*columns: np.ndarray) -> np.ndarray:
    """What Spark's ``xxhash64`` gives for 64-bit columns, as signed numbers."""
    one, two, three = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
    four, five = np.uint64(0x85EBCA77C2B2AE63), np.uint64(0x27D4EB2F165667C5)

    def turned(x, by):
        return (x << np.uint64(by)) | (x >> np.uint64(64 - by))

    hashed = np.full(len(columns[0]), 42, dtype=np.uint64)
    for column in columns:
        hashed = (hashed + five + np.uint64(8)) ^ (turned(column.astype(np.uint64) * two, 31) * one)
        hashed = turned(hashed, 27) * one + four
        hashed = (hashed ^ (hashed >> np.uint64(33))) * two
        hashed = (hashed ^ (hashed >> np.uint64(29))) * three
        hashed = hashed ^ (hashed >> np.uint64(32))
    return hashed.view(np.int64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the usual shift and multiply finisher)."""
    x = values.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def rolling_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """The polynomial hash of every ``width`` neighbours, by one running sum."""
    if len(words) < width:
        return np.zeros(0, dtype=np.uint64)
    place, back = powers(WORD_BASE, len(words))
    total = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * back, out=total[1:])
    return mixed((total[width:] - total[:-width]) * place[: len(words) - width + 1])


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one after the other."""
    if not len(lengths):
        return np.zeros(0, dtype=np.int64)
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return np.arange(len(shift)) + shift
