"""Short codes for vectors: product quantisation in whole numbers, exact on every machine.

Components become integers. Inner products run as float64 matrix products of limbs short
enough that no sum passes 2**53, and are put together in int64; the nearest entry is the
first smallest distance. No rounding takes part, so the result does not hang on the order
of rows, the number of tasks or the linear algebra library.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.session import materialise, send_code_with_tasks

send_code_with_tasks(__name__)

#: The rule that turns a component into an integer, and the codes' size.
SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Integers beyond this count as this; only components beyond 2**50 are concerned.
LARGEST = 1 << 62
LONG = (1 << 63) - 1
EXACT_BITS = 53
SUMS = "part int, entry int, place int, used bigint, total decimal(38,0)"


@dataclass(frozen=True)
class Codebooks:
    """Integer entries: ``books[part, entry, place]``; no entries where nothing was learnt from."""

    books: np.ndarray
    scale: int = SCALE

    @property
    def width(self) -> int:
        """Components of a vector, with those added to make equal parts."""
        return self.books.shape[0] * self.books.shape[2]

    def digest(self) -> str:
        """SHA-256 of all entries' decimal components, joined by commas."""
        return hashlib.sha256(",".join(str(int(v)) for v in self.books.ravel()).encode()).hexdigest()

    def decode(self, code: str) -> list[float]:
        """The middle of the cell a code stands for."""
        entries = bytes.fromhex(code)
        return [(int(v) + 0.5) / self.scale for part, entry in enumerate(entries) for v in self.books[part, entry]]


def kept_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, label, vec`` of the rows whose vector has finite components only."""
    wanted = df.select(
        F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("vec")
    )
    if dict(wanted.dtypes)["vec"] != "array<float>":
        wanted = wanted.withColumn("vec", F.col("vec").cast("array<double>"))
    infinite = F.lit(float("inf"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    return wanted.filter(F.col("vec").isNotNull() & finite)


def integers(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """The vectors of a batch as whole numbers, a row each, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.asarray(column.flatten(), dtype=np.float64)
    reals = np.zeros((len(lengths), width))
    rows = np.repeat(np.arange(len(lengths)), lengths)
    reals[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    bound = LARGEST / scale
    return np.floor(np.clip(reals, -bound, bound) * scale).astype(np.int64)


def limbs(numbers: np.ndarray, bits: int, largest: int) -> list[np.ndarray]:
    """Digits of ``bits`` bits, lowest first, as floats; the last one carries the sign."""
    digits, mask = [], (1 << bits) - 1
    for _ in range(max(1, -(-largest.bit_length() // bits)) - 1):
        digits.append((numbers & mask).astype(np.float64))
        numbers = numbers >> bits
    return [*digits, numbers.astype(np.float64)]


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``left @ right.T`` of int64 matrices, exact as long as the results fit in int64."""
    inner = left.shape[1]
    bits = (EXACT_BITS - max(inner - 1, 0).bit_length()) // 2
    sides = [limbs(m, bits, int(max(m.max(initial=0), -m.min(initial=0)))) for m in (left, right)]
    total = np.zeros((len(left), len(right)), dtype=np.int64)
    for i, a in enumerate(sides[0]):
        for j, b in enumerate(sides[1]):
            if bits * (i + j) < 64:
                total += (a @ b.T).astype(np.int64) << (bits * (i + j))
    return total


def nearest(numbers: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry per row and part, and the summed squared distance per row.

    Rows whose distances might not fit in int64 are worked on with numbers of any length,
    as are all rows where that holds for an entry; their sums stop at the largest long.
    """
    parts, _, size = books.shape
    codes = np.zeros((len(numbers), parts), dtype=np.int64)
    errors = np.zeros(len(numbers), dtype=np.int64)
    if not size or not len(numbers):
        return codes, errors
    safe = 1 << ((62 - (parts * size).bit_length()) // 2 - 1)
    near = ((numbers < safe) & (numbers > -safe)).all(axis=1)
    if not ((books < safe) & (books > -safe)).all():
        near[:] = False
    rows = numbers[near]
    for part in range(parts):
        own, book = rows[:, part * size : (part + 1) * size], books[part]
        away = (own * own).sum(axis=1)[:, None] - 2 * exact_products(own, book) + (book * book).sum(axis=1)
        best = away.argmin(axis=1)
        codes[near, part] = best
        errors[near] += away[np.arange(len(best)), best]
    entries = books.tolist()
    for row in np.flatnonzero(~near):
        values, error = numbers[row].tolist(), 0
        for part in range(parts):
            own = values[part * size : (part + 1) * size]
            away = [sum((x - c) ** 2 for x, c in zip(own, entry)) for entry in entries[part]]
            codes[row, part] = away.index(min(away))
            error += min(away)
        errors[row] = min(error, LONG)
    return codes, errors


def entry_sums(vectors: DataFrame, codebooks: Codebooks) -> DataFrame:
    """Per part, entry and place: the number of parts assigned and the sum of their numbers.

    A task adds up all of its rows, so it sends as many rows as the codebooks have numbers.
    """
    books, width, scale = codebooks.books, codebooks.width, codebooks.scale
    parts, entries, size = books.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = np.zeros((parts, entries), dtype=np.int64)
        totals = np.zeros(books.shape, dtype=object)
        for batch in batches:
            numbers = integers(batch.column("vec"), width, scale)
            codes, _ = nearest(numbers, books)
            # Halves of 31 bits, so that the sums over a batch stay in int64.
            high, low = numbers >> 31, numbers & ((1 << 31) - 1)
            for part in range(parts):
                order = np.argsort(codes[:, part], kind="stable")
                found, starts = np.unique(codes[order, part], return_index=True)
                own = slice(part * size, (part + 1) * size)
                if len(found):
                    used[part, found] += np.diff(np.append(starts, len(order)))
                    for half, shift in ((high, 31), (low, 0)):
                        sums = np.add.reduceat(half[order, own], starts, axis=0)
                        totals[part, found] += sums.astype(object) << shift
        at = np.argwhere(np.repeat(used[:, :, None] > 0, size, axis=2))
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [
                    *[pa.array(at[:, i], pa.int32()) for i in range(3)],
                    pa.array(used[at[:, 0], at[:, 1]], pa.int64()),
                    pa.array([Decimal(int(totals[tuple(i)])) for i in at], pa.decimal128(38, 0)),
                ],
                ["part", "entry", "place", "used", "total"],
            )

    sums = vectors.select("vec").mapInArrow(work, SUMS)
    return sums.groupBy("part", "entry", "place").agg(F.sum("used").alias("used"), F.sum("total").alias("total"))


def train_codebooks(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> Codebooks:
    """Codebooks of kept vectors (:func:`kept_vectors`), each part's starting from the rows
    of the smallest ids and moved ``rounds`` times to the floor of its parts' mean.

    Ids that tie are ordered by the vector, rows without id come last; fewer rows than
    entries give fewer entries. Vectors are filled up with zeros to the longest one and to
    a multiple of ``parts``. The driver sees the starting rows and, per round, one sum for
    each number of the codebooks, however many vectors there are.
    """
    if not (parts > 0 and 0 < entries <= 256):
        raise ValueError("codes need at least one part and at most 256 entries")
    longest = vectors.agg(F.max(F.size("vec"))).first()[0] or 0
    size = -(-longest // parts)
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(entries).select("vec").collect()
    if not first:
        return Codebooks(np.zeros((parts, 0, size), dtype=np.int64), scale)
    column = pa.array([r.vec for r in first], pa.list_(pa.float64()))
    numbers = integers(column, parts * size, scale)
    books = np.ascontiguousarray(numbers.reshape(len(first), parts, size).transpose(1, 0, 2))
    for _ in range(rounds if size else 0):
        moved = books.copy()
        for r in entry_sums(vectors, Codebooks(books, scale)).collect():
            moved[r.part, r.entry, r.place] = int(r.total) // r.used
        books = moved
    return Codebooks(books, scale)


def assign_codes(vectors: DataFrame, codebooks: Codebooks) -> DataFrame:
    """``vec_id, label, code, error`` of kept vectors; ``code`` has two hex digits a part."""
    books, width, scale = codebooks.books, codebooks.width, codebooks.scale
    if books.shape[1] > 256:
        raise ValueError("a code has one byte a part")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = nearest(integers(batch.column("vec"), width, scale), books)
            names = pa.array([row.tobytes().hex() for row in codes.astype(np.uint8)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), names, pa.array(errors, pa.int64())],
                ["vec_id", "label", "code", "error"],
            )

    label = vectors.schema["label"].dataType.simpleString()
    return vectors.mapInArrow(work, f"vec_id bigint, label {label}, code string, error bigint")


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Add ``label_error``, the error summed over rows of equal label, nulls together.

    Sums are made in each task first, and stored, so that their size is known when the
    join is planned. Adaptive execution splits a label that holds much of the rows.
    """
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(Decimal(LONG)).cast("decimal(38,0)"))
    sums = coded.groupBy(F.col("label").alias("of_label")).agg(total.cast("bigint").alias("label_error"))
    sums = materialise(sums, "label-errors")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of_label")), "left").drop("of_label")


def compress_vectors(
    df: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> DataFrame:
    """``vec_id, label, code, error, label_error, codebooks_sha256`` for each usable vector.

    A null vector and one with a null, NaN or infinite component are dropped; an empty
    vector is all zeros. Vectors of several lengths are filled up with zeros to the
    longest. Equal rows and equal ids each keep a row; a missing id or label stays null.
    Very long vectors cost memory by their own length only. Components beyond 2**50 count
    as that, errors stop at the largest long. Other columns are not read. An empty table
    gives an empty table.
    """
    vectors = materialise(kept_vectors(df, vec_id, vector, label), "vectors")
    codebooks = train_codebooks(vectors, parts, entries, rounds, scale)
    coded = materialise(assign_codes(vectors, codebooks), "vector-codes")
    return with_label_errors(coded).withColumn("codebooks_sha256", F.lit(codebooks.digest()))
