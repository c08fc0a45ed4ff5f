"""Packing by vector bin packing: tokens, segments and loss-bearing tokens at once."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.textbytes import chunks_of
from skyledger.llm.tokens import encode, tokenizer_path
from skyledger.session import materialise, send_code_with_tasks

send_code_with_tasks(__name__)


@dataclass(frozen=True)
class Limits:
    """What a sequence may hold at most."""

    tokens: int = 2048
    segments: int = 64
    loss_tokens: int = 2048

    def __post_init__(self):
        if min(self.tokens, self.segments, self.loss_tokens) < 1:
            raise ValueError("a sequence must hold at least one token, segment and loss-bearing token")


LIMITS = Limits()
END_ID = 1
#: Pieces packed together by one task. Padding falls and work per piece grows with it.
GROUP_PIECES = 4096

PIECES = (
    "doc_id bigint, row_key bigint, start bigint, length bigint, loss bigint, "
    "ids_crc32 bigint, doc_tokens bigint"
)


def cut_pieces(
    docs: DataFrame,
    tokenizer: str = "byte_bpe_50k",
    limits: Limits = LIMITS,
    end_id: int = END_ID,
    loss_start: str | None = None,
    keep_ids: bool = False,
) -> DataFrame:
    """Pieces of each row's ids, closed by ``end_id``, each as long as the limits allow.

    ``loss_start`` names a column with the number of a row's first loss-bearing id (an
    answer's start in instruction data); without it every id but a text's first bears
    loss, as the first has nothing to be predicted from. ``keep_ids`` adds the ids.
    """
    json_path, rank_path = tokenizer_path(f"{tokenizer}.json"), tokenizer_path(f"{tokenizer}.tiktoken")
    schema = PIECES + (", ids array<int>" if keep_ids else "")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks_of(batch, "text"):
                rows = {n: [] for n in ("doc_id", "row_key", "start", "length", "loss", "ids_crc32", "doc_tokens")}
                kept = []
                for doc_id, key, text, first in zip(*[chunk.column(n).to_pylist() for n in ("doc_id", "row_key", "text", "first")]):
                    ids = np.append(encode(text, json_path, rank_path), end_id).astype("<u4")
                    start = 0
                    while start < len(ids):
                        unscored = max(start, first)
                        piece = ids[start : min(start + limits.tokens, unscored + limits.loss_tokens)]
                        loss = max(0, start + len(piece) - unscored)
                        values = (
                            doc_id, key, start, len(piece), loss, zlib.crc32(piece.tobytes()), len(ids),
                        )
                        start += len(piece)
                        for name, value in zip(rows, values):
                            rows[name].append(value)
                        if keep_ids:
                            kept.append(piece.astype(np.int32))
                columns = [pa.array(v, pa.int64()) for v in rows.values()]
                if keep_ids:
                    columns.append(pa.array(kept, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, [*rows, *(["ids"] if keep_ids else [])])

    first = F.coalesce(F.col(loss_start).cast("bigint"), F.lit(1)) if loss_start else F.lit(1).cast("bigint")
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(text).alias("row_key"),
        F.coalesce(text, F.lit("")).alias("text"),
        first.alias("first"),
    ).mapInArrow(work, schema)


def place(sizes: np.ndarray, capacity: np.ndarray) -> list[list[int]]:
    """Items to bins by the dot-product heuristic, one bin after the other.

    ``sizes`` has a row per item and a column per limit. Into the open bin goes, of all
    items that fit, the one whose sizes, as shares of the limits and weighted by how much
    the items left need of each limit, have the largest scalar product with what is
    free in the bin; ties go to the earlier item. Equal items are handled as one kind.
    """
    if not len(sizes):
        return []
    kinds, kind_of = np.unique(sizes, axis=0, return_inverse=True)
    kind_of = kind_of.reshape(-1)
    order = np.argsort(kind_of, kind="stable")
    starts = np.searchsorted(kind_of[order], np.arange(len(kinds)))
    stops = np.append(starts[1:], len(order)).copy()
    left = stops - starts
    shares = kinds / capacity
    bins = []
    alive = np.arange(len(kinds))
    while len(alive):
        weight = (shares[alive] * left[alive, None]).sum(axis=0)
        free, chosen = capacity.astype(np.int64).copy(), []
        weighted = shares[alive] * (weight / max(weight.max(), 1e-12))
        own_kinds, own_left = kinds[alive], left[alive]
        while True:
            fits = (own_kinds <= free).all(axis=1) & (own_left > 0)
            if not fits.any():
                break
            score = np.where(fits, weighted @ (free / capacity), -1.0)
            best = int(np.argmax(score))
            kind = alive[best]
            chosen.append(int(order[starts[kind]]))
            starts[kind] += 1
            left[kind] -= 1
            own_left[best] -= 1
            free -= own_kinds[best]
        if not chosen:
            raise ValueError("an item is larger than a sequence")
        bins.append(chosen)
        if not own_left.all():
            alive = alive[own_left > 0]
    return bins


PLACED = (
    "doc_id bigint, row_key bigint, start bigint, length bigint, loss bigint, ids_crc32 bigint, "
    "doc_tokens bigint, grp bigint, bin bigint, offset bigint, segment bigint, width bigint"
)


def _place_group(limits: Limits):
    capacity = np.array([limits.tokens, limits.segments, limits.loss_tokens], dtype=np.int64)

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by([(n, "ascending") for n in ("doc_id", "row_key", "start", "ids_crc32")])
        length, loss = table.column("length").to_numpy(), table.column("loss").to_numpy()
        sizes = np.column_stack([length, np.ones_like(length), loss])
        out = {n: np.zeros(len(length), dtype=np.int64) for n in ("bin", "offset", "segment", "width")}
        for number, members in enumerate(place(sizes, capacity)):
            ends = np.cumsum(length[members])
            out["bin"][members] = number
            out["offset"][members] = ends - length[members]
            out["segment"][members] = np.arange(len(members))
            out["width"][members] = ends[-1]
        for name, values in out.items():
            table = table.append_column(name, pa.array(values))
        return table

    return work


def pack(pieces: DataFrame, limits: Limits = LIMITS, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add ``sequence_id, offset, segment, width`` to pieces (columns of ``PIECES``).

    Pieces are stored and dealt by a hash of their place in that table, so equal ones do not
    meet, into groups of about ``group_pieces``. Each group is packed by itself, full pieces
    like the others; sequences are then numbered without gaps from the number of sequences
    per group. A piece larger than a limit is an error; :func:`cut_pieces` makes none.
    """
    pieces = materialise(pieces, "pieces")
    count = pieces.count()
    groups = count // group_pieces + 1
    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    placed = materialise(dealt.groupBy("grp").applyInArrow(_place_group(limits), PLACED), "placed")
    # One row per group of thousands of pieces; numbering them needs their order only.
    sizes = placed.groupBy("grp").agg((F.max("bin") + 1).alias("bins"))
    blocks = sizes.withColumn("block", F.floor(F.col("grp") / 1024))
    per_block = blocks.groupBy("block").agg(F.sum("bins").alias("bins"))
    shift = per_block.select("block", (F.sum("bins").over(Window.orderBy("block")) - F.col("bins")).alias("shift"))
    within = F.sum("bins").over(Window.partitionBy("block").orderBy("grp")) - F.col("bins")
    starts = blocks.withColumn("within", within).join(shift, "block").select(
        "grp", (F.col("shift") + F.col("within")).alias("base")
    )
    return placed.join(starts, "grp").withColumn("sequence_id", F.col("base") + F.col("bin")).drop("grp", "bin", "base")


def padded_width(width: F.Column, limit: int = LIMITS.tokens) -> F.Column:
    """Length of a stored sequence: the limit, or its own length if that is a power of two."""
    power = width.bitwiseAND(width - 1) == 0
    return F.when(power, width).otherwise(F.lit(limit)).cast("bigint")


def pack_documents(
    docs: DataFrame, tokenizer: str = "byte_bpe_50k", limits: Limits = LIMITS, group_pieces: int = GROUP_PIECES
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    segment, loss, width, padded_width``.

    A null text is an empty one and gives the closing id alone; equal rows are packed each
    for itself; rows without doc_id are packed like others; a text may have any length;
    other columns are not read; an empty table gives an empty table.
    """
    packed = pack(cut_pieces(docs, tokenizer, limits), limits, group_pieces)
    return packed.withColumn("padded_width", padded_width(F.col("width"), limits.tokens)).drop("row_key")


def read_sequences(pieces: DataFrame, packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` from pieces with their ids, for a round trip or a writer."""
    on = ["doc_id", "start", "ids_crc32"]
    rows = pieces.select(*on, "ids").join(packed.select(*on, "sequence_id", "offset"), on)
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return rows.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
