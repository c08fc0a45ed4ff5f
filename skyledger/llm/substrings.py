"""Repeated passages: rolling hashes of all word windows, counted in Spark, then cut out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.textbytes import Words, chunks_of, ranges, rolling_hashes, spark_hash, utf8_texts
from skyledger.session import send_code_with_tasks

send_code_with_tasks(__name__)

WINDOW_WORDS = 13
#: Windows that one group of the count holds on average (16 bytes each, some copies).
GROUP_WINDOWS = 1_500_000
#: Bytes of text whose windows are sent on together.
SEND_BYTES = 4 << 20

# A document without id comes after all others and so never removes anything.
LAST_ID = np.iinfo(np.int64).max

# Rows between the steps: windows of several documents, run-length coded. ``orders`` are
# the doc_ids that decide, and with ``row_keys`` they find the rows again.
PACKED = "grp bigint, settled boolean, orders binary, row_keys binary, counts binary, hashes binary"
PACKED_TYPES = [pa.int64(), pa.bool_()] + [pa.binary()] * 4
PACKED_NAMES = ["grp", "settled", "orders", "row_keys", "counts", "hashes"]


def _shrunk(values: np.ndarray) -> bytes:
    """Whole numbers as differences, in the narrowest type that holds them."""
    steps = np.diff(values, prepend=0)
    kind = next(k for k in "bhiq" if k == "q" or (np.iinfo(k).min <= steps.min() and steps.max() <= np.iinfo(k).max))
    return kind.encode() + steps.astype(kind).tobytes()


def _grown(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, dtype=raw[:1].decode(), offset=1), dtype=np.int64)


def window_hashes(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows that lie in one text, and how many each text has."""
    rolled = rolling_hashes(words.sum_hashes(), width)
    per_text = np.maximum(words.counts - width + 1, 0)
    return rolled[ranges(words.first[:-1], per_text)], per_text


def home_of(order: np.ndarray, key: np.ndarray, groups: int) -> np.ndarray:
    """The group of a row in the last step, as ``remove_repeats`` computes it in Spark."""
    return spark_hash(order, key) % groups


def _pack(group: np.ndarray, settled: bool, order, key, hashes) -> Iterator[tuple]:
    """Entries as one tuple per group; the entries of a document stay together."""
    place = np.argsort(group, kind="stable")
    group, order, key, hashes = group[place], order[place], key[place], hashes[place]
    cuts = np.flatnonzero(np.diff(group)) + 1
    for a, b in zip(np.append(0, cuts), np.append(cuts, len(group))):
        if a == b:
            continue
        new = np.flatnonzero((np.diff(order[a:b]) != 0) | (np.diff(key[a:b]) != 0)) + 1
        first = a + np.append(0, new)
        counts = np.diff(np.append(first, b))
        yield (
            int(group[a]), settled, _shrunk(order[first]), _shrunk(key[first]), _shrunk(counts), hashes[a:b].tobytes()
        )


def _unpack(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Order, key and hash of every entry."""
    def flat(name):
        return np.concatenate([np.zeros(0, np.int64), *map(_grown, table.column(name).to_pylist())])

    counts = flat("counts")
    hashes = np.frombuffer(b"".join(table.column("hashes").to_pylist()), dtype=np.uint64)
    return np.repeat(flat("orders"), counts), np.repeat(flat("row_keys"), counts), hashes


def _beaten(order: np.ndarray, key: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries have a smaller document with the same window; which are the first of each window."""
    if not len(hashes):
        return np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int64)
    place = np.lexsort((key, hashes)) if key.any() else np.argsort(hashes)
    ordered, ids, keys = hashes[place], order[place], key[place]
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    least = np.repeat(np.minimum.reduceat(ids, starts), np.diff(np.append(starts, len(ids))))
    beaten = np.empty(len(ids), dtype=bool)
    beaten[place] = ids > least
    # One entry with the least id stands for its window; ties are copies within a document, or
    # rows without id, each of which may lose the window to a document seen elsewhere.
    winners = np.flatnonzero(ids == least)
    hashes, keys = ordered[winners], keys[winners]
    lead = np.flatnonzero(np.append(True, (hashes[1:] != hashes[:-1]) | (keys[1:] != keys[:-1])))
    return beaten, place[winners[lead]]


def _table(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(PACKED_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, PACKED_TYPES)], PACKED_NAMES)


def _send_windows(width: int, groups: int):
    """Windows of the texts of a chunk, to the groups that count them.

    Within the chunk, a window found in several documents is settled for all but the
    smallest of them, and only that one is sent to be counted. A passage that every
    document holds thus costs an entry for each chunk, not for each document. Where only
    rows without id hold it, none is settled and each different text sends its entry.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks_of(batch, "text", SEND_BYTES):
                words = Words(utf8_texts(chunk.column("text")))
                hashes, per_text = window_hashes(words, width)
                number = lambda name: np.repeat(chunk.column(name).to_numpy(), per_text)
                order, key = number("ord"), number("row_key")
                beaten, lead = _beaten(order, key, hashes)
                lead.sort()
                group = (hashes[lead] % np.uint64(groups)).astype(np.int64)
                rows = list(_pack(group, False, order[lead], key[lead], hashes[lead]))
                order, key = order[beaten], key[beaten]
                rows += _pack(home_of(order, key, groups), True, order, key, hashes[beaten])
                yield _table(rows)

    return work


def _count(groups: int):
    """Windows to remove, by the group of their rows. Settled ones pass."""

    def work(table: pa.Table) -> pa.Table:
        settled = table.column("settled").combine_chunks()
        order, key, hashes = _unpack(table.filter(pc.invert(settled)))
        beaten, _ = _beaten(order, key, hashes)
        order, key, hashes = order[beaten], key[beaten], hashes[beaten]
        place = np.lexsort((key, order))
        order, key = order[place], key[place]
        rows = list(_pack(home_of(order, key, groups), True, order, key, hashes[place]))
        return pa.concat_tables([table.filter(settled), pa.Table.from_batches([_table(rows)])])

    return work


RESULT = (
    "doc_id bigint, n_words bigint, n_removed bigint, kept_text string, "
    "removed array<struct<first: bigint, behind: bigint>>"
)
RANGES = pa.list_(pa.struct([("first", pa.int64()), ("behind", pa.int64())]))


def cut_windows(text: bytes, hit: np.ndarray, width: int) -> tuple[int, list[tuple[int, int]], bytes]:
    """Number of words, maximal ranges covered by the hit windows, and the words outside them."""
    words = text.split()
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + width, -1)
    gone = np.cumsum(cover[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False]))))
    kept = [w for w, g in zip(words, gone.tolist()) if not g] if len(hit) else words
    return len(words), list(zip(edges[::2].tolist(), edges[1::2].tolist())), b" ".join(kept)


def _cut(width: int):
    def work(texts: pa.Table, cuts: pa.Table) -> pa.Table:
        order, key, hashes = _unpack(cuts)
        place = np.lexsort((hashes, key, order))
        order, key, hashes = order[place], key[place], hashes[place]
        news = np.flatnonzero(np.append(True, (np.diff(order) != 0) | (np.diff(key) != 0))) if len(order) else []
        spans = {
            (int(order[a]), int(key[a])): (a, b) for a, b in zip(news, np.append(news[1:], len(order)))
        } if len(order) else {}
        out = []
        for batch in texts.to_batches():
            for chunk in chunks_of(batch, "text"):
                raw, rows = utf8_texts(chunk.column("text")), []
                for text, a, b in zip(raw, chunk.column("ord").to_pylist(), chunk.column("row_key").to_pylist()):
                    hit = np.zeros(0, dtype=np.int64)
                    if (a, b) in spans:
                        mine, _ = window_hashes(Words([text]), width)
                        known = hashes[slice(*spans[a, b])]
                        near = np.minimum(np.searchsorted(known, mine), len(known) - 1)
                        hit = np.flatnonzero(known[near] == mine)
                    rows.append(cut_windows(text, hit, width))
                out.append(pa.RecordBatch.from_arrays(
                    [
                        chunk.column("doc_id"),
                        pa.array([n for n, _, _ in rows], pa.int64()),
                        pa.array([sum(b - a for a, b in r) for _, r, _ in rows], pa.int64()),
                        pa.array([k for _, _, k in rows], pa.binary()).cast(pa.string()),
                        pa.array([[{"first": a, "behind": b} for a, b in r] for _, r, _ in rows], RANGES),
                    ],
                    ["doc_id", "n_words", "n_removed", "kept_text", "removed"],
                ))
        schema = pa.schema([
            ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
            ("kept_text", pa.string()), ("removed", RANGES),
        ])
        return pa.Table.from_batches(out, schema)

    return work


def remove_repeats(
    docs: DataFrame, width: int = WINDOW_WORDS, group_windows: int = GROUP_WINDOWS
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text, removed`` per row of ``docs`` (``doc_id, text``).

    A word goes if some window of ``width`` words over it also starts in a document with
    a smaller doc_id; ``removed`` holds the maximal ranges of such words, ``kept_text`` the
    others joined by blanks. Windows are those of the input, and are compared by 64-bit
    polynomial hashes of their words' hashes, which are sums of mixed terms, so two
    different windows meet by chance only.

    Windows travel as packed arrays of eight bytes each, without their places: the last
    step finds these again, and only for documents that lose something. Groups of the
    count grow in number with the text, not in size.

    A null, empty or blank text has no words and an empty kept text; rows that share a
    doc_id never remove each other's words; a row without doc_id comes after all others
    and removes nothing; other columns are not read; an empty table gives an empty table.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    groups = int(size // (6 * group_windows)) + 1
    rows = rows.withColumns({
        "ord": F.coalesce("doc_id", F.lit(int(LAST_ID))),
        "row_key": F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0)).cast("bigint"),
    })
    sent = rows.select("ord", "row_key", "text").mapInArrow(_send_windows(width, groups), PACKED)
    cuts = sent.groupBy("grp").applyInArrow(_count(groups), PACKED)
    home = F.pmod(F.xxhash64("ord", "row_key"), F.lit(groups))
    texts = rows.select(home.alias("grp"), "doc_id", "ord", "row_key", "text").groupBy("grp")
    return texts.cogroup(cuts.groupBy("grp")).applyInArrow(_cut(width), RESULT)
