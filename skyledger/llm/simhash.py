"""Near copies by SimHash: fingerprints, pigeonhole blocks, Hamming check, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.components import connected_components
from skyledger.llm.rows import own_columns, spare_names
from skyledger.llm.textbytes import chunks_of, utf8_texts
from skyledger.session import materialise, send_code_with_tasks

send_code_with_tasks(__name__)

SHINGLE_WORDS = 4
MAX_BITS = 4
#: Blocks a fingerprint is cut into; all but MAX_BITS of them are equal for a close pair.
BLOCKS = 6
SEED = 42


def shingle_hashes(text: bytes, width: int = SHINGLE_WORDS, seed: int = SEED) -> list[int]:
    """XXH64 of each shingle of a text whose letters A-Z are lowered; a shorter text is one shingle."""
    words = text.lower().split()
    if not words:
        return []
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return [digest(joined, seed)]
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    return [digest(joined[a : b - 1], seed) for a, b in zip(starts, starts[width:])]


def fingerprints_of(texts: list[bytes], width: int = SHINGLE_WORDS, seed: int = SEED) -> np.ndarray:
    """A 64-bit fingerprint per text: each bit is that of more than half of its shingles."""
    hashes = [np.array(shingle_hashes(t, width, seed), dtype=np.uint64) for t in texts]
    counts = np.array([len(h) for h in hashes], dtype=np.int64)
    prints = np.zeros(len(texts), dtype=np.uint64)
    filled = np.flatnonzero(counts)
    if not len(filled):
        return prints
    ones = np.zeros((len(texts), 64), dtype=np.int64)
    for i in filled:
        for part in np.array_split(hashes[i], max(1, len(hashes[i]) // 65_536)):
            bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones[i] += bits.sum(axis=0, dtype=np.int64)
    major = (2 * ones > counts[:, None]).astype(np.uint8)
    return np.packbits(major, axis=1, bitorder="little").reshape(-1).view("<u8").astype(np.uint64)


def with_fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, text_key, print`` for each row: a 64-bit hash of the text and its
    fingerprint, both as signed numbers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks_of(batch, "text"):
                prints = fingerprints_of(utf8_texts(chunk.column("text")), width)
                yield pa.RecordBatch.from_arrays(
                    [chunk.column("doc_id"), chunk.column("text_key"), pa.array(prints.view(np.int64))],
                    ["doc_id", "text_key", "print"],
                )

    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return texts.withColumn("text_key", F.xxhash64("text")).mapInArrow(
        work, "doc_id bigint, text_key bigint, print bigint"
    )


def block_masks(max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> list[int]:
    """Masks of the block sets on at least one of which two close fingerprints agree.

    Two fingerprints that differ in ``max_bits`` bits differ in that many blocks at
    most, so some ``blocks - max_bits`` blocks are equal as a whole.
    """
    if not max_bits < blocks <= 64:
        raise ValueError("blocks must be more than max_bits and no more than 64")
    borders = [64 * i // blocks for i in range(blocks + 1)]
    single = [(1 << b) - (1 << a) for a, b in zip(borders, borders[1:])]
    masks = [sum(kept) for kept in combinations(single, blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def forest(prints: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect all members of a block which some chain of close pairs connects.

    Every close pair of the block is looked at unless its two ends are known to be
    connected, and at most one link per member is returned: thousands of near copies
    of one text give thousands of links, not millions.
    """
    links, rest = [], prints.view(np.uint64)
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            here = queue.pop()
            near = np.bitwise_count(rest ^ here) <= max_bits
            if near.any():
                found, rest = rest[near], rest[~near]
                queue.extend(found)
                links.extend((here, other) for other in found)
    return links


def small_forest(prints: list[int], max_bits: int) -> list[tuple[int, int]]:
    """The same for the usual block of a few members, without arrays."""
    links, rest = [], [p & 0xFFFFFFFFFFFFFFFF for p in prints]
    while len(rest) > 1:
        queue = [rest.pop()]
        while queue and rest:
            here, far = queue.pop(), []
            for other in rest:
                if (here ^ other).bit_count() <= max_bits:
                    links.append((here, other))
                    queue.append(other)
                else:
                    far.append(other)
            rest = far
    return links


def close_links(prints: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """Links ``a, b`` between different fingerprints, enough to connect all close ones.

    ``prints`` has one row per different fingerprint, so copies of a text meet no
    block. A block holds different fingerprints that agree in the masked bits; within
    ``max_bits`` of one text there are only so many of them, however many its copies.
    Raise ``blocks`` with the number of texts: keys get longer, blocks smaller.
    """
    keys = F.array(*[
        F.struct(F.lit(n).alias("n"), F.col("print").bitwiseAND(F.lit(mask)).alias("bits"))
        for n, mask in enumerate(block_masks(max_bits, blocks))
    ])
    members = (
        prints.select("print", F.explode(keys).alias("key"))
        .groupBy("key.n", "key.bits")
        .agg(F.collect_list("print").alias("members"))
        .filter(F.size("members") > 1)
        .select("members")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for block in batch.column(0):
                found = block.values.to_numpy()
                links += forest(found, max_bits) if len(found) > 24 else small_forest(found.tolist(), max_bits)
            ends = np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    return members.mapInArrow(work, "a bigint, b bigint").distinct()


def near_duplicates(
    docs: DataFrame, width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, blocks: int = BLOCKS
) -> DataFrame:
    """``doc_id, text_key, print, root, component_id`` for each row of ``docs`` (``doc_id, text``).

    Rows whose fingerprints differ in at most ``max_bits`` bits are linked; ``root`` is
    the component's smallest fingerprint and ``component_id`` the smallest doc_id in it.

    A null, empty or blank text has fingerprint zero and is linked like any other; equal
    rows each give a row; a row without doc_id links others but names no component, and
    a component of such rows only has none; other columns are not read; an empty table
    gives an empty table.
    """
    rows = materialise(with_fingerprints(docs, width), "fingerprints")
    prints = rows.groupBy("print").agg(F.min("doc_id").alias("least"))
    roots = connected_components(close_links(prints, max_bits, blocks))
    rooted = prints.join(roots, prints.print == roots.node, "left").select(
        "print", F.coalesce("root", "print").alias("root"), "least"
    )
    named = rooted.join(
        rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root"
    ).select("print", "root", "component_id")
    return rows.join(materialise(named, "components"), "print").select(
        "doc_id", "text_key", "print", "root", "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame, width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, blocks: int = BLOCKS
) -> DataFrame:
    """One row of each component of :func:`near_duplicates`, with all columns of ``docs``.

    It is that of the smallest doc_id; of rows that share it, one with the smallest
    text hash, and of equal texts any one. Rows without doc_id come last, so one of them
    stays only where no row of its component has an id.
    """
    found = near_duplicates(docs, width, max_bits, blocks)
    unknown, number, text = spare_names(docs, "unknown", "number", "text_key")
    row = [F.col("doc_id").isNull().alias(unknown), F.coalesce("doc_id", F.lit(0)).alias(number), F.col("text_key").alias(text)]
    chosen = found.groupBy("root").agg(F.min(F.struct(*row)).alias("row")).select("row.*")
    keyed = docs.withColumns({
        unknown: F.col("doc_id").isNull(),
        number: F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)),
        text: F.xxhash64(F.col("text").cast("string")),
    })
    # The join leaves rows dealt out and sorted by these columns, as the last step needs them.
    keys = [unknown, number, text]
    return keyed.join(chosen, keys).dropDuplicates(keys).select(*own_columns(docs))
