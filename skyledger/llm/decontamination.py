"""Benchmark passages in documents, found by an Aho-Corasick automaton in one scan."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.rows import own_columns, spare_names
from skyledger.llm.textbytes import byte_table, chunks_of, utf8_texts
from skyledger.session import materialise, send_code_with_tasks

send_code_with_tasks(__name__)

#: Consecutive words of an item that make a window.
WINDOW_WORDS = 10
#: Bytes of item text in one automaton, which takes some 500 times as many bytes in a worker.
#: More items are scanned for by several automata; items are cut to pieces of a share of it.
PART_BYTES = 1 << 20
PIECES = 16

# Bytes that may be part of a word, and the lower case of A-Z. All other
# bytes below 0x80 become blanks; one byte stays one byte, so places stay the same.
WORD_BYTES = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
NORMAL = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in WORD_BYTES else 0x20 for b in range(256))
IS_BLANK = byte_table(b" ")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


def windows_of(text: bytes, width: int = WINDOW_WORDS) -> set[bytes]:
    """The windows of an item, each as words between blanks; all its words if they are fewer."""
    words = words_of(text)
    last = max(1, len(words) - width + 1) if words else 0
    return {b" " + b" ".join(words[i : i + width]) + b" " for i in range(last)}


def build_automaton(items: list[tuple[str, bytes]], width: int = WINDOW_WORDS) -> ahocorasick.Automaton:
    """An automaton over the windows of all items; a window knows its items and its words."""
    owners: dict[bytes, set[str]] = {}
    for item, text in items:
        for window in windows_of(text, width):
            owners.setdefault(window, set()).add(item)
    automaton = ahocorasick.Automaton()
    for window, found in owners.items():
        # Latin-1 makes every byte one letter, so places in the text are byte places.
        automaton.add_word(window.decode("latin-1"), (len(window), found))
    if owners:
        automaton.make_automaton()
    return automaton


def scan_text(automaton: ahocorasick.Automaton, text: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, merged hit ranges of words (first, behind the last) and items.

    The scan runs over the normalised text once. A match begins and ends with a blank,
    and the number of blanks before a place is the number of words there.
    """
    words = words_of(text)
    if not len(automaton) or not words:
        return len(words), [], set()
    line = b" " + b" ".join(words) + b" "
    ranges: list[tuple[int, int]] = []
    items: set[str] = set()
    matches = [(end - size + 1, end, found) for end, (size, found) in automaton.iter(line.decode("latin-1"))]
    if matches:
        blanks = np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 0x20)
        for start, end, found in sorted(matches, key=lambda m: m[0]):
            first, behind = int(np.searchsorted(blanks, start)), int(np.searchsorted(blanks, end))
            if ranges and first <= ranges[-1][1]:
                ranges[-1] = (ranges[-1][0], max(ranges[-1][1], behind))
            else:
                ranges.append((first, behind))
            items |= found
    return len(words), ranges, items


def original_ranges(text: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte places of word ranges in the original text."""
    if not ranges:
        return []
    blank = IS_BLANK[np.frombuffer(b" " + text.translate(NORMAL) + b" ", dtype=np.uint8)]
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    return [(int(starts[a]), int(ends[b - 1])) for a, b in ranges]


RESULT = (
    "n_words bigint, ranges array<struct<first: bigint, behind: bigint>>, "
    "places array<struct<first: bigint, behind: bigint>>, items array<string>"
)


def pieces_of(text: bytes, size: int, width: int = WINDOW_WORDS) -> list[bytes]:
    """Stretches of an item that hold all its windows, each window in one of them. A stretch
    ends with the first window that begins ``size`` bytes or more behind the stretch's start."""
    words = words_of(text)
    last = len(words) - width
    if last <= 0:
        return [b" ".join(words)] if words else []
    pieces, first, long = [], 0, 0
    for i in range(last + 1):
        long += len(words[i]) + 1
        if long >= size or i == last:
            pieces.append(b" ".join(words[first : i + width]))
            first, long = i + 1, 0
    return pieces


def item_parts(benchmark: DataFrame, part_bytes: int = PART_BYTES, width: int = WINDOW_WORDS) -> list[DataFrame]:
    """The items dealt into parts of about ``part_bytes`` of text. Beyond one part they are cut
    to pieces first, so that long items do not make a part much larger than the others."""
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text")
    ).filter("item is not null and text is not null")
    long = F.sum(F.octet_length("text") + F.octet_length("item"))
    if (items.agg(long).first()[0] or 0) <= part_bytes:
        return [items]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks_of(batch, "text"):
                cut = [pieces_of(t, max(1, part_bytes // PIECES), width) for t in utf8_texts(chunk.column("text"))]
                owner = np.repeat(np.arange(len(cut)), [len(c) for c in cut])
                texts = pa.array([piece.decode() for c in cut for piece in c], pa.string())
                yield pa.RecordBatch.from_arrays([chunk.column("item").take(pa.array(owner)), texts], ["item", "text"])

    pieces = materialise(items.mapInArrow(work, "item string, text string"), "benchmark-pieces")
    count = -(-(pieces.agg(long).first()[0] or 0) // part_bytes) or 1
    part = F.pmod(F.xxhash64("item", "text"), F.lit(count))
    return [pieces.filter(part == n) for n in range(count)]


def _sent(part: DataFrame, width: int):
    """A function that gives tasks the part's automaton, which a worker builds once and keeps
    with the broadcast items for its later tasks."""
    shared = part.sparkSession.sparkContext.broadcast({"items": [(r.item, r.text.encode()) for r in part.collect()]})

    def automaton() -> ahocorasick.Automaton:
        kept = shared.value
        if "automaton" not in kept:
            kept["automaton"] = build_automaton(kept["items"], width)
        return kept["automaton"]

    return automaton


def _scan(docs: DataFrame, part: DataFrame, width: int) -> DataFrame:
    """The columns of ``docs`` (one is ``text``) and a column ``found``: what one automaton finds."""
    sent = _sent(part, width)
    kind = pa.list_(pa.struct([("first", pa.int64()), ("behind", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = sent()
        for batch in batches:
            for chunk in chunks_of(batch, "text"):
                texts = utf8_texts(chunk.column("text"))
                found = [scan_text(automaton, t) for t in texts]
                pairs = lambda ranges: [{"first": a, "behind": b} for a, b in ranges]
                columns = [
                    pa.array([n for n, _, _ in found], pa.int64()),
                    pa.array([pairs(r) for _, r, _ in found], kind),
                    pa.array([pairs(original_ranges(t, r)) for t, (_, r, _) in zip(texts, found)], kind),
                    pa.array([sorted(i) for _, _, i in found], pa.list_(pa.string())),
                ]
                keep = [i for i, name in enumerate(chunk.schema.names) if name != "text"]
                yield pa.RecordBatch.from_arrays(
                    [chunk.column(i) for i in keep] + columns,
                    [chunk.schema.names[i] for i in keep] + ["n_words", "ranges", "places", "items"],
                )

    kept = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes if n != "text")
    return docs.mapInArrow(work, f"{kept}, {RESULT}")


def _with_ids(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _n_hit(ranges) -> F.Column:
    return F.aggregate(ranges, F.lit(0).cast("bigint"), lambda n, r: n + r["behind"] - r["first"])


def _union_of_ranges(ranges) -> F.Column:
    """Sorted, merged ranges of several lists of them."""
    none = F.array().cast("array<struct<first: bigint, behind: bigint>>")

    def add(done, r):
        last = F.element_at(done, -1)
        joined = F.named_struct(F.lit("first"), last["first"], F.lit("behind"), F.greatest(last["behind"], r["behind"]))
        return F.when(
            (F.size(done) > 0) & (r["first"] <= last["behind"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined)),
        ).otherwise(F.concat(done, F.array(r)))

    return F.aggregate(F.sort_array(ranges), none, add)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, width: int = WINDOW_WORDS, part_bytes: int = PART_BYTES
) -> DataFrame:
    """``doc_id, n_words, ranges, places, items, n_hit, n_items, contaminated`` per row of ``docs``.

    Words are runs of ASCII letters and digits (lowered) and of all signs above ASCII. A
    window is ``width`` consecutive words of an item, or all words of a shorter item.
    ``ranges`` are the hit words of the document by number, ``places`` their byte places
    in the original text, ``items`` the items found.

    The items are sent to all tasks, up to ``part_bytes`` of them: their size is summed
    first. Beyond it they are dealt into parts, each with a scan of its own, and the
    findings of equal rows are united by a shuffle of doc_id and text hash.

    A null or empty text has no words and no hits; an item without words has no window; a
    null item_id or text leaves the item out; an item given twice counts once; equal
    documents give equal rows; no items, no hits; other columns are not read; an empty table
    gives an empty table; a text of any length is scanned whole, one at a time.
    """
    docs = _with_ids(docs)
    parts = item_parts(benchmark, part_bytes, width)
    if len(parts) == 1:
        found = _scan(docs, parts[0], width)
    else:
        keyed = docs.withColumn("text_key", F.xxhash64("text"))
        each = [_scan(keyed, part, width) for part in parts]
        hits = reduce(DataFrame.unionByName, each).filter(F.size("items") > 0)
        united = hits.groupBy("doc_id", "text_key").agg(
            _union_of_ranges(F.flatten(F.collect_set("ranges"))).alias("ranges"),
            _union_of_ranges(F.flatten(F.collect_set("places"))).alias("places"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        counts = each[0].select("doc_id", "text_key", "n_words")
        a, b = counts.alias("a"), materialise(united, "hits").alias("b")
        on = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & F.col("a.text_key").eqNullSafe(F.col("b.text_key"))
        empty = F.array().cast("array<struct<first: bigint, behind: bigint>>")
        found = a.join(b, on, "left").select(
            "a.doc_id", "n_words",
            F.coalesce("ranges", empty).alias("ranges"),
            F.coalesce("places", empty).alias("places"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    return found.withColumns({
        "n_hit": _n_hit(F.col("ranges")),
        "n_items": F.size("items").cast("bigint"),
        "contaminated": F.size("items") > 0,
    })


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, width: int = WINDOW_WORDS, part_bytes: int = PART_BYTES
) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, with all their columns.

    The rows pass each part's automaton in turn and are never shuffled. Nulls, empty
    texts and empty tables are as in :func:`find_contamination`.
    """
    for part in item_parts(benchmark, part_bytes, width):
        docs = _drop_hits(docs, _sent(part, width))
    return docs


def _drop_hits(docs: DataFrame, sent) -> DataFrame:
    (plain,) = spare_names(docs, "plain_text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = sent()
        for batch in batches:
            for chunk in chunks_of(batch, plain):
                clean = [not scan_text(automaton, t)[2] for t in utf8_texts(chunk.column(plain))]
                kept = chunk.filter(pa.array(clean, pa.bool_()))
                yield kept.select([n for n in kept.schema.names if n != plain])

    return docs.select(*own_columns(docs), F.col("text").cast("string").alias(plain)).mapInArrow(work, docs.schema)
