"""Shards by fixed virtual slots and a versioned map from slots to shards."""

from __future__ import annotations

from collections import Counter
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.rows import spare_names
from skyledger.session import materialise, scratch_path

#: Slots never change in number, so a record's slot is fixed for good.
SLOTS = 8192

#: A slot of several rows larger than this share of a shard is split into cells of about
#: the other share.
SPLIT_ABOVE, CELL, MOST_CELLS = 1 / 2, 1 / 32, 8192

MAP_SCHEMA = "version int, virtual_slot int, shard int, rows bigint, bytes bigint"


def with_slots(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot`` for each row of ``docs``.

    The slot is a hash of doc_id; a row without one is hashed by its text.
    """
    text = F.col("text").cast("string")
    doc_id = F.col("doc_id").cast("bigint")
    slot = F.when(doc_id.isNotNull(), F.xxhash64(doc_id)).otherwise(F.xxhash64(text))
    return docs.select(
        doc_id.alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        F.pmod(slot, F.lit(slots)).cast("int").alias("virtual_slot"),
    )


def salted(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """The stored rows of :func:`with_slots` with a number that tells equal rows apart.

    They are stored, without texts, since the number must not change between the pass that
    measures slots and the one that places rows.
    """
    return materialise(with_slots(docs, slots).withColumn("salt", F.xxhash64(F.monotonically_increasing_id())), "slotted")


def cells_of(sizes: dict[int, tuple[int, int]], shards: int) -> dict[int, int]:
    """Into how many cells a slot that is large beside a shard is split, as when one doc_id
    holds much of the rows, or rows without one share a text."""
    mean = max(sum(size for _, size in sizes.values()) / shards, 1)
    return {
        slot: min(int(size / (CELL * mean)) + 1, MOST_CELLS, rows)
        for slot, (rows, size) in sizes.items() if size > SPLIT_ABOVE * mean and rows > 1
    }


def cell_sizes(split: DataFrame, cells: dict[int, int], slots: int = SLOTS) -> dict[int, tuple[int, int]]:
    """:func:`slot_sizes` with every cell of the split slots, also those no row was dealt to,
    so that a map tells how many cells there are and has a shard for each."""
    empty = {slot + slots * cell: (0, 0) for slot, count in cells.items() for cell in range(count)}
    return empty | slot_sizes(split)


def cells_in_map(mapping: dict[int, int], slots: int = SLOTS) -> dict[int, int]:
    """The cells of split slots that a map knows."""
    counts = Counter(slot % slots for slot in mapping)
    return {slot: count for slot, count in counts.items() if count > 1}


def split_slots(slotted: DataFrame, cells: dict[int, int], slots: int = SLOTS) -> DataFrame:
    """Give the rows of split slots the virtual slot ``slot + slots * cell``; cell 0 keeps the
    slot's number. The list of split slots has at most one row per slot."""
    if not cells:
        return slotted
    spark = slotted.sparkSession
    split = F.broadcast(spark.createDataFrame(sorted(cells.items()), "virtual_slot int, cells int"))
    cell = F.coalesce(F.pmod("salt", "cells"), F.lit(0)).cast("int")
    joined = slotted.join(split, "virtual_slot", "left")
    return joined.withColumn("virtual_slot", F.col("virtual_slot") + slots * cell).drop("cells")


def slot_sizes(slotted: DataFrame) -> dict[int, tuple[int, int]]:
    """Rows and bytes of each slot in use; one row per slot reaches the driver."""
    sums = slotted.groupBy("virtual_slot").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))
    return {r.virtual_slot: (r.rows, r.bytes) for r in sums.collect()}


def first_map(sizes: dict[int, tuple[int, int]], shards: int) -> dict[int, int]:
    """Slots to shards, the largest slots first, each to the shard with the fewest bytes."""
    load = [(0, shard) for shard in range(shards)]
    heapify(load)
    placed = {}
    for slot, (_, size) in sorted(sizes.items(), key=lambda x: (-x[1][1], x[0])):
        total, shard = heappop(load)
        placed[slot] = shard
        heappush(load, (total + size, shard))
    return placed


def edited_map(current: dict[int, int], sizes: dict[int, tuple[int, int]], shards: int) -> dict[int, int]:
    """The map with as few slots moved as near-equal bytes in ``shards`` shards need.

    A slot stays where it is unless its shard goes away or is above the mean; moves are
    the largest slots that do not push a full shard below the mean, to the emptiest
    shard. Slots new to the map go to the emptiest shard as well.
    """
    kept = {slot: shard for slot, shard in current.items() if shard < shards and slot in sizes}
    load = [0] * shards
    for slot, shard in kept.items():
        load[shard] += sizes[slot][1]
    mean = sum(size for _, size in sizes.values()) / shards
    loose = [slot for slot in sizes if slot not in kept]
    for slot in sorted(kept, key=lambda s: (-sizes[s][1], s)):
        shard, size = kept[slot], sizes[slot][1]
        if load[shard] - size >= mean:
            load[shard] -= size
            loose.append(slot)
    heap = [(total, shard) for shard, total in enumerate(load)]
    heapify(heap)
    for slot in sorted(loose, key=lambda s: (-sizes[s][1], s)):
        total, shard = heappop(heap)
        kept[slot] = shard
        heappush(heap, (total + sizes[slot][1], shard))
    return kept


def store_map(
    spark: SparkSession, path: str, version: int, placed: dict[int, int], sizes: dict[int, tuple[int, int]]
) -> str:
    """Add a version of the map to the table at ``path``; earlier versions stay readable."""
    rows = [(version, slot, shard, *sizes[slot]) for slot, shard in sorted(placed.items())]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the map, the latest by default."""
    table = spark.read.schema(MAP_SCHEMA).parquet(path)
    if version is None:
        version = table.agg(F.max("version")).first()[0]
    return table.filter(F.col("version") == F.lit(version))


def rebalance(docs: DataFrame, path: str, shards: int, slots: int = SLOTS) -> str:
    """Measure the slots of ``docs`` anew and store an edited map as the next version."""
    _rebalanced(salted(docs, slots), path, shards, slots)
    return path


def _rebalanced(slotted: DataFrame, path: str, shards: int, slots: int) -> DataFrame:
    """The rows under the slots of the map's next version, which is stored. A slot once split
    stays so, into as many cells or more."""
    spark = slotted.sparkSession
    current = read_map(spark, path).collect()
    known = {r.virtual_slot: r.shard for r in current}
    cells = cells_of(slot_sizes(slotted), shards)
    for slot, count in cells_in_map(known, slots).items():
        cells[slot] = max(count, cells.get(slot, 0))
    split = split_slots(slotted, cells, slots)
    sizes = cell_sizes(split, cells, slots)
    version = max((r.version for r in current), default=0) + 1
    store_map(spark, path, version, edited_map(known, sizes, shards), sizes)
    return split


def apply_map(slotted: DataFrame, mapping: DataFrame) -> DataFrame:
    """Add ``shard`` and ``slot``, the row's place in its shard, counted from 0 without gaps.

    A place is the rows of the shard's earlier virtual slots, known from the map, plus
    the place among the rows of the own virtual slot. So rows are numbered slot by slot
    in parallel and no task sees a whole shard. The map has one row per virtual slot,
    whatever the size of the data, and is sent to all tasks.
    """
    before = F.sum("rows").over(Window.partitionBy("shard").orderBy("virtual_slot")) - F.col("rows")
    starts = mapping.select("virtual_slot", "shard", before.alias("start"))
    within = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return (
        slotted.withColumn("place", within)
        .join(F.broadcast(starts), "virtual_slot")
        .withColumn("slot", (F.col("start") + F.col("place") - 1).cast("bigint"))
        .drop("start", "place")
    )


def assign_shards(
    docs: DataFrame, shards: int = 16, slots: int = SLOTS, map_path: str | None = None
) -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot, shard, slot`` for each row of ``docs``.

    Sizes are the UTF-8 bytes of the text plus one; shards get near-equal bytes. The
    map is stored at ``map_path`` (by default in the shared folder) as its next version:
    an edit of the latest one where there is one.

    A null text has size 1 and the checksum of the empty text; rows without doc_id are
    placed by their text; equal rows share a virtual slot and are numbered in any order.
    A slot larger than half a shard, as one doc_id or one text of a third of the rows gives,
    is split into cells, virtual slots beyond ``slots``, which rows are dealt to by a number;
    so shards stay near-equal unless single texts are larger than that. A very long text is
    one row of its size. Other columns are not read; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    slotted = salted(docs, slots)
    if map_path is None:
        map_path = scratch_path(spark, "slot-map")
        cells = cells_of(slot_sizes(slotted), shards)
        slotted = split_slots(slotted, cells, slots)
        sizes = cell_sizes(slotted, cells, slots)
        store_map(spark, map_path, 1, first_map(sizes, shards), sizes)
    else:
        slotted = _rebalanced(slotted, map_path, shards, slots)
    return apply_map(slotted.drop("salt"), read_map(spark, map_path))


def write_shards(docs: DataFrame, mapping: DataFrame, path: str, slots: int = SLOTS) -> str:
    """Write all columns of ``docs`` below ``path``, a folder per shard.

    Rows are brought together by shard, and a large shard is cut into several files.
    """
    (salt, slot, cells, shard) = spare_names(docs, "_salt", "_slot", "_cells", "_shard")
    doc_id, text = F.col("doc_id").cast("bigint"), F.col("text").cast("string")
    hashed = F.when(doc_id.isNotNull(), F.xxhash64(doc_id)).otherwise(F.xxhash64(text))
    base = mapping.groupBy((F.col("virtual_slot") % slots).alias(slot)).agg(F.count("*").cast("int").alias(cells))
    lookup = mapping.select(F.col("virtual_slot").alias(slot), F.col("shard").alias(shard))
    numbered = docs.withColumns({
        slot: F.pmod(hashed, F.lit(slots)).cast("int"), salt: F.xxhash64(F.monotonically_increasing_id()),
    }).join(F.broadcast(base), slot)
    cell = F.pmod(F.col(salt), F.col(cells)).cast("int")
    placed = numbered.withColumn(slot, F.col(slot) + slots * cell).join(F.broadcast(lookup), slot)
    placed.drop(slot, salt, cells).hint("rebalance", F.col(shard)).write.partitionBy(shard).parquet(path)
    return path
