"""Bounded training samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.session import materialise

#: Different values the sampling hash is reduced to.
HASHES = 1 << 40


def crc_remainder(doc_id, divisor: int):
    """crc32 of the id as text, modulo ``divisor``; null for a row without id."""
    return F.crc32(doc_id.cast("string")) % divisor


def sample_ids(labelled: DataFrame, label: str, per_label: int | dict, total: int | None = None) -> DataFrame:
    """``doc_id`` and the label of a sample drawn by a hash of doc_id: at most ``per_label``
    rows of a label (a number, or one for each label), and ``total`` in all.

    Rows are counted per label first, and only those whose hash is so low that about twice
    the wanted number remain are put in order. Otherwise the few first rows of every task
    would meet in one task, and there are as many tasks as the data is large.
    """
    counts = materialise(labelled.groupBy(label).agg(F.count("*").alias("_rows")), "label-counts")
    if isinstance(per_label, dict):
        share = F.coalesce(*[F.when(F.col(label) == key, F.lit(n)) for key, n in per_label.items()])
    else:
        share = F.lit(min(per_label, max(1, total // max(counts.count(), 1))) if total else per_label)
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(HASHES)) / HASHES
    few = labelled.join(counts, label).withColumns({"_place": place, "_share": share}).filter(
        F.col("_place") * F.col("_rows") < 2 * F.col("_share") + 100
    )
    order = Window.partitionBy(label).orderBy("_place", "doc_id")
    return few.withColumn("_n", F.row_number().over(order)).filter("_n <= _share").select("doc_id", label)


def excerpt(text, characters: int):
    """A stretch of the text of at most ``characters``; where it begins depends on the text."""
    spare = F.greatest(F.length(text) - characters, F.lit(0))
    start = F.pmod(F.xxhash64(text), spare + 1).cast("int") + 1
    return F.substring(text, start, F.lit(characters))


def sampled_texts(docs: DataFrame, chosen: DataFrame, characters: int) -> DataFrame:
    """The chosen ids with an excerpt of their text, one row each. ``chosen`` is a bounded sample,
    as :func:`sample_ids` gives it, and so is broadcast. Where several rows share an id the
    text of the smallest hash is taken; each task sends one row per id."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    there = texts.filter("text is not null").join(F.broadcast(chosen), "doc_id")
    labels = [c for c in chosen.columns if c != "doc_id"]
    cut = there.select("doc_id", *labels, F.xxhash64("text").alias("_hash"), excerpt(F.col("text"), characters).alias("text"))
    first = F.min(F.struct("_hash", "text")).alias("_first")
    return cut.groupBy("doc_id", *labels).agg(first).select("doc_id", "_first.text", *labels)
