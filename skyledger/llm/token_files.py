"""Token counts of documents in flat token files that have no index.

A file holds 16-bit ids, document after document, each closed by an end id. Tasks
search blocks of such files for the end ids; what runs over a block's border is put
together by running sums over the blocks of a file.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.textbytes import chunks_of
from skyledger.llm.tokens import rank_encoder, tokenizer_path
from skyledger.session import materialise, scratch_path, send_code_with_tasks
from skyledger.sources.archives import open_path

send_code_with_tasks(__name__)

END_ID = 50256
BLOCK_BYTES = 4 << 20
WRITTEN = "path string, bytes bigint, first bigint, doc_ids array<bigint>"


def open_output(path: str):
    """Binary output stream for a path as Spark prints it."""
    from pyarrow import fs

    if "://" in path and not path.startswith("file:"):
        system, inner = fs.FileSystem.from_uri(path.replace("s3a:", "s3:", 1))
    else:
        system, inner = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    system.create_dir(inner.rpartition("/")[0], recursive=True)
    return system.open_output_stream(inner)


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str = "byte_bpe_multi_50k", end_id: int = END_ID
) -> DataFrame:
    """Write the texts' ids to one file per task and list what was written, once.

    Each attempt of a task writes a file with a name of its own, and only the files in
    the stored list count, so a lost or repeated task leaves no double documents. The
    list names, in order, the documents of each stretch of a file; it holds no places.
    """
    path = tokenizer_path(f"{tokenizer}.tiktoken")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, size, first = f"{folder}/{uuid.uuid4().hex}.bin", 0, 0
        out = None
        for batch in batches:
            for chunk in chunks_of(batch, "text"):
                out = out or open_output(name)
                before = first
                for text in chunk.column("text").to_pylist():
                    ids = rank_encoder(path).encode_to_numpy(text or "")
                    size += out.write(np.append(ids, end_id).astype("<u2").tobytes())
                    first += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name]), pa.array([0], pa.int64()), pa.array([before], pa.int64()),
                        pa.array([chunk.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    ],
                    ["path", "bytes", "first", "doc_ids"],
                )
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([size], pa.int64()), pa.array([first], pa.int64()), pa.array([[]], pa.list_(pa.int64()))],
                ["path", "bytes", "first", "doc_ids"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialise(rows.mapInArrow(work, WRITTEN), "token-files")


def scan_blocks(files: DataFrame, end_id: int = END_ID, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``path, block, ends, head, inner, tail`` for each block of the files (``path, bytes``).

    ``ends`` is the number of end ids, ``head`` the ids before the first, ``inner`` the
    counts between them and ``tail`` the ids after the last; without any, all are tail.
    """
    if block_bytes % 2:
        raise ValueError("a block must hold whole ids")
    count = F.ceil(F.col("bytes") / block_bytes)
    blocks = files.filter("bytes > 0").select(
        "path", "bytes", F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1)).alias("block")
    )
    # The rows are tiny but each stands for a block to read, so they are dealt out.
    tasks = max(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = blocks.repartition(tasks, "path", "block")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, block in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                with open_path(path) as handle:
                    handle.seek(block * block_bytes)
                    raw = handle.read(min(block_bytes, size - block * block_bytes))
                ids = np.frombuffer(raw, dtype="<u2")
                ends = np.flatnonzero(ids == end_id)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path]), pa.array([block], pa.int64()), pa.array([len(ends)], pa.int64()),
                        pa.array([int(ends[0]) if len(ends) else 0], pa.int64()),
                        pa.array([np.diff(ends) - 1 if len(ends) else []], pa.list_(pa.int64())),
                        pa.array([len(ids) - int(ends[-1]) - 1 if len(ends) else len(ids)], pa.int64()),
                    ],
                    ["path", "block", "ends", "head", "inner", "tail"],
                )

    return dealt.mapInArrow(
        work, "path string, block bigint, ends bigint, head bigint, inner array<bigint>, tail bigint"
    )


def document_counts(files: DataFrame, end_id: int = END_ID, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``path, number, n_tokens`` for each document of the files, numbered from 0 in each.

    Per block, running sums over the blocks before it give the number of documents
    ended there and the ids carried over since the last end: all tails so far, less all
    tails so far at the last block with an end. Ids after a file's last end are a
    document too; an empty file has none.
    """
    blocks = scan_blocks(files, end_id, block_bytes)
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("path").orderBy("block")
    zero = F.lit(0).cast("bigint")
    summed = blocks.withColumns({
        "number": F.coalesce(F.sum("ends").over(before), zero),
        "tails": F.coalesce(F.sum("tail").over(before), zero),
        "last": F.lead("block").over(later).isNull(),
    })
    reset = F.max(F.when(F.col("ends") > 0, F.col("tails"))).over(before)
    carried = summed.withColumn("carry", F.col("tails") - F.coalesce(reset, zero))
    counts = F.concat(
        F.when(F.col("ends") > 0, F.array(F.col("head") + F.col("carry"))).otherwise(F.array().cast("array<bigint>")),
        F.col("inner"),
        F.when(
            F.col("last") & (F.col("tail") + F.when(F.col("ends") > 0, zero).otherwise(F.col("carry")) > 0),
            F.array(F.col("tail") + F.when(F.col("ends") > 0, zero).otherwise(F.col("carry"))),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    return carried.select("path", "number", F.posexplode(counts).alias("place", "n_tokens")).select(
        "path", (F.col("number") + F.col("place")).alias("number"), "n_tokens"
    )


def count_tokens(
    docs: DataFrame, folder: str | None = None, tokenizer: str = "byte_bpe_multi_50k", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``doc_id, n_tokens`` for each row of ``docs``, counted in the flat files of their ids.

    A null or empty text has no ids and counts 0; equal rows count each for itself; rows
    without doc_id keep the null; a text longer than a block runs over several; other
    columns are not read; an empty table gives an empty table.
    """
    spark: SparkSession = docs.sparkSession
    written = write_token_files(docs, folder or scratch_path(spark, "tokens"), tokenizer)
    files = written.filter("bytes > 0").select("path", "bytes")
    names = written.select("path", "first", F.posexplode("doc_ids").alias("place", "doc_id")).select(
        "path", (F.col("first") + F.col("place")).alias("number"), "doc_id"
    )
    # Both sides unfold from a few packed rows, so their size is not what Spark estimates
    # from the files and a broadcast would grow with the documents.
    counts = document_counts(files, block_bytes=block_bytes)
    return names.hint("merge").join(counts, ["path", "number"]).select("doc_id", "n_tokens")
