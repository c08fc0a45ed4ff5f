"""Delimited flights to a topic."""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from skyledger.session import shared_folder
from skyledger.sinks.messages import kafka_target, publish_batch, publish_stream
from skyledger.sources.delimited import read_text_records
from skyledger.sources.messages import DEFAULT_BROKERS, DEFAULT_TOPIC, text_record_stream
from skyledger.sources.paced_records import record_stream


def publish_checkpoint(spark: SparkSession, source: str, target: str) -> str:
    """A place in the shared folder that is the same for each run from source to target."""
    name = hashlib.sha256(f"{source}\n{target}".encode()).hexdigest()[:32]
    return f"{shared_folder(spark).rstrip('/')}/skyledger/publish-{name}"


def run_publish(
    spark: SparkSession,
    source: str,
    brokers: str = DEFAULT_BROKERS,
    topic: str = DEFAULT_TOPIC,
    format: str = "kafka",
    path: str | None = None,
    files_per_batch: int | None = None,
    records_per_batch: int | None = None,
    checkpoint: str | None = None,
    every: str | None = None,
    compression: str | None = None,
) -> None:
    """Publish every row as a JSON object of strings.

    With ``records_per_batch`` so many records go out at a time, whatever the files' sizes,
    and each carries a ``record_id``; with ``files_per_batch`` so many files; with ``every``
    at most one batch per interval. Otherwise all go at once, limited by the broker. What
    has gone out in batches is noted in the checkpoint. Its place follows from source and
    target where none is given, so a job started again sends only what is new.
    ``compression`` packs message files (``"gzip"``), which a reader unpacks by their names;
    messages of one file are much alike and take about a tenth of the disk then.
    """
    if every is not None and files_per_batch is None and records_per_batch is None:
        raise ValueError("'every' sets the pace of batches, so it needs 'files_per_batch' or 'records_per_batch'")
    if files_per_batch is not None and records_per_batch is not None:
        raise ValueError("give 'files_per_batch' or 'records_per_batch', not both")
    options = kafka_target(brokers, topic) if format == "kafka" else {}
    if compression is not None:
        if format == "kafka":
            raise ValueError("'compression' is for message files; a broker has settings of its own")
        options |= {"compression": compression, "zlib.compress.level": "BEST_SPEED"}
    place = checkpoint or publish_checkpoint(spark, source, path or f"{brokers}/{topic}")
    if records_per_batch is not None:
        # The source admits a batch whenever it is asked, so it can not say when all is read.
        stream = record_stream(spark, source, f"{place}/records", records_per_batch)
        _send_all(publish_stream(stream, f"{place}/state", format, path, every or "0 seconds", **options))
        return
    records = read_text_records(spark, source)
    if files_per_batch is None:
        publish_batch(records, format, path, **options)
        return
    stream = text_record_stream(spark, source, records.columns, files_per_batch)
    query = publish_stream(stream, place, format, path, every, **options)
    if every is None:
        query.awaitTermination()
    else:
        _send_all(query)


def _send_all(query: StreamingQuery) -> None:
    """Let a query that would go on for ever send what there is."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
