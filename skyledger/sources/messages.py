"""Streams of flight messages and of raw text records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.schema import text_schema
from skyledger.sources.delimited import CSV_OPTIONS
from skyledger.sources.tables import source_guard

# Defaults of the message feed.
DEFAULT_BROKERS = "localhost:9092"
DEFAULT_TOPIC = "flight_telemetry"


def kafka_options(
    brokers: str = DEFAULT_BROKERS,
    topic: str = DEFAULT_TOPIC,
    starting_offsets: str = "earliest",
    max_per_trigger: int | None = None,
    min_tasks: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka reader.

    ``max_per_trigger`` bounds one micro-batch. ``min_tasks`` cuts the offset range
    of a topic partition that holds most of the messages into several tasks.
    """
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if min_tasks is not None:
        options["minPartitions"] = str(min_tasks)
    return options


def kafka_messages(spark: SparkSession, **options) -> DataFrame:
    """Stream of a topic's messages; needs the Spark Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(**options)).load()


def file_messages(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of messages kept one per line in files, in the shape of the Kafka source."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    with source_guard(path):
        return reader.load(path).select(F.col("value").cast("binary").alias("value"))


def text_record_stream(
    spark: SparkSession, path: str, columns, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream the rows of delimited files as they arrive, values as written."""
    reader = spark.readStream.schema(text_schema(columns)).options(
        **CSV_OPTIONS, enforceSchema="false"
    )
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    with source_guard(path):
        raw = reader.csv(path)
    return raw.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns])
