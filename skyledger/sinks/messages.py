"""Publishing rows as JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyledger.sources.messages import DEFAULT_BROKERS, DEFAULT_TOPIC


def to_messages(df: DataFrame) -> DataFrame:
    """One JSON object per row in column ``value``; nulls are written, not left out."""
    record = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(F.to_json(record, {"ignoreNullFields": "false"}).alias("value"))


def kafka_target(brokers: str = DEFAULT_BROKERS, topic: str = DEFAULT_TOPIC) -> dict[str, str]:
    """Options of the Kafka writer."""
    return {"kafka.bootstrap.servers": brokers, "topic": topic}


def publish_batch(df: DataFrame, format: str = "kafka", path: str | None = None, **options) -> None:
    """Send every row once. With ``kafka`` pass :func:`kafka_target`; ``text`` writes
    one message per line, which :func:`skyledger.sources.file_messages` reads."""
    writer = to_messages(df).write.format(format).options(**options)
    if format != "kafka":
        writer = writer.mode("append")
    writer.save(path)


def publish_stream(
    df: DataFrame,
    checkpoint: str,
    format: str = "kafka",
    path: str | None = None,
    every: str | None = None,
    **options,
) -> StreamingQuery:
    """Send the rows of a stream, batch by batch as its source cuts them.

    Without ``every`` the batches follow one another and the query ends with the
    input. With it (``"500 milliseconds"``) a batch is sent per interval, which
    limits the rate, and the query goes on until it is stopped.
    """
    writer = (
        to_messages(df)
        .writeStream.format(format)
        .options(**options)
        .option("checkpointLocation", checkpoint)
    )
    if every is None:
        return writer.trigger(availableNow=True).start(path)
    return writer.trigger(processingTime=every).start(path)
