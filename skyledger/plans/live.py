"""Running mean delays from a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from skyledger.session import scratch_path
from skyledger.sinks.live import console_tables_sink, live_tables_sink
from skyledger.sources.messages import kafka_messages
from skyledger.streaming.live_delays import LIVE_KEYS, start_live_tables


def run_live(
    spark: SparkSession,
    messages: DataFrame | None = None,
    tables: str | None = None,
    checkpoint: str | None = None,
    keys=LIVE_KEYS,
    available_now: bool = False,
    record_id: str | None = None,
    within: str = "1 hour",
    **source_options,
) -> list[StreamingQuery]:
    """Start the running aggregates of all keys and return their one query, in a list.

    ``messages`` defaults to the Kafka topic. Results go to the console, or with ``tables``
    to versioned tables there, which :func:`skyledger.sinks.read_live_table` reads. The
    checkpoint is kept below ``tables`` too unless another place is given, so a restarted
    job goes on from where it was; the console alone needs a place to be given for that.
    With ``record_id`` messages that come again ``within`` that time count once.
    """
    messages = kafka_messages(spark, **source_options) if messages is None else messages
    place = checkpoint or (f"{tables}/_checkpoint" if tables else scratch_path(spark, "live"))

    def sink(running):
        if tables is None:
            return console_tables_sink(running, place, keys)
        return live_tables_sink(running, tables, place)

    return [start_live_tables(messages, sink, keys, available_now, record_id=record_id, within=within)]
