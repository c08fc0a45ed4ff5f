"""Parsing flight messages and keeping mean delays per group."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from skyledger.functions.text import to_number
from skyledger.operators.repair import fill_missing
from skyledger.schema import STREAM_FIELDS, text_schema
from skyledger.session import freeing_shuffles
from skyledger.sinks.live import KEY_NAME, KEY_VALUE
from skyledger.streaming.seen_records import first_of_each_id

# The groups whose running delay is kept. Complete mode holds every
# group for as long as the query lives, so keys must have few values, as these do.
LIVE_KEYS = ("UniqueCarrier", "DayOfWeek")


def parse_messages(
    messages: DataFrame, fields=STREAM_FIELDS, numeric=("ArrDelay",), value: str = "value"
) -> DataFrame:
    """Message bytes to columns; unknown or unreadable numbers become 0.0.

    The publisher sends every value as a JSON string. A field declared double
    would be null for such a value and then 0.0 after the fill, so all fields are
    read as text and the numeric ones converted afterwards. A message that is not
    a JSON object gives a row of nulls.
    """
    parsed = messages.select(
        F.from_json(F.col(value).cast("string"), text_schema(fields)).alias("data")
    ).select("data.*")
    typed = parsed.withColumns({c: to_number(F.col(c)) for c in numeric})
    return fill_missing(typed, dict.fromkeys(numeric, 0.0))


def running_delay(df: DataFrame, key: str, measure: str = "ArrDelay") -> DataFrame:
    """Mean delay and number of flights per key.

    The count is of known keys, so the group of unreadable messages shows a null
    key and 0 flights. Each micro-batch is reduced to one row per key and task
    before it reaches the state store.
    """
    return df.groupBy(key).agg(
        F.avg(measure).alias("AvgDelay"), F.count(key).alias("NrFlights")
    )


def running_delays(df: DataFrame, keys=LIVE_KEYS, measure: str = "ArrDelay") -> DataFrame:
    """Mean delay and number of flights for the values of several keys, in one aggregation.

    Each row is unfolded into a pair of key name and value per key, so the rows are read and
    parsed once for all keys and one state store holds all groups. Each task reduces its
    pairs to one row per key and value before they are shuffled.
    """
    pairs = F.array(*[
        F.struct(F.lit(key).alias(KEY_NAME), F.col(key).cast("string").alias(KEY_VALUE)) for key in keys
    ])
    unfolded = df.select(F.col(measure), F.inline(pairs))
    return unfolded.groupBy(KEY_NAME, KEY_VALUE).agg(
        F.avg(measure).alias("AvgDelay"), F.count(KEY_VALUE).alias("NrFlights")
    )


def without_repeats(df: DataFrame, record_id: str, within: str, columns=None) -> DataFrame:
    """The rows without those whose ``record_id`` was seen before, in any micro-batch of the
    last ``within``. Rows without an id all stay. The state holds the ids of twice that time,
    as numbers of a file's rows where they end in one (:mod:`skyledger.streaming.seen_records`).
    ``columns`` are those that are needed further on, all by default."""
    begin = "timestamp'1970-01-01 00:00:00Z'"
    span = df.sparkSession.range(1).select(F.unix_millis(F.expr(f"{begin} + interval {within}"))).first()[0]
    return first_of_each_id(df, record_id, 2 * span, columns)


def start_live_tables(
    messages: DataFrame,
    sink: Callable[[DataFrame], DataStreamWriter],
    keys=LIVE_KEYS,
    available_now: bool = False,
    measure: str = "ArrDelay",
    record_id: str | None = None,
    within: str = "1 hour",
) -> StreamingQuery:
    """Start one query that reads the messages once and keeps the delays of all keys.

    With ``record_id``, a field of the messages, a message that arrives again ``within`` that
    time does not count again, so a publisher may send a batch twice.
    """
    fields = (*keys, measure) if record_id is None else (*keys, measure, record_id)
    parsed = parse_messages(messages, fields=fields, numeric=(measure,))
    if record_id is not None:
        parsed = without_repeats(parsed, record_id, within, (*keys, measure))
    writer = sink(running_delays(parsed, keys, measure))
    if available_now:
        writer = writer.trigger(availableNow=True)
    with freeing_shuffles(messages.sparkSession):  # a query keeps the settings it begins with
        return writer.start()


def start_live_delays(
    messages: DataFrame,
    sink: Callable[[DataFrame, str], DataStreamWriter],
    keys=LIVE_KEYS,
    available_now: bool = False,
    measure: str = "ArrDelay",
) -> list[StreamingQuery]:
    """Start one query per key over the same source, for keys that must be stopped and
    restarted apart; :func:`start_live_tables` reads the source once for all.

    ``sink`` takes the running table and the key and returns the writer. Each
    query has its own offsets, state and checkpoint, so each can restart alone, and
    takes from the messages only the fields it needs.
    """
    queries = []
    for key in keys:
        parsed = parse_messages(messages, fields=(key, measure), numeric=(measure,))
        writer = sink(running_delay(parsed, key, measure), key)
        if available_now:
            writer = writer.trigger(availableNow=True)
        queries.append(writer.start())
    return queries


def wait_for_any(spark: SparkSession, timeout: int | None = None) -> bool | None:
    """Block until one query of the session ends."""
    return spark.streams.awaitAnyTermination(timeout)


def wait_for_all(queries: list[StreamingQuery], timeout: float | None = None) -> None:
    """Block until all queries have ended, however long it takes; stop the rest on
    failure, or after ``timeout`` seconds where a caller sets a limit."""
    deadline = None if timeout is None else time.monotonic() + timeout
    try:
        for query in queries:
            if deadline is None:
                query.awaitTermination()
            elif not query.awaitTermination(max(1, int(deadline - time.monotonic()))):
                raise TimeoutError(f"query {query.id} still running after {timeout} s")
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
