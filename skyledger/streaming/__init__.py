"""Continuous delay aggregates over a stream of flight messages."""

from skyledger.streaming.query_log import QueryLog
from skyledger.streaming.live_delays import (
    LIVE_KEYS,
    parse_messages,
    running_delay,
    running_delays,
    start_live_delays,
    start_live_tables,
    wait_for_all,
    wait_for_any,
    without_repeats,
)

__all__ = [
    "LIVE_KEYS",
    "parse_messages",
    "QueryLog",
    "running_delay",
    "running_delays",
    "start_live_delays",
    "start_live_tables",
    "wait_for_all",
    "wait_for_any",
    "without_repeats",
]
