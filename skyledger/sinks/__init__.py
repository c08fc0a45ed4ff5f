"""Writers: tables, day files with their manifest, messages, run log, live tables."""

from skyledger.sinks.day_files import (
    day_manifest,
    publish_day_files,
    read_day_files,
    read_published_days,
    write_day_files,
)
from skyledger.sinks.live import (
    changed_groups_sink,
    console_sink,
    console_tables_sink,
    latest_groups,
    live_tables_sink,
    memory_sink,
    read_live_table,
)
from skyledger.sinks.messages import publish_batch, publish_stream, to_messages
from skyledger.sinks.run_log import append_run, read_runs, run_entries
from skyledger.sinks.tables import preview, write_table

__all__ = [
    "append_run",
    "changed_groups_sink",
    "console_sink",
    "console_tables_sink",
    "day_manifest",
    "latest_groups",
    "live_tables_sink",
    "memory_sink",
    "preview",
    "publish_batch",
    "publish_day_files",
    "publish_stream",
    "read_day_files",
    "read_live_table",
    "read_published_days",
    "read_runs",
    "run_entries",
    "to_messages",
    "write_day_files",
    "write_table",
]
