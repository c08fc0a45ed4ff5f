"""Readers: tables, delimited text, zip archives and message streams."""

from skyledger.sources.archives import find_archives, list_members, read_unpacked, unpack_members
from skyledger.sources.delimited import (
    MissingColumnsError,
    read_flight_csv,
    read_flight_fields,
    read_text_records,
)
from skyledger.sources.messages import file_messages, kafka_messages, text_record_stream
from skyledger.sources.paced_records import record_stream
from skyledger.sources.tables import MissingSourceError, read_table

__all__ = [
    "MissingColumnsError",
    "MissingSourceError",
    "file_messages",
    "find_archives",
    "kafka_messages",
    "list_members",
    "read_flight_csv",
    "read_flight_fields",
    "read_table",
    "read_text_records",
    "read_unpacked",
    "record_stream",
    "text_record_stream",
    "unpack_members",
]
