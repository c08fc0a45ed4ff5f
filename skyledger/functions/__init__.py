"""Column expressions; each takes and returns Columns and stays in the JVM."""

from skyledger.functions.flights import (
    day_file_key,
    is_delayed,
    minutes_label,
    rounded_mean,
    scheduled_hour,
    split_bucket,
    thousands,
)
from skyledger.functions.text import MISSING_TOKENS, known_text, to_number, to_typed, to_whole

__all__ = [
    "MISSING_TOKENS",
    "day_file_key",
    "is_delayed",
    "known_text",
    "minutes_label",
    "rounded_mean",
    "scheduled_hour",
    "split_bucket",
    "thousands",
    "to_number",
    "to_typed",
    "to_whole",
]
