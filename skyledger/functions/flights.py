"""Flight-specific column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The label threshold in minutes (strictly more is late), the
# rounding of reported means and the name of a day's file below its prefix.
LATE_AFTER_MINUTES = 15
MEAN_DIGITS = 2
DAY_FILE_FORMAT = "%04d/%02d/%04d_%02d_%02d.csv"


def rounded_mean(measure: Column, digits: int = MEAN_DIGITS) -> Column:
    """Aggregate: mean over the known values, rounded half up."""
    return F.round(F.avg(measure), digits)


def is_delayed(delay: Column, minutes: float = LATE_AFTER_MINUTES) -> Column:
    """1 when the delay is known and above the threshold, else 0.

    Spark orders NaN above every number, so a bare comparison would call an
    unknown delay late; null and NaN both count as not late here.
    """
    known = F.nanvl(F.coalesce(delay.cast("double"), F.lit(0.0)), F.lit(0.0))
    return (known > F.lit(float(minutes))).cast("int")


def scheduled_hour(clock: Column) -> Column:
    """Hour of an hhmm integer; 2400 stays hour 24, null stays null."""
    return F.floor(clock / F.lit(100)).cast("int")


def day_file_key(year: Column, month: Column, day: Column, prefix: str = "") -> Column:
    """Zero-padded name of the file that holds one day."""
    name = F.format_string(DAY_FILE_FORMAT, year, month, year, month, day)
    return F.concat(F.lit(prefix.rstrip("/") + "/"), name) if prefix else name


def split_bucket(*keys: Column, buckets: int = 10, seed: int | None = None) -> Column:
    """Bucket 0..buckets-1 from a hash of the row key.

    It depends on the key alone, so a row keeps its bucket when partitions are
    recomputed, reordered or resized; a random number per row would not.
    """
    parts = keys if seed is None else (F.lit(str(seed)), *keys)
    digest = F.md5(F.concat_ws("|", *[k.cast("string") for k in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(buckets)


def thousands(number: Column) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(number, 0)


def minutes_label(number: Column) -> Column:
    """Value label of a delay bar."""
    return F.concat(number.cast("string"), F.lit(" min"))
