"""Zip archives to day files, with a manifest and an outcome per archive."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.outcomes import archive_outcomes, rows_by_day, rows_of_good_archives, with_row_counts
from skyledger.operators.repair import drop_incomplete
from skyledger.schema import ARCHIVE_FIELDS, DATE_KEY
from skyledger.session import materialise
from skyledger.sinks.day_files import publish_day_files
from skyledger.sources.archives import (
    Unpacked,
    find_archives,
    list_members,
    open_path,
    spread_members,
    unpack_members,
)
from skyledger.sources.delimited import type_fields


@dataclass
class Ingest:
    """What an ingest run did: a row per archive, a row per day, and the number of rows read,
    kept and dropped as the write itself counted them."""

    outcomes: DataFrame
    manifest: DataFrame
    totals: dict[str, int]


def stage_archives(
    spark: SparkSession, root: str, fields=ARCHIVE_FIELDS, opener: Callable = open_path, **options
) -> Unpacked:
    """Unpack every archive once into part files.

    An archive counts only if all of it could be unpacked, which is known after its last
    member and before anything is parsed.
    """
    members = spread_members(list_members(find_archives(spark, root), opener=opener))
    return unpack_members(members, fields, opener=opener, **options)


def stored_outcomes(unpacked: Unpacked) -> DataFrame:
    """One stored row per archive."""
    return materialise(archive_outcomes(unpacked.members), "archive-outcomes")


def typed_rows(unpacked: Unpacked, outcomes: DataFrame) -> DataFrame:
    """Typed rows of good archives."""
    return type_fields(rows_of_good_archives(unpacked, outcomes), unpacked.fields)


def dated_rows(
    unpacked: Unpacked, outcomes: DataFrame, date_key=DATE_KEY, seen: tuple[Observation, Observation] | None = None
) -> DataFrame:
    """Typed rows of good archives whose date is known. Whatever runs over them also counts
    the rows before and after that condition, where two observations are given."""
    rows = typed_rows(unpacked, outcomes)
    if seen is None:
        return drop_incomplete(rows, date_key)
    rows = rows.observe(seen[0], F.count(F.lit(1)).alias("rows"))
    return drop_incomplete(rows, date_key).observe(seen[1], F.count(F.lit(1)).alias("rows"))


def counted_outcomes(unpacked: Unpacked, outcomes: DataFrame) -> DataFrame:
    """Outcomes with the rows read and kept, counted over the parsed date columns."""
    return with_row_counts(outcomes, unpacked, rows_by_day(typed_rows(unpacked, outcomes)))


def run_ingest(
    spark: SparkSession,
    source: str,
    target: str,
    fields=ARCHIVE_FIELDS,
    bucket: str = "",
    opener: Callable = open_path,
    **options,
) -> Ingest:
    """All archives below ``source`` to day files below ``target`` in one job.

    Archives that share a day end up under the same key: they are united before the
    touched days are replaced, so none overwrites another.
    """
    unpacked = stage_archives(spark, source, fields, opener, **options)
    outcomes = stored_outcomes(unpacked)
    seen = Observation("rows-read"), Observation("rows-kept")
    manifest = publish_day_files(dated_rows(unpacked, outcomes, seen=seen).select(*fields), target, bucket)
    read, kept = (found.get["rows"] for found in seen)
    totals = {"rows_read": read, "rows_kept": kept, "rows_dropped": read - kept}
    return Ingest(outcomes=counted_outcomes(unpacked, outcomes), manifest=manifest, totals=totals)
