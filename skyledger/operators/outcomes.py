"""What became of each archive, and the rows of those that were read in full."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.schema import DATE_KEY
from skyledger.session import materialise
from skyledger.sources.archives import Unpacked, read_unpacked

OK, ERROR = "OK", "ERROR"


def archive_outcomes(members: DataFrame) -> DataFrame:
    """``archive, status, error`` from the catalogue: OK only when every member was unpacked."""
    failed = F.max(F.col("error").isNotNull().cast("int")) == 1
    return members.groupBy("archive").agg(
        F.when(failed, ERROR).otherwise(OK).alias("status"), F.min("error").alias("error")
    )


def rows_of_good_archives(unpacked: Unpacked, outcomes: DataFrame) -> DataFrame:
    """``member_id`` and text fields of the rows, without those of archives that failed anywhere.

    The members of failed archives are stored first. Their size is then known when the
    anti join is planned, and as long as it is small the rows are not shuffled at all.
    """
    failed = outcomes.filter(F.col("status") == ERROR).select("archive")
    named = unpacked.members.filter("member_id IS NOT NULL").join(failed, "archive", "left_semi")
    stored = materialise(named.select("member_id"), "failed-members")
    return read_unpacked(unpacked).join(stored, "member_id", "left_anti")


def rows_by_day(rows: DataFrame, date_key=DATE_KEY) -> DataFrame:
    """Stored number of rows per member and day, days unknown included: the base of the outcomes.

    Each task sends one row per member and day it saw.
    """
    return materialise(rows.groupBy("member_id", *date_key).agg(F.count("*").alias("rows")), "day-counts")


def with_row_counts(outcomes: DataFrame, unpacked: Unpacked, counts: DataFrame, date_key=DATE_KEY) -> DataFrame:
    """Add how many rows of each archive were read and how many kept, from :func:`rows_by_day`."""
    known = F.lit(True)
    for name in date_key:
        known &= F.col(name).isNotNull()
    by_member = counts.groupBy("member_id").agg(
        F.sum("rows").alias("rows_read"), F.sum(F.when(known, F.col("rows"))).alias("rows_kept")
    )
    members = unpacked.members.select("member_id", "archive").filter("member_id IS NOT NULL")
    by_archive = members.join(by_member, "member_id").groupBy("archive").agg(
        *[F.sum(c).alias(c) for c in ("rows_read", "rows_kept")]
    )
    return outcomes.join(by_archive, "archive", "left").select(
        "archive", "status", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("rows_read", "rows_kept")], "error"
    )


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """Archives and rows per status."""
    return outcomes.groupBy("status").agg(
        F.count("*").alias("archives"),
        F.sum("rows_read").alias("rows_read"),
        F.sum("rows_kept").alias("rows_kept"),
    )
