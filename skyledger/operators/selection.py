"""Row filters. All are plain predicates, so they reach the file scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def active_flights(df: DataFrame, cancelled: str = "Cancelled", required: bool = False) -> DataFrame:
    """Flights that were not cancelled; an unknown flag is not kept.

    A table without the flag passes through, unless ``required`` makes the
    missing column an error.
    """
    if cancelled not in df.columns:
        if required:
            raise ValueError(f"no column {cancelled}")
        return df
    return df.filter(F.col(cancelled) == 0)


def departed_flights(
    df: DataFrame, delay: str = "DepDelay", cancelled: str = "Cancelled"
) -> DataFrame:
    """Active flights whose departure delay is known."""
    return active_flights(df, cancelled).filter(F.col(delay).isNotNull())


def at_airport(df: DataFrame, airport: str, column: str = "Origin") -> DataFrame:
    """Rows of one airport."""
    return df.filter(F.col(column) == F.lit(airport))
