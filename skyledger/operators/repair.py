"""Filling, adding and dropping incomplete values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.schema import DELAY_MEASURES


def ensure_columns(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Add the columns that are absent, each with its constant."""
    defaults = dict.fromkeys(DELAY_MEASURES, 0.0) if defaults is None else defaults
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})


def fill_missing(df: DataFrame, values: dict | None = None) -> DataFrame:
    """Replace null, and NaN in floating columns, by a constant per column.

    Works on batch and streaming tables alike. ``coalesce`` would leave a NaN in
    place, and one NaN turns the mean of its whole group into NaN.
    """
    return df.fillna(dict.fromkeys(DELAY_MEASURES, 0.0) if values is None else values)


def drop_incomplete(df: DataFrame, columns=None) -> DataFrame:
    """Keep rows in which the columns, by default all of them, are known."""
    return df.na.drop(subset=list(columns) if columns else None)
