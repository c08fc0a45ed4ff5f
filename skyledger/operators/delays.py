"""Mean delays per group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.flights import MEAN_DIGITS, rounded_mean


def mean_delay(
    df: DataFrame, keys, measure: str = "ArrDelay", digits: int = MEAN_DIGITS, name: str = "avg_delay"
) -> DataFrame:
    """Rounded mean of ``measure`` per key.

    Each task reduces its rows to one sum and count per key before the shuffle,
    so a key that holds a large share of all rows costs no more than another.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(rounded_mean(F.col(measure), digits).alias(name))


def by_delay(means: DataFrame, key: str, name: str = "avg_delay") -> DataFrame:
    """Lowest mean first; the key makes the order total."""
    return means.orderBy(F.asc(name), F.asc(key))
