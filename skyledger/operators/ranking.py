"""Best groups within a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.operators.delays import mean_delay
from skyledger.operators.selection import at_airport

# Fixed value: places kept per group.
PLACES = 10


def rank_within(
    means: DataFrame, group: str, key: str, n: int = PLACES, measure: str = "avg_delay"
) -> DataFrame:
    """First ``n`` keys of each group by the measure, ties in key order.

    The order is total within a group. Spark cuts every task's rows to ``n`` per
    group before the shuffle (WindowGroupLimit), so the largest group sends ``n``
    rows per task and not all of its keys.
    """
    places = Window.partitionBy(group).orderBy(measure, key)
    return means.withColumn("rank", F.rank().over(places)).filter(F.col("rank") <= n)


def top_per_group(
    df: DataFrame, group: str, key: str, measure: str = "DepDelay", n: int = PLACES
) -> DataFrame:
    """The ``n`` keys with the lowest rounded mean in each group."""
    return rank_within(mean_delay(df, [group, key], measure), group, key, n)


def top_carriers(df: DataFrame, n: int = PLACES) -> DataFrame:
    """Carriers with the lowest mean departure delay at each origin."""
    return top_per_group(df, "Origin", "UniqueCarrier", n=n)


def top_destinations(df: DataFrame, n: int = PLACES) -> DataFrame:
    """Destinations with the lowest mean departure delay from each origin."""
    return top_per_group(df, "Origin", "Dest", n=n)


def best_at(ranked: DataFrame, airport: str, n: int = 5, group: str = "Origin") -> DataFrame:
    """First ``n`` places of one airport, by rank and not by file order."""
    return at_airport(ranked, airport, group).orderBy("rank").limit(n)
