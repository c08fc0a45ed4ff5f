"""One pass over the flights for all batch questions.

The five questions need totals per route, per origin and carrier, and per
weekday. Grouping sets compute the three side by side in one scan, so the flights
are neither read five times nor cached. Each task keeps one row per route, per
origin-carrier pair and per weekday; grouping by all four columns at once would
need the product of their values instead, which a task's rows hardly reduce to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.flights import MEAN_DIGITS
from skyledger.operators.airports import airport_totals
from skyledger.schema import DELAY_MEASURES

ROUTE = ("Origin", "Dest")
ORIGIN_CARRIER = ("Origin", "UniqueCarrier")
WEEKDAY = ("DayOfWeek",)
GROUPINGS = (ROUTE, ORIGIN_CARRIER, WEEKDAY)


def _all_keys(groupings) -> list[str]:
    return list(dict.fromkeys(key for grouping in groupings for key in grouping))


def delay_totals(
    df: DataFrame, groupings=GROUPINGS, measures=DELAY_MEASURES, flight: str = "FlightNum"
) -> DataFrame:
    """Flight count, and sum and number of known values per measure, for each grouping.

    ``grouping`` tells the groupings apart; the keys a grouping does not use are null.
    """
    totals = [F.grouping_id().alias("grouping"), F.count(flight).alias("flights")]
    for measure in measures:
        totals += [F.sum(measure).alias(f"sum_{measure}"), F.count(measure).alias(f"known_{measure}")]
    return df.groupingSets([list(g) for g in groupings], *_all_keys(groupings)).agg(*totals)


def of_grouping(totals: DataFrame, grouping, groupings=GROUPINGS) -> DataFrame:
    """The totals of one grouping. Spark numbers a grouping by the keys it leaves out."""
    number = 0
    for key in _all_keys(groupings):
        number = number * 2 + (key not in grouping)
    return totals.filter(F.col("grouping") == number)


def mean_from_totals(
    totals: DataFrame, keys, measure: str = "ArrDelay", known_only: bool = False, digits: int = MEAN_DIGITS
) -> DataFrame:
    """Rounded mean per key; ``known_only`` leaves out groups without a known value."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    sums = totals.groupBy(*keys).agg(
        F.sum(f"sum_{measure}").alias("total"), F.sum(f"known_{measure}").alias("known")
    )
    if known_only:
        sums = sums.filter(F.col("known") > 0)
    return sums.select(*keys, F.round(F.try_divide("total", "known"), digits).alias("avg_delay"))


def busiest_from_totals(totals: DataFrame) -> DataFrame:
    """Airports by departures plus arrivals, most first, from the totals per route."""
    return airport_totals(of_grouping(totals, ROUTE), *ROUTE, "flights")
