"""Traffic per airport."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def departures_by_origin(df: DataFrame, origin: str = "Origin", flight: str = "FlightNum") -> DataFrame:
    return df.groupBy(origin).agg(F.count(flight).alias("total_departing"))


def arrivals_by_dest(df: DataFrame, dest: str = "Dest", flight: str = "FlightNum") -> DataFrame:
    return df.groupBy(dest).agg(F.count(flight).alias("total_arriving"))


def combine_departures_arrivals(
    departures: DataFrame, arrivals: DataFrame, origin: str = "Origin", dest: str = "Dest"
) -> DataFrame:
    """Inner join of the two totals; an airport on one side only is not in the result.

    Both sides hold one row per airport, so no key repeats. No broadcast is
    forced: Spark takes one when the measured size allows it.
    """
    return departures.join(arrivals, F.col(origin) == F.col(dest)).select(
        F.col(origin).alias("airport"),
        (F.col("total_departing") + F.col("total_arriving")).alias("total_flights"),
    )


def airport_totals(routes: DataFrame, origin: str, dest: str, flights: str) -> DataFrame:
    """Departures plus arrivals from per-route totals, for airports that have both.

    Having both is a matter of rows, not of their counts: an airport whose flight
    numbers are all unknown is kept with a total of zero.
    """


    def end(airport, departing):
        return F.struct(
            F.col(airport).alias("airport"),
            F.lit(departing).alias("departing"),
            F.col(flights).alias("flights"),
        )

    ends = routes.select(F.inline(F.array(end(origin, True), end(dest, False))))
    return (
        ends.filter(F.col("airport").isNotNull())
        .groupBy("airport")
        .agg(
            F.sum("flights").alias("total_flights"),
            F.bool_or("departing").alias("departs"),
            F.bool_or(~F.col("departing")).alias("arrives"),
        )
        .filter(F.col("departs") & F.col("arrives"))
        .select("airport", "total_flights")
        .orderBy(F.desc("total_flights"), "airport")
    )


def busiest_airports(
    df: DataFrame, origin: str = "Origin", dest: str = "Dest", flight: str = "FlightNum"
) -> DataFrame:
    """Airports by departures plus arrivals, most first.

    One scan instead of the two of the join form: flights are first counted per
    route, which each task does before anything is shuffled, and only the routes
    are turned into departing and arriving ends.
    """
    routes = df.groupBy(origin, dest).agg(F.count(flight).alias("flights"))
    return airport_totals(routes, origin, dest, "flights")
