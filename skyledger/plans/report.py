"""Tables behind the two charts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.flights import minutes_label, thousands
from skyledger.operators.ranking import best_at
from skyledger.plans.analytics import ANALYTICS_DIR, BUSIEST_TABLE, TOP_CARRIERS_TABLE
from skyledger.sinks.tables import write_table
from skyledger.sources.tables import read_table

# Bars per chart and the airport of the second chart.
BARS = 5
CHART_AIRPORT = "SFO"


def busiest_chart(busiest: DataFrame, bars: int = BARS) -> DataFrame:
    """The busiest airports with their bar labels."""
    top = busiest.orderBy(F.desc("total_flights"), "airport").limit(bars)
    return top.select("airport", "total_flights", thousands(F.col("total_flights")).alias("label"))


def punctual_chart(ranked: DataFrame, airport: str = CHART_AIRPORT, bars: int = BARS) -> DataFrame:
    """The most punctual carriers at one airport with their bar labels."""
    best = best_at(ranked, airport, bars)
    return best.select("UniqueCarrier", "avg_delay", minutes_label(F.col("avg_delay")).alias("label"))


def run_report(
    spark: SparkSession, source: str = ANALYTICS_DIR, target: str | None = None, airport: str = CHART_AIRPORT
) -> tuple[DataFrame, DataFrame]:
    """Build both chart tables from the stored answers and store them."""
    target = target or f"{source}/visuals"
    busiest = busiest_chart(read_table(spark, f"{source}/{BUSIEST_TABLE}"))
    punctual = punctual_chart(read_table(spark, f"{source}/{TOP_CARRIERS_TABLE}"), airport)
    write_table(busiest, f"{target}/1_busiest_airports.parquet")
    write_table(punctual, f"{target}/2_punctual_carriers.parquet")
    return busiest, punctual
