"""The batch questions over the cleaned flights."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from skyledger.operators.delays import by_delay
from skyledger.operators.features import offline_features
from skyledger.operators.ranking import rank_within
from skyledger.operators.selection import active_flights
from skyledger.operators.totals import (
    ORIGIN_CARRIER,
    ROUTE,
    WEEKDAY,
    busiest_from_totals,
    delay_totals,
    mean_from_totals,
    of_grouping,
)
from skyledger.plans.clean import CLEANED_PATH
from skyledger.session import materialise
from skyledger.sinks.tables import write_table
from skyledger.sources.tables import read_table

# Names of the stored results.
ANALYTICS_DIR = "data/analytics"
BUSIEST_TABLE = "q1_1_busiest_airports.parquet"
TOP_CARRIERS_TABLE = "q2_1_top_airlines_by_airport.parquet"
FEATURES_TABLE = "ml_features.parquet"


@dataclass
class Answers:
    """The five results, each ordered where its question asks for an order."""

    busiest_airports: DataFrame
    delay_by_carrier: DataFrame
    delay_by_weekday: DataFrame
    top_carriers: DataFrame
    top_destinations: DataFrame


def answers_from_totals(totals: DataFrame) -> Answers:
    """All five questions from the totals per grouping."""
    by_carrier = of_grouping(totals, ORIGIN_CARRIER)
    by_weekday = of_grouping(totals, WEEKDAY)

    def ranked(grouping):
        means = mean_from_totals(of_grouping(totals, grouping), grouping, "DepDelay", known_only=True)
        return rank_within(means, *grouping)

    return Answers(
        busiest_airports=busiest_from_totals(totals),
        delay_by_carrier=by_delay(mean_from_totals(by_carrier, "UniqueCarrier"), "UniqueCarrier"),
        delay_by_weekday=by_delay(mean_from_totals(by_weekday, "DayOfWeek"), "DayOfWeek"),
        top_carriers=ranked(ORIGIN_CARRIER),
        top_destinations=ranked(ROUTE),
    )


def answer_questions(flights: DataFrame) -> Answers:
    """Scan the active flights once into stored totals and answer from there."""
    return answers_from_totals(materialise(delay_totals(active_flights(flights)), "delay-totals"))


def run_analytics(
    spark: SparkSession, source: str = CLEANED_PATH, target: str = ANALYTICS_DIR
) -> Answers:
    """Answer the questions and store the busiest airports, the top carriers and
    the offline feature rows."""
    flights = read_table(spark, source)
    answers = answer_questions(flights)
    write_table(answers.busiest_airports, f"{target}/{BUSIEST_TABLE}")
    write_table(answers.top_carriers, f"{target}/{TOP_CARRIERS_TABLE}")
    write_table(offline_features(flights), f"{target}/{FEATURES_TABLE}")
    return answers
