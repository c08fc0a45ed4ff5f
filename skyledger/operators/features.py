"""Rows for the delay model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.flights import is_delayed, scheduled_hour, split_bucket
from skyledger.operators.repair import drop_incomplete
from skyledger.operators.selection import active_flights
from skyledger.schema import MODEL_CATEGORICAL, MODEL_NUMERIC, OFFLINE_FEATURES

# Seed of the split and the share of the training side.
SPLIT_SEED = 42
SPLIT_BUCKETS = 10
TRAIN_BUCKETS = 8

# A flight's natural key. Every part is included so that no single value, however
# frequent, can pull its rows to one side of the split.
ROW_KEY = (
    "Year", "Month", "DayofMonth", "UniqueCarrier", "FlightNum", "CRSDepTime", "Origin", "Dest",
)


def offline_features(df: DataFrame, columns=OFFLINE_FEATURES) -> DataFrame:
    """Complete cases of the feature columns, cancelled flights included."""
    return drop_incomplete(df.select(*columns))


def with_split(
    df: DataFrame,
    keys=ROW_KEY,
    train_buckets: int = TRAIN_BUCKETS,
    buckets: int = SPLIT_BUCKETS,
    seed: int = SPLIT_SEED,
) -> DataFrame:
    """Add ``bucket`` from a hash of the row key and ``in_train``."""
    bucket = split_bucket(*[F.col(k) for k in keys], buckets=buckets, seed=seed)
    return df.withColumn("bucket", bucket).withColumn("in_train", F.col("bucket") < train_buckets)


def split_counts(df: DataFrame) -> DataFrame:
    """Rows per bucket of a split table."""
    return df.groupBy("bucket", "in_train").agg(F.count("*").alias("rows"))


def delay_features(
    df: DataFrame, carry=(), numeric=MODEL_NUMERIC, categorical=MODEL_CATEGORICAL
) -> DataFrame:
    """Active flights with label ``IsDelayed`` and the model inputs.

    Flights without a scheduled departure have no hour and are left out;
    :func:`rows_without_hour` counts them.
    """
    usable = active_flights(df, required=True).filter(F.col("CRSDepTime").isNotNull())
    derived = usable.withColumns(
        {
            "IsDelayed": is_delayed(F.col("ArrDelay")),
            "DepHour": scheduled_hour(F.col("CRSDepTime")),
        }
    )
    return derived.select(*numeric, *categorical, "IsDelayed", *carry)


def rows_without_hour(df: DataFrame) -> DataFrame:
    """One row: how many active flights :func:`delay_features` leaves out."""
    missing = active_flights(df, required=True).filter(F.col("CRSDepTime").isNull())
    return missing.agg(F.count("*").alias("rows"))


def collapse_rows(df: DataFrame, weight: str = "weight") -> DataFrame:
    """Equal rows become one row with their number as weight.

    The inputs are a few columns of few values each, so a training table of any
    length shrinks to its distinct combinations, already within each task. A
    weighted learner or metric gives the same result on it.
    """
    return df.groupBy(*df.columns).agg(F.count("*").cast("double").alias(weight))
