"""Train, evaluate, log and store the delay model."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators import boosting
from skyledger.operators.features import (
    ROW_KEY,
    collapse_rows,
    delay_features,
    rows_without_hour,
    with_split,
)
from skyledger.operators.metrics import classification_metrics, roc_auc
from skyledger.plans.clean import CLEANED_PATH
from skyledger.schema import MODEL_CATEGORICAL, MODEL_NUMERIC
from skyledger.session import dealt_evenly, materialise
from skyledger.sinks.run_log import append_run, run_entries
from skyledger.sources.tables import read_table

# Experiment and model names.
EXPERIMENT = "Flight_Delay_Prediction"
MODEL_NAME = "flight-delay-model"


@dataclass
class Trained:
    model: boosting.DelayModel
    metrics: DataFrame
    scored: DataFrame


def training_table(flights: DataFrame, keys=ROW_KEY) -> DataFrame:
    """Stored, weighted distinct model rows with their side of the split.

    One scan of the flights; all boosting rounds and the evaluation then work on
    this table.
    """
    rows = delay_features(with_split(flights, keys), carry=("in_train",))
    return materialise(collapse_rows(rows), "training-rows")


def train_and_evaluate(
    table: DataFrame,
    numeric=MODEL_NUMERIC,
    categorical=MODEL_CATEGORICAL,
    fit_on: str = "train",
    **model_options,
) -> Trained:
    """Fit on the training side and measure on the other.

    ``fit_on="all"`` also takes the category labels of test rows, ``"train"``
    leaves unseen ones to the extra code.
    """
    train, test = table.filter("in_train"), table.filter("NOT in_train")
    model = boosting.fit_delay_model(
        train, numeric, categorical, weight="weight",
        label_rows=table if fit_on == "all" else None, **model_options,
    )
    scored = materialise(boosting.score_flights(model, dealt_evenly(test), categorical), "scored-rows")
    area = roc_auc(scored, weight="weight").first()["roc_auc"]
    metrics = classification_metrics(scored, weight="weight").withColumn(
        "roc_auc", F.lit(area).cast("double")
    )
    return Trained(model, metrics, scored)


def run_training(
    spark: SparkSession,
    source: str = CLEANED_PATH,
    target: str = "data/models",
    run_id: str | None = None,
    fit_on: str = "train",
    **model_options,
) -> Trained:
    """From the cleaned table to a stored model and its entry in the run log."""
    flights = read_table(spark, source)
    table = training_table(flights)
    trained = train_and_evaluate(table, fit_on=fit_on, **model_options)
    params = {
        "loss": "logistic",
        "categories": "sorted codes as numbers",
        "max_bins": boosting.MAX_BINS,
        "max_depth": boosting.MAX_DEPTH,
        "learning_rate": boosting.LEARNING_RATE,
        "trees": boosting.TREES,
        "seed": boosting.SEED,
        "fit_on": fit_on,
        "rows_without_hour": rows_without_hour(flights).first()["rows"],
    } | model_options
    entries = run_entries(
        spark, run_id or uuid.uuid4().hex, EXPERIMENT, params, trained.metrics
    )
    append_run(entries, f"{target}/runs")
    boosting.save_model(trained.model, f"{target}/{MODEL_NAME}")
    return trained
