"""The gradient-boosted delay classifier, a model of MLlib."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.categories import attach_codes, category_codes
from skyledger.operators.tree_growth import GrownTrees
from skyledger.schema import MODEL_CATEGORICAL, MODEL_NUMERIC
from skyledger.session import dealt_evenly, materialise, shared_folder

# The model's parameters.
MAX_DEPTH = 6
LEARNING_RATE = 0.1
TREES = 100
SEED = 42
MAX_BINS = 256


@dataclass
class DelayModel:
    """The trees and the codes of the categories they were trained with."""

    trees: PipelineModel
    codes: DataFrame


def with_codes(df: DataFrame, codes: DataFrame, columns=MODEL_CATEGORICAL) -> DataFrame:
    """Add each column's code as a number; a value without one gets the next code."""
    for column in columns:
        df = attach_codes(df, codes, column, f"{column}_code")
    return df


def fit_delay_model(
    train: DataFrame,
    numeric=MODEL_NUMERIC,
    categorical=MODEL_CATEGORICAL,
    label: str = "IsDelayed",
    weight: str | None = None,
    label_rows: DataFrame | None = None,
    trees: int = TREES,
    max_depth: int = MAX_DEPTH,
    learning_rate: float = LEARNING_RATE,
    seed: int = SEED,
) -> DelayModel:
    """Number the categories, then fit boosted trees on numbers and codes.

    A code is a value's rank among the sorted values, a number like any other feature, so
    columns of few and of many values are treated alike and no list of values reaches the
    driver. Codes are those of the training rows, or of ``label_rows`` to number the
    values of all rows. Pass weighted distinct rows (``collapse_rows``): trees see the
    same sums, on far fewer rows.
    """
    numeric, categorical = list(numeric), list(categorical)
    shared_folder(train.sparkSession)  # boosting cuts its lineage there
    codes = materialise(category_codes(train if label_rows is None else label_rows, *categorical), "codes")
    assembler = VectorAssembler(inputCols=numeric + [f"{c}_code" for c in categorical], outputCol="features")
    trees_stage = GBTClassifier(
        featuresCol="features", labelCol=label, maxDepth=max_depth, stepSize=learning_rate,
        maxIter=trees, lossType="logistic", seed=seed, maxBins=MAX_BINS,
    )
    if weight:
        trees_stage = trees_stage.setWeightCol(weight)
    # Stored, so that the boosting rounds read numbers instead of joining again, and dealt
    # evenly, as each round passes several times over what its tasks hold in memory.
    coded = materialise(with_codes(train, codes, categorical), "coded-rows")
    return DelayModel(Pipeline(stages=[assembler, GrownTrees(trees_stage)]).fit(dealt_evenly(coded)), codes)


def score_flights(model: DelayModel, df: DataFrame, categorical=MODEL_CATEGORICAL) -> DataFrame:
    """The rows with ``prediction`` (0/1) and ``probability`` of a late arrival."""
    scored = model.trees.transform(with_codes(df, model.codes, categorical))
    return scored.select(
        *df.columns,
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("probability"),
    )


def save_model(model: DelayModel, path: str) -> str:
    """Store the trees and, beside them, the codes."""
    model.trees.write().overwrite().save(f"{path}/trees")
    model.codes.write.mode("overwrite").parquet(f"{path}/codes")
    return path


def load_model(path: str) -> DelayModel:
    codes = SparkSession.active().read.parquet(f"{path}/codes")
    return DelayModel(PipelineModel.load(f"{path}/trees"), codes)
