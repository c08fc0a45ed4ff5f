"""Scores by walking the nodes of stored trees, apart from the library that grew them.

A second reading of a stored model: what it says of a row can be held against what the
library that trained it says, and rows can be scored where that library is not at hand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.boosting import with_codes
from skyledger.schema import MODEL_CATEGORICAL, MODEL_NUMERIC
from skyledger.session import send_code_with_tasks

send_code_with_tasks(__name__)


def stored_nodes(spark: SparkSession, path: str) -> list[dict[str, np.ndarray]]:
    """The trees of a model that :func:`skyledger.operators.save_model` stored, as arrays.

    Nodes of a tree are in the order of their ids, children named by id. As many numbers as
    the trees have nodes reach the driver: a model's size, whatever it was trained on.
    """
    stage = f"{path}/trees/stages/*"
    # The columns of this table have no names that can be relied on.
    weights = {r[0]: r[-1] for r in spark.read.parquet(f"{stage}/treesMetadata").collect()}
    nodes = spark.read.parquet(f"{stage}/data").select("treeID", "nodeData.*").select(
        "treeID", "id", "prediction", "leftChild", "rightChild", F.col("split.featureIndex").alias("feature"),
        F.try_element_at("split.leftCategoriesOrThreshold", F.lit(1)).alias("threshold"), F.col("split.numCategories").alias("categories"),
    )
    found = nodes.orderBy("treeID", "id").toPandas()
    if (found["categories"] > 0).any():
        raise ValueError("splits by sets of categories are not walked: codes are numbers here")
    trees = []
    for number, tree in found.groupby("treeID", sort=True):
        columns = {c: tree[c].to_numpy() for c in ("prediction", "leftChild", "rightChild", "threshold")}
        columns["feature"] = tree["feature"].fillna(-1).to_numpy(dtype=np.int64)
        trees.append(columns | {"weight": weights[number]})
    return trees


def walk(trees: list[dict], features: np.ndarray) -> np.ndarray:
    """The weighted sum of the trees' values for each row of features."""
    total = np.zeros(len(features))
    for tree in trees:
        at = np.zeros(len(features), dtype=np.int64)
        while True:
            inner = np.flatnonzero(tree["leftChild"][at] >= 0)
            if not len(inner):
                break
            node = at[inner]
            left = features[inner, tree["feature"][node]] <= tree["threshold"][node]
            at[inner] = np.where(left, tree["leftChild"][node], tree["rightChild"][node])
        total += tree["weight"] * tree["prediction"][at]
    return total


def score_by_walking(
    spark: SparkSession, path: str, df: DataFrame, numeric=MODEL_NUMERIC, categorical=MODEL_CATEGORICAL
) -> DataFrame:
    """The rows with ``walked``, the probability of a late arrival by the stored nodes and codes."""
    trees = stored_nodes(spark, path)
    coded = with_codes(df, spark.read.parquet(f"{path}/codes"), categorical)
    inputs = [*numeric, *[f"{c}_code" for c in categorical]]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            margin = walk(trees, batch[inputs].to_numpy(dtype=np.float64))
            yield batch.assign(walked=1 / (1 + np.exp(-2 * margin)))

    schema = ", ".join(f"`{name}` {kind}" for name, kind in coded.dtypes)
    return coded.mapInPandas(work, f"{schema}, walked double").select(*df.columns, "walked")
