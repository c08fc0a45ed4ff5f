"""Quality of a binary classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.session import materialise


def classification_metrics(
    df: DataFrame, label: str = "IsDelayed", prediction: str = "prediction", weight: str | None = None
) -> DataFrame:
    """One row: the confusion counts and accuracy, precision and recall from them.

    One aggregate over the scored rows. A ratio with nothing below the line is 0. A row
    without a prediction is one that was not flagged.
    """
    amount = F.col(weight) if weight else F.lit(1)
    positive, flagged = F.col(label) == 1, F.coalesce(F.col(prediction) == 1, F.lit(False))

    def total(condition, name):
        return F.coalesce(F.sum(F.when(condition, amount)), F.lit(0)).cast("double").alias(name)

    counts = df.agg(
        total(positive & flagged, "tp"),
        total(~positive & flagged, "fp"),
        total(positive & ~flagged, "fn"),
        total(~positive & ~flagged, "tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def ratio(part, whole):
        return F.when(whole == 0, F.lit(0.0)).otherwise(F.try_divide(part, whole))

    return counts.select(
        "tp", "fp", "fn", "tn",
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
    )


def roc_auc(
    df: DataFrame, label: str = "IsDelayed", score: str = "probability", weight: str | None = None,
    slices: int | None = None,
) -> DataFrame:
    """One row ``roc_auc``: exact area under the curve, null unless both classes occur.

    The area is the share of (late, punctual) pairs whose late row has the higher score,
    equal scores counting half. Rows are reduced to one per score, with the weight of either
    class. Ordered slices of the scores, cut without regard to how often one occurs, are
    summed up on their own and then moved up by the slices below, so no task sees more
    scores than a slice holds. The slices are stored first, as their borders come from
    sampling. Rows without label or score are left out.
    """
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    amount = (F.col(weight) if weight else F.lit(1)).cast("double")
    late = F.col(label).cast("double") == 1.0

    def total(condition, name):
        return F.coalesce(F.sum(F.when(condition, amount)), F.lit(0.0)).alias(name)

    by_score = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull()).groupBy(
        F.col(score).cast("double").alias("score")
    ).agg(total(late, "late"), total(~late, "punctual"))
    sliced = materialise(
        by_score.repartitionByRange(slices, "score").withColumn("slice", F.spark_partition_id()), "scores"
    )
    sizes = sliced.groupBy("slice").agg(F.sum("punctual").alias("size"))
    below = F.sum("size").over(Window.orderBy("slice")) - F.col("size")
    starts = sizes.select("slice", below.alias("start"))
    before = F.sum("punctual").over(Window.partitionBy("slice").orderBy("score")) - F.col("punctual")
    pairs = sliced.withColumn("before", before).join(starts, "slice").select(
        "late", "punctual", (F.col("late") * (F.col("start") + F.col("before") + F.col("punctual") / 2)).alias("won")
    )
    sums = pairs.agg(*[F.sum(c).alias(c) for c in ("late", "punctual", "won")])
    both = (F.col("late") > 0) & (F.col("punctual") > 0)
    return sums.select(F.when(both, F.col("won") / (F.col("late") * F.col("punctual"))).alias("roc_auc"))
