"""Integer codes for text categories, in sorted order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.session import materialise

# Fixed value: the text an unknown category takes; it sorts among the others.
UNKNOWN_CATEGORY = "None"


def category_text(column: str):
    return F.coalesce(F.col(column).cast("string"), F.lit(UNKNOWN_CATEGORY))


def number_in_order(
    df: DataFrame, order: str, name: str, group: str, slices: int | None = None
) -> DataFrame:
    """Number each group's rows 0, 1, ... in the order of a column, in parallel.

    ``group`` and ``order`` together are unique, and groups are few while one may
    hold nearly all rows. A rank per group would be computed by one task for each.
    Here the rows are cut into ordered slices that ignore where groups begin; each
    slice is numbered on its own and moved up by its group's rows in the slices
    before it. The slices are stored first: range borders come from sampling, and a
    recomputed slice must not get different ones.
    """
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = materialise(
        df.repartitionByRange(slices, group, order).withColumn("slice", F.spark_partition_id()),
        "ordered",
    )
    # Slices are ranges, so a group begins in one and runs on: there are fewer
    # (group, slice) pairs than groups plus slices, whatever the size of the data.
    sizes = sliced.groupBy(group, "slice").agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.partitionBy(group).orderBy("slice")) - F.col("size")
    starts = sizes.select(group, "slice", before.alias("start"))
    within = F.row_number().over(Window.partitionBy(group, "slice").orderBy(order))
    return (
        sliced.withColumn("place", within)
        .join(starts, [group, "slice"])
        .withColumn(name, F.col("start") + F.col("place") - 1)
        .drop("slice", "place", "start")
    )


def category_codes(df: DataFrame, *columns: str, slices: int | None = None) -> DataFrame:
    """``column, category, code``: the distinct values of each column, sorted and
    numbered from 0. One scan serves all columns, and each task reduces its rows to
    its distinct values before anything is shuffled."""
    texts = [category_text(c).alias(c) for c in columns]
    categories = df.select(*texts).unpivot([], list(columns), "column", "category").distinct()
    return number_in_order(categories, "category", "code", "column", slices)


def attach_codes(df: DataFrame, codes: DataFrame, column: str, name: str) -> DataFrame:
    """Add the code of a column; a category not in ``codes`` gets the next free code.

    The code list is stored first, so its size is known when the join is planned:
    it is broadcast only while that size allows it, and otherwise a frequent
    category's rows are split over tasks by adaptive execution.
    """
    own = materialise(
        codes.filter(F.col("column") == column).select("category", F.col("code").alias(name)),
        "codes",
    )
    coded = df.join(own, category_text(column) == F.col("category"), "left").drop("category")
    return coded.withColumn(name, F.coalesce(F.col(name), F.lit(own.count())))
