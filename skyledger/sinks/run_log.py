"""Parameters and metrics of training runs, kept as a Parquet table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.sources.tables import read_table

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("experiment", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)


def run_entries(
    spark: SparkSession, run_id: str, experiment: str, params: dict, metrics: DataFrame
) -> DataFrame:
    """Rows of one run; ``metrics`` is a one-row table with a column per metric."""
    constants = spark.createDataFrame(
        [(run_id, experiment, "param", str(k), str(v)) for k, v in params.items()], RUN_SCHEMA
    )
    measured = metrics.unpivot(
        [], [F.col(c).cast("double").alias(c) for c in metrics.columns], "key", "measured"
    ).select(
        F.lit(run_id).alias("run_id"),
        F.lit(experiment).alias("experiment"),
        F.lit("metric").alias("kind"),
        "key",
        F.col("measured").cast("string").alias("value"),
    )
    return constants.unionByName(measured)


def append_run(entries: DataFrame, path: str) -> str:
    """Add a run's rows to the log; earlier runs stay."""
    entries.coalesce(1).write.mode("append").parquet(path)
    return path


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, RUN_SCHEMA)
