"""Parquet tables and the guard for sources that do not exist."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


class MissingSourceError(FileNotFoundError):
    """The input path does not exist."""


@contextmanager
def source_guard(path: str):
    """Turn Spark's path-not-found error into one that names the missing input."""
    try:
        yield
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingSourceError(f"no data at {path}") from error
        raise


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Scan a Parquet table; columns and filters used later are pushed into the scan."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    with source_guard(path):
        return reader.parquet(path)
