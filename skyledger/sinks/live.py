"""Sinks for running aggregates. All restart from an explicit checkpoint."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from skyledger.sinks.commits import Commits
from skyledger.sources.tables import MissingSourceError

#: Columns of the running delays of several keys, and what a batch is stored by.
KEY_NAME, KEY_VALUE = "key_name", "key_value"


def console_sink(running: DataFrame, checkpoint: str, mode: str = "complete") -> DataStreamWriter:
    """Print the whole, untruncated result after every micro-batch."""
    return (
        running.writeStream.outputMode(mode)
        .format("console")
        .option("truncate", "false")
        .option("checkpointLocation", checkpoint)
    )


def memory_sink(running: DataFrame, checkpoint: str, name: str, mode: str = "complete"):
    """Keep the result as a temporary view on the driver; for few groups only."""
    return (
        running.writeStream.outputMode(mode)
        .format("memory")
        .queryName(name)
        .option("checkpointLocation", checkpoint)
    )


def console_tables_sink(running: DataFrame, checkpoint: str, keys, rows: int = 1000) -> DataStreamWriter:
    """Print the running table of each key after every micro-batch."""

    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"-------- Batch: {batch_id} --------")
        for key in keys:
            _of_key(batch, key).show(rows, truncate=False)

    return (
        running.writeStream.queryName("console-tables").outputMode("complete")
        .option("checkpointLocation", checkpoint).foreachBatch(show)
    )


def _of_key(batch: DataFrame, key: str) -> DataFrame:
    rows = batch.filter(F.col(KEY_NAME) == key).drop(KEY_NAME)
    return rows.withColumnRenamed(KEY_VALUE, key)


def live_tables_sink(running: DataFrame, path: str, checkpoint: str, keep: int = 2) -> DataStreamWriter:
    """Keep the complete running tables of all keys, one version per micro-batch.

    A batch writes a folder of its own, parted by key, and then commits it by one file.
    :func:`read_live_table` takes the last committed one, so it always sees whole tables, of
    one batch for all keys. A batch replayed after a failure that its commit survived
    changes nothing. The last ``keep`` versions stay for readers that have begun.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        commits = Commits(spark, path)
        mark = {"query": spark.sparkContext.getLocalProperty("sql.streaming.queryId"), "batch": batch_id}
        last = commits.last()
        if last and {name: last[name] for name in mark} == mark:
            return
        folder = f"v-{uuid.uuid4().hex}"
        batch.write.partitionBy(KEY_NAME).parquet(f"{path}/{folder}")
        commits.add(mark | {"folder": folder, "schema": batch.schema.jsonValue()})
        commits.forget(keep)

    return running.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(store)


def read_live_table(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The running table of one key as of the last committed batch."""
    last = Commits(spark, path).last()
    if last is None:
        raise MissingSourceError(f"no committed batch below {path}")
    rows = spark.read.schema(StructType.fromJson(last["schema"]))
    return _of_key(rows.parquet(f"{path}/{last['folder']}"), key)


def changed_groups_sink(running: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Store, per micro-batch, only the groups it changed.

    For keys with very many values, where writing every group each time would cost
    more than the batch itself. A replayed batch replaces its own folder.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        running.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
    )


def latest_groups(changes: DataFrame, key: str) -> DataFrame:
    """The current state from stored changes: each group as of its last batch."""
    values = [c for c in changes.columns if c not in (key, "batch")]
    last = F.max_by(F.struct(*values), F.col("batch")).alias("last")
    return changes.groupBy(key).agg(last).select(key, "last.*")
