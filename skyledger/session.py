"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf, cloudpickle
from pyspark.sql import DataFrame, SparkSession

# Adaptive execution does the run-time work the operators count on: it splits
# skewed join and rebalance partitions, merges small ones and switches to a
# broadcast join once a side's real size is known to be under the threshold.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "skyledger", master: str | None = None, **conf) -> SparkSession:
    """Get or create a session; settings given at submit time win over defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    submitted = SparkConf()
    for key, value in SESSION_DEFAULTS.items():
        if submitted.get(key) is None:
            builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def send_code_with_tasks(module_name: str) -> None:
    """Send a module's functions along with the tasks that call them, so that
    executors need not have this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster that
    folder would exist on one machine only.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="skyledger-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/skyledger/{label}-{uuid.uuid4().hex}"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries begun here give up their shuffle files when they end. Otherwise these lie on the
    executors' disks until the driver next collects garbage, beside those of what runs then."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


# A task that wrote far more than the others leaves several files, so that the next
# stage can share its rows out again.
MAX_FILE_ROWS = 5_000_000


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    The table outlives lost executors, so whatever is built on it restarts from
    a columnar file scan and never from the beginning of the lineage.
    """
    path = scratch_path(df.sparkSession, label)
    with freeing_shuffles(df.sparkSession):
        df.write.option("maxRecordsPerFile", MAX_FILE_ROWS).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Rows of a slice whose rows are all held in memory, or scored, by one task.
SLICE_ROWS = 500_000


def dealt_evenly(df: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The rows of a stored table in slices of equal size, for work that costs much per row.

    A scan cuts a table by its bytes on disk. Where rows pack to a few bytes, that gives
    fewer and less even tasks than there are cores. Here there are at least two slices per
    core, and none has many more than ``slice_rows`` rows, whatever the size of the table.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(2 * cores, -(-df.count() // slice_rows)))
