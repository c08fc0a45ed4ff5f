"""Delimited files partitioned by calendar day, and the manifest of what was written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.flights import day_file_key
from skyledger.schema import DATE_KEY, text_schema
from skyledger.session import materialise
from skyledger.sources.delimited import KEEP_TEXT
from skyledger.sources.headers import CSV_OPTIONS
from skyledger.sources.tables import source_guard

# Directory columns. They are derived, so the files keep every original column.
LAYOUT = {"y": "%04d", "m": "%02d", "d": "%04d_%02d_%02d"}


def _with_layout(df: DataFrame, date_key) -> DataFrame:
    taken = {c.lower() for c in df.columns} & set(LAYOUT)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are used for the directory layout")
    day = F.format_string(LAYOUT["d"], *[F.col(c).cast("int") for c in date_key])
    return df.withColumns(
        {
            "y": F.substring_index(day, "_", 1),
            "m": F.substring_index(F.substring_index(day, "_", 2), "_", -1),
            "d": day,
        }
    )


def write_day_files(df: DataFrame, path: str, date_key=DATE_KEY) -> str:
    """Write one directory per day, replacing only the days present in ``df``.

    The rebalance hint brings a day's rows together so that a day gives few
    files, but lets adaptive execution cut a day that is far larger than the
    others into several tasks and files. A plain repartition by day would send
    such a day to a single task.

    Rows whose date is not known belong to no day; drop them first.
    """
    by_day = df.hint("rebalance", *[F.col(c) for c in date_key])
    (
        _with_layout(by_day, date_key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", "true")
        .options(**KEEP_TEXT)
        .partitionBy(*LAYOUT)
        .csv(path)
    )
    return path


def read_day_files(spark: SparkSession, path: str, schema, multi_line: bool = False) -> DataFrame:
    """Read written days back; ``schema`` is that of the files. Values with line breaks
    need ``multi_line``, which stops files being split."""
    with source_guard(path):
        files = spark.read.schema(schema).options(**CSV_OPTIONS, multiLine=multi_line).csv(path)
    return files.drop(*LAYOUT)


def day_manifest(
    df: DataFrame, prefix: str = "", bucket: str = "", date_key=DATE_KEY, counted: str | None = None
) -> DataFrame:
    """What the writer stores per day: ``bucketname, key, path, rows``.

    ``key`` is the logical name of the day, ``path`` the directory holding its
    part files. The sum of ``rows`` is the number of lines written. Only the date
    columns are scanned, and each task reduces its rows to one per day. ``counted`` names
    a column of row counts where ``df`` has been counted already.
    """
    year, month, day = date_key
    amount = F.sum(counted) if counted else F.count("*")
    days = df.groupBy(*date_key).agg(amount.alias("rows"))
    layout = F.format_string(
        "/".join(f"{name}={pattern}" for name, pattern in LAYOUT.items()),
        F.col(year), F.col(month), F.col(year), F.col(month), F.col(day),
    )
    root = prefix.rstrip("/") + "/" if prefix else ""
    return days.select(
        F.lit(bucket).alias("bucketname"),
        day_file_key(F.col(year), F.col(month), F.col(day), prefix).alias("key"),
        F.concat(F.lit(root), layout).alias("path"),
        "rows",
    )


def _day_key(day: str) -> str:
    """``2008/01/2008_01_15.csv`` for ``2008_01_15``."""
    return f"{'/'.join(day.split('_')[:2])}/{day}.csv"


def publish_day_files(df: DataFrame, target: str, bucket: str = "", date_key=DATE_KEY) -> DataFrame:
    """Write ``df`` so that each day lies under its key, and tell what lies there.

    The days are written beside the others first. Only when all of them are complete is
    each moved to ``target/2008/01/2008_01_15.csv``, a folder of part files that readers
    open by that name; days that are not in ``df`` stay. A run that fails before has
    changed nothing, and one that fails while moving is simply run again. The manifest
    (``bucketname, key, path, files, rows``) is counted from the files then found under
    the keys. The driver moves one folder per day.
    """
    spark = df.sparkSession
    target = target.rstrip("/")
    staging = f"{target}/_staging-{uuid.uuid4().hex}"
    write_day_files(df, staging, date_key)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    files = path_of(target).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    days = sorted(
        (found.getPath().getName().removeprefix("d="), found.getPath())
        for found in files.globStatus(path_of(f"{staging}/y=*/m=*/d=*")) or []
    )
    for day, written in days:
        place = path_of(f"{target}/{_day_key(day)}")
        files.mkdirs(place.getParent())
        files.delete(place, True)
        if not files.rename(written, place):
            raise OSError(f"{written} can not be moved to {place}")
    files.delete(path_of(staging), True)
    return published_manifest(spark, target, [day for day, _ in days], df.columns, bucket)


def published_manifest(spark: SparkSession, target: str, days: list[str], columns, bucket: str = "") -> DataFrame:
    """Stored ``bucketname, key, path, files, rows`` of the days, from the files under their keys.

    A task sends one row per file. The key is that of the folder a row was read from.
    """
    keys = [f"{target}/{_day_key(day)}" for day in days]
    if keys:
        rows = spark.read.schema(text_schema(columns)).options(**CSV_OPTIONS, multiLine="true").csv(keys)
    else:
        rows = spark.createDataFrame([], text_schema(columns)).withColumn("_metadata", F.struct(F.lit("").alias("file_path")))
    by_file = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))
    day = F.regexp_extract("file", r"/(\d{4,}_\d\d_\d\d)\.csv/[^/]*$", 1)
    parts = F.split(day, "_")
    key = F.concat(F.lit(f"{target}/"), parts[0], F.lit("/"), parts[1], F.lit("/"), day, F.lit(".csv"))
    counted = by_file.groupBy(key.alias("key")).agg(F.count("*").alias("files"), F.sum("rows").alias("rows"))
    return materialise(
        counted.select(F.lit(bucket).alias("bucketname"), "key", F.col("key").alias("path"), "files", "rows"), "manifest"
    )


def read_published_days(spark: SparkSession, target: str, schema, multi_line: bool = False) -> DataFrame:
    """Rows of all days under their keys."""
    path = f"{target.rstrip('/')}/*/*/*.csv"
    with source_guard(target):
        return spark.read.schema(schema).options(**CSV_OPTIONS, multiLine=multi_line).csv(path)
