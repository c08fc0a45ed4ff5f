"""Files made from the driver tables, for the queries that start from files.

They are written by tasks into the shared folder, so their number and size grow
with the tables and nothing is gathered on the driver.
"""

from __future__ import annotations

import shutil
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.session import scratch_path, send_code_with_tasks
from skyledger.sinks.messages import to_messages
from skyledger.sources.archives import find_archives, open_path
from skyledger.sources.delimited import KEEP_TEXT
from skyledger.sources.paths import file_system

send_code_with_tasks(__name__)

# The archives of these years get a second, unreadable member.
SPOILT_YEARS = (1996, 2000)
SPOILT_MEMBER = "Year,Month\n2008,1\n"


def as_raw_text(df: DataFrame) -> DataFrame:
    """Values as text with unknown ones written as the token NA."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("NA")).alias(c) for c in df.columns])


def write_raw_csv(df: DataFrame, label: str = "raw", path: str | None = None) -> str:
    """The table as raw delimited files, beside those that ``path`` holds already."""
    path = path or scratch_path(df.sparkSession, label)
    as_raw_text(df).write.mode("append").option("header", "true").options(**KEEP_TEXT).csv(path)
    return path


def write_messages(df: DataFrame, label: str) -> str:
    """The table as JSON messages of strings, one per line."""
    path = scratch_path(df.sparkSession, label)
    to_messages(as_raw_text(df)).write.text(path)
    return path


def write_output(path: str):
    """Binary output stream for a path as Spark prints it."""
    system, inner = file_system(path)
    system.create_dir(inner.rpartition("/")[0], recursive=True)
    return system.open_output_stream(inner, compression=None)


def write_archives(df: DataFrame, label: str, year: str = "Year") -> str:
    """The table as zip archives of raw delimited files, one per part file.

    The part files are cut by size as usual, so no archive holds an unbounded
    share of the table.
    """
    root = scratch_path(df.sparkSession, label)
    raw = as_raw_text(df).withColumn("pack", F.col(year))
    (
        raw.hint("rebalance", F.col("pack"))
        .write.option("header", "true")
        .options(**KEEP_TEXT)
        .partitionBy("pack")
        .csv(f"{root}/csv")
    )
    parts = find_archives(df.sparkSession, f"{root}/csv", ".csv")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            packed = []
            for part in batch["archive"]:
                folder, _, name = part.rpartition("/")
                base, _, value = folder.rpartition("/csv/pack=")
                archive = f"{base}/zip/flights_{value}_{name.removesuffix('.csv')}.zip"
                with write_output(archive) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as zipped:
                    with open_path(part) as source, zipped.open("flights.csv", "w") as member:
                        shutil.copyfileobj(source, member)
                    if int(value) in SPOILT_YEARS:
                        zipped.writestr("more.csv", SPOILT_MEMBER)
                packed.append(archive)
            yield pd.DataFrame({"archive": packed})

    parts.mapInPandas(pack, "archive string").write.parquet(f"{root}/packed")
    return f"{root}/zip"
