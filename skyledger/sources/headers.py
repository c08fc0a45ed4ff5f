"""Columns of delimited files found by the names in each file's own header."""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.schema import text_schema
from skyledger.session import materialise, send_code_with_tasks
from skyledger.sources.paths import file_system, spread_members

send_code_with_tasks(__name__)

# Quotes inside a quoted field are doubled, not backslash-escaped.
CSV_OPTIONS = {"header": "true", "escape": '"'}


#: Bytes read at a time, and at most, in search of a header's end.
HEAD_BYTES, HEADER_BYTES = 1 << 16, 1 << 20


class MissingColumnsError(ValueError):
    """A requested column is not in the header."""


def header_names(line: str) -> list[str]:
    """The names in a header line, without a byte order mark."""
    return next(csv.reader([line.removeprefix("\ufeff").replace("\n", " ").replace("\r", " ")]), [])


def _first_line(stream) -> str:
    """The header line at the head of an open stream."""
    start = b""
    while b"\n" not in start and len(start) < HEADER_BYTES:
        more = stream.read(HEAD_BYTES)
        if not more:
            break
        start += more
    return start.partition(b"\n")[0].decode("utf-8", "replace").rstrip("\r")


def header_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Stored ``path, header`` of each file below ``path`` that is not empty.

    Tasks read the first bytes of each file, unpacked where its name says so; the file
    listing is spread over them first.
    """
    def headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for place in batch["path"]:
                system, inner = file_system(place)
                with system.open_input_stream(inner, buffer_size=HEAD_BYTES) as stream:
                    rows.append((place, _first_line(stream)))
            yield pd.DataFrame(rows, columns=["path", "header"])

    files = spark.read.format("binaryFile").load(path).select("path")
    found = spread_members(files, "delimited-files").mapInPandas(headers, "path string, header string")
    return materialise(found.filter("header <> ''"), "headers")


def positions(names: list[str], fields) -> list[int]:
    """Where the fields are in a header; the first place of a name that occurs twice."""
    absent = [field for field in fields if field not in names]
    if absent:
        raise MissingColumnsError(f"Usecols do not match the header: no column {', '.join(absent)}")
    return [names.index(field) for field in fields]


def scan_by_position(
    spark: SparkSession, paths, names: list[str], fields, multi_line: bool = False, extra: list[Column] = ()
) -> DataFrame:
    """The fields as text, from files that all have the header ``names``.

    Columns are read under names of their own, so a header may name one twice; only those
    of the fields are parsed.
    """
    schema = text_schema([f"_{i}" for i in range(len(names))])
    rows = spark.read.schema(schema).options(**CSV_OPTIONS, multiLine=str(multi_line).lower()).csv(paths)
    wanted = [F.col(f"_{i}").alias(field) for i, field in zip(positions(names, fields), fields)]
    return rows.select(*wanted, *extra)
