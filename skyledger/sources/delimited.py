"""Delimited flight files.

Everything is scanned as text and typed afterwards, so no pass over the data is
spent on inferring types and a stray token can not change a column's type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.text import to_typed
from skyledger.schema import ARCHIVE_FIELDS, FLIGHT_COLUMNS, text_schema
from skyledger.sources.headers import CSV_OPTIONS, MissingColumnsError, header_catalogue, header_names, scan_by_position
from skyledger.sources.tables import source_guard

# For writers, which otherwise cut off blanks around a value.
KEEP_TEXT = {
    "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def _scan_text(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All columns of the header as strings.

    The names come from one header line. ``enforceSchema=false`` then makes each
    file's own header be compared with them, as Spark would otherwise assign the
    columns of a differently ordered file by position.
    """
    options = {**CSV_OPTIONS, "multiLine": str(multi_line).lower()}
    with source_guard(path):
        names = spark.read.options(**options).csv(path).columns
        return (
            spark.read.schema(text_schema(names))
            .options(**options, enforceSchema="false")
            .csv(path)
        )


def read_flight_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Every column of the file: known flight columns typed, others kept as text."""
    raw = _scan_text(spark, path, multi_line)
    return raw.select(
        *[to_typed(F.col(f"`{c}`"), FLIGHT_COLUMNS.get(c, "string")).alias(c) for c in raw.columns]
    )


def read_flight_fields(
    spark: SparkSession, path: str, fields=ARCHIVE_FIELDS, multi_line: bool = False
) -> DataFrame:
    """Only the named columns, found by name in each file's own header.

    Files may differ in the order and number of their columns: there is a scan per distinct
    header, of the columns asked for, and the scans are united by name. A file without one
    of the columns is an error; an empty file has no rows. ``multi_line`` allows line breaks
    in quoted values, and stops files being split.
    """
    with source_guard(path):
        catalogue = header_catalogue(spark, path)
    headers = [r.header for r in catalogue.select("header").distinct().collect()]
    united = None
    for header in sorted(headers):
        paths = path
        if len(headers) > 1:
            paths = [r.path for r in catalogue.filter(F.col("header") == header).select("path").collect()]
        try:
            rows = scan_by_position(spark, paths, header_names(header), fields, multi_line)
        except MissingColumnsError as error:
            raise MissingColumnsError(f"{path}: {error}") from None
        united = rows if united is None else united.unionByName(rows)
    if united is None:
        raise MissingColumnsError(f"{path} has no header")
    return type_fields(united, fields)


def type_fields(df: DataFrame, fields=ARCHIVE_FIELDS) -> DataFrame:
    """Give text columns the flight types, keeping any other column as it is."""
    typed = {c: to_typed(F.col(c), FLIGHT_COLUMNS.get(c, "string")) for c in fields}
    return df.withColumns(typed)


def read_text_records(spark: SparkSession, path: str) -> DataFrame:
    """Rows exactly as written, every value a string and blank fields ``''``.

    This is the publisher's view: no missing-value tokens, no types.
    """
    raw = _scan_text(spark, path)
    return raw.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in raw.columns])

