"""Column names and types of a flight record."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of the public Data Expo 2009 on-time table, in file
# order, with the type each one is normalised to.
FLIGHT_COLUMNS = {
    "Year": "int",
    "Month": "int",
    "DayofMonth": "int",
    "DayOfWeek": "int",
    "DepTime": "int",
    "CRSDepTime": "int",
    "ArrTime": "int",
    "CRSArrTime": "int",
    "UniqueCarrier": "string",
    "FlightNum": "bigint",
    "TailNum": "string",
    "ActualElapsedTime": "int",
    "CRSElapsedTime": "int",
    "AirTime": "int",
    "ArrDelay": "double",
    "DepDelay": "double",
    "Origin": "string",
    "Dest": "string",
    "Distance": "int",
    "TaxiIn": "int",
    "TaxiOut": "int",
    "Cancelled": "int",
    "CancellationCode": "string",
    "Diverted": "int",
    "CarrierDelay": "double",
    "WeatherDelay": "double",
    "NASDelay": "double",
    "SecurityDelay": "double",
    "LateAircraftDelay": "double",
}

# The projection the archive ingest keeps, the date key it groups
# by, the delay measures the cleaner repairs, the offline feature columns, the
# model inputs and the fields of a streamed record.
ARCHIVE_FIELDS = (
    "Year", "Month", "DayofMonth", "DayOfWeek", "DepTime",
    "CRSDepTime", "ArrTime", "CRSArrTime", "UniqueCarrier", "FlightNum",
)
DATE_KEY = ("Year", "Month", "DayofMonth")
DELAY_MEASURES = ("ArrDelay", "DepDelay")
OFFLINE_FEATURES = (
    "Month", "DayOfWeek", "UniqueCarrier", "Origin", "Dest", "DepDelay", "ArrDelay",
)
MODEL_NUMERIC = ("Month", "DayOfWeek", "DepHour")
MODEL_CATEGORICAL = ("UniqueCarrier", "Origin", "Dest")
STREAM_FIELDS = (
    "Year", "Month", "DayofMonth", "DayOfWeek",
    "Origin", "Dest", "UniqueCarrier", "ArrDelay",
)


def text_schema(columns) -> T.StructType:
    """All-nullable string columns: how raw text is read before it is typed."""
    return T.StructType([T.StructField(name, T.StringType(), True) for name in columns])


def flight_schema(columns=tuple(FLIGHT_COLUMNS)) -> T.StructType:
    """Typed, all-nullable schema of the given flight columns."""
    return T.StructType.fromDDL(", ".join(f"`{c}` {FLIGHT_COLUMNS[c]}" for c in columns))
