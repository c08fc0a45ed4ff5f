import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from skyledger.schema import flight_schema  # noqa: E402
from skyledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_flights(spark):
    """Flights from dicts; columns that no row names are null."""

    def make(rows, columns=None):
        columns = columns or sorted({c for row in rows for c in row})
        schema = flight_schema(columns)
        return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], schema)

    return make


@pytest.fixture
def raw_flights(make_flights):
    """Three flights on three days, one without actual times."""
    columns = (
        "Year", "Month", "DayofMonth", "DayOfWeek", "DepTime", "CRSDepTime", "ArrTime",
        "CRSArrTime", "UniqueCarrier", "FlightNum",
    )
    values = [
        (2011, 3, 7, 1, 617, 610, 748, 735, "QX", 4410),
        (2011, 3, 9, 3, None, 2005, None, 2140, "ZY", 512),
        (2011, 11, 30, 3, 1244, 1230, 1351, 1355, "KV", 77),
    ]
    return make_flights([dict(zip(columns, v)) for v in values], columns)


def rows_of(df):
    """Rows as a sorted list of plain tuples; nulls sort first."""
    return sorted(
        (tuple(row) for row in df.collect()),
        key=lambda row: tuple((v is not None, str(type(v)) if v is None else v) for v in row),
    )
