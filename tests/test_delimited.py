import pytest

from skyledger.functions import MISSING_TOKENS
from skyledger.plans import run_clean
from skyledger.schema import ARCHIVE_FIELDS
from skyledger.sources import (
    MissingColumnsError,
    MissingSourceError,
    read_flight_csv,
    read_flight_fields,
    read_table,
    read_text_records,
)


def write(path, text):
    path.write_text(text)
    return str(path)


def test_tokens_types_quotes_and_extra_columns(spark, tmp_path):
    source = write(
        tmp_path / "f.csv",
        'Year,UniqueCarrier,ArrDelay,FlightNum,Note\n'
        '2008,WN,-14,101,"said ""hi"", twice"\n'
        '2008.0,NA,NA,202,n/a\n'
        ',"","12.5",,\n',
    )
    df = read_flight_csv(spark, source)
    assert dict(df.dtypes) == {
        "Year": "int", "UniqueCarrier": "string", "ArrDelay": "double",
        "FlightNum": "bigint", "Note": "string",
    }
    assert [tuple(r) for r in df.collect()] == [
        (2008, "WN", -14.0, 101, 'said "hi", twice'),
        (2008, None, None, 202, None),
        (None, None, 12.5, None, None),
    ]


def test_every_missing_token_in_a_file(spark, tmp_path):
    lines = "".join(f'"{token}",1\n' for token in MISSING_TOKENS)
    source = write(tmp_path / "f.csv", "ArrDelay,Month\n" + lines + "7,1\n")
    got = [r[0] for r in read_flight_csv(spark, source).select("ArrDelay").collect()]
    assert got == [None] * len(MISSING_TOKENS) + [7.0]


def test_short_rows_are_padded(spark, tmp_path):
    source = write(tmp_path / "f.csv", "Year,Month,ArrDelay\n2008,1\n")
    assert tuple(read_flight_csv(spark, source).first()) == (2008, 1, None)


def test_projection_by_header_name(spark, tmp_path):
    names = ["Extra", *reversed(ARCHIVE_FIELDS)]
    values = ["x", "101", "WN", "1600", "1600", "1430", "1430", "2", "15", "1", "2008"]
    source = write(tmp_path / "f.csv", ",".join(names) + "\n" + ",".join(values) + "\n")
    df = read_flight_fields(spark, source)
    assert df.columns == list(ARCHIVE_FIELDS)
    assert tuple(df.first()) == (2008, 1, 15, 2, 1430, 1430, 1600, 1600, "WN", 101)


def test_missing_column_is_an_error(spark, tmp_path):
    source = write(tmp_path / "f.csv", "Year,Month\n2008,1\n")
    with pytest.raises(MissingColumnsError, match="DayofMonth"):
        read_flight_fields(spark, source)


def test_files_with_another_column_order_are_refused(spark, tmp_path):
    write(tmp_path / "a.csv", "Year,Month\n2008,1\n")
    write(tmp_path / "b.csv", "Month,Year\n1,2008\n")
    with pytest.raises(Exception, match="does not conform"):
        read_flight_csv(spark, str(tmp_path)).collect()


def test_columns_are_found_by_name_in_each_file(spark, tmp_path):
    """Two orders, a further and a repeated column, a byte order mark, an empty and a packed file."""
    import gzip

    write(tmp_path / "a.csv", "Year,Month\n2008,1\n2008,2\n")
    write(tmp_path / "b.csv", "Note,Month,Year,Month\n\"x,y\",3,2009,99\n")
    write(tmp_path / "c.csv", "\ufeffYear,Month\r\n2010,4\r\n")
    write(tmp_path / "d.csv", "")
    with gzip.open(tmp_path / "e.csv.gz", "wt") as packed:
        packed.write("Month,Year\n5,2011\n")
    df = read_flight_fields(spark, str(tmp_path), ("Year", "Month"))
    assert sorted(tuple(r) for r in df.collect()) == [(2008, 1), (2008, 2), (2009, 3), (2010, 4), (2011, 5)]
    write(tmp_path / "f.csv", "Year\n2012\n")
    with pytest.raises(MissingColumnsError, match="Month"):
        read_flight_fields(spark, str(tmp_path), ("Year", "Month"))


def test_missing_path_names_the_input(spark, tmp_path):
    for read in (read_flight_csv, read_text_records, read_table):
        with pytest.raises(MissingSourceError, match="nowhere"):
            read(spark, str(tmp_path / "nowhere"))


def test_text_records_keep_blanks_and_tokens(spark, tmp_path):
    source = write(tmp_path / "f.csv", "UniqueCarrier,ArrDelay\nNA,\n,-14\n")
    assert [tuple(r) for r in read_text_records(spark, source).collect()] == [("NA", ""), ("", "-14")]


def test_clean_adds_and_fills_delays(spark, tmp_path):
    source = write(tmp_path / "f.csv", "Year,ArrDelay,Tag\n2008,NA,a\n2008,5,b\n")
    cleaned = run_clean(spark, source, str(tmp_path / "out"))
    assert cleaned.columns == ["Year", "ArrDelay", "Tag", "DepDelay"]
    assert sorted(tuple(r) for r in cleaned.collect()) == [
        (2008, 0.0, "a", 0.0), (2008, 5.0, "b", 0.0),
    ]
