import glob

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from skyledger.schema import ARCHIVE_FIELDS, flight_schema
from skyledger.sinks import day_manifest, read_day_files, write_day_files


def test_three_rows_on_three_days(spark, raw_flights, tmp_path):
    manifest = rows_of(day_manifest(raw_flights, prefix="prefix").select("key", "rows"))
    assert manifest[0] == ("prefix/2011/03/2011_03_07.csv", 1)
    assert len(manifest) == 3 and sum(n for _, n in manifest) == 3
    path = write_day_files(raw_flights, str(tmp_path / "out"))
    assert len(glob.glob(f"{path}/y=*/m=*/d=*/part-*")) == 3
    back = read_day_files(spark, path, flight_schema(ARCHIVE_FIELDS))
    assert rows_of(back) == rows_of(raw_flights)


def test_files_keep_the_date_columns(raw_flights, tmp_path):
    path = write_day_files(raw_flights, str(tmp_path / "out"))
    (part,) = glob.glob(f"{path}/y=2011/m=03/d=2011_03_09/part-*")
    assert open(part).read() == ",".join(ARCHIVE_FIELDS) + "\n2011,3,9,3,,2005,,2140,ZY,512\n"


def test_only_touched_days_are_replaced(spark, raw_flights, make_flights, tmp_path):
    path = write_day_files(raw_flights, str(tmp_path / "out"))
    new = {"Year": 2011, "Month": 3, "DayofMonth": 7, "UniqueCarrier": "UA", "FlightNum": 9}
    write_day_files(make_flights([new], ARCHIVE_FIELDS), path)
    back = read_day_files(spark, path, flight_schema(ARCHIVE_FIELDS))
    assert rows_of(back.select("UniqueCarrier", "FlightNum")) == [("KV", 77), ("UA", 9), ("ZY", 512)]


def test_a_day_far_larger_than_the_others_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(0, 200_000, 1, 16).select(
        F.lit(2008).alias("Year"),
        F.lit(1).alias("Month"),
        F.when(F.col("id") % 3 == 0, 1 + F.col("id") % 28).otherwise(5).cast("int").alias("DayofMonth"),
        F.sha2(F.col("id").cast("string"), 512).alias("TailNum"),
    )
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        path = write_day_files(rows, str(tmp_path / "out"))
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert len(glob.glob(f"{path}/y=2008/m=01/d=2008_01_05/part-*")) > 4
    back = read_day_files(spark, path, rows.schema)
    assert back.agg(F.count("*"), F.sum(F.xxhash64("TailNum").cast("decimal(38)"))).first() == rows.agg(
        F.count("*"), F.sum(F.xxhash64("TailNum").cast("decimal(38)"))
    ).first()


def test_layout_columns_may_not_collide(raw_flights, tmp_path):
    with pytest.raises(ValueError, match="layout"):
        write_day_files(raw_flights.withColumn("Y", F.lit(1)), str(tmp_path / "out"))


def test_text_comes_back_as_it_was(spark, make_flights, tmp_path):
    texts = [" WN ", "a\nb", 'say "x", y', "\tZ"]
    rows = [{"Year": 2008, "Month": 1, "DayofMonth": 1, "UniqueCarrier": t, "FlightNum": i} for i, t in enumerate(texts)]
    path = write_day_files(make_flights(rows, ARCHIVE_FIELDS), str(tmp_path / "out"))
    back = read_day_files(spark, path, flight_schema(ARCHIVE_FIELDS), multi_line=True)
    assert rows_of(back.select("FlightNum", "UniqueCarrier")) == list(enumerate(texts))
