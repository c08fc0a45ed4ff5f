import decimal
import math

from conftest import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyledger import functions as fn

SLOW = settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def one_column(spark, values, type_name="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {type_name}")


def test_missing_tokens_become_null(spark):
    df = one_column(spark, [*fn.MISSING_TOKENS, None, "-14", "12.5", "WN", " NA"])
    got = [r[0] for r in df.select(fn.known_text(F.col("x"))).collect()]
    assert got == [None] * (len(fn.MISSING_TOKENS) + 1) + ["-14", "12.5", "WN", " NA"]


def test_numbers_and_whole_numbers(spark):
    df = one_column(spark, ["-14", "12.5", "1430.0", "NA", "abc", "99999999999", None, "7.00", "0.0", "100", "10.50", "NaN"])
    got = df.select(
        fn.to_number(F.col("x")), fn.to_whole(F.col("x")), fn.to_whole(F.col("x"), "bigint")
    ).collect()
    assert [tuple(r) for r in got] == [
        (-14.0, -14, -14),
        (12.5, None, None),
        (1430.0, 1430, 1430),
        (None, None, None),
        (None, None, None),
        (99999999999.0, None, 99999999999),
        (None, None, None),
        (7.0, 7, 7),
        (0.0, 0, 0),
        (100.0, 100, 100),
        (10.5, None, None),
        (None, None, None),
    ]


def test_no_missing_token_reads_as_a_number(spark):
    df = one_column(spark, list(fn.MISSING_TOKENS))
    got = df.select(fn.to_number(F.col("x")), fn.to_whole(F.col("x")), fn.to_whole(F.col("x"), "bigint"))
    assert {tuple(r) for r in got.collect()} == {(None, None, None)}


def test_label_treats_unknown_as_on_time(spark):
    df = one_column(spark, [None, math.nan, 15.0, 15.5, -3.0, math.inf], "double")
    got = [r[0] for r in df.select(fn.is_delayed(F.col("x"))).collect()]
    assert got == [0, 0, 0, 1, 0, 1]


def test_hour_of_clock(spark):
    df = one_column(spark, [5, 1430, 2400, 0, None], "int")
    assert [r[0] for r in df.select(fn.scheduled_hour(F.col("x"))).collect()] == [0, 14, 24, 0, None]


@SLOW
@given(st.lists(st.one_of(st.none(), st.integers(0, 2400)), min_size=1, max_size=20),
       st.lists(st.one_of(st.none(), st.floats(-100, 100)), min_size=1, max_size=20))
def test_label_and_hour_match_plain_python(spark, clocks, delays):
    hours = [r[0] for r in one_column(spark, clocks, "int").select(fn.scheduled_hour(F.col("x"))).collect()]
    assert hours == [None if c is None else c // 100 for c in clocks]
    labels = [r[0] for r in one_column(spark, delays, "double").select(fn.is_delayed(F.col("x"))).collect()]
    assert labels == [int(d is not None and d > 15) for d in delays]


@SLOW
@given(st.lists(st.integers(-5000, 5000), min_size=1, max_size=12))
def test_mean_rounds_the_printed_value_half_up(spark, minutes):
    got = one_column(spark, [float(m) for m in minutes], "double").agg(
        fn.rounded_mean(F.col("x"))
    ).first()[0]
    mean = decimal.Decimal(repr(sum(minutes) / len(minutes)))
    assert got == float(mean.quantize(decimal.Decimal("0.01"), decimal.ROUND_HALF_UP))


def test_half_cents_round_away_from_zero(spark):
    got = one_column(spark, [-1.005], "double").agg(fn.rounded_mean(F.col("x"))).first()[0]
    assert got == -1.01


def test_day_file_key(spark):
    df = spark.createDataFrame([(2008, 1, 15)], "y int, m int, d int")
    key = fn.day_file_key(F.col("y"), F.col("m"), F.col("d"), "prefix/")
    assert df.select(key).first()[0] == "prefix/2008/01/2008_01_15.csv"


def test_bar_labels(spark):
    df = spark.createDataFrame([(1234567, -1.5)], "n bigint, x double")
    got = df.select(fn.thousands(F.col("n")), fn.minutes_label(F.col("x"))).first()
    assert tuple(got) == ("1,234,567", "-1.5 min")


def test_split_bucket_depends_on_the_key_only(spark):
    df = spark.range(2000).select("id", F.lit("WN").alias("c"))
    bucket = fn.split_bucket(F.col("c"), F.col("id"), seed=42).alias("b")
    once = rows_of(df.select("id", bucket))
    assert rows_of(df.repartition(13).select("id", bucket)) == once
    sizes = [sum(1 for _, b in once if b == i) for i in range(10)]
    assert min(sizes) > 140 and sum(sizes) == 2000


def test_missing_tokens_never_meet_a_cast(spark):
    """A cast that fails raises an error within Spark; a column of tokens would raise one per row."""
    cast = fn.to_whole(F.col("x"))
    df = one_column(spark, [*fn.MISSING_TOKENS, None, "7"])
    assert [r[0] for r in df.select(cast).collect()] == [None] * (len(fn.MISSING_TOKENS) + 1) + [7]
    plan = df.select(cast.alias("n"))._jdf.queryExecution().optimizedPlan().toString()
    project = next(line for line in plan.splitlines() if " AS n" in line)
    assert 0 <= project.find("INSET") < project.find("cast(")
