"""The registered queries: ``name -> f(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger import operators as op
from skyledger.functions import scheduled_hour
from skyledger.operators.delays import by_delay
from skyledger.operators.features import rows_without_hour
from skyledger.plans.analytics import Answers, answer_questions, run_analytics
from skyledger.plans.clean import clean_flights, run_clean
from skyledger.plans.ingest import counted_outcomes, run_ingest, stage_archives, stored_outcomes
from skyledger.plans.live import run_live
from skyledger.plans.replay import run_publish
from skyledger.plans.report import busiest_chart, punctual_chart, run_report
from skyledger.plans.training import MODEL_NAME, run_training, train_and_evaluate, training_table
from skyledger.registry.fixtures import write_archives, write_messages, write_raw_csv
from skyledger.registry.flights_view import flights
from skyledger.schema import (
    ARCHIVE_FIELDS,
    DELAY_MEASURES,
    MODEL_CATEGORICAL,
    MODEL_NUMERIC,
    STREAM_FIELDS,
    flight_schema,
)
from skyledger.session import dealt_evenly, freeing_shuffles, materialise, scratch_path
from skyledger.sinks import (
    day_manifest,
    preview,
    read_day_files,
    read_live_table,
    read_published_days,
    read_runs,
    to_messages,
    write_day_files,
    write_table,
)
from skyledger.sources import (
    file_messages,
    read_flight_fields,
    read_table,
    read_text_records,
)
from skyledger.streaming import parse_messages, wait_for_all

Query = Callable[[SparkSession, str], DataFrame]

# An airport present at every scale factor.
AIRPORT = "NATION_12"
RUN_ID = "run-1"

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def registered_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def active(spark, sf_dir, *columns):
    return op.active_flights(flights(spark, sf_dir, *columns, "Cancelled"))


# --- scans, filters, projections ------------------------------------------------


@query
def flight_records(spark, sf_dir):
    return flights(spark, sf_dir)


@query
def active_flights(spark, sf_dir):
    return op.active_flights(
        flights(spark, sf_dir, "FlightNum", "UniqueCarrier", "CRSDepTime", "Cancelled")
    )


@query
def departed_flights(spark, sf_dir):
    return op.departed_flights(flights(spark, sf_dir, "FlightNum", "DepDelay", "Cancelled"))


@query
def flights_at_airport(spark, sf_dir):
    return op.at_airport(flights(spark, sf_dir, "FlightNum", "Origin", "DepDelay"), AIRPORT)


@query
def scheduled_hours(spark, sf_dir):
    rows = flights(spark, sf_dir, "FlightNum", "CRSDepTime")
    return rows.select("FlightNum", scheduled_hour(F.col("CRSDepTime")).alias("DepHour"))


# --- repair ---------------------------------------------------------------------


@query
def fill_missing_delays(spark, sf_dir):
    return op.fill_missing(flights(spark, sf_dir, "FlightNum", "Cancelled", *DELAY_MEASURES))


@query
def add_missing_columns(spark, sf_dir):
    rows = flights(spark, sf_dir, "FlightNum", "UniqueCarrier", "ArrDelay")
    return op.ensure_columns(rows)


def flights_with_gaps(spark, sf_dir):
    """The archived fields, with the day unknown for flights that left and never arrived."""
    rows = flights(spark, sf_dir, *ARCHIVE_FIELDS)
    lost = F.col("DepTime").isNotNull() & F.col("ArrTime").isNull()
    return rows.withColumn("DayofMonth", F.when(~lost, F.col("DayofMonth")))


@query
def drop_null_dates(spark, sf_dir):
    return op.drop_incomplete(flights_with_gaps(spark, sf_dir), ("Year", "Month", "DayofMonth"))


# --- delimited files ------------------------------------------------------------


@query
def csv_clean_roundtrip(spark, sf_dir):
    raw = write_raw_csv(flights(spark, sf_dir), "raw-flights")
    return run_clean(spark, raw, scratch_path(spark, "cleaned-flights"))


@query
def csv_projected_scan(spark, sf_dir):
    """Files of two column orders, one with a further column, under one path."""
    rows = flights(spark, sf_dir)
    early = F.col("Month") <= 6
    raw = write_raw_csv(rows.filter(early), "raw-flights")
    turned = rows.filter(~early).select(*reversed(rows.columns)).withColumn("Remark", F.lit('a "remark", quoted'))
    return read_flight_fields(spark, write_raw_csv(turned, path=raw))


@query
def csv_text_records(spark, sf_dir):
    raw = write_raw_csv(
        flights(spark, sf_dir, "FlightNum", "UniqueCarrier", "DepTime", "DepDelay"), "raw-flights"
    )
    return read_text_records(spark, raw)


# --- day files ------------------------------------------------------------------


@query
def day_file_manifest(spark, sf_dir):
    rows = flights(spark, sf_dir, "Year", "Month", "DayofMonth")
    return day_manifest(rows, prefix="flights", bucket="archive")


@query
def written_lines(spark, sf_dir):
    rows = flights(spark, sf_dir, "Year", "Month", "DayofMonth")
    return day_manifest(rows).agg(
        F.sum("rows").alias("written_lines"), F.count("*").alias("written_days")
    )


@query
def day_partitioned_roundtrip(spark, sf_dir):
    rows = flights(spark, sf_dir, *ARCHIVE_FIELDS)
    path = write_day_files(rows, scratch_path(spark, "day-files"))
    return read_day_files(spark, path, flight_schema(ARCHIVE_FIELDS))


# --- archives -------------------------------------------------------------------


def packed_flights(spark, sf_dir) -> str:
    """Archives of the flights, some of them damaged, some rows without a day."""
    return write_archives(flights_with_gaps(spark, sf_dir), "flight-archives")


@query
def zip_ingest_rows(spark, sf_dir):
    """The whole ingest, read back from the day files it published. Parts are cut every
    64 KB, so most members are read by several tasks."""
    target = scratch_path(spark, "ingested-days")
    run_ingest(spark, packed_flights(spark, sf_dir), target, part_bytes=1 << 16)
    return read_published_days(spark, target, flight_schema(ARCHIVE_FIELDS))


@query
def zip_ingest_status(spark, sf_dir):
    unpacked = stage_archives(spark, packed_flights(spark, sf_dir))
    outcomes = counted_outcomes(unpacked, stored_outcomes(unpacked))
    pack = F.regexp_extract("archive", r"flights_(\d+)_", 1).cast("int").alias("pack")
    return outcomes.groupBy(pack, "status").agg(
        F.sum("rows_read").alias("rows_read"), F.sum("rows_kept").alias("rows_kept")
    )


@query
def zip_ingest_manifest(spark, sf_dir):
    """Keys and rows as found in the published files."""
    target = f"{scratch_path(spark, 'ingest')}/days"
    manifest = run_ingest(spark, packed_flights(spark, sf_dir), target).manifest
    return manifest.select(F.regexp_replace("key", "^.*/days/", "days/").alias("key"), "rows")


# --- traffic and delays ---------------------------------------------------------


@query
def departures_by_origin(spark, sf_dir):
    return op.departures_by_origin(active(spark, sf_dir, "Origin", "FlightNum"))


@query
def arrivals_by_dest(spark, sf_dir):
    return op.arrivals_by_dest(active(spark, sf_dir, "Dest", "FlightNum"))


@query
def departures_join_arrivals(spark, sf_dir):
    return op.combine_departures_arrivals(
        op.departures_by_origin(active(spark, sf_dir, "Origin", "FlightNum")),
        op.arrivals_by_dest(active(spark, sf_dir, "Dest", "FlightNum")),
    )


@query
def busiest_airports(spark, sf_dir):
    return op.busiest_airports(active(spark, sf_dir, "Origin", "Dest", "FlightNum"))


@query
def busiest_airports_top5(spark, sf_dir):
    return preview(busiest_airports(spark, sf_dir), 5)


@query
def avg_arr_delay_by_carrier(spark, sf_dir):
    rows = active(spark, sf_dir, "UniqueCarrier", "ArrDelay")
    return by_delay(op.mean_delay(rows, "UniqueCarrier"), "UniqueCarrier")


@query
def avg_arr_delay_by_dow(spark, sf_dir):
    rows = active(spark, sf_dir, "DayOfWeek", "ArrDelay")
    return by_delay(op.mean_delay(rows, "DayOfWeek"), "DayOfWeek")


@query
def best_carriers_top5(spark, sf_dir):
    return preview(avg_arr_delay_by_carrier(spark, sf_dir), 5)


@query
def avg_arr_delay_by_carrier_cleaned(spark, sf_dir):
    rows = op.active_flights(
        clean_flights(flights(spark, sf_dir, "UniqueCarrier", "Cancelled", *DELAY_MEASURES))
    )
    return by_delay(op.mean_delay(rows, "UniqueCarrier"), "UniqueCarrier")


def departed(spark, sf_dir, *columns):
    return op.departed_flights(flights(spark, sf_dir, *columns, "DepDelay", "Cancelled"))


@query
def avg_dep_delay_by_origin_carrier(spark, sf_dir):
    rows = departed(spark, sf_dir, "Origin", "UniqueCarrier")
    return op.mean_delay(rows, ["Origin", "UniqueCarrier"], "DepDelay")


@query
def avg_dep_delay_by_route(spark, sf_dir):
    rows = departed(spark, sf_dir, "Origin", "Dest")
    return op.mean_delay(rows, ["Origin", "Dest"], "DepDelay")


@query
def top_carriers_by_origin(spark, sf_dir):
    return op.top_carriers(departed(spark, sf_dir, "Origin", "UniqueCarrier"))


@query
def top_destinations_by_origin(spark, sf_dir):
    return op.top_destinations(departed(spark, sf_dir, "Origin", "Dest"))


@query
def top_carriers_at_airport(spark, sf_dir):
    return op.best_at(top_carriers_by_origin(spark, sf_dir), AIRPORT)


@query
def top_destinations_at_airport(spark, sf_dir):
    return op.best_at(top_destinations_by_origin(spark, sf_dir), AIRPORT)


QUESTION_KEYS = ("Origin", "Dest", "UniqueCarrier", "DayOfWeek")


@query
def delay_totals(spark, sf_dir):
    totals = op.delay_totals(active(spark, sf_dir, *QUESTION_KEYS, "FlightNum", *DELAY_MEASURES))
    return totals.withColumn("grouping", F.col("grouping").cast("int"))


def long_answers(answers: Answers) -> DataFrame:
    """All answers in one table: question, its one or two keys, value."""

    def rows(question, df, first, second, value):
        return df.select(
            F.lit(question).alias("question"),
            F.col(first).cast("string").alias("first_key"),
            (F.col(second) if second else F.lit(None)).cast("string").alias("second_key"),
            F.col(value).cast("double").alias("value"),
        )

    parts = [
        rows("busiest_airports", answers.busiest_airports, "airport", None, "total_flights"),
        rows("delay_by_carrier", answers.delay_by_carrier, "UniqueCarrier", None, "avg_delay"),
        rows("delay_by_weekday", answers.delay_by_weekday, "DayOfWeek", None, "avg_delay"),
        rows("top_carriers", answers.top_carriers, "Origin", "UniqueCarrier", "avg_delay"),
        rows("top_destinations", answers.top_destinations, "Origin", "Dest", "avg_delay"),
    ]
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part)
    return united


def analytics_input(spark, sf_dir):
    return flights(
        spark, sf_dir, "Month", "Cancelled", *QUESTION_KEYS, "FlightNum", *DELAY_MEASURES
    )


@query
def all_questions(spark, sf_dir):
    return long_answers(answer_questions(analytics_input(spark, sf_dir)))


def stored_analytics(spark, sf_dir) -> str:
    source = write_table(analytics_input(spark, sf_dir), scratch_path(spark, "analytics-input"))
    target = scratch_path(spark, "analytics")
    run_analytics(spark, source, target)
    return target


@query
def stored_top_carriers(spark, sf_dir):
    return read_table(
        spark, f"{stored_analytics(spark, sf_dir)}/q2_1_top_airlines_by_airport.parquet"
    )


# --- charts ---------------------------------------------------------------------


@query
def chart_busiest(spark, sf_dir):
    return busiest_chart(busiest_airports(spark, sf_dir))


@query
def chart_punctual_carriers(spark, sf_dir):
    return punctual_chart(top_carriers_by_origin(spark, sf_dir), AIRPORT)


@query
def report_tables(spark, sf_dir):
    busiest, punctual = run_report(spark, stored_analytics(spark, sf_dir), airport=AIRPORT)
    return busiest.select(
        F.lit("busiest").alias("chart"), F.col("airport").alias("bar"), "label"
    ).unionByName(
        punctual.select(F.lit("punctual").alias("chart"), F.col("UniqueCarrier").alias("bar"), "label")
    )


# --- messages and streams -------------------------------------------------------


@query
def json_roundtrip(spark, sf_dir):
    rows = flights(spark, sf_dir, *STREAM_FIELDS)
    return parse_messages(to_messages(rows.select(*[F.col(c).cast("string") for c in rows.columns])))


@query
def published_records(spark, sf_dir):
    raw = write_raw_csv(flights(spark, sf_dir, *STREAM_FIELDS, "FlightNum"), "raw-flights")
    topic = scratch_path(spark, "topic")
    run_publish(spark, raw, format="text", path=topic)
    return parse_messages(spark.read.text(topic), fields=(*STREAM_FIELDS, "FlightNum"))


def live_delays(spark, sf_dir, key) -> DataFrame:
    topic = write_messages(flights(spark, sf_dir, *STREAM_FIELDS), "topic")
    tables = scratch_path(spark, "live-tables")
    wait_for_all(run_live(spark, file_messages(spark, topic), tables, available_now=True))
    return read_live_table(spark, tables, key)


@query
def stream_delay_by_carrier(spark, sf_dir):
    return live_delays(spark, sf_dir, "UniqueCarrier")


@query
def stream_delay_by_dow(spark, sf_dir):
    return live_delays(spark, sf_dir, "DayOfWeek")


@query
def stream_publish_and_consume(spark, sf_dir):
    """Files to messages, some thousand records at a time, to running means. The messages of
    the first half of the year are sent twice and counted once."""
    # Derived once; both halves and their number come from the stored rows.
    rows = materialise(flights(spark, sf_dir, *STREAM_FIELDS), "streamed-flights")
    raw = write_raw_csv(rows.filter("Month <= 6"), "raw-flights")
    topic, tables = scratch_path(spark, "topic"), scratch_path(spark, "live-tables")
    per_batch = max(5000, rows.count() // 8)

    def publish(run):
        state = scratch_path(spark, run)
        run_publish(
            spark, raw, format="text", path=f"{topic}/{run}", records_per_batch=per_batch, checkpoint=state, compression="gzip",
        )

    publish("first")
    write_raw_csv(rows.filter("Month > 6"), path=raw)
    publish("without-memory")
    wait_for_all(run_live(spark, file_messages(spark, f"{topic}/*", 8), tables, available_now=True, record_id="record_id"))
    by_carrier = read_live_table(spark, tables, "UniqueCarrier")
    by_weekday = read_live_table(spark, tables, "DayOfWeek")
    return by_carrier.withColumnRenamed("UniqueCarrier", "key").unionByName(
        by_weekday.withColumnRenamed("DayOfWeek", "key")
    )


# --- model rows, split and quality ----------------------------------------------


@query
def ml_feature_rows(spark, sf_dir):
    return op.offline_features(
        flights(spark, sf_dir, "Month", "DayOfWeek", "UniqueCarrier", "Origin", "Dest", *DELAY_MEASURES)
    )


def model_input(spark, sf_dir):
    return flights(
        spark, sf_dir, "Year", "Month", "DayofMonth", "DayOfWeek", "CRSDepTime", "UniqueCarrier",
        "FlightNum", "Origin", "Dest", "Cancelled", "ArrDelay",
    )


def unscheduled_flights(spark, sf_dir):
    """Model input with the scheduled time unknown where the departure is unknown too."""
    rows = flights(
        spark, sf_dir, "Month", "DayOfWeek", "CRSDepTime", "DepTime", "UniqueCarrier", "FlightNum",
        "Origin", "Dest", "Cancelled", "ArrDelay",
    )
    known = F.col("DepTime").isNotNull()
    return rows.withColumn("CRSDepTime", F.when(known, F.col("CRSDepTime")))


@query
def delay_features(spark, sf_dir):
    return op.delay_features(unscheduled_flights(spark, sf_dir), carry=("FlightNum",))


@query
def flights_without_hour(spark, sf_dir):
    return rows_without_hour(unscheduled_flights(spark, sf_dir))


@query
def weighted_features(spark, sf_dir):
    return op.collapse_rows(op.delay_features(model_input(spark, sf_dir)))


@query
def category_codes(spark, sf_dir):
    rows = flights(spark, sf_dir, "UniqueCarrier", "Origin", "Dest")
    return op.category_codes(rows, *rows.columns)


@query
def encoded_carriers(spark, sf_dir):
    rows = flights(spark, sf_dir, "FlightNum", "UniqueCarrier")
    codes = op.category_codes(rows, "UniqueCarrier")
    return op.attach_codes(rows, codes, "UniqueCarrier", "carrier_code")


@query
def train_test_split_counts(spark, sf_dir):
    return op.split_counts(op.with_split(model_input(spark, sf_dir)))


def fixed_scores(spark, sf_dir):
    """Labelled rows with a score that depends on the scheduled time only."""
    rows = active(spark, sf_dir, "FlightNum", "CRSDepTime", "ArrDelay", "Month", "DayOfWeek")
    labelled = op.delay_features(
        rows, carry=("CRSDepTime",), numeric=("Month", "DayOfWeek", "DepHour"), categorical=()
    )
    return labelled.withColumns(
        {
            "probability": (F.col("CRSDepTime") % 97) / F.lit(97.0),
            "prediction": (F.col("CRSDepTime") % 97 >= 48).cast("int"),
        }
    )


def _rounded(df, *columns):
    return df.select(*[F.round(c, 6).alias(c) for c in columns])


@query
def classification_metrics(spark, sf_dir):
    metrics = op.classification_metrics(fixed_scores(spark, sf_dir))
    return _rounded(metrics, *metrics.columns)


@query
def roc_auc(spark, sf_dir):
    return _rounded(op.roc_auc(fixed_scores(spark, sf_dir)), "roc_auc")


def stored_model_input(spark, sf_dir) -> str:
    with freeing_shuffles(spark):
        return write_table(model_input(spark, sf_dir), scratch_path(spark, "model-input"))


def whole_run(spark, source) -> str:
    """The training job with its own parameters over stored flights; where it put its results."""
    target = scratch_path(spark, "training")
    run_training(spark, source, target, run_id=RUN_ID)
    return target


@query
def run_log(spark, sf_dir):
    """The log of a whole run: its numeric parameters, what its counts add up to, and whether
    the ratios follow from the counts. The counts themselves are the model's own."""
    entries = read_runs(spark, f"{whole_run(spark, stored_model_input(spark, sf_dir))}/runs")
    numbers = entries.withColumn("value", F.col("value").try_cast("double"))
    params = numbers.filter("kind = 'param' AND value IS NOT NULL")
    measured = numbers.filter("kind = 'metric'").groupBy("run_id", "experiment").agg(
        *[F.max(F.when(F.col("key") == k, F.col("value"))).alias(k) for k in ("tp", "fp", "fn", "tn", "accuracy", "precision", "recall", "roc_auc")]
    )
    tested = F.expr("tp + fp + fn + tn")

    def follows(ratio, part, whole):
        return (F.abs(F.col(ratio) * whole - part) < 1e-6).cast("double")

    checked = measured.select(
        "run_id", "experiment", F.lit("metric").alias("kind"),
        tested.alias("rows_tested"), F.expr("tp + fn").alias("late_tested"),
        follows("accuracy", F.expr("tp + tn"), tested).alias("accuracy_follows"),
        follows("precision", F.col("tp"), F.expr("tp + fp")).alias("precision_follows"),
        follows("recall", F.col("tp"), F.expr("tp + fn")).alias("recall_follows"),
        F.col("roc_auc").between(0, 1).cast("double").alias("roc_auc_known"),
    )
    keys = ["run_id", "experiment", "kind"]
    values = [c for c in checked.columns if c not in keys]
    return params.select(*keys, "key", "value").unionByName(checked.unpivot(keys, values, "key", "value"))


@query
def gbt_scores(spark, sf_dir):
    """Rows of the test side scored by the stored model of a whole run, and whether the
    probabilities equal those found by walking the stored nodes."""
    source = stored_model_input(spark, sf_dir)
    path = f"{whole_run(spark, source)}/{MODEL_NAME}"
    test = dealt_evenly(training_table(read_table(spark, source)).filter("NOT in_train"))
    scored = op.score_flights(op.load_model(path), op.score_by_walking(spark, path, test))
    return scored.select(
        *MODEL_NUMERIC, *MODEL_CATEGORICAL, "IsDelayed", "weight",
        (F.abs(F.col("probability") - F.col("walked")) < 1e-9).alias("as_walked"),
        ((F.col("walked") > 0.5).cast("int") == F.col("prediction")).alias("agrees"),
    )


@query
def gbt_scored_rows(spark, sf_dir):
    """Train a few small trees on one side, store them, and score the other with the stored
    copy: which rows were scored, and whether every score is a probability that agrees with
    its class; the digits of the scores are the model's own."""
    table = training_table(model_input(spark, sf_dir))
    trained = train_and_evaluate(table, trees=3, max_depth=4)
    path = op.save_model(trained.model, scratch_path(spark, "model"))
    scored = op.score_flights(op.load_model(path), dealt_evenly(table.filter("NOT in_train")))
    return scored.select(
        *MODEL_NUMERIC, *MODEL_CATEGORICAL, "IsDelayed", "weight",
        F.col("probability").between(0, 1).alias("is_probability"),
        ((F.col("probability") > 0.5).cast("int") == F.col("prediction")).alias("agrees"),
    )
