import itertools
import math

import pytest
from conftest import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyledger import operators as op
from skyledger.operators import boosting
from skyledger.operators.features import rows_without_hour
from skyledger.plans.training import run_training, train_and_evaluate, training_table
from skyledger.session import dealt_evenly, materialise
from skyledger.sinks import read_runs

QUICK = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def planted(spark, n=6000):
    """Flights of carrier XX in the evening are late; the rest mostly is not."""
    i = F.col("id")
    carrier = F.when(i % 4 == 0, "XX").when(i % 4 == 1, "AA").when(i % 4 == 2, "BB").otherwise(F.lit(None))
    hour = (i * 7) % 24
    late = ((i % 4 == 0) & (hour >= 15)) | (i % 37 == 0)
    return spark.range(n).select(
        F.lit(2008).alias("Year"), (1 + i % 12).cast("int").alias("Month"),
        (1 + i % 28).cast("int").alias("DayofMonth"), (1 + i % 7).cast("int").alias("DayOfWeek"),
        F.when(i % 500 != 0, (hour * 100 + i % 60).cast("int")).alias("CRSDepTime"),
        carrier.alias("UniqueCarrier"), i.alias("FlightNum"),
        F.concat(F.lit("O"), (i % 5).cast("string")).alias("Origin"),
        F.concat(F.lit("D"), (i % 3).cast("string")).alias("Dest"),
        F.when(i % 50 == 1, 1).otherwise(0).alias("Cancelled"),
        F.when(late, 40.0).otherwise(0.0).alias("ArrDelay"), F.lit(0.0).alias("DepDelay"),
    )


def test_features_and_rows_without_an_hour(spark):
    flights = planted(spark, 1000)
    rows = op.delay_features(flights)
    assert rows.columns == ["Month", "DayOfWeek", "DepHour", "UniqueCarrier", "Origin", "Dest", "IsDelayed"]
    kept, lost = rows.count(), rows_without_hour(flights).first()["rows"]
    assert lost == 2 and kept + lost == flights.filter("Cancelled = 0").count()
    with pytest.raises(ValueError, match="Cancelled"):
        op.delay_features(flights.drop("Cancelled"))


def test_offline_features_keep_cancelled_complete_rows(make_flights):
    base = dict(Month=1, DayOfWeek=1, UniqueCarrier="X", Origin="A", Dest="B", DepDelay=0.0, ArrDelay=0.0)
    df = make_flights([base | dict(Cancelled=1), base | dict(Origin=None), base | dict(ArrDelay=math.nan)])
    assert rows_of(op.offline_features(df)) == [(1, 1, "X", "A", "B", 0.0, 0.0)]


def test_collapsed_rows_keep_the_total(spark):
    rows = op.delay_features(planted(spark, 3000), numeric=("DayOfWeek",), categorical=("UniqueCarrier",))
    collapsed = op.collapse_rows(rows)
    assert collapsed.agg(F.sum("weight")).first()[0] == rows.count()
    assert collapsed.count() == rows.distinct().count()


@QUICK
@given(st.lists(st.one_of(st.none(), st.text("abcXYZ", max_size=3)), min_size=1, max_size=40), st.integers(1, 5))
def test_codes_number_the_sorted_values(spark, values, slices):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    want = sorted({"None" if v is None else v for v in values})
    got = op.category_codes(df, "c", slices=slices).select("category", "code")
    assert rows_of(got) == list(zip(want, range(len(want))))


def test_codes_of_several_columns_come_from_one_scan(spark):
    df = spark.range(1000).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("wide"), (F.col("id") % 3).alias("narrow")
    )
    got = rows_of(op.category_codes(df, "wide", "narrow", slices=7))
    keys = sorted(f"k{i}" for i in range(1000))
    assert got == [("narrow", str(i), i) for i in range(3)] + [("wide", k, i) for i, k in enumerate(keys)]


def test_unseen_category_gets_the_next_code(spark):
    seen = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    codes = op.category_codes(seen, "c")
    later = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    assert rows_of(op.attach_codes(later, codes, "c", "code")) == [(None, 0), ("a", 1), ("z", 3)]


def brute_auc(rows):
    pairs = [
        (p > n) + 0.5 * (p == n)
        for (lp, p), (ln, n) in itertools.product(rows, rows) if lp == 1 and ln == 0
    ]
    return sum(pairs) / len(pairs) if pairs else None


@QUICK
@given(st.lists(st.tuples(st.integers(0, 1), st.sampled_from([0.0, 0.25, 0.5, 0.75, 1.0])), min_size=1, max_size=30))
def test_quality_matches_plain_python(spark, rows):
    df = spark.createDataFrame([(y, s, int(s > 0.5)) for y, s in rows], "IsDelayed int, probability double, prediction int")
    area, want = op.roc_auc(df).first()[0], brute_auc(rows)
    assert (area is None) == (want is None)
    assert area is None or area == pytest.approx(want, abs=1e-12)
    m = op.classification_metrics(df).first().asDict()
    tp = sum(y == 1 and s > 0.5 for y, s in rows)
    fp = sum(y == 0 and s > 0.5 for y, s in rows)
    fn = sum(y == 1 and s <= 0.5 for y, s in rows)
    tn = len(rows) - tp - fp - fn
    assert (m["tp"], m["fp"], m["fn"], m["tn"]) == (tp, fp, fn, tn)
    assert m["accuracy"] == pytest.approx((tp + tn) / len(rows))
    assert m["precision"] == pytest.approx(tp / (tp + fp) if tp + fp else 0.0)
    assert m["recall"] == pytest.approx(tp / (tp + fn) if tp + fn else 0.0)


def test_nothing_flagged_gives_zero_precision(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "IsDelayed int, prediction int")
    assert op.classification_metrics(df).first().asDict() == {
        "tp": 0.0, "fp": 0.0, "fn": 1.0, "tn": 1.0, "accuracy": 0.5, "precision": 0.0, "recall": 0.0,
    }


def test_weights_equal_repeated_rows(spark):
    once = spark.createDataFrame(
        [(1, 0.9, 1, 3.0), (0, 0.9, 1, 2.0), (1, 0.1, 0, 1.0), (0, 0.2, 0, 4.0)],
        "IsDelayed int, probability double, prediction int, weight double",
    )
    repeated = once.select("*", F.explode(F.sequence(F.lit(1), F.col("weight").cast("int")))).drop("col", "weight")
    assert op.roc_auc(once, weight="weight").first() == op.roc_auc(repeated).first()
    assert op.classification_metrics(once, weight="weight").first() == op.classification_metrics(repeated).first()


def test_weighted_distinct_rows_train_the_same_trees(spark):
    rows = op.delay_features(planted(spark, 3000)).drop("DepHour")
    options = dict(numeric=("Month", "DayOfWeek"), trees=3, max_depth=3)
    plain = op.fit_delay_model(rows, **options)
    weighted = op.fit_delay_model(op.collapse_rows(rows), weight="weight", **options)
    distinct = rows.drop("IsDelayed").distinct()
    columns = ["Month", "DayOfWeek", "UniqueCarrier", "Origin", "Dest", "probability"]
    for a, b in zip(rows_of(op.score_flights(plain, distinct).select(columns)),
                    rows_of(op.score_flights(weighted, distinct).select(columns))):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-9)


def test_planted_signal_is_found_and_the_stored_model_agrees(spark, tmp_path):
    source, target = str(tmp_path / "flights"), str(tmp_path / "model")
    planted(spark).write.parquet(source)
    trained = run_training(spark, source, target, run_id="r1", trees=5, max_depth=4)
    metrics = trained.metrics.first().asDict()
    assert metrics["roc_auc"] > 0.8 and metrics["recall"] > 0.5
    test = training_table(planted(spark)).filter("NOT in_train")
    columns = [c for c in trained.scored.columns if c != "in_train"]
    again = op.score_flights(op.load_model(f"{target}/flight-delay-model"), test)
    assert rows_of(again.select(columns)) == rows_of(trained.scored.select(columns))

    log = {(r["kind"], r["key"]): r["value"] for r in read_runs(spark, f"{target}/runs").collect()}
    assert float(log["metric", "roc_auc"]) == metrics["roc_auc"]
    assert log["param", "trees"] == "5" and log["param", "rows_without_hour"] == "12"
    run_training(spark, source, target, run_id="r2", fit_on="all", trees=1, max_depth=2)
    assert rows_of(read_runs(spark, f"{target}/runs").select("run_id").distinct()) == [("r1",), ("r2",)]


def test_unseen_and_unknown_categories_can_be_scored(spark):
    table = training_table(planted(spark, 2000))
    trained = train_and_evaluate(table, trees=1, max_depth=2)
    new = spark.createDataFrame(
        [(1, 1, 10, None, "O1", "D1"), (1, 1, 10, "??", "O1", "D1")],
        "Month int, DayOfWeek int, DepHour int, UniqueCarrier string, Origin string, Dest string",
    )
    scored = op.score_flights(trained.model, new)
    assert rows_of(scored.select("UniqueCarrier")) == [(None,), ("??",)]
    assert all(0 <= r["probability"] <= 1 for r in scored.collect())


def test_a_loaded_model_scores_raw_rows_of_any_cardinality(spark, tmp_path):
    source, target = str(tmp_path / "flights"), str(tmp_path / "model")
    wide = planted(spark, 3000).withColumn("Origin", F.concat(F.lit("O"), F.col("FlightNum").cast("string")))
    wide.write.parquet(source)
    run_training(spark, source, target, trees=2, max_depth=3)
    model = op.load_model(f"{target}/flight-delay-model")
    codes = rows_of(model.codes.filter("column = 'Origin'").select("category", "code"))
    assert len(codes) > 1000 and [c for _, c in codes] == list(range(len(codes)))
    scored = op.score_flights(model, training_table(wide))
    assert scored.filter("probability between 0 and 1").count() == training_table(wide).count()


def test_missing_prediction_counts_as_not_flagged(spark):
    df = spark.createDataFrame([(1, None), (0, None), (1, 1)], "IsDelayed int, prediction int")
    m = op.classification_metrics(df).first()
    assert (m.tp, m.fp, m.fn, m.tn) == (1.0, 0.0, 1.0, 1.0)


@pytest.mark.parametrize("slices", [1, 3, 40])
def test_area_does_not_hang_on_the_slices(spark, slices):
    """A score that a third of the rows share, ties, and rows without a score."""
    rows = [(i % 3 % 2, 0.5 if i % 3 == 0 else (i * 37 % 11) / 11) for i in range(200)]
    df = spark.createDataFrame(rows + [(1, None), (None, 0.5)], "IsDelayed int, probability double")
    assert math.isclose(op.roc_auc(df, slices=slices).first()[0], brute_auc(rows), rel_tol=1e-12)
    assert op.roc_auc(df.filter("IsDelayed = 1"), slices=slices).first()[0] is None
    assert op.roc_auc(df.limit(0), slices=slices).first()[0] is None


def test_stored_nodes_give_the_same_scores(spark, tmp_path):
    table = training_table(planted(spark, 2000))
    trained = train_and_evaluate(table, trees=6, max_depth=5)
    path = op.save_model(trained.model, str(tmp_path / "model"))
    # An unseen carrier, too, gets the same code in both ways.
    test = table.filter("NOT in_train").withColumn("UniqueCarrier", F.when(F.col("Month") == 3, "ZZ").otherwise(F.col("UniqueCarrier")))
    both = op.score_flights(op.load_model(path), op.score_by_walking(spark, path, test)).collect()
    assert len({r.probability for r in both}) > 5
    assert all(math.isclose(r.probability, r.walked, abs_tol=1e-12) for r in both)


def test_boosting_and_scoring_get_slices_of_equal_size(spark, monkeypatch):
    """A table in one small file, which a scan reads in one task."""
    dealt, fit, score = [], boosting.Pipeline.fit, boosting.score_flights
    monkeypatch.setattr(boosting.Pipeline, "fit", lambda self, df: dealt.append(df) or fit(self, df))
    monkeypatch.setattr(boosting, "score_flights", lambda model, df, *rest: dealt.append(df) or score(model, df, *rest))
    table = materialise(training_table(planted(spark)).coalesce(1), "one-file")
    train_and_evaluate(table, trees=1, max_depth=2)
    assert len(dealt) == 2
    for df in dealt:
        sizes = df.rdd.glom().map(len).collect()
        assert len(sizes) >= 2 * spark.sparkContext.defaultParallelism and max(sizes) <= 2 * sum(sizes) / len(sizes)
    sizes = dealt_evenly(table, slice_rows=50).rdd.glom().map(len).collect()
    assert sum(sizes) == table.count() and max(sizes) <= 60
