from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from skyledger import operators as op
from skyledger.operators.totals import ORIGIN_CARRIER
from skyledger.plans.analytics import answer_questions

ROUTES = [
    ("A", "B", 1), ("B", "A", 2), ("A", "C", None), ("C", "A", None), ("A", "D", 5),
    ("E", "A", 6), (None, "A", 7), ("B", None, 8), ("F", "A", None), ("A", "F", None),
]


def test_busiest_airports_edges(make_flights):
    df = make_flights([dict(Origin=o, Dest=d, FlightNum=n) for o, d, n in ROUTES])
    got = [tuple(r) for r in op.busiest_airports(df).collect()]
    assert got == [("A", 5), ("B", 3), ("C", 0), ("F", 0)]
    joined = op.combine_departures_arrivals(op.departures_by_origin(df), op.arrivals_by_dest(df))
    assert rows_of(joined) == sorted(got)


def test_null_airports_are_counted_as_groups_but_never_joined(make_flights):
    df = make_flights([dict(Origin=o, Dest=d, FlightNum=n) for o, d, n in ROUTES])
    assert (None, 1) in rows_of(op.departures_by_origin(df))
    assert (None, 1) in rows_of(op.arrivals_by_dest(df))


def test_busiest_ties_are_in_airport_order(make_flights):
    df = make_flights([dict(Origin=o, Dest=d, FlightNum=1) for o, d in ("BA", "AB", "DC", "CD")])
    assert [r["airport"] for r in op.busiest_airports(df).collect()] == ["A", "B", "C", "D"]


def test_cancelled_flag_is_optional_unless_required(make_flights):
    flights = make_flights([dict(FlightNum=1, Cancelled=0), dict(FlightNum=2, Cancelled=1), dict(FlightNum=3)])
    assert rows_of(op.active_flights(flights).select("FlightNum")) == [(1,)]
    without = flights.drop("Cancelled")
    assert op.active_flights(without).count() == 3
    with pytest.raises(Exception, match="Cancelled"):
        op.active_flights(without, required=True).count()


def test_departed_flights_need_a_known_delay(make_flights):
    flights = make_flights([
        dict(FlightNum=1, Cancelled=0, DepDelay=1.0), dict(FlightNum=2, Cancelled=0),
        dict(FlightNum=3, Cancelled=1, DepDelay=1.0),
    ])
    assert rows_of(op.departed_flights(flights).select("FlightNum")) == [(1,)]
    assert rows_of(op.departed_flights(flights.drop("Cancelled")).select("FlightNum")) == [(1,), (3,)]


def test_fill_replaces_null_and_nan(spark):
    df = spark.createDataFrame([(None, 1.0), (float("nan"), None), (3.0, 4.0)], "ArrDelay double, DepDelay double")
    assert rows_of(op.fill_missing(df)) == [(0.0, 0.0), (0.0, 1.0), (3.0, 4.0)]


def test_ensure_columns_leaves_present_ones(spark):
    df = spark.createDataFrame([(None,)], "ArrDelay double")
    assert op.ensure_columns(df).collect()[0].asDict() == {"ArrDelay": None, "DepDelay": 0.0}


def test_drop_incomplete(spark):
    df = spark.createDataFrame([(1, 2.0), (None, 2.0), (1, float("nan")), (1, None)], "a int, b double")
    assert rows_of(op.drop_incomplete(df)) == [(1, 2.0)]
    assert op.drop_incomplete(df, ["a"]).count() == 3


def test_equal_means_rank_in_carrier_order_and_null_carrier_counts(make_flights):
    rows = [dict(Origin="A", UniqueCarrier=c, DepDelay=d) for c, d in
            [("ZZ", 1.0), ("YY", 1.001), ("XX", 1.004), (None, 1.0), ("WW", 1.006)]]
    got = [tuple(r) for r in op.top_carriers(make_flights(rows), n=4).orderBy("rank").collect()]
    assert got == [("A", None, 1.0, 1), ("A", "XX", 1.0, 2), ("A", "YY", 1.0, 3), ("A", "ZZ", 1.0, 4)]


def test_ten_places_per_origin(make_flights):
    rows = [dict(Origin=o, UniqueCarrier=f"{c:02d}", DepDelay=float(c)) for o in "AB" for c in range(14)]
    ranked = op.top_carriers(make_flights(rows))
    assert rows_of(ranked.groupBy("Origin").count()) == [("A", 10), ("B", 10)]
    assert [tuple(r) for r in op.best_at(ranked, "B", 3).collect()] == [
        ("B", "00", 0.0, 1), ("B", "01", 1.0, 2), ("B", "02", 2.0, 3)]


def test_ranking_cuts_rows_before_the_shuffle(make_flights):
    df = op.top_carriers(make_flights([dict(Origin="A", UniqueCarrier="X", DepDelay=1.0)]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


FLIGHTS = st.lists(
    st.fixed_dictionaries({
        "Origin": st.sampled_from(["A", "B", "C", None]),
        "Dest": st.sampled_from(["A", "B", "D", None]),
        "UniqueCarrier": st.sampled_from(["WN", "AA", "DL", None]),
        "DayOfWeek": st.integers(1, 7),
        "FlightNum": st.one_of(st.none(), st.integers(1, 9)),
        "Cancelled": st.sampled_from([0, 0, 0, 1, None]),
        "ArrDelay": st.one_of(st.none(), st.integers(-30, 90).map(float)),
        "DepDelay": st.one_of(st.none(), st.integers(-30, 90).map(float)),
    }),
    min_size=1, max_size=40,
)


def mean2(values):
    mean = Decimal(repr(sum(values) / len(values)))
    return float(mean.quantize(Decimal("0.01"), ROUND_HALF_UP))


def brute_top(rows, key):
    groups = defaultdict(list)
    for r in rows:
        if r["Cancelled"] == 0 and r["DepDelay"] is not None:
            groups[r["Origin"], r[key]].append(r["DepDelay"])
    places = defaultdict(list)
    for (origin, k), delays in groups.items():
        places[origin].append((mean2(delays), k is not None, k or ""))
    return {
        (origin, k if known else None, mean, rank)
        for origin, means in places.items()
        for rank, (mean, known, k) in enumerate(sorted(means)[:10], 1)
    }


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(FLIGHTS)
def test_direct_and_one_pass_answers_match_plain_python(make_flights, rows):
    columns = list(rows[0])
    df = make_flights(rows, columns)
    live = [r for r in rows if r["Cancelled"] == 0]

    outs, ins = defaultdict(int), defaultdict(int)
    for r in live:
        outs[r["Origin"]] += r["FlightNum"] is not None
        ins[r["Dest"]] += r["FlightNum"] is not None
    busiest = {(a, outs[a] + ins[a]) for a in set(outs) & set(ins) if a is not None}

    def arrival_means(key):
        groups = defaultdict(list)
        for r in live:
            groups[r[key]] += [r["ArrDelay"]] if r["ArrDelay"] is not None else []
        return {(k, mean2(v) if v else None) for k, v in groups.items()}

    answers = answer_questions(df)
    active = op.active_flights(df)
    departed = op.departed_flights(df)
    for got, want in [
        (op.busiest_airports(active), busiest),
        (answers.busiest_airports, busiest),
        (op.mean_delay(active, "UniqueCarrier"), arrival_means("UniqueCarrier")),
        (answers.delay_by_carrier, arrival_means("UniqueCarrier")),
        (op.mean_delay(active, "DayOfWeek"), arrival_means("DayOfWeek")),
        (answers.delay_by_weekday, arrival_means("DayOfWeek")),
        (op.top_carriers(departed), brute_top(rows, "UniqueCarrier")),
        (answers.top_carriers, brute_top(rows, "UniqueCarrier")),
        (op.top_destinations(departed), brute_top(rows, "Dest")),
        (answers.top_destinations, brute_top(rows, "Dest")),
    ]:
        collected = [tuple(r) for r in got.collect()]
        assert len(collected) == len(set(collected))
        assert set(collected) == want


def test_totals_keep_nan_visible(make_flights):
    nan = dict(Origin="A", Dest="B", UniqueCarrier="X", DayOfWeek=1, FlightNum=1, ArrDelay=float("nan"), DepDelay=1.0)
    df = make_flights([nan])
    totals = op.delay_totals(df)
    carriers = op.of_grouping(totals, ORIGIN_CARRIER)
    assert str(op.mean_from_totals(carriers, "UniqueCarrier").first()["avg_delay"]) == "nan"
    assert str(op.mean_delay(df, "UniqueCarrier").first()["avg_delay"]) == "nan"
    assert op.busiest_from_totals(totals).count() == 0
    assert rows_of(totals.groupBy("grouping").count().select("count")) == [(1,)] * 3


def test_flights_are_scanned_once_for_all_questions(make_flights):
    df = make_flights([dict(Origin="A", Dest="B", UniqueCarrier="X", DayOfWeek=1, FlightNum=1, ArrDelay=1.0, DepDelay=1.0)])
    plan = op.delay_totals(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("Exchange") == 1
