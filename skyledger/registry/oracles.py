"""SQL twins of the registered queries, for an independent engine."""

from __future__ import annotations

from skyledger.registry.fixtures import SPOILT_YEARS
from skyledger.registry.flights_view import FLIGHTS_SQL
from skyledger.registry.queries import AIRPORT, RUN_ID


def _round(value: str, digits: int = 2) -> str:
    """Round the decimal print of a double half up, as Spark does."""
    return (
        f"cast(round(cast(cast({value} as varchar) as decimal(38,18)), {digits}) as double)"
    )


def _over_flights(sql: str) -> str:
    return f"with flights as ({FLIGHTS_SQL})\n{sql}"


# Flights that left and never arrived, whose day the archive queries take as unknown.
_DATED = "not (DepTime is not null and ArrTime is null)"
_READABLE = f"Year not in {SPOILT_YEARS}"
_KEY = "printf('%04d/%02d/%04d_%02d_%02d.csv', Year, Month, Year, Month, DayofMonth)"

_AIRPORT_TOTALS = """
    select airport, cast(sum(flights) as bigint) as total_flights
    from (select Origin as airport, 1 as departs, count(FlightNum) as flights
          from flights where Cancelled = 0 group by Origin
          union all
          select Dest, 0, count(FlightNum) from flights where Cancelled = 0 group by Dest)
    where airport is not null
    group by airport having min(departs) = 0 and max(departs) = 1
"""


def _top(key: str, n: int = 10) -> str:
    return f"""
    select * from (
      select Origin, {key}, avg_delay,
             cast(rank() over (partition by Origin
                               order by avg_delay nulls first, {key} nulls first) as integer) as rank
      from (select Origin, {key}, {_round('avg(DepDelay)')} as avg_delay
            from flights where Cancelled = 0 and DepDelay is not null group by Origin, {key}))
    where rank <= {n}
"""


def _live(key: str) -> str:
    return (
        f"select cast({key} as varchar) as {key}, avg(coalesce(ArrDelay, 0.0)) as AvgDelay, "
        f"count({key}) as NrFlights from flights group by {key}"
    )


_MEAN_BY = "select {key}, " + _round("avg(ArrDelay)") + " as avg_delay from flights where Cancelled = 0 group by {key}"

_STREAMED = """select cast(Year as varchar) as Year, cast(Month as varchar) as Month,
       cast(DayofMonth as varchar) as DayofMonth, cast(DayOfWeek as varchar) as DayOfWeek,
       Origin, Dest, UniqueCarrier, coalesce(ArrDelay, 0.0) as ArrDelay"""

_LABEL = "cast(case when coalesce(ArrDelay, 0) > 15 then 1 else 0 end as integer)"

_SCORED = f"""
    select {_LABEL} as IsDelayed, (CRSDepTime % 97) / 97.0::double as score,
           case when CRSDepTime % 97 >= 48 then 1 else 0 end as flagged
    from flights where Cancelled = 0
"""

_METRICS = f"""
    select tp, fp, fn, tn, {_round('(tp + tn) / (tp + fp + fn + tn)', 6)} as accuracy,
           case when tp + fp = 0 then 0.0::double else {_round('tp / (tp + fp)', 6)} end as precision,
           case when tp + fn = 0 then 0.0::double else {_round('tp / (tp + fn)', 6)} end as recall
    from (select cast(count(*) filter (IsDelayed = 1 and flagged = 1) as double) as tp,
                 cast(count(*) filter (IsDelayed = 0 and flagged = 1) as double) as fp,
                 cast(count(*) filter (IsDelayed = 1 and flagged = 0) as double) as fn,
                 cast(count(*) filter (IsDelayed = 0 and flagged = 0) as double) as tn
          from ({_SCORED}))
"""

_BUCKET = (
    "cast('0x' || substr(md5(concat_ws('|', '42', Year, Month, DayofMonth, UniqueCarrier, "
    "FlightNum, CRSDepTime, Origin, Dest)), 1, 8) as bigint) % 10"
)

_CLEANED = """select Year, Month, DayofMonth, DayOfWeek, DepTime, CRSDepTime, ArrTime, CRSArrTime,
       UniqueCarrier, FlightNum, Origin, Dest, Cancelled,
       coalesce(DepDelay, 0.0) as DepDelay, coalesce(ArrDelay, 0.0) as ArrDelay from flights"""

_ARCHIVED = (
    "Year, Month, DayofMonth, DayOfWeek, DepTime, CRSDepTime, ArrTime, CRSArrTime, "
    "UniqueCarrier, FlightNum"
)

_BUSIEST_BARS = f"""
    select airport, total_flights, format('{{:,}}', total_flights) as label
    from ({_AIRPORT_TOTALS}) order by total_flights desc, airport limit 5
"""

_PUNCTUAL_BARS = f"""
    select UniqueCarrier, avg_delay, cast(avg_delay as varchar) || ' min' as label
    from ({_top('UniqueCarrier')}) where Origin = '{AIRPORT}' order by rank limit 5
"""

_SQL = {
    "flight_records": "select * from flights",
    "active_flights": "select FlightNum, UniqueCarrier, CRSDepTime, Cancelled from flights where Cancelled = 0",
    "departed_flights": """select FlightNum, DepDelay, Cancelled from flights
        where Cancelled = 0 and DepDelay is not null""",
    "flights_at_airport": f"select FlightNum, Origin, DepDelay from flights where Origin = '{AIRPORT}'",
    "scheduled_hours": "select FlightNum, cast(floor(CRSDepTime / 100) as integer) as DepHour from flights",
    "fill_missing_delays": """select FlightNum, Cancelled, coalesce(ArrDelay, 0.0) as ArrDelay,
        coalesce(DepDelay, 0.0) as DepDelay from flights""",
    "add_missing_columns": "select FlightNum, UniqueCarrier, ArrDelay, 0.0::double as DepDelay from flights",
    "drop_null_dates": f"""select {_ARCHIVED} from flights where {_DATED}
        and Year is not null and Month is not null and DayofMonth is not null""",
    "csv_clean_roundtrip": _CLEANED,
    "csv_projected_scan": f"select {_ARCHIVED} from flights",
    "csv_text_records": """select cast(FlightNum as varchar) as FlightNum, UniqueCarrier,
        coalesce(cast(DepTime as varchar), 'NA') as DepTime,
        coalesce(cast(DepDelay as varchar), 'NA') as DepDelay from flights""",
    "day_file_manifest": f"""select 'archive' as bucketname, 'flights/' || {_KEY} as key,
        printf('flights/y=%04d/m=%02d/d=%04d_%02d_%02d', Year, Month, Year, Month, DayofMonth) as path,
        count(*) as rows from flights group by Year, Month, DayofMonth""",
    "written_lines": """select count(*) as written_lines,
        count(distinct (Year, Month, DayofMonth)) as written_days from flights""",
    "day_partitioned_roundtrip": f"select {_ARCHIVED} from flights",
    "zip_ingest_rows": f"""select {_ARCHIVED} from flights
        where {_READABLE} and {_DATED}""",
    "zip_ingest_status": f"""select Year as pack, case when {_READABLE} then 'OK' else 'ERROR' end as status,
        case when {_READABLE} then count(*) else 0 end as rows_read,
        case when {_READABLE} then count(*) filter ({_DATED}) else 0 end as rows_kept
        from flights group by Year""",
    "zip_ingest_manifest": f"""select 'days/' || {_KEY} as key, count(*) as rows from flights
        where {_READABLE} and {_DATED} group by Year, Month, DayofMonth""",
    "departures_by_origin": """select Origin, count(FlightNum) as total_departing from flights
        where Cancelled = 0 group by Origin""",
    "arrivals_by_dest": """select Dest, count(FlightNum) as total_arriving from flights
        where Cancelled = 0 group by Dest""",
    "departures_join_arrivals": """select d.Origin as airport, d.n + a.n as total_flights
        from (select Origin, count(FlightNum) as n from flights where Cancelled = 0 group by Origin) d
        join (select Dest, count(FlightNum) as n from flights where Cancelled = 0 group by Dest) a
          on d.Origin = a.Dest""",
    "busiest_airports": f"{_AIRPORT_TOTALS} order by total_flights desc, airport",
    "busiest_airports_top5": f"{_AIRPORT_TOTALS} order by total_flights desc, airport limit 5",
    "avg_arr_delay_by_carrier": _MEAN_BY.format(key="UniqueCarrier"),
    "avg_arr_delay_by_dow": _MEAN_BY.format(key="DayOfWeek"),
    "best_carriers_top5": _MEAN_BY.format(key="UniqueCarrier")
    + " order by avg_delay nulls first, UniqueCarrier limit 5",
    "avg_arr_delay_by_carrier_cleaned": f"""select UniqueCarrier,
        {_round('avg(coalesce(ArrDelay, 0.0))')} as avg_delay
        from flights where Cancelled = 0 group by UniqueCarrier""",
    "avg_dep_delay_by_origin_carrier": f"""select Origin, UniqueCarrier, {_round('avg(DepDelay)')} as avg_delay
        from flights where Cancelled = 0 and DepDelay is not null group by Origin, UniqueCarrier""",
    "avg_dep_delay_by_route": f"""select Origin, Dest, {_round('avg(DepDelay)')} as avg_delay
        from flights where Cancelled = 0 and DepDelay is not null group by Origin, Dest""",
    "top_carriers_by_origin": _top("UniqueCarrier"),
    "top_destinations_by_origin": _top("Dest"),
    "top_carriers_at_airport": f"select * from ({_top('UniqueCarrier', 5)}) where Origin = '{AIRPORT}'",
    "top_destinations_at_airport": f"select * from ({_top('Dest', 5)}) where Origin = '{AIRPORT}'",
    "delay_totals": """select Origin, Dest, UniqueCarrier, DayOfWeek,
        cast(grouping(Origin, Dest, UniqueCarrier, DayOfWeek) as integer) as "grouping",
        count(FlightNum) as flights,
        sum(ArrDelay) as "sum_ArrDelay", count(ArrDelay) as "known_ArrDelay",
        sum(DepDelay) as "sum_DepDelay", count(DepDelay) as "known_DepDelay"
        from flights where Cancelled = 0
        group by grouping sets ((Origin, Dest), (Origin, UniqueCarrier), (DayOfWeek))""",
    "all_questions": f"""
        select 'busiest_airports' as question, airport as first_key, cast(null as varchar) as second_key,
               cast(total_flights as double) as value from ({_AIRPORT_TOTALS})
        union all select 'delay_by_carrier', UniqueCarrier, null, avg_delay
          from ({_MEAN_BY.format(key='UniqueCarrier')})
        union all select 'delay_by_weekday', cast(DayOfWeek as varchar), null, avg_delay
          from ({_MEAN_BY.format(key='DayOfWeek')})
        union all select 'top_carriers', Origin, UniqueCarrier, avg_delay from ({_top('UniqueCarrier')})
        union all select 'top_destinations', Origin, Dest, avg_delay from ({_top('Dest')})""",
    "stored_top_carriers": _top("UniqueCarrier"),
    "chart_busiest": _BUSIEST_BARS,
    "chart_punctual_carriers": _PUNCTUAL_BARS,
    "report_tables": f"""select 'busiest' as chart, airport as bar, label from ({_BUSIEST_BARS})
        union all select 'punctual', UniqueCarrier, label from ({_PUNCTUAL_BARS})""",
    "json_roundtrip": f"{_STREAMED} from flights",
    "published_records": f"{_STREAMED}, cast(FlightNum as varchar) as FlightNum from flights",
    "stream_delay_by_carrier": _live("UniqueCarrier"),
    "stream_delay_by_dow": _live("DayOfWeek"),
    "stream_publish_and_consume": f"""select UniqueCarrier as key, AvgDelay, NrFlights
        from ({_live('UniqueCarrier')})
        union all select DayOfWeek, AvgDelay, NrFlights from ({_live('DayOfWeek')})""",
    "ml_feature_rows": """select Month, DayOfWeek, UniqueCarrier, Origin, Dest, ArrDelay, DepDelay
        from flights where ArrDelay is not null and DepDelay is not null and UniqueCarrier is not null
        and Origin is not null and Dest is not null and Month is not null and DayOfWeek is not null""",
    "delay_features": f"""select Month, DayOfWeek, cast(floor(CRSDepTime / 100) as integer) as DepHour,
        UniqueCarrier, Origin, Dest, {_LABEL} as IsDelayed, FlightNum
        from flights where Cancelled = 0 and DepTime is not null""",
    "flights_without_hour": "select count(*) as rows from flights where Cancelled = 0 and DepTime is null",
    "weighted_features": f"""select Month, DayOfWeek, cast(floor(CRSDepTime / 100) as integer) as DepHour,
        UniqueCarrier, Origin, Dest, {_LABEL} as IsDelayed, cast(count(*) as double) as weight from flights
        where Cancelled = 0 and CRSDepTime is not null group by all""",
    "category_codes": " union all ".join(
        f"""select '{c}' as "column", category, dense_rank() over (order by category) - 1 as code
        from (select distinct coalesce({c}, 'None') as category from flights)"""
        for c in ("UniqueCarrier", "Origin", "Dest")
    ),
    "encoded_carriers": """select FlightNum, UniqueCarrier,
        dense_rank() over (order by coalesce(UniqueCarrier, 'None')) - 1 as carrier_code from flights""",
    "train_test_split_counts": f"""select bucket, bucket < 8 as in_train, count(*) as rows
        from (select {_BUCKET} as bucket from flights) group by bucket""",
    "gbt_scores": f"""select Month, DayOfWeek, cast(floor(CRSDepTime / 100) as integer) as DepHour,
        UniqueCarrier, Origin, Dest, {_LABEL} as IsDelayed, cast(count(*) as double) as weight,
        true as as_walked, true as agrees from flights
        where Cancelled = 0 and CRSDepTime is not null and {_BUCKET} >= 8 group by all""",
    "gbt_scored_rows": f"""select Month, DayOfWeek, cast(floor(CRSDepTime / 100) as integer) as DepHour,
        UniqueCarrier, Origin, Dest, {_LABEL} as IsDelayed, cast(count(*) as double) as weight,
        true as is_probability, true as agrees from flights
        where Cancelled = 0 and CRSDepTime is not null and {_BUCKET} >= 8 group by all""",
    "classification_metrics": _METRICS,
    "roc_auc": f"""select {_round('''
          (sum(case when IsDelayed = 1 then mean_rank else 0 end)
           - count(*) filter (IsDelayed = 1) * (count(*) filter (IsDelayed = 1) + 1) / 2)
          / (count(*) filter (IsDelayed = 1) * count(*) filter (IsDelayed = 0))''', 6)} as roc_auc
        from (select IsDelayed, cast(rank() over (order by score) as double)
                     + (count(*) over (partition by score) - 1) / 2 as mean_rank from ({_SCORED}))""",
    "run_log": f"""
        , tested as (
          select count(*) as n, sum({_LABEL}) as late from flights
          where Cancelled = 0 and CRSDepTime is not null and {_BUCKET} >= 8)
        select '{RUN_ID}' as run_id, 'Flight_Delay_Prediction' as experiment, kind, key, value from (
          select 'param' as kind, 'max_depth' as key, 6.0::double as value
          union all select 'param', 'learning_rate', 0.1::double
          union all select 'param', 'trees', 100.0::double
          union all select 'param', 'seed', 42.0::double
          union all select 'param', 'max_bins', 256.0::double
          union all select 'param', 'rows_without_hour', cast(count(*) as double) from flights
            where Cancelled = 0 and CRSDepTime is null
          union all select 'metric', 'rows_tested', cast(n as double) from tested
          union all select 'metric', 'late_tested', cast(late as double) from tested
          union all select 'metric', name || '_follows', 1.0::double
            from (values ('accuracy'), ('precision'), ('recall')) as ratios(name)
          union all select 'metric', 'roc_auc_known', 1.0::double)""",
}


def oracle_queries() -> dict[str, str]:
    return {name: _over_flights(sql) for name, sql in _SQL.items()}
