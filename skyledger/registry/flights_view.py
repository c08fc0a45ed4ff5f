"""Flight records derived from the order tables the driver provides.

A line item plays a flight: its supplier's nation is the origin, its customer's
nation the destination, its part's brand the carrier, and the days from order to
shipping give whole-minute delays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.sources.tables import read_table

# The columns used of each driver table. Stating them spares a job per table that
# would read a file footer for the schema.
TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_returnflag string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "part": "p_partkey bigint, p_brand string",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
}

COLUMNS = (
    "Year", "Month", "DayofMonth", "DayOfWeek", "DepTime", "CRSDepTime", "ArrTime", "CRSArrTime",
    "UniqueCarrier", "FlightNum", "Origin", "Dest", "Cancelled", "DepDelay", "ArrDelay",
)


def _clock(hours_later: int = 0, minutes_later: int = 0):
    hour = (F.col("l_partkey") + hours_later) % 24
    minute = (F.col("l_linenumber") * 7 + minutes_later) % 60
    return (hour * 100 + minute).cast("int")


def flights(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The flight view, or only some of its columns.

    Dimensions are looked up with left joins on their keys, which never change the
    number of rows. A lookup no requested column needs is left out, so a question
    about weekdays does not shuffle by part or supplier.
    """
    wanted = columns or COLUMNS

    def table(name):
        return read_table(spark, f"{sf_dir}/{name}.parquet", TABLES[name])

    def looked_up(rows, key, dimension, dimension_key):
        return rows.join(dimension, F.col(key) == F.col(dimension_key), "left").drop(dimension_key)

    def nation(name):
        return table("nation").select(F.col("n_nationkey").alias(f"{name}_key"), F.col("n_name").alias(name))

    # One lookup after the other: each is planned by the size of its own table. Joined
    # among themselves first, dimensions would be weighed by the product of their inputs.
    rows = table("lineitem")
    if {"Dest", "DepDelay", "ArrDelay"} & set(wanted):
        rows = looked_up(rows, "l_orderkey", table("orders"), "o_orderkey")
    if "Dest" in wanted:
        rows = looked_up(rows, "o_custkey", table("customer"), "c_custkey")
        rows = looked_up(rows, "c_nationkey", nation("dest_name"), "dest_name_key")
    if "UniqueCarrier" in wanted:
        rows = looked_up(rows, "l_partkey", table("part").withColumnRenamed("p_partkey", "part"), "part")
    if "Origin" in wanted:
        rows = looked_up(rows, "l_suppkey", table("supplier"), "s_suppkey")
        rows = looked_up(rows, "s_nationkey", nation("origin_name"), "origin_name_key")

    returned = F.col("l_returnflag").eqNullSafe("R")
    line = F.col("l_linenumber")
    no_departure, no_arrival = returned | (line == 7), returned | (line >= 6)
    ship = F.col("l_shipdate")

    def lateness():
        return F.datediff(ship.cast("date"), F.col("o_orderdate").cast("date")) % 61

    makers = {
        "Year": lambda: F.year(ship),
        "Month": lambda: F.month(ship),
        "DayofMonth": lambda: F.day(ship),
        "DayOfWeek": lambda: F.weekday(ship) + 1,
        "DepTime": lambda: F.when(~no_departure, _clock(0, 4)),
        "CRSDepTime": lambda: _clock(),
        "ArrTime": lambda: F.when(~no_arrival, _clock(2, 9)),
        "CRSArrTime": lambda: _clock(2),
        "UniqueCarrier": lambda: F.col("p_brand"),
        "FlightNum": lambda: F.col("l_orderkey"),
        "Origin": lambda: F.col("origin_name"),
        "Dest": lambda: F.col("dest_name"),
        "Cancelled": lambda: F.when(returned, 1).otherwise(0),
        "DepDelay": lambda: F.when(~no_departure, lateness().cast("double")),
        "ArrDelay": lambda: F.when(
            ~no_arrival, (lateness() + F.col("l_quantity").cast("int") - 25).cast("double")
        ),
    }
    return rows.select(*[makers[c]().alias(c) for c in wanted])


# The same view for the SQL side.
FLIGHTS_SQL = """
select cast(year(l_shipdate) as integer) as Year,
       cast(month(l_shipdate) as integer) as Month,
       cast(day(l_shipdate) as integer) as DayofMonth,
       cast(isodow(l_shipdate) as integer) as DayOfWeek,
       case when l_returnflag = 'R' or l_linenumber = 7 then null
            else cast((l_partkey % 24) * 100 + (l_linenumber * 7 + 4) % 60 as integer) end as DepTime,
       cast((l_partkey % 24) * 100 + (l_linenumber * 7) % 60 as integer) as CRSDepTime,
       case when l_returnflag = 'R' or l_linenumber >= 6 then null
            else cast(((l_partkey + 2) % 24) * 100 + (l_linenumber * 7 + 9) % 60 as integer) end as ArrTime,
       cast(((l_partkey + 2) % 24) * 100 + (l_linenumber * 7) % 60 as integer) as CRSArrTime,
       p_brand as UniqueCarrier,
       l_orderkey as FlightNum,
       sn.n_name as Origin,
       cn.n_name as Dest,
       cast(case when l_returnflag = 'R' then 1 else 0 end as integer) as Cancelled,
       case when l_returnflag = 'R' or l_linenumber = 7 then null
            else cast(date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date)) % 61
                      as double) end as DepDelay,
       case when l_returnflag = 'R' or l_linenumber >= 6 then null
            else cast(date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date)) % 61
                      + cast(l_quantity as integer) - 25 as double) end as ArrDelay
from lineitem
left join orders on l_orderkey = o_orderkey
left join part on l_partkey = p_partkey
left join supplier on l_suppkey = s_suppkey
left join nation sn on s_nationkey = sn.n_nationkey
left join customer on o_custkey = c_custkey
left join nation cn on c_nationkey = cn.n_nationkey
"""
