import importlib
import os

import duckdb
import pytest
from conftest import rows_of

from skyledger.__main__ import main
from skyledger.registry import oracle_queries, registered_queries
from skyledger.sinks import read_live_table
from skyledger.session import materialise, scratch_path, shared_folder

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

entry = importlib.import_module("__spark_entry__")


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_materialised_table_has_the_same_rows_and_columns(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, 0.5)], "n int, k string, x double")
    stored = materialise(df, "t")
    assert stored.dtypes == df.dtypes and rows_of(stored) == rows_of(df)


def test_a_cluster_session_needs_the_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_command_line_from_raw_file_to_report(spark, tmp_path, capsys):
    raw, cleaned, answers = (str(tmp_path / n) for n in ("raw.csv", "cleaned", "answers"))
    with open(raw, "w") as f:
        f.write("Year,Month,DayofMonth,DayOfWeek,CRSDepTime,UniqueCarrier,FlightNum,ArrDelay,DepDelay,Origin,Dest,Cancelled\n")
        for i in range(400):
            o, d = ("SFO", "LAX") if i % 2 else ("LAX", "SFO")
            late = 40 if i % 3 == 0 else "NA" if i % 7 == 0 else 0
            f.write(f"2008,{1 + i % 12},{1 + i % 28},{1 + i % 7},{i % 24 * 100},C{i % 3},{i},{late},{i % 5},{o},{d},{int(i % 50 == 0)}\n")
    main(["clean", "--source", raw, "--target", cleaned])
    main(["analytics", "--source", cleaned, "--target", answers])
    main(["report", "--source", answers, "--target", f"{answers}/visuals"])
    assert rows_of(spark.read.parquet(f"{answers}/visuals/1_busiest_airports.parquet")) == [
        ("LAX", 392, "392"), ("SFO", 392, "392")]
    assert spark.read.parquet(f"{answers}/visuals/2_punctual_carriers.parquet").count() == 3
    assert spark.read.parquet(f"{answers}/ml_features.parquet").count() == 400
    main(["train", "--source", cleaned, "--target", str(tmp_path / "model"), "--trees", "1"])
    assert os.path.isdir(tmp_path / "model" / "flight-delay-model")
    topic = str(tmp_path / "topic")
    main(["publish", "--source", raw, "--format", "text", "--path", topic])
    main(["live", "--messages", topic, "--tables", str(tmp_path / "live"), "--available-now"])
    live = read_live_table(spark, str(tmp_path / "live"), "UniqueCarrier")
    assert sum(r["NrFlights"] for r in live.collect()) == 400
    assert "roc_auc" in capsys.readouterr().out


def test_command_line_ingest(spark, tmp_path, capsys):
    from test_archives import GOOD, zipped

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.zip").write_bytes(zipped(a__csv=GOOD))
    main(["ingest", "--source", str(tmp_path / "in"), "--target", str(tmp_path / "out"),
          "--report", str(tmp_path / "report")])
    assert rows_of(spark.read.parquet(str(tmp_path / "report" / "manifest")).select("rows")) == [(1,)]
    assert spark.read.parquet(str(tmp_path / "report" / "outcomes")).first()["status"] == "OK"
    assert "OK" in capsys.readouterr().out
    assert os.path.isdir(tmp_path / "out" / "2011" / "03" / "2011_03_07.csv")


def test_flagship(spark):
    if not os.path.isdir(SMALL):
        pytest.skip("no driver tables")
    assert entry.entry(spark).count() == 10


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    # The queries of the optional corpus subpackage have tests of their own.
    assert set(registered_queries()) == set(oracle_queries())


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_matches_its_sql_twin(spark, name):
    if not os.path.isdir(SMALL):
        pytest.skip("no driver tables")
    df = entry.queries()[name](spark, SMALL)
    got = rows_of(df.select(sorted(df.columns)))
    assert got
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    names = {row[0] for row in db.execute(f"describe {sql}").fetchall()}
    assert names == set(df.columns)
    columns = ", ".join(f'"{c}"' for c in sorted(df.columns))
    want = db.execute(f"select {columns} from ({sql})").fetchall()
    assert got == sorted(want, key=lambda row: tuple((v is not None, str(type(v)) if v is None else v) for v in row))
