import json
import time

import pytest
from conftest import rows_of
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from skyledger import operators as op
from skyledger.plans import run_live, run_publish
from skyledger.sinks import (
    changed_groups_sink,
    console_sink,
    latest_groups,
    live_tables_sink,
    memory_sink,
    publish_batch,
    read_live_table,
    to_messages,
)
from skyledger.sinks.commits import Commits
from skyledger.sources import (
    MissingColumnsError,
    MissingSourceError,
    file_messages,
    read_text_records,
    record_stream,
    text_record_stream,
)
from skyledger.sinks.messages import kafka_target, publish_stream
from skyledger.sources.messages import kafka_options
from skyledger.streaming import (
    QueryLog,
    parse_messages,
    running_delay,
    start_live_delays,
    start_live_tables,
    wait_for_all,
)

PAYLOADS = [
    '{"UniqueCarrier":"WN","DayOfWeek":"1","ArrDelay":"-14"}',
    '{"UniqueCarrier":"WN","DayOfWeek":"1","ArrDelay":-14}',
    '{"UniqueCarrier":"WN","ArrDelay":"NA"}',
    '{"UniqueCarrier":"WN","ArrDelay":"NaN"}',
    '{"UniqueCarrier":"","ArrDelay":""}',
    "not json",
]


def messages(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string").select(F.col("value").cast("binary"))


def test_payloads(spark):
    parsed = parse_messages(messages(spark, PAYLOADS))
    got = [(r["UniqueCarrier"], r["DayOfWeek"], r["ArrDelay"]) for r in parsed.collect()]
    assert got == [("WN", "1", -14.0), ("WN", "1", -14.0), ("WN", None, 0.0), ("WN", None, 0.0),
                   ("", None, 0.0), (None, None, 0.0)]


def test_running_delay_counts_known_keys(spark):
    got = rows_of(running_delay(parse_messages(messages(spark, PAYLOADS)), "UniqueCarrier"))
    assert got == [(None, 0.0, 0), ("", 0.0, 1), ("WN", -7.0, 4)]


def test_messages_keep_nulls(spark):
    df = spark.createDataFrame([("WN", None)], "UniqueCarrier string, ArrDelay string")
    assert json.loads(to_messages(df).first()[0]) == {"UniqueCarrier": "WN", "ArrDelay": None}


def test_kafka_settings():
    assert kafka_options("h1:1,h2:2", "t", max_per_trigger=10_000, min_tasks=64) == {
        "kafka.bootstrap.servers": "h1:1,h2:2", "subscribe": "t",
        "startingOffsets": "earliest", "maxOffsetsPerTrigger": "10000", "minPartitions": "64",
    }
    assert "maxOffsetsPerTrigger" not in kafka_options()
    assert kafka_target("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}


def test_the_topic_is_the_default_source(spark):
    """The connector is not on the test class path, so Spark must ask for it by name."""
    with pytest.raises(AnalysisException, match="kafka"):
        run_live(spark, brokers="localhost:9092", topic="flights")


@pytest.fixture
def raw_folder(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for part in range(5):
        lines = [
            f"2008,1,{1 + i % 28},{1 + i % 7},O,D,{'WN AA DL'.split()[i % 3]},{'NA' if i % 10 == 0 else i - 50}"
            for i in range(part * 40, part * 40 + 40)
        ]
        (folder / f"{part}.csv").write_text(
            "Year,Month,DayofMonth,DayOfWeek,Origin,Dest,UniqueCarrier,ArrDelay\n" + "\n".join(lines) + "\n"
        )
    return str(folder)


def batch_answer(spark, raw_folder, key):
    rows = op.fill_missing(
        read_text_records(spark, raw_folder).withColumn("ArrDelay", F.expr("try_cast(ArrDelay as double)")),
        {"ArrDelay": 0.0},
    )
    return rows_of(running_delay(rows, key))


@pytest.mark.parametrize("files_per_batch", [None, 2])
def test_stream_equals_batch(spark, raw_folder, tmp_path, files_per_batch):
    topic, tables = str(tmp_path / "topic"), str(tmp_path / "tables")
    run_publish(spark, raw_folder, format="text", path=topic, files_per_batch=files_per_batch)
    queries = run_live(
        spark, file_messages(spark, topic, 1), tables, str(tmp_path / "state"), available_now=True
    )
    wait_for_all(queries, 120)
    assert len(queries) == 1 and len(queries[0].lastProgress["sources"]) == 1
    for key in ("UniqueCarrier", "DayOfWeek"):
        assert rows_of(read_live_table(spark, tables, key)) == batch_answer(spark, raw_folder, key)


def test_a_reader_between_batches_sees_whole_tables_and_a_replay_changes_nothing(spark, raw_folder, tmp_path):
    topic, tables, state = (str(tmp_path / n) for n in ("topic", "tables", "state"))
    run_publish(spark, raw_folder, format="text", path=topic)
    seen, folders = [], []

    def sink(running):
        writer = live_tables_sink(running, tables, state, keep=1)

        def spied(batch, batch_id):
            before = Commits(spark, tables).last()
            store(batch, batch_id)
            now = Commits(spark, tables).last()
            # All keys of a version are of the same batch: they count the same messages.
            counts = [read_live_table(spark, tables, k).agg(F.sum("NrFlights")).first()[0] for k in ("UniqueCarrier", "DayOfWeek")]
            seen.append(counts)
            store(batch, batch_id)
            folders.append((before and before["folder"], now["folder"], Commits(spark, tables).last()["folder"]))

        store = captured(writer)
        return running.writeStream.outputMode("complete").option("checkpointLocation", state).foreachBatch(spied)

    query = start_live_tables(file_messages(spark, topic, 1), sink, available_now=True)
    wait_for_all([query], 120)
    assert len(seen) > 1 and all(a == b for a, b in seen) and seen[-1] == [200, 200]
    assert all(before != now and now == replayed for before, now, replayed in folders)
    assert len([p for p in (tmp_path / "tables").iterdir() if p.name.startswith("v-")]) == 1


STORED = []


def captured(writer):
    """The function a foreachBatch writer calls."""
    return STORED.pop()


@pytest.fixture(autouse=True)
def keep_batch_functions(monkeypatch):
    original = DataStreamWriter.foreachBatch

    def foreach_batch(self, function):
        STORED.append(function)
        return original(self, function)

    monkeypatch.setattr(DataStreamWriter, "foreachBatch", foreach_batch)


def test_a_batch_published_twice_counts_once(spark, tmp_path):
    topic, tables = str(tmp_path / "topic"), str(tmp_path / "tables")
    rows = [("WN", str(i), f"f:{i}") for i in range(20)] + [("AA", "7", None)] * 2
    df = spark.createDataFrame(rows, "UniqueCarrier string, ArrDelay string, record_id string")
    found = []
    for _ in range(2):
        publish_batch(df, "text", topic)
        wait_for_all(run_live(spark, file_messages(spark, topic), tables, keys=("UniqueCarrier",), available_now=True, record_id="record_id"))
        found.append(rows_of(read_live_table(spark, tables, "UniqueCarrier")))
    assert found == [[("AA", 7.0, 2), ("WN", 9.5, 20)], [("AA", 7.0, 4), ("WN", 9.5, 20)]]


def test_live_tables_before_the_first_batch(spark, tmp_path):
    with pytest.raises(MissingSourceError, match="no committed batch"):
        read_live_table(spark, str(tmp_path), "UniqueCarrier")


def test_the_log_keeps_progress_and_the_failing_query(spark, raw_folder, tmp_path):
    topic = str(tmp_path / "topic")
    run_publish(spark, raw_folder, format="text", path=topic)
    log = QueryLog(spark, str(tmp_path / "log"))

    def sink(running, key):
        if key == "DayOfWeek":
            return memory_sink(running, str(tmp_path / "a"), "kept_log")
        return memory_sink(running.withColumn("x", F.raise_error(F.lit("broken on purpose"))), str(tmp_path / "b"), "broken_log")

    failing, kept = start_live_delays(file_messages(spark, topic), sink, available_now=True)
    kept.awaitTermination(60)
    with pytest.raises(Exception, match="broken on purpose"):
        wait_for_all([failing], 60)
    events = {}
    for _ in range(50):
        events = {(r.query, r.event): r for r in log.table().collect()} if (tmp_path / "log").exists() else {}
        if len([e for _, e in events if e in ("failed", "ended")]) == 2:
            break
        time.sleep(0.2)
    log.stop()
    failed = [r for (_, event), r in events.items() if event == "failed"]
    assert len(failed) == 1 and "broken on purpose" in failed[0].error
    names = {r.query: r.name for (_, event), r in events.items() if event == "started"}
    assert names[failed[0].query] == "broken_log"
    assert sum(r.rows for r in log.table().filter("event = 'progress' AND name = 'kept_log'").collect()) == 200


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    topic, tables, state = (str(tmp_path / n) for n in ("topic", "tables", "state"))

    def send(delay):
        df = spark.createDataFrame([("WN", delay)], "UniqueCarrier string, ArrDelay string")
        publish_batch(df, "text", topic)

    def run():
        wait_for_all(run_live(spark, file_messages(spark, topic), tables, state, ("UniqueCarrier",), True), 120)
        return rows_of(read_live_table(spark, tables, "UniqueCarrier"))

    send("10")
    assert run() == [("WN", 10.0, 1)]
    send("20")
    assert run() == [("WN", 15.0, 2)]


def test_memory_and_console_sinks(spark, raw_folder, tmp_path):
    topic = str(tmp_path / "topic")
    run_publish(spark, raw_folder, format="text", path=topic)

    def sink(running, key):
        place = str(tmp_path / "state" / key)
        return memory_sink(running, place, "live") if key == "DayOfWeek" else console_sink(running, place)

    queries = start_live_delays(file_messages(spark, topic), sink, available_now=True)
    wait_for_all(queries, 120)
    assert "Console" in queries[0].lastProgress["sink"]["description"]
    assert rows_of(spark.table("live")) == batch_answer(spark, raw_folder, "DayOfWeek")


def test_publishing_stops_at_the_given_files_per_batch(spark, raw_folder, tmp_path):
    columns = read_text_records(spark, raw_folder).columns
    stream = text_record_stream(spark, raw_folder, columns, 2)
    query = publish_stream(stream, str(tmp_path / "state"), "text", str(tmp_path / "topic"))
    query.awaitTermination(120)
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [80, 80, 40]


def test_at_most_one_batch_per_interval(spark, raw_folder, tmp_path):
    start = time.monotonic()
    run_publish(spark, raw_folder, format="text", path=str(tmp_path / "topic"), files_per_batch=1, every="1 second")
    assert time.monotonic() - start > 3
    assert spark.read.text(str(tmp_path / "topic")).count() == 200


def test_changed_groups_give_the_same_state(spark, raw_folder, tmp_path):
    topic, changes = str(tmp_path / "topic"), str(tmp_path / "changes")
    run_publish(spark, raw_folder, format="text", path=topic)

    def sink(running, key):
        return changed_groups_sink(running, changes, str(tmp_path / "state"))

    queries = start_live_delays(file_messages(spark, topic, 1), sink, ("DayOfWeek",), True)
    wait_for_all(queries, 120)
    stored = spark.read.parquet(changes)
    assert stored.select("batch").distinct().count() > 1
    assert rows_of(latest_groups(stored, "DayOfWeek")) == batch_answer(spark, raw_folder, "DayOfWeek")


def test_a_failing_query_stops_the_others(spark, raw_folder, tmp_path):
    topic = str(tmp_path / "topic")
    run_publish(spark, raw_folder, format="text", path=topic)

    def sink(running, key):
        if key == "DayOfWeek":
            return memory_sink(running, str(tmp_path / "a"), "kept")
        broken = running.withColumn("x", F.raise_error(F.lit("broken on purpose")))
        return memory_sink(broken, str(tmp_path / "b"), "broken")

    queries = start_live_delays(file_messages(spark, topic), sink)
    with pytest.raises(Exception, match="broken on purpose"):
        wait_for_all(queries, 60)
    assert not any(q.isActive for q in queries)


def test_jobs_started_again_without_a_checkpoint_go_on(spark, raw_folder, tmp_path):
    topic, tables = str(tmp_path / "topic"), str(tmp_path / "tables")
    for _ in range(2):
        run_publish(spark, raw_folder, format="text", path=topic, files_per_batch=1)
        wait_for_all(run_live(spark, file_messages(spark, topic), tables, keys=("UniqueCarrier",), available_now=True))
    sent = spark.read.text(topic).count()
    assert sent == spark.read.csv(raw_folder, header=True).count()
    assert read_live_table(spark, tables, "UniqueCarrier").agg(F.sum("NrFlights")).first()[0] == sent


def test_a_pace_without_batches_is_refused(spark, raw_folder, tmp_path):
    with pytest.raises(ValueError, match="files_per_batch"):
        run_publish(spark, raw_folder, format="text", path=str(tmp_path / "topic"), every="1 second")


def records_file(folder, name, count, text="x{i}"):
    folder.mkdir(exist_ok=True)
    lines = [f"{i},{text.format(i=i)}" for i in range(count)]
    (folder / name).write_text("FlightNum,UniqueCarrier\n" + "\n".join(lines) + "\n")


def batch_sizes(topic):
    sizes = [len(p.read_text().splitlines()) for p in sorted(topic.glob("part-*")) if p.stat().st_size]
    return sorted(sizes, reverse=True)


def test_records_go_out_some_thousand_at_a_time_and_a_restart_goes_on_in_mid_file(spark, tmp_path):
    raw, topic = tmp_path / "raw", tmp_path / "topic"
    records_file(raw, "big.csv", 12_345)
    stream = record_stream(spark, str(raw), str(tmp_path / "state" / "records"), 5000)
    first = publish_stream(stream, str(tmp_path / "state" / "state"), "text", str(topic), "1 hour")
    for _ in range(300):
        if first.lastProgress and first.lastProgress["batchId"] == 0:
            break
        time.sleep(0.1)
    first.stop()
    assert batch_sizes(topic) == [5000]

    def publish():
        run_publish(spark, str(raw), format="text", path=str(topic), records_per_batch=5000, checkpoint=str(tmp_path / "state"))

    publish()
    assert batch_sizes(topic) == [5000, 5000, 2345]
    records_file(raw, "a-later.csv", 10)
    publish()
    sent = [json.loads(r.value) for r in spark.read.text(str(topic)).collect()]
    assert len(sent) == len({r["record_id"] for r in sent}) == 12_355
    big = {int(r["FlightNum"]): r for r in sent if "/big.csv:" in r["record_id"]}
    assert sorted(big) == list(range(12_345)) and all(r["UniqueCarrier"] == f"x{i}" for i, r in big.items())
    assert all(r["record_id"].endswith(f"big.csv:{i}") for i, r in big.items())


@pytest.mark.parametrize("per_batch", [1, 2, 7, 100])
def test_admitted_records_equal_the_file(spark, tmp_path, per_batch):
    """Quotes, line breaks in values, blank lines, short rows, no last line break."""
    from skyledger.sources import paced_records as module

    (tmp_path / "raw").mkdir()
    text = 'a,b\r\n1,"x\n""y"", z"\r\n\r\n2\r\n,\r\n"3",é,over\r\n\r\n4,"last"'
    (tmp_path / "raw" / "f.csv").write_bytes(text.encode())
    index = str(tmp_path / "state" / "records")
    stream = module.record_stream(spark, str(tmp_path / "raw"), index, per_batch, None)
    query = stream.writeStream.format("memory").queryName(f"admitted_{per_batch}").start()
    try:
        query.processAllAvailable()
        assert sorted(tuple(r) for r in spark.table(f"admitted_{per_batch}").collect()) == [
            ("", ""), ("1", 'x\n"y", z'), ("2", ""), ("3", "é"), ("4", "last")
        ]
    finally:
        query.stop()
    stretches = spark.read.parquet(index).collect()
    assert sum(r.rows for r in stretches) == 5 and all(r.rows <= per_batch for r in stretches)


def test_stretches_of_chunks_smaller_than_records(spark, tmp_path, monkeypatch):
    from skyledger.sources import paced_records as module

    text = "name\n" + "".join(("w" * (i % 9) + "\n") for i in range(50))
    (tmp_path / "f.csv").write_text(text)
    whole = list(module._file_stretches(str(tmp_path / "f.csv"), 4))
    for size in (1, 2, 3, 5, 64):
        monkeypatch.setattr(module, "CHUNK_BYTES", size)
        assert list(module._file_stretches(str(tmp_path / "f.csv"), 4)) == whole
    assert sum(rows for _, _, rows, _, _ in whole) == sum(bool(line) for line in text.split("\n")[1:])


def test_files_of_several_headers_are_no_record_stream(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n1\n")
    (tmp_path / "b.csv").write_text("y\n1\n")
    with pytest.raises(MissingColumnsError, match="several headers"):
        record_stream(spark, str(tmp_path), str(tmp_path / "_state"), 5)


def test_a_batch_takes_stretches_of_several_files_and_is_dealt_over_tasks(spark, tmp_path, monkeypatch):
    from skyledger.sources import paced_records as module

    monkeypatch.setattr(module, "STRETCH_RECORDS", 10)
    monkeypatch.setattr(module, "TASK_RECORDS", 20)
    raw, topic, state = tmp_path / "raw", tmp_path / "topic", tmp_path / "state"
    records_file(raw, "a.csv", 25)
    records_file(raw, "b.csv", 65)
    run_publish(spark, str(raw), format="text", path=str(topic), records_per_batch=60, checkpoint=str(state))
    assert sorted(p.name for p in (topic / "_spark_metadata").glob("[0-9]*")) == ["0", "1"]
    assert len(batch_sizes(topic)) > 2 and max(batch_sizes(topic)) <= 30
    sent = [json.loads(r.value) for r in spark.read.text(str(topic)).collect()]
    assert len(sent) == 90 == len({r["record_id"] for r in sent})
    assert all(r["record_id"].endswith(f".csv:{r['FlightNum']}") for r in sent)
    reader = module.StretchReader(str(state / "records"), 60)
    first, end = reader.read(reader.initialOffset())
    first = list(first)
    assert sum(rows for _, _, rows, _, _ in first) == 55 and {path.rpartition("/")[2] for path, *_ in first} == {"a.csv", "b.csv"}
    assert list(reader.readBetweenOffsets(reader.initialOffset(), end)) == first
    rest, last = reader.read(end)
    assert sum(rows for _, _, rows, _, _ in rest) == 35 and list(reader.read(last)[0]) == []
