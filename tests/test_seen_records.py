import json
import random

import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from skyledger.plans import run_live, run_publish
from skyledger.session import SHUFFLE_CLEANUP, freeing_shuffles
from skyledger.sinks import publish_batch, read_live_table
from skyledger.sources import file_messages
from skyledger.streaming import wait_for_all, without_repeats
from skyledger.streaming.seen_records import BLOCK_RECORDS, Seen

IDS = [
    "f:0", "f:1", "f:01", "f:1\n", "f: 1", "f:+1", "f:-1", "f:", ":1", "1", "f", "", "g:1", "f:g:1", "f::1",
    f"f:{BLOCK_RECORDS - 1}", f"f:{BLOCK_RECORDS}", f"f:{BLOCK_RECORDS + 1}", "f:999999999999999999", "f:9999999999999999999",
    "é:٣", "\x00:1", "f:1 ",
]


def test_ids_of_any_form_are_known_again(spark, tmp_path):
    """Many ids, most of them several times in a batch and again in later ones; rows without an id stay."""
    random.seed(5)
    sent, topic = [], tmp_path / "topic"
    for batch in range(3):
        rows = [random.choice([*IDS, None, *[f"h:{i}" for i in range(200)]]) for _ in range(300)]
        publish_batch(spark.createDataFrame([(r, batch) for r in rows], "id string, batch int").coalesce(1), "text", str(topic))
        sent += [(r, batch) for r in rows]
    stream = file_messages(spark, str(topic), 1).select(F.from_json(F.col("value").cast("string"), "id string, batch int").alias("d")).select("d.*")
    out = str(tmp_path / "out")
    without_repeats(stream, "id", "1 hour").writeStream.option("checkpointLocation", str(tmp_path / "state")).trigger(
        availableNow=True).start(out, format="parquet").awaitTermination()
    got = [r.id for r in spark.read.parquet(out).collect()]
    known = [i for i in got if i is not None]
    assert len(known) == len(set(known)) and set(known) == {i for i, _ in sent if i is not None}
    assert len(got) - len(known) == sum(i is None for i, _ in sent)


def test_a_bucket_forgets_what_is_old_and_keeps_the_rest():
    def seen(state, time, places, digest=7):
        bucket = Seen(state, time - 100)
        n = len(places)
        keep = bucket.first(np.full(n, digest), np.zeros(n, dtype=np.int64), np.array(places))
        return bucket.stored(time), keep.tolist()

    state, keep = seen(None, 0, [3, 4, 3, -2, -2])
    assert keep == [True, True, False, True, True]
    state, keep = seen(state, 50, [4, 5])
    assert keep == [False, True]
    state, keep = seen(state, 60, [-1, -1], digest=8)
    assert keep == [True, False]
    state, keep = seen(state, 120, [3, 5])  # 3 was seen at 0, 5 at 50
    assert keep == [True, False]
    state, keep = seen(state, 155, [-1], digest=8)
    assert keep == [False]
    assert seen(state, 500, [5])[1] == [True] and len(Seen(state, 499).blocks) == 0


def test_messages_and_state_take_little_disk(spark, tmp_path):
    """Records sent twice: packed message files hold the same messages, and the state takes
    less than a byte a record."""
    raw, topic, tables = tmp_path / "raw", tmp_path / "topic", tmp_path / "tables"
    raw.mkdir()
    lines = [f"2008,1,1,{1 + i % 7},O,D,C{i % 20},{i % 100}" for i in range(60_000)]
    (raw / "f.csv").write_text("Year,Month,DayofMonth,DayOfWeek,Origin,Dest,UniqueCarrier,ArrDelay\n" + "\n".join(lines) + "\n")
    for run in ("first", "again"):
        run_publish(spark, str(raw), format="text", path=str(topic / run), records_per_batch=20_000,
                    checkpoint=str(tmp_path / run), compression="gzip")
    sent = spark.read.text(str(topic / "first"))
    packed = sum(p.stat().st_size for p in (topic / "first").glob("part-*.gz"))
    assert packed < sum(len(r.value) for r in sent.collect()) / 8
    assert sorted(json.loads(r.value)["record_id"].rpartition(":")[2] for r in sent.collect()) == sorted(map(str, range(60_000)))
    wait_for_all(run_live(spark, file_messages(spark, f"{topic}/*", 4), str(tables), available_now=True, record_id="record_id"))
    counts = rows_of(read_live_table(spark, str(tables), "UniqueCarrier").select("UniqueCarrier", "NrFlights"))
    assert counts == sorted((f"C{i}", 3000) for i in range(20))
    state = [p for p in (tables / "_checkpoint" / "state").rglob("*.*") if p.is_file() and p.suffix in (".delta", ".snapshot")]
    assert sum(p.stat().st_size for p in state) < 60_000


def test_packing_is_for_files(spark, tmp_path):
    with pytest.raises(ValueError, match="broker"):
        run_publish(spark, str(tmp_path), compression="gzip")


def test_a_finished_write_gives_up_its_shuffle_files(spark, tmp_path):
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    with freeing_shuffles(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before
