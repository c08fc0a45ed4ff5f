import io
import os
import random
import zipfile

import pytest
from conftest import rows_of

from skyledger.operators import outcome_counts
from skyledger.plans.ingest import dated_rows, run_ingest, stage_archives, stored_outcomes
from skyledger.schema import ARCHIVE_FIELDS, flight_schema
from skyledger.sinks import read_published_days
from skyledger.sources import MissingSourceError, find_archives, list_members, read_unpacked, unpack_members
from skyledger.sources.archives import RecordEnds, spread_members

HEADER = ",".join(ARCHIVE_FIELDS) + "\n"
GOOD = HEADER + "2011,3,7,1,617,610,748,735,QX,7101\n"


def zipped(**members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as target:
        for name, text in members.items():
            target.writestr(name.replace("__", ".").replace("_slash_", "/"), text)
    return buffer.getvalue()


def damaged_second_member():
    data = zipped(a__csv=GOOD, b__csv=GOOD.replace("7101", "7102"))
    with zipfile.ZipFile(io.BytesIO(data)) as source:
        info = source.infolist()[1]
    start = info.header_offset + 30 + len(info.filename)
    return data[:start] + b"\xff" * 12 + data[start + 12:]


@pytest.fixture
def archives(tmp_path):
    root = tmp_path / "in"
    (root / "deep er").mkdir(parents=True)
    two = zipped(
        first__csv=GOOD + "2011,3,NA,3,NA,2005,NA,2140,ZY,512\n",
        sub_slash_second__csv=HEADER + "2011.0,11,30,3,1244.0,1230,1351,1355,KV,77\n",
        notes__txt="ignored",
    )
    (root / "two.zip").write_bytes(two)
    (root / "deep er" / "nested.zip").write_bytes(zipped(x__csv=GOOD.replace("7101", "404")))
    (root / "none.zip").write_bytes(zipped(readme__txt="no table here"))
    (root / "corrupt.zip").write_bytes(b"this is not a zip file")
    (root / "columns.zip").write_bytes(zipped(x__csv="Year,Month\n2008,1\n"))
    (root / "half.zip").write_bytes(damaged_second_member())
    (root / "UPPER.ZIP").write_bytes(zipped(x__csv=GOOD))
    return str(root)


def test_discovery_is_by_suffix_at_any_depth(spark, archives):
    names = {r["archive"].rpartition("/")[2] for r in find_archives(spark, archives).collect()}
    assert names == {"two.zip", "nested.zip", "none.zip", "corrupt.zip", "columns.zip", "half.zip"}


def test_discovery_of_a_missing_folder(spark, tmp_path):
    with pytest.raises(MissingSourceError):
        find_archives(spark, str(tmp_path / "nowhere"))


def test_outcomes_rows_days_and_manifest(spark, archives, tmp_path):
    target = str(tmp_path / "out")
    done = run_ingest(spark, archives, target, bucket="store")
    outcomes = {
        r["archive"].rpartition("/")[2]: (r["status"], r["rows_read"], r["rows_kept"])
        for r in done.outcomes.collect()
    }
    assert outcomes == {
        "two.zip": ("OK", 3, 2),
        "nested.zip": ("OK", 1, 1),
        "none.zip": ("ERROR", 0, 0),
        "corrupt.zip": ("ERROR", 0, 0),
        "columns.zip": ("ERROR", 0, 0),
        "half.zip": ("ERROR", 0, 0),
    }
    errors = {r["archive"].rpartition("/")[2]: r["error"] for r in done.outcomes.collect()}
    assert "no .csv member" in errors["none.zip"]
    assert "BadZipFile" in errors["corrupt.zip"]
    assert "Usecols" in errors["columns.zip"]
    assert errors["half.zip"] and errors["two.zip"] is None
    assert rows_of(outcome_counts(done.outcomes)) == [("ERROR", 4, 0, 0), ("OK", 2, 4, 3)]

    assert done.totals == {"rows_read": 4, "rows_kept": 3, "rows_dropped": 1}
    assert rows_of(done.manifest.select("bucketname", "key", "rows")) == [
        ("store", f"{target}/2011/03/2011_03_07.csv", 2),
        ("store", f"{target}/2011/11/2011_11_30.csv", 1),
    ]
    for r in done.manifest.collect():
        assert r["path"] == r["key"] and os.path.isdir(r["key"])
        assert spark.read.csv(r["key"], header=True).count() == r["rows"]
    assert not [name for name in os.listdir(target) if name.startswith("_")]
    written = read_published_days(spark, target, flight_schema(ARCHIVE_FIELDS))
    assert rows_of(written) == [
        (2011, 3, 7, 1, 617, 610, 748, 735, "QX", 404),
        (2011, 3, 7, 1, 617, 610, 748, 735, "QX", 7101),
        (2011, 11, 30, 3, 1244, 1230, 1351, 1355, "KV", 77),
    ]


def unpacked_from(spark, folder, *texts, **options):
    folder.mkdir()
    for i, text in enumerate(texts):
        (folder / f"{i}.zip").write_bytes(zipped(a__csv=text))
    return unpack_members(list_members(find_archives(spark, str(folder))), **options)


def read_one(spark, folder, text, **options):
    unpacked = unpacked_from(spark, folder, text, **options)
    return read_unpacked(unpacked), unpacked.members.first()


def test_a_large_member_is_cut_into_parts_that_several_tasks_read(spark, tmp_path):
    body = "".join(f"2008,1,{1 + i % 28},2,1,1,1,1,WN,{i}\n" for i in range(60_000))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        rows, member = read_one(spark, tmp_path / "in", HEADER + body, part_bytes=100_000)
        assert member["error"] is None and member["parts"] > 10
        assert rows.rdd.getNumPartitions() >= 8
        assert sorted(int(r["FlightNum"]) for r in rows.collect()) == list(range(60_000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_short_rows_late_in_a_member_are_padded_and_nothing_repeats(spark, tmp_path):
    lines = [f"2008,1,{1 + i % 28},2,1,1,1,1,WN,{i}" for i in range(1000)]
    lines[700] = "2008,1,1,2"
    rows, member = read_one(spark, tmp_path / "in", HEADER + "\n".join(lines) + "\n", part_bytes=500)
    numbers = [r["FlightNum"] for r in rows.collect()]
    assert numbers.count(None) == 1
    assert sorted(int(n) for n in numbers if n) == [i for i in range(1000) if i != 700]
    assert member["error"] is None


@pytest.mark.parametrize("part_bytes", [100, 1 << 20])
def test_bad_bytes_and_short_rows_have_one_outcome_wherever_they_stand(spark, tmp_path, part_bytes):
    """The same bad row, first and last of many, reads the same, whatever the parts."""
    bad = b"2008,1,15,2,1,1,1,1,W\xff\xfeN,5\n2008,1,16\n"
    good = b"".join(b"2008,1,1,2,1,1,1,1,WN,%d\n" % i for i in range(50))
    for name, body in (("first", bad + good), ("last", good + bad)):
        rows, member = read_one(spark, tmp_path / name, HEADER.encode() + body, part_bytes=part_bytes)
        found = [r for r in rows.collect() if r["DayofMonth"] in ("15", "16")]
        assert sorted((r["DayofMonth"], r["UniqueCarrier"], r["FlightNum"]) for r in found) == [
            ("15", "W\ufffd\ufffdN", "5"), ("16", None, None)
        ]
        assert member["error"] is None and rows.count() == 52


def test_fields_beyond_the_header_are_left_out(spark, tmp_path):
    rows, member = read_one(spark, tmp_path / "in", GOOD + GOOD.splitlines()[1] + ",too,many\n")
    assert [r["FlightNum"] for r in rows.collect()] == ["7101", "7101"]
    assert member["error"] is None


def test_members_of_several_headers_are_united_by_name(spark, tmp_path):
    turned = ",".join([*reversed(ARCHIVE_FIELDS), "Year"]) + "\n" + "9,WN,8,7,6,5,4,3,2,2008,1999\n"
    unpacked = unpacked_from(spark, tmp_path / "in", GOOD, turned, "\ufeff" + GOOD, GOOD.replace("\n", "\r\n"), GOOD.replace("\n", "\r"))
    found = [tuple(r)[1:] for r in read_unpacked(unpacked).collect()]
    one = ("2011", "3", "7", "1", "617", "610", "748", "735", "QX", "7101")
    assert sorted(found) == [("2008", "2", "3", "4", "5", "6", "7", "8", "WN", "9"), one, one, one, one]


def test_a_repeated_task_leaves_the_same_parts(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.zip").write_bytes(zipped(a__csv=GOOD + GOOD.splitlines()[1] + "\n"))
    members = list_members(find_archives(spark, str(tmp_path / "in")))
    for _ in range(2):
        unpacked = unpack_members(members, part_bytes=20, folder=str(tmp_path / "parts"))
    assert read_unpacked(unpacked).count() == 2


def plain_record_ends(data):
    """Line feeds outside quotes, sign by sign."""
    ends, quoted, start, place = [], False, True, 0
    while place < len(data):
        sign = data[place : place + 1]
        if quoted and data[place : place + 2] == b'""':
            place += 1
        elif sign == b'"' and (quoted or start):
            quoted = not quoted
        elif sign == b"\n" and not quoted:
            ends.append(place + 1)
        start = not quoted and sign in b",\r\n"
        place += 1
    return ends


@pytest.mark.parametrize("pieces", [
    ["a", ",", "\n", '"b,\n"', '""', '"x""y"', '"""\n"""'],
    ["a", ",", "\n", '"', '""', "\r\n", "é"],
])
def test_record_ends_are_found_across_chunks(pieces):
    rng = random.Random(2)
    for _ in range(300):
        data = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 60))).encode()
        ends, at, found = RecordEnds(), 0, []
        while at < len(data):
            size = rng.randint(1, 12)
            found += [at + int(e) for e in ends.of(data[at : at + size])]
            at += size
        assert found == plain_record_ends(data), data


def test_quoted_line_breaks_and_an_empty_member(spark, tmp_path):
    quoted = GOOD.replace("QX", '"W\n""N"')
    rows, _ = read_one(spark, tmp_path / "in", quoted + quoted.split("\n", 1)[1], part_bytes=1)
    assert [r["UniqueCarrier"] for r in rows.collect()] == ['W\n"N'] * 2
    rows, member = read_one(spark, tmp_path / "header", HEADER)
    assert rows.count() == 0 and member["error"] is None
    _, member = read_one(spark, tmp_path / "empty", "")
    assert "MissingColumnsError" in member["error"]


def test_members_of_one_archive_are_unpacked_by_several_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    (tmp_path / "in").mkdir()
    many = {f"m{i}__csv": GOOD.replace("7101", str(i)) for i in range(16)}
    (tmp_path / "in" / "big.zip").write_bytes(zipped(**many))
    members = spread_members(list_members(find_archives(spark, str(tmp_path / "in"))))
    assert members.select(F.spark_partition_id().alias("p")).distinct().count() > 4
    assert read_unpacked(unpack_members(members)).count() == 16


def test_no_archives_at_all(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.txt").write_text("x")
    staged = stage_archives(spark, str(tmp_path / "in"))
    assert dated_rows(staged, stored_outcomes(staged)).count() == 0


def test_rows_are_not_shuffled_to_take_out_failed_archives(spark, archives):
    staged = stage_archives(spark, archives)
    plan = dated_rows(staged, stored_outcomes(staged))._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti, BuildRight" in plan and "hashpartitioning" not in plan
