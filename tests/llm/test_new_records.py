"""Conversations, vector codes and archives against plain versions and round trips."""

import base64
import hashlib
import math
import random
import re
import zlib
from functools import lru_cache

import pytest
from corpus_fixtures import LONG
from pyspark.sql import functions as F

from skyledger.llm import conversations, vector_codes, warc
from skyledger.llm.queries import op11_conversations, op12_vector_codes, op13_warc

SF = "/root/testdata/sf0.01"
BLANKS = " \t\n\x0b\x0c\r"
CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string, digest string, alive string, whole string"


# --- conversations --------------------------------------------------------------


def plain_damage(rows):
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        harm = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        role = "user" if harm == 4 else role
        for _ in range(0 if harm == 0 else 2 if harm == 3 else 1):
            yield conv, turn, role, text


def tie(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def plain_repair(turns):
    """Every field but conv_id, by search from each row and state to the end with whole strings."""
    turns = sorted(turns, key=lambda x: (x[0] is not None, x[0] or 0, tie(x[1], x[2])))
    seen, faults = set(), []
    for _, role, text in turns:
        words = text.strip(BLANKS)
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)

    def after(state):
        return "a" if state == "u" else "u"

    @lru_cache(None)
    def best(i, state, inserts):
        ways = []
        if i == len(turns) and state in ("", "a"):
            ways.append((0, "", ()))
        if inserts < 4:
            cost, edits, left = best(i, after(state), inserts + 1)
            ways.append((cost + 2, "I" + edits, ((("user" if after(state) == "u" else "assistant"), ""), *left)))
        if i < len(turns):
            _, role, text = turns[i]
            cost, edits, left = best(i + 1, state, 0)
            ways.append((cost + 3, "D" + edits, left))
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                cost, edits, left = best(i + 1, after(state), 0)
                ways.append((cost + 2 + more, "R" + edits, (("user" if after(state) == "u" else "assistant", text), *left)))
                if role[:1] == after(state) or role[:1] == "s" and state == "":
                    cost, edits, left = best(i + 1, role[:1], 0)
                    ways.append((cost + more, "K" + edits, ((role, text), *left)))
        return min(ways, default=(math.inf, "", ()))

    for i in range(len(turns), -1, -1):
        for state in ("", "s", "u", "a"):
            best(i, state, 0)
    cost, audit, left = best(0, "", 0)
    known = [t for t, _, _ in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    initials = [role[:1] for _, role, _ in turns]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    text = "\n".join(f"{r}:{t}" for r, t in left)
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()), list(left)


def plain_results(rows, names):
    grouped = {conv: [] for conv in names}
    for conv, turn, role, text in rows:
        grouped[conv].append((turn, role, text))
    return {conv: plain_repair(turns)[0] for conv, turns in grouped.items()}


def results(df):
    found = {r["conv_id"]: tuple(r[c] for c in conversations.RESULT[1:]) for r in df.collect()}
    assert len(found) == df.count()
    return found


def random_turns(seed, conversations_, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations_):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "unknown", "tool", "", None])
            text = rng.choice(["One. ", "Two!", "three", " \t\n", "", None, "É?", f"text {rng.randint(0, 9)}."])
            rows.append((conv or None, rng.choice([turn, turn, turn + 3, None]), role, text, "d", "x", "w"))
    return rows


def test_conversations_of_the_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    expected = plain_results(plain_damage(rows), {r[0] for r in rows})
    assert results(op11_conversations(spark, SF)) == expected


@pytest.mark.parametrize("stretch_rows", [1, 3, 4096])
def test_any_cut_gives_the_same_repair(spark, stretch_rows):
    rows = random_turns(5, 60, 12) + random_turns(6, 1, 60)
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(5)
    expected = plain_results([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x, *_ in rows], {r[0] for r in rows})
    assert results(conversations.repair_conversations(df, stretch_rows=stretch_rows)) == expected


def test_repaired_turns_alternate(spark):
    rows = random_turns(8, 30, 9)
    df = spark.createDataFrame(rows, CONVERSATIONS)
    found = {}
    for r in conversations.repaired_turns(df, stretch_rows=4).orderBy("part", "seq", "place").collect():
        found.setdefault(r.conv_id, []).append((r.role, r.text))
    for conv in {r[0] for r in rows}:
        turns = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x, *_ in rows if c == conv]
        left = plain_repair(turns)[1]
        assert found.get(conv, []) == left
        assert re.fullmatch("(s?(ua)+)?", "".join(role[:1] for role, _ in left))


def test_conversations_dropped_empty_or_very_long(spark):
    rows = [(1, 0, "user", "gone"), (2, 0, "user", LONG + "."), (2, 1, "assistant", LONG + "."), (2, 1, "assistant", LONG + ".")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = results(conversations.repair_conversations(df, alive=F.col("conv_id") != 1))
    assert found[1] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found[2][:-1] == (0, 0, 1, 0, 1, 3, "KKD")
    assert conversations.repair_conversations(df.limit(0)).count() == 0
    assert conversations.repaired_turns(df.limit(0)).count() == 0


def test_one_conversation_of_many_equal_rows_is_cut(spark):
    """Thousands of equal rows of one conversation do not meet in one stretch."""
    df = spark.range(6000).selectExpr("7L as conv_id", "1L as turn", "'user' as role", "'Same.' as text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = conversations.stretches(conversations.plain_rows(df), False, 4096)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r.n for r in table.selectExpr("size(roles) as n").collect()]
    assert sum(sizes) == 6000 and len(sizes) >= 6 and max(sizes) < 3000
    assert results(conversations.repair_conversations(df))[7][:6] == (0, 0, 5999, 0, 5999, 2 + 3 * 5999)


def test_deceiving_hashes_are_found_out():
    """With a modulus of 7 nearly all hashes meet; the order must still be that of the strings."""
    rng = random.Random(3)
    audits, level = conversations.Audits(base=3, prime=7), [0]
    for _ in range(40):
        level = [audits.add(node, rng.choice(["D", "K", "R", "IK", "IIR"])) for node in rng.choices(level, k=6)]
        for a in level:
            for b in level:
                for one, other in (("K", "K"), ("D", "IK")):
                    expected = audits.spelled(a) + one < audits.spelled(b) + other
                    if audits.spelled(a) != audits.spelled(b) or a == b:
                        assert audits.before(a, one, b, other) == expected


# --- vector codes ---------------------------------------------------------------


def plain_codes(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = -(-max(len(v) for _, v, _ in kept) // parts)
    cut = [[(v + [0] * (parts * size))[p * size : (p + 1) * size] for _, v, _ in kept] for p in range(parts)]
    books = [[list(x) for x in cut[p][:entries]] for p in range(parts)]

    def near(x, book):
        away = [sum((a - b) ** 2 for a, b in zip(x, entry)) for entry in book]
        return away.index(min(away)), min(away)

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for x in cut[p]:
                groups.setdefault(near(x, books[p])[0], []).append(x)
            for j, group in groups.items():
                books[p][j] = [sum(c) // len(group) for c in zip(*group)]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out, sums = [], {}
    for n, (i, _, label) in enumerate(kept):
        found = [near(cut[p][n], books[p]) for p in range(parts)]
        error = sum(e for _, e in found)
        out.append((i, label, "".join(f"{c:02x}" for c, _ in found), error))
        sums[label] = sums.get(label, 0) + error
    most = (1 << 63) - 1
    return sorted((i, c, min(e, most), min(sums[label], most), digest) for i, label, c, e in out)


def test_codes_of_the_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted(tuple(r) for r in op12_vector_codes(spark, SF).collect()) == plain_codes(rows)


@pytest.mark.parametrize("kind", ["array<float>", "array<double>"])
@pytest.mark.parametrize("scale", [1.0, 3e6])
def test_codes_of_odd_vectors(spark, kind, scale):
    """Nulls, ties, equal rows, several lengths and components whose squares pass a long."""
    rng = random.Random(4)
    rows = [(i, [rng.choice([0.5, -0.25, rng.random()]) * scale for _ in range(12 if i % 4 else 9)], rng.choice([None, 1, 2]), "x") for i in range(70)]
    rows += [(3, rows[3][1], 1, "x")] * 3
    rows += [(90, None, 1, "x"), (91, [0.5, None], 1, "x"), (92, [math.nan], 1, "x"), (93, [-math.inf], 1, "x"), (94, [], None, "x")]
    df = spark.createDataFrame(rows, f"vec_id bigint, embedding {kind}, label int, code string").repartition(3)
    kept = [tuple(r)[:3] for r in df.collect()]
    found = vector_codes.compress_vectors(df).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    assert sorted(tuple(r) for r in found) == plain_codes(kept)


def test_codes_of_no_or_few_vectors(spark):
    df = spark.createDataFrame([(1, [0.5, 1.5], None), (2, None, 1)], "vec_id bigint, embedding array<float>, label int")
    rows = vector_codes.compress_vectors(df).collect()
    assert [(r.vec_id, r.code, r.error, r.label_error) for r in rows] == [(1, "00" * 8, 0, 0)]
    assert vector_codes.compress_vectors(df.limit(0)).count() == 0
    codebooks = vector_codes.train_codebooks(vector_codes.kept_vectors(df))
    assert codebooks.decode("00" * 8)[:2] == [0.5 + 0.5 / 4096, 1.5 + 0.5 / 4096]


def test_products_are_exact():
    import numpy as np

    rng = random.Random(9)
    for bits in (3, 20, 28, 30):
        left, right = ([[rng.randint(-(1 << bits), 1 << bits) for _ in range(7)] for _ in range(n)] for n in (11, 5))
        expected = [[sum(a * b for a, b in zip(x, y)) for y in right] for x in left]
        assert vector_codes.exact_products(np.array(left), np.array(right)).tolist() == expected


# --- archives -------------------------------------------------------------------


def plain_pages(rows, least=0):
    payloads = [(i, (html or "").encode()) for i, html in rows]
    largest = {}
    for i, p in payloads:
        largest[p] = max(largest.get(p, i), i)
    out = []
    for i, p in payloads:
        first = len(p) < least or largest[p] == i
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        out.append((i, len(p), digest, "response" if first else "revisit", None if first else largest[p], True))
    return sorted(out)


def test_pages_of_the_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect()]
    assert sorted(tuple(r) for r in op13_warc(spark, SF).collect()) == plain_pages(rows)


PAGE = "<html>\r\n\r\nWARC/1.1\r\n\r\n é日 \x00 </html>"


@pytest.mark.parametrize("least", [0, 10])
def test_pages_repeated_empty_and_very_long(spark, tmp_path, least):
    rows = [(i, [PAGE, "", None, LONG, "short", f"once {i}"][i % 6]) for i in range(600)]
    urls = [(i, html, ["http://a/\r\nWARC-Type: revisit", None, "http://b/ü x"][i % 3], "r") for i, html in rows]
    df = spark.createDataFrame(urls, "page_id bigint, html string, url string, record_id string").repartition(4)
    found = warc.archive_pages(df, str(tmp_path), least)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"]
    assert sorted(tuple(r) for r in found.select(names).collect()) == plain_pages(rows, least)
    for path in tmp_path.iterdir():
        assert path.read_bytes()[:4] == bytes.fromhex("5d2a4d18")


def test_equal_rows_and_rows_without_page_id(spark):
    rows = [(5, "u", "same")] * 4 + [(None, "u", "same"), (None, "u", "alone"), (None, None, None), (None, "v", "alone")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = warc.archive_pages(df).collect()
    assert len(found) == 8 and all(r.intact for r in found)
    same = [(r.page_id, r.record_type, r.refers_to) for r in found if r.payload_bytes == 4]
    assert sorted(same, key=str) == sorted([(5, "response", None)] + [(5, "revisit", 5)] * 3 + [(None, "revisit", 5)], key=str)
    assert sorted(r.record_type for r in found if r.payload_bytes == 5) == ["response", "revisit"]
    assert warc.archive_pages(df.limit(0)).count() == 0


def test_a_record_can_be_read_alone_and_files_are_closed_in_time(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    texts = {r.page_id: r.html for r in pages.collect()}
    many = pages.select("page_id", "url", "html").unionAll(pages.selectExpr("page_id + 100000", "url", "concat(html, page_id)"))
    found = warc.with_first_records(many.coalesce(1), 0)
    date = "2020-01-01T00:00:00Z"
    listed = warc.write_archives(found, f"file:{tmp_path}", date, file_bytes=1000).collect()
    assert len(listed) == 500 and len({r.path for r in listed}) == 1
    for r in listed[::37]:
        fields, block = warc.read_record(r.path, r.offset, r.length)
        assert fields["warc-record-id"] == f"<urn:uuid:{r.record_id}>" and fields["warc-date"] == date
        if r.page_id in texts:
            assert block.partition(b"\r\n\r\n")[2].decode() == texts[r.page_id]
    stored = sum(p.stat().st_size for p in tmp_path.iterdir())
    assert stored < 0.5 * sum(len(t.encode()) for t in texts.values()) * 2


def test_archives_cut_short_are_refused(spark, tmp_path):
    df = spark.createDataFrame([(i, "u", LONG[: 1000 + i]) for i in range(50)], "page_id bigint, url string, html string")
    warc.archive_pages(df.coalesce(1), str(tmp_path)).collect()
    path = next(p for p in tmp_path.iterdir() if p.suffix == ".zst")
    whole = path.read_bytes()
    files = spark.createDataFrame([(f"file:{path}",)], "path string")
    for size in (len(whole) - 30, len(whole) // 2):
        path.write_bytes(whole[:size])
        with pytest.raises(Exception, match="ends within"):
            warc.read_archives(files).collect()
