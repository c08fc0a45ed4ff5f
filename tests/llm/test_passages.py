"""SimHash, decontamination and repeated passages against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from conftest import rows_of
from corpus_fixtures import edge_docs, make_docs, small_docs  # noqa: F401

from skyledger.llm import decontamination, substrings
from skyledger.llm.queries import op10_substrings
from skyledger.llm.simhash import block_masks, close_links, drop_near_duplicates, forest, near_duplicates, small_forest
from skyledger.llm.textbytes import spark_hash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_print(text):
    words = WORD.findall(lowered(text))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest id reachable over links of at most four bits, for id -> print."""
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in prints:
        for j in prints:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 4 and find(i) != find(j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {i: find(i) for i in prints}


def test_near_duplicates_match_brute_force(small_docs):
    texts = {r.doc_id: r.text for r in small_docs.collect()}
    prints = {i: plain_print(t) for i, t in texts.items()}
    found = near_duplicates(small_docs).collect()
    assert {r.doc_id: r.print % (1 << 64) for r in found} == prints
    assert {r.doc_id: r.component_id for r in found} == plain_components(prints)


def test_any_close_pair_shares_a_block():
    rng = random.Random(3)
    for blocks in (5, 6, 7):
        masks = block_masks(4, blocks)
        for _ in range(300):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                b ^= 1 << bit
            assert any((a ^ b) & m == 0 for m in masks)


@pytest.mark.parametrize("find", [lambda p: forest(p, 4), lambda p: small_forest(p.tolist(), 4)])
def test_forest_connects_what_close_pairs_connect(find):
    rng = np.random.default_rng(2)
    base = rng.integers(-(2**62), 2**62, 6)
    prints = np.unique([b ^ (1 << int(k)) ^ (1 << int(j)) for b in base for k, j in rng.integers(0, 60, (12, 2))])
    expected = plain_components({int(p) % (1 << 64): int(p) % (1 << 64) for p in prints})
    links = find(prints)
    assert len(links) < len(prints)
    linked = {p: {p} for p in expected}
    for a, b in links:
        assert (int(a) ^ int(b)).bit_count() <= 4
        both = linked[int(a)] | linked[int(b)]
        for p in both:
            linked[p] = both
    assert {p: min(group) for p, group in linked.items()} == expected


def test_chain_of_close_prints_is_one_component(spark):
    chain = [((1 << (4 * k)) - 1) - (1 << 63) for k in range(15)]
    links = close_links(spark.createDataFrame([(p,) for p in chain], "print bigint"))
    assert links.count() >= len(chain) - 1


def test_simhash_edges(edge_docs, make_docs):
    found = rows_of(near_duplicates(edge_docs).select("doc_id", "component_id"))
    assert found == [(None, None), (1, 1), (2, 1), (3, 1), (4, 4), (5, 5), (6, 6), (6, 6), (7, 5)]
    kept = drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    assert rows_of(kept.select("doc_id")) == [(None,), (1,), (4,), (5,), (6,)]
    assert near_duplicates(make_docs([])).count() == 0 and drop_near_duplicates(make_docs([])).count() == 0


def plain_contamination(texts, items):
    windows = {}
    for item, text in items:
        words = ITEM_WORD.findall(lowered(text))
        for i in range(max(1, len(words) - 9) if words else 0):
            windows.setdefault(tuple(words[i : i + 10]), set()).add(item)
    result = []
    for doc_id, text in texts:
        words, hit, found = ITEM_WORD.findall(lowered(text)), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                owners = windows.get(tuple(words[i : i + size]))
                if owners:
                    hit |= set(range(i, i + size))
                    found |= owners
        result.append((doc_id, len(words), len(hit), sorted(found)))
    return result


ITEMS = [("b", "One two three FOUR five six seven eight nine ten eleven twelve"), ("a", "short Item"), ("c", ""), ("d", None), (None, "x y"), ("a", "short Item"), ("e", "é ü")]
TEXTS = [
    (1, "zero one, two three four five six seven eight nine ten eleven and short item; SHORT-ITEM"),
    (2, "two three four five six seven eight nine ten eleven twelve"), (3, None), (4, ""), (5, "shortitem short, items"),
    (6, "a É ü b"), (7, "a é ü"), (8, "short item " * 3), (8, "short item " * 3), (None, "short item"),
]


@pytest.mark.parametrize("part_bytes", [1 << 20, 30])
def test_contamination_matches_brute_force(spark, make_docs, part_bytes):
    bench = spark.createDataFrame(ITEMS, "item_id string, text string")
    items = [(i, t) for i, t in ITEMS if i and t is not None]
    found = decontamination.find_contamination(make_docs(TEXTS), bench, part_bytes=part_bytes)
    got = [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.collect()]
    order = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(got, key=order) == sorted(plain_contamination(TEXTS, items), key=order)
    clean = decontamination.drop_contaminated(make_docs(TEXTS), bench, part_bytes=part_bytes)
    assert clean.columns == make_docs([]).columns
    assert rows_of(clean.select("doc_id")) == [(3,), (4,), (5,), (6,)]


def test_pieces_hold_every_window_once():
    rng = random.Random(9)
    for n in (0, 1, 9, 10, 11, 60):
        text = " ".join("w" * rng.randint(1, 9) + str(i) for i in range(n)).encode()
        for size in (1, 20, 10**6):
            pieces = decontamination.pieces_of(text, size)
            found = [w for piece in pieces for w in decontamination.windows_of(piece)]
            assert sorted(found) == sorted(decontamination.windows_of(text))
            assert size > 1 or len(pieces) == len(found)


def test_places_point_into_the_original_text(spark, make_docs):
    bench = spark.createDataFrame(ITEMS[:2], "item_id string, text string")
    text = "Öl — ok. Short,\tITEM!"
    (row,) = decontamination.find_contamination(make_docs([(1, text)]), bench).collect()
    assert [text.encode()[p.first : p.behind].decode() for p in row.places] == ["Short,\tITEM"]


def test_contamination_edges(spark, make_docs, edge_docs):
    empty = spark.createDataFrame([], "item_id string, text string")
    assert {r.contaminated for r in decontamination.find_contamination(edge_docs, empty).collect()} == {False}
    assert decontamination.find_contamination(make_docs([]), empty).count() == 0


def plain_removal(texts, width):
    first = {}
    known = [(i if i is not None else float("inf"), t) for i, t in texts]
    for i, text in known:
        words = WORD.findall(text or "")
        for k in range(len(words) - width + 1):
            key = tuple(words[k : k + width])
            first[key] = min(first.get(key, i), i)
    result = []
    for (doc_id, text), (i, _) in zip(texts, known):
        words, gone = WORD.findall(text or ""), set()
        for k in range(len(words) - width + 1):
            if first[tuple(words[k : k + width])] < i:
                gone |= set(range(k, k + width))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        result.append((doc_id, len(words), len(gone), kept))
    return result


def test_repeats_match_brute_force(make_docs):
    rng = random.Random(5)
    passage = [f"p{k}" for k in range(20)]
    texts = []
    for i in rng.sample(range(500), 120):
        words = [rng.choice("abcdefg") + str(rng.randint(0, 30)) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            at, a = rng.randint(0, len(words)), rng.randint(0, 8)
            words[at:at] = passage[a : a + rng.randint(3, 20)]
        texts.append((i, rng.choice([" ", "\n", "\t "]).join(words)))
    texts += [(texts[0][0], texts[0][1]), (None, " ".join(passage)), (None, " ".join(passage)), (900, None)]
    found = substrings.remove_repeats(make_docs(texts).repartition(6), 5, group_windows=50)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found.collect()]
    assert sorted(got, key=key) == sorted(plain_removal(texts, 5), key=key)
    for r in found.collect():
        assert sum(x.behind - x.first for x in r.removed) == r.n_removed


def test_rows_without_id_each_lose_a_passage_of_another_partition(make_docs):
    passage = [f"p{k}" for k in range(9)]
    numbered = [(i, " ".join([f"n{i}", *passage])) for i in (3, 8)]
    unnumbered = [(None, " ".join([f"a{i}", *passage, f"b{i}", "u v w x y z"])) for i in range(4)]
    docs = make_docs(numbered).coalesce(2).union(make_docs(unnumbered).coalesce(2))
    found = substrings.remove_repeats(docs, 5).collect()
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found]
    assert sorted(got, key=str) == sorted(plain_removal(numbered + unnumbered, 5), key=str)
    assert {r.n_removed for r in found if r.doc_id is None} == {9}


def test_repeats_edges(edge_docs, make_docs):
    got = {(r.doc_id, r.n_words, r.n_removed) for r in substrings.remove_repeats(edge_docs).collect()}
    assert got == {(None, 4, 0), (1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 1, 0), (5, 60_000, 0), (6, 32, 0), (7, 60_000, 60_000)}
    assert substrings.remove_repeats(make_docs([])).count() == 0


def test_digest_is_that_of_the_kept_words(spark):
    rows = op10_substrings(spark, "/root/testdata/sf0.001").collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    untouched = [r for r in rows if not r.n_removed]
    assert untouched
    for r in untouched:
        assert r.kept_sha256 == hashlib.sha256(" ".join(WORD.findall(docs[r.doc_id])).encode()).hexdigest()


def test_group_numbers_agree_with_spark(spark):
    a = np.array([0, 1, -7, 2**62, -(2**63)], dtype=np.int64)
    rows = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, a[::-1])], "a bigint, b bigint")
    assert [r.h for r in rows.selectExpr("xxhash64(a, b) as h").collect()] == spark_hash(a, a[::-1]).tolist()
