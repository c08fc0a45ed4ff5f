"""Shards, packing and token files: exact placement and round trips."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import rows_of
from corpus_fixtures import edge_docs, make_docs, small_docs  # noqa: F401

from skyledger.llm import packing, sharding, token_files, tokens
from skyledger.llm.queries import op2_sharding, op7_packing

SF = "/root/testdata/sf0.001"


def test_shards_are_near_equal_and_gapless(spark, small_docs):
    rows = op2_sharding(spark, SF).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in small_docs.collect()}
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        assert r["size"] == len(texts[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id])
        assert r.law == "bytes" and r.grown_shard is None
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert len(rows) == len(texts) and set(sizes) == set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes.values()) <= max(len(t) + 1 for t in texts.values())


def test_rebalancing_adds_a_version_and_moves_little(spark, small_docs, tmp_path):
    path = str(tmp_path / "map")
    slotted = sharding.with_slots(small_docs)
    sizes = sharding.slot_sizes(slotted)
    sharding.store_map(spark, path, 1, sharding.first_map(sizes, 16), sizes)
    sharding.rebalance(small_docs, path, 17)
    old = {r.virtual_slot: r.shard for r in sharding.read_map(spark, path, 1).collect()}
    new = {r.virtual_slot: r.shard for r in sharding.read_map(spark, path).collect()}
    moved = [s for s in old if old[s] != new[s]]
    assert set(old) == set(new) and 0 < len(moved) < len(old) / 4
    load = defaultdict(int)
    for slot, shard in new.items():
        load[shard] += sizes[slot][1]
    assert len(load) == 17 and max(load.values()) < 1.5 * sum(load.values()) / 17
    assert sharding.read_map(spark, path).first().version == 2
    sharding.rebalance(small_docs, path, 12)
    assert {r.shard for r in sharding.read_map(spark, path).collect()} == set(range(12))


def test_shard_files_hold_all_rows(spark, make_docs, tmp_path):
    docs = make_docs([(i, f"text {i}") for i in range(50)])
    sizes = sharding.slot_sizes(sharding.with_slots(docs))
    sharding.store_map(spark, str(tmp_path / "map"), 1, sharding.first_map(sizes, 4), sizes)
    path = sharding.write_shards(docs, sharding.read_map(spark, str(tmp_path / "map")), str(tmp_path / "out"))
    assert spark.read.parquet(path).count() == 50


def test_shard_edges(edge_docs, make_docs):
    rows = sharding.assign_shards(edge_docs, 4).collect()
    assert len(rows) == 9 and {r["size"] for r in rows if r.doc_id in (1, 2)} == {1}
    assert sharding.assign_shards(make_docs([]), 4).count() == 0


def plain_ids(text):
    encoder = tokens.json_encoder(tokens.tokenizer_path("byte_bpe_50k.json"))
    return encoder.encode(text or "", add_special_tokens=False).ids + [1]


@pytest.mark.parametrize("text", ["", "plain words, 12 of 'em", "ünï çødé ñandú ß", "日本語 русский ελληνικά", "a<|endoftext|>b", "x\x0b\x85 y \n\n  z", "🎉" * 5])
def test_ids_equal_the_defining_library(text):
    paths = [tokens.tokenizer_path(f"byte_bpe_50k.{e}") for e in ("json", "tiktoken")]
    assert tokens.encode(text, *paths).tolist() == plain_ids(text)[:-1]


def test_packed_pieces_round_trip(spark, small_docs):
    rows = op7_packing(spark, SF).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for doc in small_docs.collect():
        ids, at = plain_ids(doc.text), 0
        for r in sorted(pieces[doc.doc_id], key=lambda r: r.start):
            part = np.array(ids[at : at + r.length], dtype="<u4")
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(part.tobytes())
            at += r.length
        assert at == len(ids)
    assert sorted(sequences) == list(range(len(sequences)))
    padding = total = 0
    for members in sequences.values():
        members.sort(key=lambda r: r.offset)
        ends = np.cumsum([r.length for r in members])
        assert [r.offset for r in members] == [0, *ends[:-1]] and ends[-1] <= 2048
        total += ends[-1]
        padding += 0 if ends[-1] & (ends[-1] - 1) == 0 else 2048 - ends[-1]
    assert padding < 0.03 * total


def test_sequences_can_be_read_back(small_docs):
    limits = packing.Limits(256, 4, 200)
    pieces = packing.cut_pieces(small_docs.limit(20).dropDuplicates(["text"]), limits=limits, keep_ids=True)
    packed = packing.pack(pieces.drop("ids"), limits)
    joined = {r.sequence_id: r.ids for r in packing.read_sequences(pieces, packed).collect()}
    for r in packed.collect():
        part = joined[r.sequence_id][r.offset : r.offset + r.length]
        assert zlib.crc32(np.array(part, dtype="<u4").tobytes()) == r.ids_crc32


def test_all_limits_hold_at_once(make_docs):
    limits = packing.Limits(tokens=40, segments=3, loss_tokens=25)
    docs = make_docs([(i, "word " * (i % 60)) for i in range(120)]).selectExpr("*", "doc_id % 7 as answer")
    packed = packing.pack(packing.cut_pieces(docs, limits=limits, loss_start="answer"), limits, group_pieces=32).collect()
    sums = defaultdict(lambda: np.zeros(3, int))
    for r in packed:
        sums[r.sequence_id] += [r.length, 1, r.loss]
    assert all((s <= [40, 3, 25]).all() for s in sums.values())
    assert sum(s[0] for s in sums.values()) == sum(len(plain_ids("word " * (i % 60))) for i in range(120))
    with pytest.raises(ValueError):
        packing.Limits(0, 1, 1)


def test_packing_edges(edge_docs, make_docs):
    packed = packing.pack_documents(edge_docs)
    assert rows_of(packed.filter("doc_id < 3").select("doc_id", "start", "length")) == [(1, 0, 1), (2, 0, 1)]
    assert packed.filter("doc_id = 6").count() == 2 and packed.filter("doc_id is null").count() == 1
    assert packing.pack_documents(make_docs([])).count() == 0


@pytest.mark.parametrize("block_bytes", [2, 64, 1 << 20])
def test_token_counts_across_blocks(small_docs, block_bytes):
    docs = small_docs.filter("length(text) < 300") if block_bytes == 2 else small_docs
    encoder = tokens.rank_encoder(tokens.tokenizer_path("byte_bpe_multi_50k.tiktoken"))
    expected = sorted((r.doc_id, len(encoder.encode_ordinary(r.text))) for r in docs.collect())
    assert rows_of(token_files.count_tokens(docs, block_bytes=block_bytes)) == expected


def test_flat_files_with_and_without_a_last_end(spark, tmp_path):
    end = token_files.END_ID
    streams = {"a": [end, 1, 2, end, end, 3], "b": [], "c": [5] * 9 + [end], "d": [7, 8], "e": [end]}
    rows = []
    for name, ids in streams.items():
        (tmp_path / name).write_bytes(np.array(ids, dtype="<u2").tobytes())
        rows.append((f"file:{tmp_path / name}", 2 * len(ids)))
    files = spark.createDataFrame(rows, "path string, bytes bigint")
    for block in (2, 4, 6, 1000):
        found = token_files.document_counts(files, block_bytes=block).collect()
        by_file = defaultdict(dict)
        for r in found:
            by_file[r.path[-1]][r.number] = r.n_tokens
        assert {f: [n for _, n in sorted(c.items())] for f, c in by_file.items()} == {
            "a": [0, 2, 0, 1], "c": [9], "d": [2], "e": [0]
        }


def test_token_count_edges(edge_docs, make_docs):
    rows = token_files.count_tokens(edge_docs).collect()
    assert len(rows) == 9 and [r.n_tokens for r in rows if r.doc_id in (1, 2)] == [0, 0]
    assert token_files.count_tokens(make_docs([])).count() == 0
