"""Hot keys, meeting hashes, few labels, and executors that lack the package."""

import subprocess
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from corpus_fixtures import make_docs  # noqa: F401
from pyspark.sql import functions as F

from skyledger.llm import packing, sharding, substrings, toxicity
from skyledger.llm.samples import sampled_texts
from skyledger.llm.textbytes import Words


@pytest.mark.parametrize("hot", [("one doc_id", 7, None), ("no id, one text", None, "t" * 99)])
def test_shards_stay_equal_with_a_third_of_rows_in_one_slot(spark, hot, tmp_path):
    _, doc_id, text = hot
    docs = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(doc_id)).otherwise(F.col("id")).cast("bigint").alias("doc_id"),
        F.when((F.col("id") % 3 == 0) & F.lit(text is not None), F.lit(text)).otherwise(
            F.rpad(F.col("id").cast("string"), 99, "x")
        ).alias("text"),
    )
    path = str(tmp_path / "map")
    sizes = sharding.slot_sizes(sharding.with_slots(docs))
    sharding.store_map(spark, path, 1, sharding.first_map(sizes, 16), sizes)
    for placed, shards in ((sharding.assign_shards(docs, 16), 16), (sharding.assign_shards(docs, 12, map_path=path), 12)):
        rows = placed.collect()
        load, slots = Counter(), defaultdict(list)
        for r in rows:
            load[r.shard] += r["size"]
            slots[r.shard].append(r.slot)
        assert len(rows) == 30_000 and len(load) == shards
        assert max(load.values()) - min(load.values()) <= 0.02 * sum(load.values()) / shards
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    written = spark.read.parquet(sharding.write_shards(docs, sharding.read_map(spark, path), str(tmp_path / "out")))
    counts = [r["count"] for r in written.groupBy("_shard").count().collect()]
    assert sum(counts) == 30_000 and max(counts) < 1.1 * 30_000 / 12


def test_equal_pieces_are_dealt_over_groups(spark, make_docs):
    docs = make_docs([(None, None)] * 3000)
    packed = packing.pack(packing.cut_pieces(docs), group_pieces=300)
    per_sequence = [r["count"] for r in packed.groupBy("sequence_id").count().collect()]
    # Every group ends in one sequence that is not full: 10 groups and more, none of all rows.
    assert sum(per_sequence) == 3000 and sum(n < 64 for n in per_sequence) >= 8


def test_long_words_that_meet_in_every_polynomial_stay_apart(make_docs):
    """Two words of the Thue-Morse kind have equal polynomial hashes modulo 2**64 in any odd base."""
    signs = [bin(i).count("1") % 2 for i in range(1024)]
    words = ["".join("ab"[s] for s in signs), "".join("ba"[s] for s in signs)]
    assert len(set(Words([w.encode()]).hashes()[0] for w in words)) == 1
    assert len(set(Words([w.encode()]).sum_hashes()[0] for w in words)) == 2
    rest = " ".join(f"w{i}" for i in range(12))
    rows = substrings.remove_repeats(make_docs([(1, f"{words[0]} {rest}"), (2, f"{words[1]} {rest}")])).collect()
    assert [r.n_removed for r in rows] == [0, 0]


def test_word_hashes_hang_on_the_word_alone():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcé"), rng.integers(1, 90))) for _ in range(300)]
    alone = [int(Words([w.encode()]).sum_hashes()[0]) for w in words]
    together = Words([" ".join(words[:150]).encode(), ("\t".join(words[150:])).encode()]).sum_hashes().tolist()
    assert together == alone and len(set(alone)) == len(set(words))


def test_the_cut_bounds_false_alarms():
    logits = np.concatenate([np.linspace(-5, 3, 200), [-4.0, -3.0, 4.0, 5.0]])
    labels = np.array([0] * 200 + [1] * 4)
    cut = toxicity.best_cut(logits, labels)
    assert (logits[:200] >= cut).mean() <= toxicity.FALSE_ALARMS and 3 <= cut <= 4


def test_one_text_and_one_label_per_id(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(2, "b")], "doc_id bigint, text string")
    chosen = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, toxic int")
    first = sorted(tuple(r) for r in sampled_texts(docs, chosen, 100).collect())
    assert len(first) == 2 and first == sorted(tuple(r) for r in sampled_texts(docs.repartition(7), chosen, 100).collect())


WITHOUT_PACKAGE = """
import sys
sys.path.insert(0, {repo!r})
from skyledger.session import build_session
spark = build_session("bare", "local[2]", **{{
    "spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": {folder!r}, "spark.ui.showConsoleProgress": "false",
}})
spark.sparkContext.setLogLevel("ERROR")
def known(batches):
    import importlib.util
    import pandas as pd
    for _ in batches:
        yield pd.DataFrame({{"found": [importlib.util.find_spec("skyledger") is not None]}})
assert not spark.range(1).mapInPandas(known, "found boolean").first().found
from skyledger.llm.queries import llm_queries
from pyspark.sql import functions as F
sf = "/root/testdata/sf0.001"
for name, query in llm_queries().items():
    print(name, query(spark, sf).count())
"""


def test_executors_need_not_have_the_package(tmp_path):
    """The workers' path holds neither the repository nor the folder the driver runs in."""
    script = tmp_path / "bare.py"
    repo = str(Path(__file__).resolve().parents[2])
    script.write_text(WITHOUT_PACKAGE.format(repo=repo, folder=str(tmp_path / "shared")))
    import os

    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    assert len(done.stdout.split("\n")) > 13
