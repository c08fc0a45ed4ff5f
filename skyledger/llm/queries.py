"""The operators of this subpackage as queries over the driver tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import (
    conversations, decontamination, language, packing, pii, quality, sharding, simhash, substrings, token_files, toxicity,
    vector_codes, warc,
)

#: The key of the registered query only; a deployment passes its own secret.
SURROGATE_KEY = "registered-query"
SHARDS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.train_toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(documents(spark, sf_dir), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with surrogates, and how many entities of which kinds were replaced."""
    done = pii.with_surrogates(documents(spark, sf_dir).select("doc_id", "text"), SURROGATE_KEY, kinds="kinds")
    return done.select(
        "doc_id", "text", F.size("kinds").cast("bigint").alias("n_entities"),
        F.array_join(F.sort_array(F.array_distinct("kinds")), ",").alias("kinds"),
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"), "contaminated",
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir)).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language.identify_language(docs, language.train_language_model(docs))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.count_tokens(documents(spark, sf_dir))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.repair_conversations(rows, alive=F.col("alive"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress_vectors(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256"
    )


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"
    )


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    operators = (
        op1_toxicity, op2_sharding, op3_pii, op4_simhash, op5_quality, op6_decontamination, op7_packing, op8_language,
        op9_token_counts, op10_substrings, op11_conversations, op12_vector_codes, op13_warc,
    )
    return {f.__name__: f for f in operators}


LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ITEM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORDS = r"[^\x20\x09-\x0D]+"

OP6_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWERED.format("coalesce(text, '')")}, '{ITEM_WORDS}') AS w
  FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWERED.format("text")}, '{ITEM_WORDS}') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL
), iw AS (
  SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), ks AS (SELECT DISTINCT k FROM iw), wins AS (SELECT DISTINCT k, win FROM iw),
dw AS (
  SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)
), m AS (SELECT r, k, i, win FROM dw SEMI JOIN wins USING (k, win)),
hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM m) GROUP BY r),
its AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM m JOIN iw USING (k, win)) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN its USING (r)
"""

OP10_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w FROM documents
), win AS (
  SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS x
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)
), cut AS (
  SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY x) AS least FROM win)
  WHERE coalesce(doc_id, 9223372036854775807) > least
), gone AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS p FROM cut),
word AS (SELECT r, unnest(w) AS v, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT r, string_agg(v, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (r, p) GROUP BY r),
lost AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN lost USING (r)
"""


def llm_oracles() -> dict[str, str]:
    """SQL twins of the operators that SQL expresses. The others learn, draw by keyed
    hashes, use hashes or ids that SQL has no function for, or repeat until settled."""
    return {"op6_decontamination": OP6_SQL, "op10_substrings": OP10_SQL}
