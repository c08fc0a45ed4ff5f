"""Toxicity: every overlapping window of a text is scored by a recurrent network."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.recurrent import (
    Adam, CHAR_BUCKETS, first_weights, gradients, input_gates, running_logits, squash, window_logits, word_vectors,
)
from skyledger.llm.rows import own_columns, spare_names
from skyledger.llm.samples import crc_remainder, sample_ids, sampled_texts
from skyledger.llm.textbytes import Words, byte_table, chunks_of, ranges
from skyledger.session import send_code_with_tasks

send_code_with_tasks(__name__)

#: Words of a window; each word of a text begins one. Training looks at one in some words only.
WINDOW, TRAINING_STRIDE = 10, 5
#: Bounds of the training sample: texts of each label, and characters of each text. One
#: toxic text in five and every other clean one are not trained on but used to place the
#: cut between the labels.
PER_LABEL = {0: 7000, 1: 1600}
SAMPLE_CHARACTERS = 3000
ASIDE = {0: 2, 1: 5}
#: Words with a vector of their own, and in how many sample texts a word or letter group
#: must be found to count; rarer ones would be learnt by heart.
VOCABULARY, LEAST_TEXTS = 4000, 3
#: Share of the clean texts set aside that may lie above the cut.
FALSE_ALARMS = 0.02
EPOCHS, WARM_UP = 8, 2
#: Steps of each round at least, and texts of a step at most.
STEPS, BATCH_TEXTS = 60, 96
THRESHOLD = 0.7
CHUNK_BYTES = 1 << 19
SLOT_BITS = 16

# ASCII letters and everything above ASCII belong to words.
LETTERS = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
IS_BLANK = byte_table(b" \n")


@dataclass
class ToxicityModel:
    """Weights, and the table that finds the row of a known word by its hash."""

    weights: dict[str, np.ndarray]
    slot_hash: np.ndarray
    slot_row: np.ndarray
    cut: float = 0.0

    def word_rows(self, hashes: np.ndarray) -> np.ndarray:
        slot = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        return np.where(self.slot_hash[slot] == hashes, self.slot_row[slot], 0)


def lowered(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace").translate(LETTERS)


def char_groups(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the three- and five-byte groups around each letter of each word, a row
    per letter, and the number of rows per word. Groups begin and end with the word's blanks
    at most, which are the same wherever it stands."""
    counts = words.ends - words.starts
    place = ranges(words.starts, counts)
    data = np.concatenate(([0x20], words.data, [0x20] * 4)).astype(np.uint32)
    at = place + 1
    shift = np.uint32(32 - CHAR_BUCKETS.bit_length() + 1)
    left = np.repeat(counts, counts) - (place - np.repeat(words.starts, counts))
    before = data[at - 1]
    before[np.cumsum(counts) - counts] = 0x20
    code, buckets = before * np.uint32(263) + data[at], []
    for step in (1, 2, 3):
        code = code * np.uint32(263) + np.where(left > step, data[at + step], (left == step) * 0x20).astype(np.uint32)
        if step != 2:
            buckets.append((code + np.uint32(step)) * np.uint32(2654435761) >> shift)
    return np.stack(buckets, axis=1).astype(np.uint16), counts


def windows_of(counts: np.ndarray, stride: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, length and text of every window over texts of so many words, which
    follow one another; the windows cover all words. A text of fewer words has one window."""
    first = np.cumsum(counts) - counts
    windows = np.where(counts > 0, np.maximum(0, -(-(counts - WINDOW) // stride)) + 1, 0)
    owner = np.repeat(np.arange(len(counts)), windows)
    inside = ranges(np.zeros(len(counts), dtype=np.int64), windows) * stride
    return first[owner] + inside, np.minimum(WINDOW, counts[owner] - inside), owner


@dataclass
class Features:
    """What the network reads of texts that follow one another."""

    rows: np.ndarray  # of known words
    groups: np.ndarray  # letter groups of all words
    group_counts: np.ndarray  # per word
    word_counts: np.ndarray  # per text


def features_of(model: ToxicityModel, texts: list[bytes]) -> Features:
    words = Words(texts, IS_BLANK)
    return Features(model.word_rows(words.hashes()), *char_groups(words), words.counts)


def training_logits(model: ToxicityModel, seen: Features) -> np.ndarray:
    """Logits of the windows that training looks at."""
    starts, lengths, _ = windows_of(seen.word_counts, TRAINING_STRIDE)
    if not len(starts):
        return np.zeros(0)
    gates = input_gates(model.weights, word_vectors(model.weights, seen.rows, seen.groups, seen.group_counts))
    return np.concatenate([
        window_logits(model.weights, gates, starts[a : a + 4096], lengths[a : a + 4096], WINDOW)
        for a in range(0, len(starts), 4096)
    ])


def score_windows(model: ToxicityModel, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Logit and text of every window; the inputs of a word found often are computed once."""
    words = Words(texts, IS_BLANK)
    starts, lengths, owner = windows_of(words.counts)
    if not len(starts):
        return np.zeros(0), owner
    known, one, word = np.unique(words.hashes(), return_index=True, return_inverse=True)
    words.starts, words.ends = words.starts[one], words.ends[one]
    gates = input_gates(model.weights, word_vectors(model.weights, model.word_rows(known), *char_groups(words)))
    # Windows that would run on into the next text begin at no place of ``starts``.
    running, full = running_logits(model.weights, gates, word, WINDOW), lengths == WINDOW
    logits = np.empty(len(starts), dtype=np.float32)
    logits[full] = running[starts[full]]
    if not full.all():
        own = {s: gates[s][word] for s in gates}
        logits[~full] = window_logits(model.weights, own, starts[~full], lengths[~full], WINDOW)
    return logits, owner


def worst_logits(model: ToxicityModel, texts: list[bytes]) -> np.ndarray:
    """The largest logit of each text's windows; minus infinity without any word."""
    worst = np.full(len(texts), -np.inf)
    logits, owner = score_windows(model, texts)
    if len(owner):
        first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        worst[owner[first]] = np.maximum.reduceat(logits, first)
    return worst


def score_texts(model: ToxicityModel, texts: list[bytes], threshold: float = THRESHOLD) -> np.ndarray:
    """The score of a text is that of its worst window; 0 without any word. A logit at the
    model's cut scores ``threshold``."""
    at_cut = np.log(threshold / (1 - threshold))
    return squash(worst_logits(model, texts) - model.cut + at_cut)


def best_cut(logits: np.ndarray, labels: np.ndarray) -> float:
    """Of the cuts with at most ``FALSE_ALARMS`` of the clean texts above them, the one that tells
    most texts of each label apart, in the middle of the widest gap where several do equally
    well. Without the bound, few toxic texts that look clean would draw the cut far down."""
    order = np.argsort(logits, kind="stable")
    ordered, toxic = logits[order], labels[order] > 0
    missed = np.append(0, np.cumsum(toxic)) / max(toxic.sum(), 1)
    alarms = np.append(0, np.cumsum(~toxic)) / max((~toxic).sum(), 1)
    gain = alarms - missed
    low, high = np.append(-np.inf, ordered), np.append(ordered, np.inf)
    usable = np.isfinite(low) & np.isfinite(high) & (alarms >= 1 - FALSE_ALARMS)
    if not usable.any():
        # Beyond all of them, by more than what rounding does to a text's logit.
        return float(ordered[-1]) + 1.0 if len(ordered) and np.isfinite(ordered[-1]) else 0.0
    best = np.flatnonzero(usable & (gain >= gain[usable].max() - 1e-12))
    widest = best[np.argmax(high[best] - low[best])]
    return float((low[widest] + high[widest]) / 2)


def _in_texts(features: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values of a feature, and in how many texts each is found."""
    order = np.lexsort((owner, features))
    features, owner = features[order], owner[order]
    new = np.append(True, (features[1:] != features[:-1]) | (owner[1:] != owner[:-1]))
    return np.unique(features[new], return_counts=True)


def _vocabulary(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A table of the words found in most texts; of two in one place the commoner stays."""
    known, texts = _in_texts(hashes, owner)
    order = np.lexsort((known, -texts))[:VOCABULARY]
    known = known[order][texts[order] >= LEAST_TEXTS]
    slot_hash, slot_row = np.zeros(1 << SLOT_BITS, np.uint64), np.zeros(1 << SLOT_BITS, np.int64)
    slots = (known >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    for row in range(len(known) - 1, -1, -1):
        slot_hash[slots[row]], slot_row[slots[row]] = known[row], row + 1
    return slot_hash, slot_row


def _common_groups(parts: list[Features]) -> np.ndarray:
    """Which buckets of letter groups are found in enough texts."""
    texts = np.zeros(CHAR_BUCKETS, dtype=np.int64)
    for part in parts:
        owner = np.repeat(np.repeat(np.arange(len(part.word_counts)), part.word_counts), part.group_counts)
        for column in range(part.groups.shape[1]):
            found, n = _in_texts(part.groups[:, column], owner)
            texts[found] += n
    return texts >= LEAST_TEXTS


def fit_model(texts: list[str], labels: list[int], seed: int = 5) -> ToxicityModel:
    """Train on texts, of which only some windows make a toxic one toxic.

    After some rounds on windows drawn at random, each round takes from every text the
    windows that look worst: the worst of a toxic text is toxic, the two worst of a clean
    text, and one at random, are not. Known words are hidden now and then, so that their
    letters are learnt as well. The cut between the labels is placed on texts that were
    not trained on.
    """
    seen = {0: 0, 1: 0}
    aside, rest = [], []
    for i, label in enumerate(labels):
        seen[label] += 1
        (rest if seen[label] % ASIDE[label] else aside).append(i)
    model = _trained([texts[i] for i in rest], [labels[i] for i in rest], seed)
    parts = [aside[a : a + PART_TEXTS] for a in range(0, len(aside), PART_TEXTS)]
    logits = [worst_logits(model, [lowered(texts[i]) for i in part]) for part in parts]
    if logits:
        model.cut = best_cut(np.concatenate(logits), np.array([labels[i] for i in aside]))
    return model


PART_TEXTS = 200


def _trained(texts: list[str], labels: list[int], seed: int) -> ToxicityModel:
    """Features are made and windows are scored for some hundred texts at a time."""
    rng = np.random.default_rng(seed)
    raw = [lowered(t) for t in texts]
    raw_parts = [raw[a : a + PART_TEXTS] for a in range(0, len(raw), PART_TEXTS)]
    hashes, owner = [], []
    for n, part in enumerate(raw_parts):
        words = Words(part, IS_BLANK)
        hashes.append(words.hashes())
        owner.append(np.repeat(np.arange(len(part)) + n * PART_TEXTS, words.counts))
    slot_hash, slot_row = _vocabulary(np.concatenate(hashes), np.concatenate(owner))
    del hashes, owner
    model = ToxicityModel(first_weights(int(slot_row.max()) + 1, rng), slot_hash, slot_row)
    parts = [features_of(model, part) for part in raw_parts]
    common = _common_groups(parts)
    model.weights["char"][~common] = 0
    rows = np.concatenate([p.rows for p in parts])
    groups = np.concatenate([p.groups for p in parts])
    counts = np.concatenate([p.group_counts for p in parts])
    word_counts = np.concatenate([p.word_counts for p in parts])
    group_starts = np.cumsum(counts) - counts
    starts, lengths, owner = windows_of(word_counts, TRAINING_STRIDE)
    first = np.searchsorted(owner, np.arange(len(raw) + 1))
    y = np.array(labels, dtype=np.float32)
    weight = np.where(y > 0, len(y) / (2 * max((y > 0).sum(), 1)), len(y) / (2 * max((y == 0).sum(), 1)))
    adam = Adam()
    filled = np.flatnonzero(word_counts > 0)
    for epoch in range(EPOCHS if len(filled) else 0):
        adam.rate = 0.01 if epoch < EPOCHS - 3 else 0.003
        worst = np.concatenate([training_logits(model, p) for p in parts]) if epoch >= WARM_UP else None
        steps = max(min(STEPS, len(filled)), len(filled) // BATCH_TEXTS)
        for texts_now in np.array_split(rng.permutation(filled), steps):
            chosen, cost = [], []
            for text in texts_now:
                own = np.arange(first[text], first[text + 1])
                if worst is None:
                    pick = rng.permutation(own)[:3]
                elif y[text]:
                    pick = own[[np.argmax(worst[own])]]
                else:
                    pick = np.unique(np.append(own[np.argsort(-worst[own])[:2]], rng.choice(own)))
                chosen.append(pick)
                cost.append(np.full(len(pick), weight[text] / len(pick) / len(texts_now)))
            pick, cost = np.concatenate(chosen), np.concatenate(cost)
            place = _gather(starts[pick], lengths[pick])
            used = np.unique(place)
            ids = np.where(rng.random(len(used)) < 0.3, 0, rows[used])
            mask = (np.arange(WINDOW)[:, None] < lengths[pick][None, :]).astype(np.float32)
            _, slopes = gradients(
                model.weights, ids, groups[ranges(group_starts[used], counts[used])], counts[used],
                np.searchsorted(used, place), mask, y[owner[pick]], cost,
            )
            slopes["char"][~common] = 0
            adam.step(model.weights, slopes)
    return model


def _gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Words of windows, time by window; places behind a window repeat its last word."""
    return starts[None, :] + np.minimum(np.arange(WINDOW)[:, None], lengths[None, :] - 1)


def train_toxicity_model(
    docs: DataFrame, labels: DataFrame, per_label: dict[int, int] = PER_LABEL, characters: int = SAMPLE_CHARACTERS
) -> ToxicityModel | None:
    """Fit on a sample of the labelled rows; None unless both labels occur.

    The sample holds at most ``per_label`` texts of a label and ``characters`` of each of
    them; rows with crc32(doc_id) mod 3 = 1 are never in it. A doc_id with both labels
    counts as toxic; of several texts under one doc_id the one of the smallest hash is taken.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    usable = known.filter("toxic in (0, 1) and doc_id is not null").filter(crc_remainder(F.col("doc_id"), 3) != 1)
    there = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).join(there, "doc_id", "left_semi")
    chosen = sample_ids(usable, "toxic", per_label)
    rows = sorted((r.doc_id, r.toxic, r.text) for r in sampled_texts(docs, chosen, characters).collect())
    if len({toxic for _, toxic, _ in rows}) < 2:
        return None
    return fit_model([text for _, _, text in rows], [toxic for _, toxic, _ in rows])


def score_toxicity(docs: DataFrame, model: ToxicityModel | None, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs`` (``doc_id, text``).

    A text's score is that of the worst of its overlapping windows, which cover all of
    it. A null or empty text, or one without letters, has score 0, as has any text if the
    model is None. ``held_out`` marks ids never trained on; rows without doc_id are held
    out too. Equal texts get equal scores; other columns are not read; an empty table
    gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pickle.loads(shared.value)
        for batch in batches:
            for chunk in chunks_of(batch, "text", CHUNK_BYTES):
                texts = [lowered(t) for t in chunk.column("text").to_pylist()]
                scores = np.zeros(len(texts)) if known is None else score_texts(known, texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        chunk.column("doc_id"), chunk.column("held_out"), pa.array(scores.astype(np.float64)),
                        pa.array((scores >= threshold).astype(np.int32)),
                    ],
                    ["doc_id", "held_out", "score", "predicted"],
                )

    doc_id = F.col("doc_id").cast("bigint")
    return docs.select(
        doc_id.alias("doc_id"),
        F.coalesce(crc_remainder(doc_id, 3) == 1, F.lit(True)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    ).mapInArrow(work, "doc_id bigint, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, model: ToxicityModel | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns; scores
    are those of :func:`score_toxicity`, so rows without text stay."""
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))
    (plain,) = spare_names(docs, "plain_text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pickle.loads(shared.value)
        for batch in batches:
            for chunk in chunks_of(batch, plain, CHUNK_BYTES):
                texts = [lowered(t) for t in chunk.column(plain).to_pylist()]
                scores = np.zeros(len(texts)) if known is None else score_texts(known, texts)
                kept = chunk.filter(pa.array(scores < threshold))
                yield kept.select([n for n in kept.schema.names if n != plain])

    return docs.select(*own_columns(docs), F.col("text").cast("string").alias(plain)).mapInArrow(work, docs.schema)
