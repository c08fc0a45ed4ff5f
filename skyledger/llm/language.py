"""Language identification: the family first, then one-versus-one linear machines in it."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.samples import crc_remainder, sample_ids, sampled_texts
from skyledger.llm.textbytes import chunks_of, utf8_texts
from skyledger.session import send_code_with_tasks

send_code_with_tasks(__name__)

#: Bounds of the training sample: texts of each language, texts in all, characters of each.
PER_LANGUAGE = 400
SAMPLE_TEXTS = 4000
SAMPLE_CHARACTERS = 4000
#: Hash buckets of letter groups, and how many bytes a group has.
BUCKETS = 1 << 13
GROUP_SIZES = (2, 3, 4)
EPOCHS = 16
PENALTY = 1e-5
UNKNOWN = "und"

# Families of closely related languages. A language not listed is a
# family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "da", "sv", "no", "nb", "nn", "is"),
    "romance": ("fr", "es", "it", "pt", "ca", "gl", "oc", "ro"),
    "slavic": ("ru", "uk", "be", "bg", "sr", "hr", "bs", "sl", "mk", "cs", "sk", "pl"),
    "baltic": ("lt", "lv"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "mr", "ne", "bn", "gu", "pa", "ur"),
    "semitic": ("ar", "he", "mt"),
}

# ASCII letters in lower case; all other ASCII signs are blanks.
LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def family_of(language: str) -> str:
    return next((name for name, members in FAMILIES.items() if language in members), f"={language}")


@dataclass
class LanguageModel:
    """Weights per bucket: a column per family, then one per pair of a family's languages."""

    families: list[str]
    languages: list[list[str]]
    pairs: list[tuple[int, int, int]]
    weights: np.ndarray
    biases: np.ndarray
    scale: float

    def predict(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Languages and scores from the margins of texts.

        The family of the largest margin is taken; in it each pair of languages votes
        for one, and the sum of the pairs' margins breaks ties.
        """
        count = len(self.families)
        squash = lambda x: 1 / (1 + np.exp(-np.clip(self.scale * x, -50, 50)))
        best = margins[:, :count].argmax(axis=1)
        sure = squash(margins[:, :count])
        sure = sure[np.arange(len(best)), best] / sure.sum(axis=1)
        names = np.empty(len(best), dtype=object)
        for family in range(count):
            rows = np.flatnonzero(best == family)
            members = self.languages[family]
            votes, total, odds = (np.zeros((len(rows), len(members))) for _ in range(3))
            own = [(n, a, b) for n, (f, a, b) in enumerate(self.pairs) if f == family]
            for n, a, b in own:
                margin = margins[rows, count + n]
                votes[:, a] += margin > 0
                votes[:, b] += margin <= 0
                total[:, a] += margin
                total[:, b] -= margin
                odds[:, a] += squash(margin)
                odds[:, b] += squash(-margin)
            won = np.lexsort((total, votes), axis=1)[:, -1] if len(rows) else np.zeros(0, dtype=int)
            names[rows] = np.array(members, dtype=object)[won]
            if own and len(rows):
                sure[rows] *= odds[np.arange(len(rows)), won] / (len(members) - 1)
        return names, sure


def letter_groups(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all letter groups, group size by group size for each place, and the text of each place."""
    parts = [b" " + t.translate(LETTERS) + b" " for t in texts]
    data = np.frombuffer(b"".join(parts) + b" " * max(GROUP_SIZES), dtype=np.uint8)
    size = sum(map(len, parts))
    owner = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
    blank = data == 0x20
    rolling = data.astype(np.uint32)
    value, buckets = rolling[:size].copy(), []
    last = max(GROUP_SIZES)
    for width in range(2, last + 1):
        value = value * np.uint32(257) + rolling[width - 1 : size + width - 1]
        if width in GROUP_SIZES:
            spread = (value + np.uint32(width)) * np.uint32(2654435761)
            buckets.append(spread >> np.uint32(32 - BUCKETS.bit_length() + 1))
    inside = ~(blank[:size] & blank[1 : size + 1])
    return np.stack(buckets, axis=1)[inside], owner[inside]


def text_margins(model: LanguageModel, texts: list[bytes]) -> np.ndarray:
    """Margins of all machines: the mean weight over a text's letter groups, plus the bias."""
    buckets, owner = letter_groups(texts)
    sums = np.zeros((len(texts), model.weights.shape[1]))
    counts = np.bincount(owner, minlength=len(texts)) * len(GROUP_SIZES)
    starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else []
    if len(owner):
        each = sum(model.weights[buckets[:, k]] for k in range(buckets.shape[1]))
        sums[owner[starts]] = np.add.reduceat(each, starts, axis=0, dtype=np.float64)
    return sums / np.maximum(counts, 1)[:, None] + model.biases


def _machine(x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, float]:
    """A linear support vector machine by averaged stochastic subgradients; y is 1 or -1."""
    weights, bias = np.zeros(x.shape[1], dtype=np.float32), 0.0
    mean, mean_bias, steps = np.zeros(x.shape[1], dtype=np.float64), 0.0, 0
    cost = np.where(y > 0, len(y) / (2 * max((y > 0).sum(), 1)), len(y) / (2 * max((y < 0).sum(), 1)))
    for epoch in range(EPOCHS):
        rate = 200.0 / (1 + epoch)
        for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // 32)):
            margin = y[rows] * (x[rows] @ weights + bias)
            push = np.where(margin < 1, y[rows] * cost[rows], 0.0).astype(np.float32)
            weights *= 1 - min(0.5, rate * PENALTY)
            weights += rate / len(rows) * (push @ x[rows])
            bias += 0.01 * float(push.mean())
            if epoch >= EPOCHS // 2:
                mean += weights
                mean_bias += bias
                steps += 1
    return (mean / max(steps, 1)).astype(np.float32), mean_bias / max(steps, 1)


def fit_model(texts: list[str], languages: list[str], seed: int = 11) -> LanguageModel:
    """Fit the family machines and the pair machines of each family."""
    rng = np.random.default_rng(seed)
    raw = [t.encode() for t in texts]
    x = np.zeros((len(raw), BUCKETS), dtype=np.float32)
    for i, text in enumerate(raw):
        buckets, _ = letter_groups([text])
        x[i] = np.bincount(buckets.reshape(-1), minlength=BUCKETS) / max(buckets.size, 1)
    names = np.array(languages, dtype=object)
    families = sorted({family_of(n) for n in languages})
    members = [sorted({n for n in languages if family_of(n) == f}) for f in families]
    pairs = [(f, a, b) for f, own in enumerate(members) for a, b in combinations(range(len(own)), 2)]
    family = np.array([families.index(family_of(n)) for n in languages])
    machines = []
    for f in range(len(families)):
        machines.append(_machine(x, np.where(family == f, 1, -1), rng) if len(families) > 1 else (np.zeros(BUCKETS, np.float32), 1.0))
    for f, a, b in pairs:
        rows = np.flatnonzero((names == members[f][a]) | (names == members[f][b]))
        machines.append(_machine(x[rows], np.where(names[rows] == members[f][a], 1, -1), rng))
    weights = np.stack([w for w, _ in machines], axis=1)
    return LanguageModel(families, members, pairs, weights, np.array([b for _, b in machines]), 3.0)


def train_language_model(
    docs: DataFrame,
    per_language: int = PER_LANGUAGE,
    sample_texts: int = SAMPLE_TEXTS,
    characters: int = SAMPLE_CHARACTERS,
) -> LanguageModel | None:
    """Fit on a sample of the rows of ``docs`` with a known language; None if there is none.

    The sample holds at most ``per_language`` texts of each language, ``sample_texts``
    in all, and ``characters`` of each of them; rows with crc32(doc_id) mod 4 = 2 are
    never in it.
    """
    labelled = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    usable = labelled.filter("lang is not null and doc_id is not null").filter(
        crc_remainder(F.col("doc_id"), 4) != 2
    )
    chosen = sample_ids(usable.groupBy("doc_id").agg(F.min("lang").alias("lang")), "lang", per_language, sample_texts)
    rows = sorted((r.doc_id, r.lang, r.text) for r in sampled_texts(docs, chosen, characters).collect())
    rows = [r for r in rows if any(c.isalpha() for c in r[2])]
    return fit_model([r[2] for r in rows], [r[1] for r in rows]) if rows else None


def identify_language(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for each row of ``docs`` (``doc_id, text``).

    The whole text counts. A null text or one without a letter is ``und`` with score 0,
    as is any text if the model is None. ``held_out`` marks the ids never trained on;
    rows without doc_id are held out too. Equal texts get equal predictions; other
    columns are not read; an empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pickle.loads(shared.value)
        for batch in batches:
            for chunk in chunks_of(batch, "text"):
                texts = chunk.column("text").to_pylist()
                names, scores = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
                rows = [i for i, t in enumerate(texts) if t and any(c.isalpha() for c in t)]
                if known is not None and rows:
                    raw = utf8_texts(chunk.column("text"))
                    found = known.predict(text_margins(known, [raw[i] for i in rows]))
                    names[rows], scores[rows] = found
                yield pa.RecordBatch.from_arrays(
                    [chunk.column("doc_id"), chunk.column("held_out"), pa.array(names, pa.string()), pa.array(scores)],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    doc_id = F.col("doc_id").cast("bigint")
    return docs.select(
        doc_id.alias("doc_id"),
        F.coalesce(crc_remainder(doc_id, 4) == 2, F.lit(True)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    ).mapInArrow(work, "doc_id bigint, held_out boolean, lang_pred string, score double")
