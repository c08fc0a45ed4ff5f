"""Which records of a stream were seen before, remembered in few bytes a record.

A record is known by its id. Ids that end in a colon and a number, as a file and a row, are
kept as one bit each: a block of neighbouring numbers under the same text is a bitmap, which
packs to next to nothing where whole stretches were seen. Any other id is kept as a digest of
16 bytes. Blocks and digests lie in a fixed number of buckets, each one value of the state
store, and what has expired goes whenever its bucket is used.
"""

from __future__ import annotations

import pickle
import warnings
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.session import send_code_with_tasks

send_code_with_tasks(__name__)

#: Numbers of a block, and buckets of the state. Fixed: a checkpoint is written with them.
BLOCK_RECORDS, BUCKETS = 1 << 16, 4096

# Places of ids that have no number, and of rows that have no id.
_TEXT, _WITHOUT = -1, -2


def with_places(df: DataFrame, record_id: str) -> DataFrame:
    """Add where each row's id is kept: a bucket, the digest of its block or of itself in two
    halves, and its place in the block, below 0 for an id without a number and for no id.

    Numbers are taken as such only in the one way they are printed, so ``a:7`` and ``a:07``
    are different ids. Rows without an id are dealt over the buckets.
    """
    name = F.col(record_id)
    tail = F.substring_index(name, ":", -1)
    number = F.when(name.contains(":") & tail.rlike(r"\A(0|[1-9][0-9]{0,17})\z"), tail.try_cast("bigint"))
    # What a block is known by: the text and its first number, -1 where the text is the whole id.
    text = F.when(number.isNull(), name).otherwise(F.left(name, F.length(name) - F.length(tail)))
    begin = F.coalesce(number - number % BLOCK_RECORDS, F.lit(-1))
    placed = df.withColumns({
        "_place": F.when(name.isNull(), F.lit(_WITHOUT)).otherwise(F.coalesce((number % BLOCK_RECORDS).cast("int"), F.lit(_TEXT))),
        "_high": F.xxhash64(F.lit(1), text, begin),
        "_low": F.xxhash64(F.lit(2), text, begin),
    })
    bucket = F.when(name.isNotNull(), F.pmod(F.col("_high"), F.lit(BUCKETS))).otherwise(F.floor(F.rand() * BUCKETS))
    return placed.withColumn("_bucket", bucket.cast("int"))


class Seen:
    """The ids of one bucket: per block the numbers that were seen, and the digests of ids
    without a number, both by the time they were first seen."""

    def __init__(self, stored: bytes | None, after: int):
        """``stored`` is what :meth:`stored` gave; what was first seen at ``after`` or before is forgotten."""
        blocks, texts = pickle.loads(stored) if stored else ([], [])
        self.blocks = {}
        for time, digest, bits in blocks:
            if time > after:
                self.blocks.setdefault(digest, []).append((time, bits))
        self.texts = [(time, digests) for time, digests in texts if time > after]
        self.known = {digest for _, digests in self.texts for digest in digests}
        self.open, self.new = {}, []

    def _numbers(self, digest: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """Which numbers of a block were seen before this batch, and which up to now."""
        if digest not in self.open:
            before = np.zeros(BLOCK_RECORDS, dtype=bool)
            for _, bits in self.blocks.get(digest, ()):
                before |= np.unpackbits(np.frombuffer(zlib.decompress(bits), dtype=np.uint8)).astype(bool)
            self.open[digest] = before, before.copy()
        return self.open[digest]

    def first(self, high: np.ndarray, low: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Whether each row is the first of its id; its id has been seen from now on."""
        keep = places == _WITHOUT
        order = np.lexsort((low, high))
        new_run = (np.diff(high[order]) != 0) | (np.diff(low[order]) != 0)
        for rows in np.split(order, np.flatnonzero(new_run) + 1):
            rows = rows[places[rows] != _WITHOUT]
            if not len(rows):
                continue
            digest = int(high[rows[0]]), int(low[rows[0]])
            if places[rows[0]] == _TEXT:
                if digest not in self.known:
                    keep[rows[0]] = True
                    self.known.add(digest)
                    self.new.append(digest)
                continue
            _, seen = self._numbers(digest)
            numbers, at = np.unique(places[rows], return_index=True)
            keep[rows[at[~seen[numbers]]]] = True
            seen[numbers] = True
        return keep

    def stored(self, time: int) -> bytes:
        """The bucket as bytes, with what a batch of that time has added."""
        blocks = [(t, digest, bits) for digest, found in self.blocks.items() for t, bits in found]
        for digest, (before, now) in self.open.items():
            added = now & ~before
            if added.any():
                blocks.append((time, digest, zlib.compress(np.packbits(added).tobytes(), 1)))
        return pickle.dumps((blocks, self.texts + ([(time, self.new)] if self.new else [])))


def first_of_each_id(df: DataFrame, record_id: str, keep_ms: int, columns=None) -> DataFrame:
    """The rows of a stream without those whose id was first seen less than ``keep_ms`` ago, in
    this micro-batch or an earlier one. Rows without an id all stay. ``columns`` are those the
    result needs, all by default; no others are sent to the tasks that hold the state."""
    columns = list(columns or df.columns)

    def first(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        # Spark puts empty frames beside those given here.
        warnings.filterwarnings("ignore", "The behavior of DataFrame concatenation", FutureWarning)
        now = state.getCurrentProcessingTimeMs()
        seen = Seen(state.get[0] if state.exists else None, now - keep_ms)
        for rows in batches:
            yield rows.loc[seen.first(*(rows[c].to_numpy() for c in ("_high", "_low", "_place"))), columns]
        state.update((seen.stored(now),))

    placed = with_places(df, record_id).select(*columns, "_high", "_low", "_place", "_bucket")
    schema = df.select(*columns).schema
    return placed.groupBy("_bucket").applyInPandasWithState(first, schema, "seen binary", "append", "NoTimeout")
