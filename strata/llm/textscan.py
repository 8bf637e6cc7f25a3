"""Vectorised text scanning shared by the training-data operators.

A task receives Arrow batches from ``mapInArrow``; every batch is cut into
slices of bounded size and the words of a slice are found and hashed with a
few numpy passes over its UTF-8 bytes.  No per-row Python loop runs over the
characters or words of a text, and texts are never cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that are worked on at once (a longer single text forms a slice alone).
SLICE_BYTES = 1 << 20
#: Rows that Spark sends to Python at once; bounds a task's memory with long texts.
BATCH_ROWS = 512
#: Lower-cased A-Z, everything else as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Word characters of the shingle operators: all but space and 0x09-0x0D.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Letters for word features: a-z (after lower-casing) and every non-ASCII byte.
LETTER = np.zeros(256, bool)
LETTER[97:123] = True
LETTER[128:] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)


def _power(n: int, base: np.uint64) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    steps = np.full(max(n, 1), base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows, and each row's start (one more at the end). Null: empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece has about SLICE_BYTES of text, or one row."""
    if batch.num_rows == 0:
        return
    size = np.diff(text_buffer(batch.column(column))[1])
    ends = np.cumsum(size)
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + SLICE_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


class ByteHashes:
    """64-bit hashes of any part of a byte array, from one prefix sum."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * _power(n, _BASE), out=self._sums[1:])
        self._down = _power(n + 1, _INVERSE)

    def of(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Hashes of the bytes from s up to e."""
        return mix64((self._sums[e] - self._sums[s]) * self._down[s] + (e - s).astype(np.uint64))


class Words:
    """The words of a slice: start, end, row, and hashes of any part of them."""

    def __init__(self, data: np.ndarray, rows: np.ndarray, is_word: np.ndarray):
        n = len(data)
        inside = is_word[data]
        first, last = inside.copy(), inside.copy()
        if n:
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            edges = np.unique(rows[(rows > 0) & (rows < n)])  # words end with their row
            first[edges] = inside[edges]
            last[edges - 1] = inside[edges - 1]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        #: index of the first word of each row, one more at the end
        self.at = np.searchsorted(self.starts, rows)
        self._bytes = ByteHashes(data)

    def hashes(self, starts: np.ndarray | None = None, ends: np.ndarray | None = None) -> np.ndarray:
        """64-bit hashes of the bytes between starts and ends (default: whole words)."""
        return self._bytes.of(self.starts if starts is None else starts, self.ends if ends is None else ends)


def map_texts(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str,
              column: str = "text") -> DataFrame:
    """Run ``work`` over bounded slices of ``df`` in the tasks; ``schema`` is the result's."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, column):
                yield work(piece)

    return df.mapInArrow(run, schema)


def bounded_batches(spark: SparkSession) -> None:
    """At most BATCH_ROWS rows go to Python at once, so that long texts fit in memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def share_of(key, fraction: float):
    """A repeatable Bernoulli filter: keeps about ``fraction`` of the rows by a hash of ``key``."""
    return F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) < F.lit(int(min(1.0, fraction) * (1 << 30)))


def crc_class(doc_id, modulus: int):
    """crc32 of the id's decimal text, modulo ``modulus`` (null ids: -1)."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % modulus, F.lit(-1))
