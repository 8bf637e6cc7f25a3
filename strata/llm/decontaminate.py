"""Benchmark decontamination by spaced-seed hashing (operator 3).

Words are runs of ASCII letters (case folded), digits and non-ASCII bytes.  A
fixed mask of ones and zeros hashes the words under its ones and ignores those
under its zeros, so that a substituted word inside a passage spoils only some
of its seeds.  Seeds of the training texts are joined with those of the test
items, and each hit is verified on its diagonal: a document is contaminated by
an item if some window of min(WINDOW, item's words) aligned words differs in
at most ``tolerated(window)`` places.  MASKS hit every such window (a test
tries all placements of the substitutions), so verification loses none.

The test items go to the tasks in blocks of about BLOCK_CHARS characters (the
table's size is counted first); a larger benchmark takes several passes over
the documents instead of a larger broadcast.  Documents are never shuffled.

Defined results: null or empty texts match nothing; items of fewer than five
words are too short to be told from chance and match nothing; items that
repeat a text each get their own rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textscan import LETTER, LOWER, Words, map_texts, mix64, text_buffer

MASKS = ("111011", "1100001011", "11111")
WINDOW, SHORTEST = 16, 5
BLOCK_CHARS = 16_000_000

_WORD = LETTER.copy()
_WORD[48:58] = True
_SPREAD = np.random.default_rng(33).integers(1, 1 << 63, (len(MASKS), 16), dtype=np.uint64) | np.uint64(1)
#: bits of the hash that the first, cheap look-up uses
_SIEVE_BITS = 22


def tolerated(window: int) -> int:
    """Substituted words allowed in a window: none below 10 words, 3 in 14 or more."""
    return min(3, max(0, (window - 8) // 2))


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, rows = text_buffer(texts)
    found = Words(LOWER[data], rows, _WORD)
    return found.hashes(), found.at


def seeds(hashes: np.ndarray, at: np.ndarray, mask: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (first word) and hashes of one mask's seeds that lie inside a row."""
    ones = [i for i, c in enumerate(MASKS[mask]) if c == "1"]
    span, n = len(MASKS[mask]), len(hashes)
    full = max(0, n - span + 1)
    acc = np.full(full, mask + 1, np.uint64)
    for k, o in enumerate(ones):
        acc += hashes[o:o + full] * _SPREAD[mask, k]
    end = np.repeat(at[1:], np.diff(at))[:full]
    inside = np.arange(full) + span <= end
    return np.flatnonzero(inside), mix64(acc[inside])


class TestItems:
    """One block of test items: words, and seeds in hash order with their places."""
    __test__ = False

    def __init__(self, ids: pa.Array, texts: pa.Array):
        self.ids = ids
        self.words, self.at = _words(texts)
        size = np.diff(self.at)
        hashes, places = [], []
        for m in range(len(MASKS)):
            pos, h = seeds(self.words, self.at, m)
            long_enough = np.repeat(size, size)[pos] >= SHORTEST
            hashes.append(h[long_enough])
            places.append(pos[long_enough])
        h, place = np.concatenate(hashes), np.concatenate(places)
        order = np.argsort(h, kind="stable")
        self.hashes, self.places = h[order], place[order]
        self.item_of = np.repeat(np.arange(len(size)), size)
        self.sieve = np.zeros(1 << _SIEVE_BITS, bool)
        self.sieve[self.hashes >> np.uint64(64 - _SIEVE_BITS)] = True

    def matches(self, texts: pa.Array) -> list[tuple[int, int, int, int, int]]:
        """(row, item, first word, aligned words, equal words) of each verified overlap:
        the best window of every contaminated row and item."""
        words, at = _words(texts)
        rows, items, diagonals = [], [], []
        row_of = np.repeat(np.arange(len(at) - 1), np.diff(at))
        for m in range(len(MASKS)):
            pos, h = seeds(words, at, m)
            maybe = self.sieve[h >> np.uint64(64 - _SIEVE_BITS)]
            pos, h = pos[maybe], h[maybe]
            low = np.searchsorted(self.hashes, h, "left")
            count = np.searchsorted(self.hashes, h, "right") - low
            hit = np.repeat(pos, count)
            offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            place = self.places[np.repeat(low, count) + offset]
            item = self.item_of[place]
            rows.append(row_of[hit])
            items.append(item)
            diagonals.append(hit - (place - self.at[item]))  # where the item's first word would lie
        found = np.stack([np.concatenate(x) for x in (rows, items, diagonals)])
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for row, item, start in np.unique(found, axis=1).T.tolist() if found.shape[1] else []:
            got = self._verify(words, at[row], at[row + 1], item, start)
            if got and got[2] > best.get((row, item), (0, 0, -1))[2]:
                best[(row, item)] = got
        return [(*key, *value) for key, value in sorted(best.items())]

    def _verify(self, words, low, high, item, start):
        first, last = self.at[item], self.at[item + 1]
        window = min(WINDOW, last - first)
        a, b = max(start, low), min(start + (last - first), high)  # aligned part of the document
        if b - a < window:
            return None
        same = words[a:b] == self.words[first + (a - start):first + (b - start)]
        sums = np.concatenate([[0], np.cumsum(same)])
        inside = sums[window:] - sums[:-window]
        k = int(inside.argmax())
        if inside[k] < window - tolerated(window):
            return None
        return int(a + k - low), int(window), int(inside[k])


def _blocks(benchmark: DataFrame, block_chars: int) -> list[TestItems]:
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(
        F.col("text").isNotNull() & F.col("item_id").isNotNull())
    chars = items.select(F.sum(F.length("text"))).first()[0] or 0
    if not chars:
        return []
    n = -(-chars // block_chars)
    out = []
    for b in range(n):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).toArrow()
        if block.num_rows:
            out.append(TestItems(block.column("item_id").combine_chunks(),
                                 block.column("text").combine_chunks()))
    return out


_MATCH = "doc_id long, item_id long, at_word long, window_words long, equal_words long"


def _find(docs: DataFrame, block: TestItems) -> DataFrame:
    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        found = block.matches(piece.column("text"))
        columns = [np.array(c, np.int64) for c in zip(*found)] or [np.zeros(0, np.int64)] * 5
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id").cast(pa.int64()).take(pa.array(columns[0])),
             block.ids.take(pa.array(columns[1])), *(pa.array(c) for c in columns[2:])],
            ["doc_id", "item_id", "at_word", "window_words", "equal_words"])

    return map_texts(docs.select("doc_id", "text"), work, _MATCH)


def contaminated(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per contaminated document and test item, with the best window's place."""
    out = docs.sparkSession.createDataFrame([], _MATCH)
    for i, block in enumerate(_blocks(benchmark, block_chars)):
        found = _find(docs, block)
        out = out.unionAll(found) if i else found
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents that no test item contaminates, all columns unchanged."""
    def keep(block: TestItems):
        def work(piece: pa.RecordBatch) -> pa.RecordBatch:
            clean = np.ones(piece.num_rows, bool)
            clean[[m[0] for m in block.matches(piece.column("text"))]] = False
            return piece.filter(pa.array(clean))
        return work

    for block in _blocks(benchmark, block_chars):
        docs = map_texts(docs, keep(block), docs.schema)
    return docs
