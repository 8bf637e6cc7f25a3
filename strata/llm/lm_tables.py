"""Bigram counts of the corpus, and the scores they give (operator 7).

Every word and every bigram of the documents is counted.  Both models share one
vocabulary, all words of the documents:

  P(w)     = (c(w) + 0.1) / (tokens + 0.1 * vocabulary)
  P(w | v) = (c(v, w) + k(v) * P(w)) / (c(v) + k(v)),  k(v) = followers of v + 1

A word's code is its rank among the HEAD_WORDS most frequent ones or else its
63-bit hash below zero.  Words are counted first, in a written table.

Bigrams leave the texts once.  A slice of documents sends each part of the key
space one packed row: its distinct (bigram, document) pairs with their counts,
as compressed differences of sorted keys.  The packed rows are written bucketed
by part, and their number of parts grows with the tokens, so that a part is
bounded.  Two readings follow, without another shuffle of the bigrams:

* ``_totals``: what no single part knows, that is the counts of bigrams of two
  hot words, the contexts of hot words, and which parts meet which unranked words;
* ``_sums``: the log probabilities of a part's bigrams, added per document and
  sent on packed by slice, as integers of 2^-32, so that no order of adding
  changes a score.

Hot words are the HOT most frequent ones and the start of a text.  A bigram of
two goes to the part of its slice, one whose first word alone is hot goes by both
words, any other by its first word.  So no part gets a frequent bigram or word
whole: a word that isn't hot is at most 1 / HOT of all tokens.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bucketed, discard, drop_bucketed, written
from .textscan import LETTER, LOWER, Words, bounded_batches, map_texts, mix64, slices, text_buffer

RANK_BITS = 17
HEAD_WORDS = (1 << RANK_BITS) - 1
HOT_BITS = 8
HOT = (1 << HOT_BITS) - 1
#: Tokens of a part, about; Spark allows MOST_BUCKETS buckets, and a bucket may hold several parts.
PART_TOKENS, MOST_BUCKETS = 2_000_000, 100_000
#: Pseudo-count of every word of the vocabulary.
LEAST = 0.1
#: Sums of logarithms are kept in these units.
UNIT = 2.0 ** -32

_WORD = LETTER.copy()
_WORD[48:58] = True
_CODEC = "zstd"


class Codes:
    """Codes of words: 1 to HEAD_WORDS for the given hashes (top bit set), negative for any other."""

    def __init__(self, ranked: np.ndarray):
        self._rank = np.argsort(ranked, kind="stable")
        self._hashes = ranked[self._rank]

    def of(self, hashes: np.ndarray) -> np.ndarray:
        other = hashes | np.uint64(1 << 63)
        if len(self._hashes) == 0:
            return other.view(np.int64)
        at = np.minimum(np.searchsorted(self._hashes, other), len(self._hashes) - 1)
        return np.where(self._hashes[at] == other, self._rank[at] + 1, other.view(np.int64))


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every token, and where each text's tokens begin (one more at the end)."""
    data, rows = text_buffer(texts)
    words = Words(LOWER[data], rows, _WORD)
    return words.hashes(), words.at


def _bigrams(texts: pa.Array, codes: Codes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word before (0: none), word and text index of every token, and the tokens of each text."""
    hashes, at = _words(texts)
    own, n = codes.of(hashes), np.diff(at)
    before = np.concatenate([np.zeros(1, np.int64), own[:-1]]) if len(own) else own
    before[at[:-1][n > 0]] = 0
    return before, own, np.repeat(np.arange(len(n)), n), n


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of int64 as compressed bytes: equal bytes of all values stand together."""
    planes = [np.ascontiguousarray(c.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns]
    return pa.compress(b"".join(planes), codec=_CODEC, asbytes=True)


def _unpacked(data: bytes, n: int, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(data, decompressed_size=8 * n * columns, codec=_CODEC, asbytes=True), np.uint8)
    return [np.ascontiguousarray(p.T).view("<i8").reshape(-1) for p in raw.reshape(columns, 8, n)]


def count_words(marked: DataFrame) -> DataFrame:
    """(w, every, target): tokens of every word in all and in the target documents of ``marked(text, target)``."""
    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        hashes, at = _words(piece.column("text"))
        word, which, every = np.unique(hashes | np.uint64(1 << 63), return_inverse=True, return_counts=True)
        chosen = np.repeat(piece.column("target").to_numpy(zero_copy_only=False).astype(bool), np.diff(at))
        target = np.bincount(which[chosen], minlength=len(word)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(every.astype(np.int64)),
                                           pa.array(target)], ["w", "every", "target"])

    return (map_texts(marked.select("text", "target"), work, "w long, every long, target long")
            .groupBy("w").agg(F.sum("every").alias("every"), F.sum("target").alias("target")))


def _head(table: DataFrame, most: int):
    """A condition on ``every`` that the most frequent rows meet: ``most`` of them or fewer."""
    level = F.floor(F.log2("every") * 16)
    taken, cut = 0, None
    for r in sorted(table.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):
        taken += r["count"]
        if taken > most:
            break
        cut = r["level"]
    return F.lit(False) if cut is None else level >= cut


class _Vocabulary:
    """The ranked words with their probabilities (bounded by HEAD_WORDS), and the totals of all."""

    def __init__(self, words: DataFrame):
        head = words.where(_head(words, HEAD_WORDS)).toArrow()
        size = words.agg(F.count("*").alias("n"), F.sum("every").alias("every"), F.sum("target").alias("target")).first()
        word, every, target = (head.column(c).to_numpy() for c in ("w", "every", "target"))
        order = np.lexsort((word, -every))
        self.tokens = size["every"] or 0
        self._total = {c: max((size[c] or 0) + LEAST * size["n"], LEAST) for c in ("every", "target")}
        self.ranked = word[order].view(np.uint64)
        # the rank of a word is its place, from 1
        self.p = {c: self.probability(np.concatenate([[0], n[order]]), c)
                  for c, n in (("every", every), ("target", target))}

    def probability(self, count: np.ndarray, which: str) -> np.ndarray:
        return (count + LEAST) / self._total[which]


def _part_of(before: np.ndarray, own: np.ndarray, whole: int, parts: int) -> np.ndarray:
    """The part of every bigram; ``whole`` is that of the slice."""
    hot_v, hot_w = (before >= 0) & (before <= HOT), (own >= 0) & (own <= HOT)
    v, w = before.astype(np.uint64), own.astype(np.uint64)
    key = np.where(hot_v, mix64(v + np.uint64(1)) ^ w, v)
    part = (mix64(key + np.uint64(7)) % np.uint64(parts)).astype(np.int64)
    return np.where(hot_v & hot_w, whole, part)


def _packs(piece: pa.RecordBatch, codes: Codes, parts: int) -> pa.RecordBatch:
    """One row for every part that a slice's bigrams meet; the slice's own part also gets its documents."""
    before, own, row, n = _bigrams(piece.column("text"), codes)
    keys = piece.column("row").to_numpy().view(np.uint64)
    # the same rows in the same order give the same name, also where a lost task is run again
    name = int(mix64(np.cumsum(mix64(keys + np.arange(len(keys), dtype=np.uint64)))[-1:])[0])
    whole = name % parts
    target = piece.column("target").to_numpy(zero_copy_only=False).astype(np.int64)
    # ranked words fit in one key; others keep both codes
    ranked = (before >= 0) & (own >= 0)
    order = np.argsort(np.where(ranked, (before << RANK_BITS) | own, 0), kind="stable")
    if not ranked.all():
        order = np.lexsort((row, own, before))
    before, own, row = before[order], own[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (before[1:] != before[:-1]) | (own[1:] != own[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(row)))
    before, own, row = before[first], own[first], row[first]
    part = _part_of(before, own, whole, parts)
    by_part = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
    before, own, row, times, part = (a[by_part] for a in (before, own, row, times, part))
    names = np.unique(np.append(part, whole))
    starts, ends = np.searchsorted(part, names), np.searchsorted(part, names, side="right")
    sizes, blobs, ids, tokens = [], [], [], []
    for p, s, e in zip(names, starts, ends):
        sizes.append(e - s)
        blobs.append(_packed(np.diff(before[s:e], prepend=0), own[s:e], 2 * row[s:e] + target[row[s:e]], times[s:e]))
        ids.append(piece.column("doc_id").to_pylist() if p == whole else None)
        tokens.append(n if p == whole else None)
    return pa.RecordBatch.from_arrays(
        [pa.array(names), pa.array(np.full(len(names), name, np.uint64).view(np.int64)),
         pa.array(np.array(sizes, np.int32)), pa.array(blobs, pa.binary()),
         pa.array(ids, pa.list_(pa.int64())), pa.array(tokens, pa.list_(pa.int64()))],
        ["part", "slice", "size", "pairs", "ids", "tokens"])


_PACKS = "part long, slice long, size int, pairs binary, ids array<long>, tokens array<long>"


class _Part:
    """The bigrams of one part: its distinct ones with their counts, and its pairs with documents."""

    def __init__(self, table: pa.Table):
        self.sizes = table.column("size").to_numpy()
        total, at = int(self.sizes.sum()), 0
        v, w = np.empty(total, np.int64), np.empty(total, np.int64)
        self.row, self.times, chosen = np.empty(total, np.int32), np.empty(total, np.int32), np.empty(total, bool)
        for blob, n in zip(table.column("pairs"), self.sizes.tolist()):
            here = slice(at, at + n)
            step, w[here], doc, self.times[here] = _unpacked(blob.as_py(), n, 4)
            v[here], self.row[here], chosen[here] = np.cumsum(step), doc >> 1, doc & 1
            at += n
        if (v < 0).any() or (w < 0).any():
            order = np.lexsort((w, v))
        else:
            order = np.argsort((v << RANK_BITS) | w, kind="stable")
        new = np.ones(total, bool)
        for k in (v, w):
            k[:] = k[order]
        new[1:] = (v[1:] != v[:-1]) | (w[1:] != w[:-1])
        self.v, self.w = v[new], w[new]
        del v, w
        #: the distinct bigram of every pair
        self.which = np.empty(total, np.int32)
        self.which[order] = np.cumsum(new, dtype=np.int32) - 1
        del order
        self.count = {"every": np.bincount(self.which, self.times, len(self.v)),
                      "target": np.bincount(self.which[chosen], self.times[chosen], len(self.v))}
        self.hot_v = (self.v >= 0) & (self.v <= HOT)
        self.hot = self.hot_v & (self.w >= 0) & (self.w <= HOT)


def _totals(packs: DataFrame) -> DataFrame:
    """(kind, a, b, every, target) that parts share, added over parts.

    Kind 0: bigram a, b of hot words.  Kind 1: tokens after the hot word a whose word isn't
    hot; kind 2: how many such words follow it.  Kind 3: part a meets the unranked word b.
    """
    def work(table: pa.Table) -> pa.Table:
        part = _Part(table)
        once = part.hot_v & ~part.hot
        seen = np.bincount(part.v[once], minlength=HOT + 1)
        after = np.flatnonzero(seen)
        rare = np.unique(part.w[part.w < 0])
        zero = np.zeros
        columns = []
        for kind, a, b, every, target in (
                (0, part.v[part.hot], part.w[part.hot], part.count["every"][part.hot], part.count["target"][part.hot]),
                (1, after, zero(len(after)), *(np.bincount(part.v[once], part.count[c][once], HOT + 1)[after]
                                               for c in ("every", "target"))),
                (2, after, zero(len(after)), seen[after],
                 np.bincount(part.v[once], part.count["target"][once] > 0, HOT + 1)[after]),
                (3, np.full(len(rare), table.column("part")[0].as_py()), rare, zero(len(rare)), zero(len(rare)))):
            # hashes must not pass through doubles
            columns.append([np.asarray(c).astype(np.int64) for c in (np.full(len(a), kind), a, b, every, target)])
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*columns)],
                                    ["kind", "a", "b", "every", "target"])

    return (packs.groupBy("part").applyInArrow(work, "kind long, a long, b long, every long, target long")
            .groupBy("kind", "a", "b").agg(F.sum("every").alias("every"), F.sum("target").alias("target")))


def _hot_tables(shared: DataFrame) -> tuple[dict, dict, dict]:
    """Counts of hot bigrams, and tokens and followers of hot words: fixed size, by HOT."""
    got = shared.where("kind < 3").toArrow()
    kind, a, b = (got.column(c).to_numpy() for c in ("kind", "a", "b"))
    pair, tokens, kinds = {}, {}, {}
    for c in ("every", "target"):
        n = got.column(c).to_numpy().astype(float)
        pair[c] = np.zeros((HOT + 1, HOT + 1))
        pair[c][a[kind == 0], b[kind == 0]] = n[kind == 0]
        tokens[c] = pair[c].sum(axis=1) + np.bincount(a[kind == 1], n[kind == 1], HOT + 1)
        kinds[c] = (pair[c] > 0).sum(axis=1) + np.bincount(a[kind == 2], n[kind == 2], HOT + 1) + 1.0
    return pair, tokens, kinds


def _sums(packs: DataFrame, rare: DataFrame, vocabulary: _Vocabulary, hot: tuple[dict, dict, dict]) -> DataFrame:
    """(slice, size, sums, ids, tokens): every part's sums of logarithms of a slice's documents, packed."""
    pair, tokens, kinds = hot
    # tasks get the ranked words' probabilities, not their hashes
    p_ranked, probability = vocabulary.p, vocabulary.probability

    def work(table: pa.Table, words: pa.Table) -> pa.Table:
        if table.num_rows == 0:
            return _no_rows
        part = _Part(table)
        context = np.flatnonzero(np.concatenate([[True], part.v[1:] != part.v[:-1]])[:len(part.v)])
        which = np.cumsum(np.concatenate([[0], part.v[1:] != part.v[:-1]])[:len(part.v)])
        order = np.argsort(words.column("w").to_numpy(), kind="stable")
        known = words.column("w").to_numpy()[order]
        ranked, place = part.w >= 0, np.searchsorted(known, part.w)
        logs = {}
        for c in ("every", "target"):
            n = part.count[c].copy()
            n[part.hot] = pair[c][part.v[part.hot], part.w[part.hot]]
            # a first word that isn't hot has all its bigrams here
            total = np.bincount(which, n, len(context))[which] if len(n) else n
            follow = np.bincount(which, n > 0, len(context))[which] + 1.0 if len(n) else n
            total[part.hot_v], follow[part.hot_v] = tokens[c][part.v[part.hot_v]], kinds[c][part.v[part.hot_v]]
            p = np.empty(len(n))
            p[ranked] = p_ranked[c][part.w[ranked]]
            p[~ranked] = probability(words.column(c).to_numpy()[order][place[~ranked]], c)
            logs[c] = np.log((n + follow * p) / (total + follow))
        sizes, sums, start = [], [], 0
        for n in part.sizes.tolist():
            here = slice(start, start + n)
            rows, at = np.unique(part.row[here].astype(np.int64), return_inverse=True)
            own = [np.rint(np.bincount(at, logs[c][part.which[here]] * part.times[here], len(rows)) / UNIT)
                   for c in ("target", "every")]
            sizes.append(len(rows))
            sums.append(_packed(np.diff(rows, prepend=0), *own))
            start += n
        return pa.Table.from_arrays(
            [table.column("slice"), pa.array(sizes, pa.int32()), pa.array(sums, pa.binary()),
             table.column("ids"), table.column("tokens")], _no_rows.schema.names)

    return packs.groupBy("part").cogroup(rare.groupBy("part")).applyInArrow(
        work, "slice long, size int, sums binary, ids array<long>, tokens array<long>")


_no_rows = pa.schema([("slice", pa.int64()), ("size", pa.int32()), ("sums", pa.binary()),
                      ("ids", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int64()))]).empty_table()


def _scored(table: pa.Table) -> pa.Table:
    """The scores of a slice's documents from the sums of all parts.

    Slices of equal rows in equal order share a name: their sums come as often as they do.
    """
    owners = [i for i, ids in enumerate(table.column("ids")) if ids.is_valid]
    ids, n = table.column("ids")[owners[0]].as_py(), np.array(table.column("tokens")[owners[0]].as_py(), np.int64)
    sums = np.zeros((2, len(ids)), np.int64)
    for size, blob in zip(table.column("size").to_pylist(), table.column("sums")):
        step, target, every = _unpacked(blob.as_py(), size, 3)
        at = np.cumsum(step)
        sums[0, at] += target
        sums[1, at] += every
    times, none = len(owners), n == 0
    target, every = -(sums // times) * UNIT / np.maximum(n, 1)
    one = pa.table([pa.array(ids, pa.int64()), pa.array(n), pa.array(target, mask=none), pa.array(every, mask=none),
                    pa.array(np.where(none, 0.0, target - every))],
                   names=["doc_id", "n_tokens", "target_loss", "background_loss", "score"])
    return pa.concat_tables([one] * times)


def scores(docs: DataFrame, target_ids: DataFrame, shuffled: bool = False) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) of ``docs(doc_id, text)``.

    The target is the documents whose id is in the distinct ``target_ids(target_id)``;
    ``shuffled`` says that they are joined by a shuffle, whose order of rows may change
    when a lost task is run again: rows are sorted there, as slices are named by theirs.
    """
    spark = docs.sparkSession
    marked = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
              .join(target_ids, F.col("doc_id") == F.col("target_id"), "left")
              .select("doc_id", "text", F.col("target_id").isNotNull().alias("target")))
    words, words_path = written(count_words(marked), "lm-words")
    vocabulary = _Vocabulary(words)
    codes, parts = Codes(vocabulary.ranked), max(1, math.ceil(vocabulary.tokens / PART_TOKENS))
    named = marked.withColumn("row", F.xxhash64("doc_id", "text"))
    if shuffled:
        named = named.sortWithinPartitions("doc_id", "row")
    bounded_batches(spark)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                yield _packs(piece, codes, parts)

    packs, packs_table = bucketed(named.mapInArrow(send, _PACKS), "lm-packs", "part", min(parts, MOST_BUCKETS))
    shared, shared_path = written(_totals(packs), "lm-shared")
    hot = _hot_tables(shared)
    rare = (shared.where("kind = 3").select(F.col("a").alias("part"), F.col("b").alias("w"))
            .join(words, "w").select("part", "w", "every", "target"))
    done, _ = written(_sums(packs, rare, vocabulary, hot).groupBy("slice").applyInArrow(
        _scored, "doc_id long, n_tokens long, target_loss double, background_loss double, score double"), "lm-scores")
    for path in (words_path, shared_path):
        discard(spark, path)
    drop_bucketed(spark, packs_table)
    return done
