"""Nearest neighbours by cross-polytope hashing (operator 13).

Three rounds of random signs and a fast Hadamard transform turn a unit vector
pseudo-randomly; its hash is the nearest signed axis (Andoni et al. 2015).  AXES
independent turns make a bucket, TABLES such codes a vector's places.  A bucket
matches a query as well as the query's coordinates on the bucket's axes sum up;
all buckets above a cut are probed, in each table.  The cut is calibrated: for
SAMPLE rows, the exact neighbours among all rows are found, and the cut is set
where a share RECALL of them lies in a probed bucket of some table.

Codes of a table are cut into ranges of about equal width; a range is a block
of rows, and each query goes to the blocks that may hold one of its buckets (a
range is ruled out by its first two axes).  Crowded blocks are cut again by
hashes of ids, on both sides, by counts of all rows and probes, so that no task
gets a block much larger than the mean.  The task measures a query against the
rows of its probed buckets, on the original vectors in double precision, and
sends on the K nearest of each block.  A query with fewer than K found is
searched again with all buckets.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and rows without vec_id, take no part; shorter vectors count as
padded with zeros; rows with the same vec_id are one candidate, at its nearest
row, and one query, with the nearest of all its rows; a row never finds its own
vec_id; ties go to the smaller vec_id; an empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, shuffle_width
from .textscan import mix64

#: Neighbours returned for each query; queries are the ids divisible by QUERY_EVERY.
K, QUERY_EVERY = 10, 100
TABLES, AXES, TURNS = 3, 3, 3
#: Rows whose exact neighbours set the cut, and the share of these to be found.
SAMPLE, RECALL = 256, 0.98
#: Rows and queries of a block, at most; ranges of a table, at least and at most.
BLOCK_ROWS, BLOCK_QUERIES = 1 << 16, 1 << 14
LEAST_RANGES, MOST_RANGES = 8, 1 << 14
#: Numbers in one array of a task, about; candidate pairs that are measured at once.
NUMBERS, PAIRS = 1 << 20, 1 << 16


def _floats(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows of doubles, padded with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    size = np.diff(column.offsets.to_numpy())
    if (size == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(size), width))
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


@dataclass
class Hasher:
    """The turns, cut and blocks that all tasks share; its size depends on the width of a vector only."""

    width: int
    signs: np.ndarray  # TABLES x AXES x TURNS x size
    cut: float = -np.inf

    @classmethod
    def of(cls, width: int, seed: int = 13) -> Hasher:
        size = 1 << max(1, (width - 1).bit_length())
        signs = np.random.default_rng(seed).choice([-1.0, 1.0], (TABLES, AXES, TURNS, size))
        return cls(width, signs)

    @property
    def size(self) -> int:
        return self.signs.shape[-1]

    def turned(self, vectors: np.ndarray) -> np.ndarray:
        """Coordinates after each table's turns: rows x TABLES x AXES x size."""
        unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no overflow in the squares below
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        x = np.zeros((len(vectors), TABLES, AXES, self.size))
        x[..., :self.width] = unit[:, None, None, :]
        for turn in range(TURNS):
            x *= self.signs[:, :, turn]
            step = 1
            while step < self.size:  # butterflies of the fast Hadamard transform
                pairs = x.reshape(*x.shape[:-1], self.size // (2 * step), 2, step)
                x = np.stack([pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]],
                             axis=-2).reshape(x.shape)
                step *= 2
            x /= np.sqrt(self.size)
        return x

    def codes(self, turned: np.ndarray) -> np.ndarray:
        """Bucket of each row in each table: the nearest signed axis of each turn, as one number."""
        axis = np.abs(turned).argmax(axis=-1)
        axis = 2 * axis + (np.take_along_axis(turned, axis[..., None], -1)[..., 0] < 0)
        return (axis * (2 * self.size) ** np.arange(AXES - 1, -1, -1)).sum(axis=-1)

    def axes(self, codes: np.ndarray) -> list[np.ndarray]:
        return [codes // (2 * self.size) ** (AXES - 1 - k) % (2 * self.size) for k in range(AXES)]

    @staticmethod
    def signed(turned: np.ndarray) -> np.ndarray:
        """Coordinates on all signed axes, in the codes' numbering."""
        return np.stack([turned, -turned], axis=-1).reshape(*turned.shape[:-1], 2 * turned.shape[-1])

    def score(self, signed: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """How well buckets match: queries (rows of ``signed``: AXES x 2 size) by buckets."""
        return sum(signed[:, k, axis] for k, axis in enumerate(self.axes(codes)))

    def ranges(self, signed: np.ndarray, n: int) -> np.ndarray:
        """Whether each of ``n`` code ranges may hold a probed bucket of each query."""
        most = signed[:, 0, :, None] + signed[:, 1, None, :] + signed[:, 2:].max(axis=-1).sum(axis=1)[:, None, None]
        hit = (most >= self.cut - 1e-9).reshape(len(signed), -1)
        first = self.range_of(np.arange(hit.shape[1]) * (2 * self.size) ** (AXES - 2), n)
        starts = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])
        out = np.zeros((len(signed), n), bool)
        out[:, first[starts]] = np.logical_or.reduceat(hit, starts, axis=1)
        return out

    def range_of(self, codes: np.ndarray, n: int) -> np.ndarray:
        """The code's range: by its first two axes alone."""
        return codes // (2 * self.size) ** (AXES - 2) * n // (2 * self.size) ** 2


def sound(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0),
                      F.lit(False))


def _pieces(batches: Iterator[pa.RecordBatch], hasher: Hasher) -> Iterator[pa.RecordBatch]:
    step = max(1, NUMBERS // (TABLES * AXES * hasher.size))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def _nearest(query: np.ndarray, other: np.ndarray, distance: np.ndarray, *more: np.ndarray) -> list[np.ndarray]:
    """The K rows of least (distance, other) for each query, each other once."""
    order = np.lexsort((distance, other, query))
    query, other, distance = query[order], other[order], distance[order]
    more = [m[order] for m in more]
    once = np.r_[True, (query[1:] != query[:-1]) | (other[1:] != other[:-1])][:len(query)]
    query, other, distance = query[once], other[once], distance[once]
    more = [m[once] for m in more]
    order = np.lexsort((other, distance, query))
    query = query[order]
    first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]][:len(query)])
    rank = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)]))
    keep = order[rank < K]
    by = query[rank < K]
    return [by, other[keep], distance[keep], *[m[keep] for m in more]]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to rows, without cancellation."""
    return np.sqrt(((a - b) ** 2).sum(axis=1))


def calibrated(rows: DataFrame, hasher: Hasher) -> Hasher:
    """``hasher`` with the cut that finds a share RECALL of the sample's exact neighbours."""
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit("cut")), "vec_id").limit(SAMPLE).toArrow().combine_chunks()
    if sample.num_rows < 2:
        return hasher
    ids = sample.column("vec_id").to_numpy()
    query = _floats(sample.column("embedding").combine_chunks(), hasher.width)
    signed = hasher.signed(hasher.turned(query))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0)]
        for piece in _pieces(batches, hasher):
            other, vectors = piece.column("vec_id").to_numpy(), _floats(piece.column("embedding"), hasher.width)
            codes = hasher.codes(hasher.turned(vectors))
            score = np.max([hasher.score(signed[:, t], codes[:, t]) for t in range(TABLES)], axis=0)
            for i in range(len(ids)):
                d = _distances(query[i], vectors)
                d[other == ids[i]] = np.inf
                near = np.argpartition(d, min(K, len(d)) - 1)[:K]
                near = near[np.isfinite(d[near])]
                new = [np.full(len(near), i), other[near], d[near], score[i, near]]
                best = [np.concatenate([a, b]) for a, b in zip(best, new)]
            best = _nearest(*best)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in best], ["query", "vec_id", "distance", "score"])

    found = rows.mapInArrow(run, "query long, vec_id long, distance double, score double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy("distance", "vec_id"))
    score = found.withColumn("rank", rank).where(F.col("rank") <= K).select("score").toArrow().column(0).to_numpy()
    if len(score):  # at most K rows for each row of the sample
        hasher.cut = float(np.sort(score)[int(np.floor((1 - RECALL) * len(score)))]) - 1e-9
    return hasher


@dataclass
class Blocks:
    """How ranges are cut into blocks: parts by rows and by queries of each range."""

    row_parts: np.ndarray  # TABLES x ranges
    query_parts: np.ndarray

    @property
    def first(self) -> np.ndarray:
        size = (self.row_parts * self.query_parts).ravel()
        return (np.cumsum(size) - size).reshape(self.row_parts.shape)

    def copies(self, table: int, ranges: np.ndarray, ids: np.ndarray, queries: bool) -> tuple[np.ndarray, np.ndarray]:
        """(row, block) of each copy of rows (or queries) that fall in ``ranges``."""
        own, across = self.row_parts[table, ranges], self.query_parts[table, ranges]
        if queries:
            own, across = across, own
        part = (mix64(ids.astype(np.uint64)) % own.astype(np.uint64)).astype(np.int64)
        row = np.repeat(np.arange(len(ids)), across)
        k = np.arange(len(row)) - np.repeat(np.cumsum(across) - across, across)
        inner = self.query_parts[table, ranges][row]
        block = (k * inner + part[row]) if queries else (part[row] * inner + k)
        return row, self.first[table, ranges][row] + block


def _routes(hasher: Hasher, n: int, vectors: np.ndarray, asks: np.ndarray) -> Iterator[tuple]:
    """For each table: the codes, the range of each row, and the (query, range) pairs to be searched."""
    turned = hasher.turned(vectors)
    codes = hasher.codes(turned)
    for t in range(TABLES):
        signed = hasher.signed(turned[asks, t])
        step = max(1, NUMBERS // (2 * hasher.size) ** 2)
        parts = [np.argwhere(hasher.ranges(signed[i:i + step], n)) + [i, 0] for i in range(0, len(signed), step)]
        wanted = np.concatenate(parts) if parts else np.zeros((0, 2), np.int64)
        yield t, codes[:, t], hasher.range_of(codes[:, t], n), asks[wanted[:, 0]], wanted[:, 1]


def _searched(rows: DataFrame, queries: Column, hasher: Hasher, total: int) -> DataFrame:
    """(query_id, vec_id, score): the K nearest of each query in each block."""
    n = int(min(MOST_RANGES, (2 * hasher.size) ** 2, max(-(-total // BLOCK_ROWS), LEAST_RANGES)))
    asked = rows.select("vec_id", "embedding", queries.alias("asks"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, TABLES, n), np.int64)
        for piece in _pieces(batches, hasher):
            vectors = _floats(piece.column("embedding"), hasher.width)
            asks = np.flatnonzero(piece.column("asks").to_numpy(zero_copy_only=False))
            for t, _, of_row, _, of_query in _routes(hasher, n, vectors, asks):
                counts[0, t] += np.bincount(of_row, minlength=n)
                counts[1, t] += np.bincount(of_query, minlength=n)
        at = np.flatnonzero(counts.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts.ravel()[at])], ["at", "n"])

    # at most 2 x TABLES x MOST_RANGES rows
    sums = asked.mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(2 * TABLES * n, np.int64)
    counts[sums.column("at").to_numpy()] = sums.column("n").to_numpy()
    held, probes = counts.reshape(2, TABLES, n)
    most_rows = min(BLOCK_ROWS, max(1, -(-2 * total // n)))
    blocks = Blocks(np.maximum(1, -(-held // most_rows)), np.maximum(1, -(-probes // BLOCK_QUERIES)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches, hasher):
            ids = piece.column("vec_id").to_numpy()
            vectors = _floats(piece.column("embedding"), hasher.width)
            asks = np.flatnonzero(piece.column("asks").to_numpy(zero_copy_only=False))
            for t, codes, of_row, query, of_query in _routes(hasher, n, vectors, asks):
                row, block = blocks.copies(t, of_row, ids, False)
                yield _dealt(piece, row, block, t, False, codes)
                copy, block = blocks.copies(t, of_query, ids[query], True)
                yield _dealt(piece, query[copy], block, t, True, codes)

    kind = rows.schema["embedding"].dataType.simpleString()
    dealt = asked.mapInArrow(deal, f"block long, place int, asks boolean, code long, vec_id long, embedding {kind}")
    dealt = dealt.repartition(shuffle_width(rows.sparkSession), "block").sortWithinPartitions("block", "asks")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for piece in _pieces(batches, hasher):
            block, asks = piece.column("block").to_numpy(), piece.column("asks").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((block[1:] != block[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip(np.r_[0, cuts], np.r_[cuts, piece.num_rows]):
                run = piece.slice(a, b - a)
                ids, codes = run.column("vec_id").to_numpy(), run.column("code").to_numpy()
                vectors = _floats(run.column("embedding"), hasher.width)
                if block[a] != now:
                    now, held = block[a], []
                if not asks[a]:
                    held.append((ids, codes, vectors))
                elif held:
                    if len(held) > 1:
                        held = [tuple(np.concatenate(c) for c in zip(*held))]
                    yield _block_nearest(hasher, run.column("place")[0].as_py(), ids, vectors, *held[0])

    return dealt.mapInArrow(search, "query_id long, vec_id long, score double")


def _dealt(piece: pa.RecordBatch, row: np.ndarray, block: np.ndarray, table: int, asks: bool,
           codes: np.ndarray) -> pa.RecordBatch:
    at = pa.array(row)
    return pa.RecordBatch.from_arrays(
        [pa.array(block, pa.int64()), pa.array(np.full(len(row), table, np.int32)), pa.array(np.full(len(row), asks)),
         pa.array(codes[row]), piece.column("vec_id").take(at), piece.column("embedding").take(at)],
        ["block", "place", "asks", "code", "vec_id", "embedding"])


def _block_nearest(hasher: Hasher, table: int, query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray,
                   codes: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
    """The K nearest of each query among the rows of its probed buckets."""
    signed = hasher.signed(hasher.turned(queries)[:, table])
    buckets, bucket_of = np.unique(codes, return_inverse=True)
    best = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    step = max(1, PAIRS // max(1, len(ids)))
    for i in range(0, len(queries), step):
        probed = hasher.score(signed[i:i + step], buckets) >= hasher.cut
        q, r = np.nonzero(probed[:, bucket_of])
        q += i
        other = query_ids[q] != ids[r]
        q, r = q[other], r[other]
        d = np.concatenate([_distances(queries[q[j:j + PAIRS]], vectors[r[j:j + PAIRS]])
                            for j in range(0, max(1, len(q)), PAIRS)])
        best = [np.concatenate([a, b]) for a, b in zip(best, _nearest(query_ids[q], ids[r], d))]
    best = _nearest(*best)
    return pa.RecordBatch.from_arrays([pa.array(c) for c in best], ["query_id", "vec_id", "score"])


def _ranked(found: DataFrame) -> DataFrame:
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return (once.withColumn("rank", rank).where(F.col("rank") <= K)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def nearest(embeddings: DataFrame, every: int = QUERY_EVERY) -> DataFrame:
    """``embeddings(vec_id, embedding, ...)`` to (query_id, rank, vec_id, score) of the rows divisible by ``every``."""
    rows = (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
            .where(F.col("vec_id").isNotNull() & sound(F.col("embedding"))))
    asks = F.col("vec_id") % every == 0
    size = rows.agg(F.count("*").alias("rows"), F.max(F.size("embedding")).alias("width")).first()
    hasher = calibrated(rows, Hasher.of(size["width"] or 1))
    found = cut_lineage(_ranked(_searched(rows, asks, hasher, size["rows"])), "ann-found")
    # exact way for queries whose probed buckets hold fewer than K others
    full = found.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") == K).select("query_id")
    short = rows.where(asks).select("vec_id").distinct().join(full, F.col("vec_id") == F.col("query_id"), "left_anti")
    short = cut_lineage(short.select(F.col("vec_id").alias("short_id")), "ann-short")
    if short.isEmpty():
        return found
    marked = rows.join(short, F.col("vec_id") == F.col("short_id"), "left")
    whole = Hasher(hasher.width, hasher.signs)  # no cut: every bucket is probed
    again = _ranked(_searched(marked, F.col("short_id").isNotNull(), whole, size["rows"]))
    return (found.join(short, F.col("query_id") == F.col("short_id"), "left_anti").unionByName(again))
