"""Embedding near-duplicates by iterative quantisation (operator 8).

Equal vectors of one label form one class with a weight.  A rotation learned
on a bounded sample (principal components, then iterative quantisation: Gong
and Lazebnik 2011) turns every class vector into a balanced binary code.  The
code's bits are cut into CHUNKS parts, and each pair of parts is a table:
codes that agree in two parts meet in that table's bucket, so every pair of
codes within CHUNKS - 2 bits meets, and most pairs somewhat beyond.  Meeting
classes are reranked with their original vectors in double precision.

A pair is looked at in one bucket only (the first pair of parts that agree),
and no pair is kept: the task that reranks it adds up link counts and keeps
a spanning forest of the links of its batch.  Counting links looks at each
pair of *different* vectors that meet; that work grows with the square of a
group of near copies, as the number of its links does.

Defined results: vectors that are null, empty, zero, or hold null or
non-finite elements, and rows with a null label, have no links and stand for
themselves; vectors of different length link with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .components import connected_components
from .textscan import bounded_batches, mix64, share_of

COSINE = 0.98
#: Vectors that the rotation is learned on, and rounds of learning.
SAMPLE, ROUNDS = 8_000, 40
BITS, CHUNKS = 64, 6
TABLES = list(combinations(range(CHUNKS), 2))
#: Codes further apart than this aren't reranked: an angle of cosine 0.98 (0.2
#: radians) parts 4 of 64 bits on average, and 16 bits with probability 1e-5.
FURTHEST = 16


@dataclass
class Quantiser:
    mean: np.ndarray
    project: np.ndarray  # dimensions x bits, rotation included

    @property
    def bits(self) -> int:
        return self.project.shape[1]

    def chunk_masks(self) -> list[int]:
        cuts = [round(i * self.bits / CHUNKS) for i in range(CHUNKS + 1)]
        return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts[:-1], cuts[1:])]

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """64-bit codes of unit vectors."""
        on = (vectors - self.mean) @ self.project > 0
        full = np.zeros((len(on), 64), np.uint8)
        full[:, :self.bits] = on
        return np.packbits(full, axis=1, bitorder="little").view(np.uint64).ravel()


def fit(unit: np.ndarray, bits: int = BITS, rounds: int = ROUNDS) -> Quantiser:
    """Principal directions of the sample, rotated so that the codes lose least."""
    n, d = unit.shape
    bits = min(bits, d)
    mean = unit.mean(axis=0) if n else np.zeros(d)
    centred = unit - mean
    _, vectors = np.linalg.eigh(centred.T @ centred + 1e-9 * np.eye(d))
    project = vectors[:, ::-1][:, :bits]
    v = centred @ project
    rotation = np.linalg.qr(np.random.default_rng(88).normal(size=(bits, bits)))[0]
    for _ in range(rounds if n > 1 else 0):
        u, _, w = np.linalg.svd(np.where(v @ rotation > 0, 1.0, -1.0).T @ v)
        rotation = (u @ w).T
    return Quantiser(mean, project @ rotation)


def _unit(column: pa.Array, dimensions: int) -> np.ndarray:
    """Rows scaled to length one; shorter ones padded with zeros, longer ones cut (for codes only)."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    at = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.to_numpy(zero_copy_only=False).astype(float)
    size = np.diff(at)
    out = np.zeros((len(size), dimensions))
    keep = np.minimum(size, dimensions)
    row = np.repeat(np.arange(len(size)), keep)
    place = np.arange(keep.sum()) - np.repeat(np.cumsum(keep) - keep, keep)
    out[row, place] = flat[np.repeat(at[:-1], keep) + place]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-300)


def _keys(codes: np.ndarray, group: np.ndarray, masks: list[int]) -> np.ndarray:
    """Bucket keys, one column for each table; ``group`` keeps labels and lengths apart."""
    out = np.empty((len(codes), len(TABLES)), np.uint64)
    for t, (i, j) in enumerate(TABLES):
        part = codes & np.uint64(masks[i] | masks[j])
        out[:, t] = mix64(mix64(part + np.uint64(t + 1)) ^ group)
    return out.view(np.int64)


def _rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted link counts of each class, and a spanning forest of the links, by batch."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
        wide = max(1, int(np.diff(batch.column("vector_a").offsets.to_numpy()).max()))
        x, y = _unit(batch.column("vector_a"), wide), _unit(batch.column("vector_b"), wide)
        link = (x * y).sum(axis=1) >= COSINE
        a, b = a[link], b[link]
        wa, wb = batch.column("weight_a").to_numpy()[link], batch.column("weight_b").to_numpy()[link]
        ids, which = np.unique(np.concatenate([a, b]), return_inverse=True)
        n = np.bincount(which, np.concatenate([wb, wa]), len(ids)).astype(np.int64)
        root = np.arange(len(ids))
        ia, ib = which[:len(a)], which[len(a):]
        while True:  # smallest reachable, by repeated minima
            before = root.copy()
            low = np.minimum(root[ia], root[ib])
            np.minimum.at(root, ia, low)
            np.minimum.at(root, ib, low)
            root = root[root]
            if (root == before).all():
                break
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n), pa.array(ids[root])], ["rep", "n", "root"])


def _sound(vector):
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)


def near_duplicates(embeddings: DataFrame) -> DataFrame:
    """``embeddings(vec_id, embedding, label, ...)`` to (vec_id, n_links, component_id, kept)."""
    spark = embeddings.sparkSession
    bounded_batches(spark)
    rows = embeddings.select("vec_id", "label", "embedding")
    sound = rows.where(F.col("label").isNotNull() & _sound(F.col("embedding")))
    classes = cut_lineage(
        sound.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"))
        .where(F.col("rep").isNotNull()), "itq-classes")
    size = classes.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")) \
        .orderBy(F.desc("n"), "d").first()
    d = size["d"] if size else 1
    sample = (classes.where((F.size("embedding") == d) & share_of(F.col("rep"), SAMPLE / max(1, size["n"])))
              .select("embedding").toArrow() if size else None)
    quantiser = fit(_unit(sample.column("embedding"), d) if sample is not None else np.zeros((0, d)))
    masks = quantiser.chunk_masks()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = quantiser.codes(_unit(batch.column("embedding"), d))
                keys = _keys(codes, batch.column("grouped").to_numpy().view(np.uint64), masks)
                at = np.arange(len(codes) + 1, dtype=np.int32) * len(TABLES)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rep"), pa.array(codes.view(np.int64)),
                     pa.ListArray.from_arrays(at, pa.array(keys.ravel()))], ["rep", "code", "keys"])

    coded = (classes.select("rep", "embedding", F.xxhash64("label", F.size("embedding")).alias("grouped"))
             .mapInArrow(encode, "rep long, code long, keys array<long>"))
    entry = cut_lineage(coded.select("rep", "code", F.posexplode("keys").alias("t", "key")), "itq-tables")
    shared = entry.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("key")
    # only classes that meet another one carry their vectors on
    member = (entry.join(shared, "key").join(
        classes.select("rep", "weight", F.col("embedding").alias("vector"), "label"), "rep"))
    first = F.element_at(F.array(*[F.lit(i) for i, _ in TABLES]), F.col("t") + 1)
    second = F.element_at(F.array(*[F.lit(j) for _, j in TABLES]), F.col("t") + 1)
    member = cut_lineage(member.withColumns({"i": first, "j": second}), "itq-members")

    def side(tag: str) -> DataFrame:
        return member.select("key", F.col("rep").alias(tag),
                             *[F.col(c).alias(f"{c}_{tag}") for c in ("code", "weight", "vector", "label", "i", "j")])

    differ = F.col("code_a").bitwiseXOR(F.col("code_b"))
    here = (F.col("i_a") == F.col("i_b")) & (F.col("j_a") == F.col("j_b"))
    for k, mask in enumerate(masks):  # no earlier part agrees: the pair's first bucket
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        agrees = differ.bitwiseAND(F.lit(signed)) == 0
        here = here & ~((F.col("j_a") > k) & (F.col("i_a") != k) & agrees)
    meets = (side("a").join(side("b"), "key")
             .where((F.col("a") < F.col("b")) & (F.bit_count(differ) <= FURTHEST) & here
                    & (F.col("label_a") == F.col("label_b"))
                    & (F.size("vector_a") == F.size("vector_b"))))
    found = cut_lineage(meets.select("a", "b", "weight_a", "weight_b", "vector_a", "vector_b")
                        .mapInArrow(_rerank, "rep long, n long, root long"), "itq-links")
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    group = connected_components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))

    named = (classes.join(counts, "rep", "left")
             .join(group.select(F.col("node").alias("rep"), "component"), "rep", "left")
             .select("label", "embedding", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                     F.coalesce("component", "rep").alias("component_id")))
    matched = sound.join(named, ["label", "embedding"], "left").select("vec_id", "n_links", "component_id")
    unsound = rows.where(~F.coalesce(F.col("label").isNotNull() & _sound(F.col("embedding")), F.lit(False)))
    alone = unsound.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return (matched.unionByName(alone)
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
                    F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept")))
