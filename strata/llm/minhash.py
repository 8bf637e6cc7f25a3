"""MinHash near-duplicates with odd sketches (operator 10).

One pass over the texts gives each document a MinHash signature (BANDS x ROWS
samples of its distinct 5-word shingles), one key per band, an odd sketch
and a 128-bit digest of the whole shingle set.  Documents with equal sets form
one class, which goes on with its smallest doc_id.  Classes that share a band
key are candidates; odd sketches (Mitzenmacher, Pagh, Pham 2014: samples folded
into a parity bitmap, whose XOR population count estimates the size of their
difference) rule out pairs below the threshold, and the rest is confirmed on
the full shingle sets of the whole texts.  There are two sketches: one of the
MinHash samples, and one of the whole set, whose count never exceeds the size
of the sets' difference, so that it loses no link; for sets of up to some
thousand shingles it leaves few pairs that don't link.

Pairs within a bucket are not all emitted.  First each member is paired with a
leader of the bucket (the bands choose it in ORDERS ways), then the members
that are still in another component with the bucket's best linked member.
What these confirmed links leave in different components inside one bucket is
compared pair by pair, so that every link between candidates either is
confirmed or lies inside a component.

Defined results: null or blank text has an empty set (n_shingles 0), links
with nothing and is kept; a null doc_id takes part in a class but never names
a component; rows that repeat a doc_id must repeat its text and each get a row.
Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .components import connected_components
from .textscan import (LOWER, NOT_SPACE, SLICE_BYTES, Words, bounded_batches, map_texts, mix64,
                       text_buffer)

WORDS = 5
#: A pair links if 100 * intersection >= PERCENT * union.
PERCENT = 75
#: A pair of similarity 0.75 shares no band with probability (1 - 0.75^4)^32 = 5e-6.
BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
SKETCH_BITS, WHOLE_BITS = 256, 1024
#: Estimated similarity below which a pair is dropped.  At similarity 0.75 the sketches differ in
#: 50 bits on average with a deviation of 7.2 (of samples and folding together; measured), and the
#: limit that this floor sets is 86 bits, five deviations off.
SKETCH_FLOOR = 0.44

_rng = np.random.default_rng(1010)
_XOR = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)
_MUL = _rng.integers(0, 1 << 31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_FOLD = _rng.integers(1, 1 << 63, ROWS, dtype=np.uint64) | np.uint64(1)

#: Leaders are chosen in so many ways, by the band: the member whose id is nearest a mask.
ORDERS = 8
_MASKS = [int(m) for m in _rng.integers(0, 1 << 62, ORDERS)]

#: Sketch columns: of the samples, and of the whole set.
_ODD = [f"o{i}" for i in range(SKETCH_BITS // 64)]
_WHOLE = [f"w{i}" for i in range(WHOLE_BITS // 64)]
_SKETCH = _ODD + _WHOLE
_SIGNATURE = ("doc_id long, n_shingles long, set_hi long, set_lo long, bands array<long>, "
              + ", ".join(f"{c} long" for c in _SKETCH))


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each row."""
    data, rows = text_buffer(texts)
    found = Words(LOWER[data], rows, NOT_SPACE)
    h = found.hashes()
    base = np.uint64(0xD6E8FEB86659FD93)
    full = max(0, len(h) - words + 1)
    rolled = np.zeros(full, np.uint64)
    for k in range(words):
        rolled = rolled * base + h[k:k + full]
    rolled = mix64(rolled)
    out = []
    for a, b in zip(found.at[:-1].tolist(), found.at[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(rolled[a:b - words + 1]))
        elif b > a:  # fewer words: the whole sequence, told apart by its length
            acc = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for x in h[a:b]:
                    acc = acc * base + x
            out.append(mix64(np.array([acc], np.uint64) ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minhash(hashes: np.ndarray) -> np.ndarray:
    """SAMPLES minima of the set under as many hash functions."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    best = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 2048):
        np.minimum(best, ((x[at:at + 2048, None] ^ _XOR) * _MUL).min(axis=0), out=best)
    return best


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps (rows x 4 words of 64 bits) of (position, minimum) pairs."""
    keyed = samples.astype(np.uint64) | (np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32))
    row = np.repeat(np.arange(len(samples)), SAMPLES)
    return _parity(row, mix64(keyed).ravel(), len(samples), SKETCH_BITS)


def whole_sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Parity bitmaps (rows x 16 words of 64 bits) of whole sets."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    return _parity(row, np.concatenate([np.zeros(0, np.uint64), *sets]), len(sets), WHOLE_BITS)


def _parity(row: np.ndarray, hashes: np.ndarray, n: int, bits: int) -> np.ndarray:
    flat = row * bits + (hashes % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(flat, minlength=n * bits) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(n, bits), axis=1).view(np.uint64)


def _sign(piece: pa.RecordBatch) -> pa.RecordBatch:
    sets = shingle_sets(piece.column("text"))
    n = len(sets)
    samples = np.array([minhash(s) for s in sets], np.uint32).reshape(n, SAMPLES)
    folded = np.zeros((n, BANDS), np.uint64)
    for k in range(ROWS):
        folded = folded * np.uint64(0x9E3779B97F4A7C15) + samples[:, k::ROWS] * _FOLD[k]
    keys = mix64(folded + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    sketch = np.hstack([odd_sketches(samples), whole_sketches(sets)]).view(np.int64)
    digest = b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets)
    whole = np.frombuffer(digest, np.int64).reshape(n, 2)
    bands = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * BANDS,
                                     pa.array(keys.view(np.int64).ravel()))
    columns = [piece.column("doc_id").cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
               pa.array(whole[:, 0]), pa.array(whole[:, 1]), bands,
               *(pa.array(np.ascontiguousarray(c)) for c in sketch.T)]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "set_hi", "set_lo", "bands",
                                                *_SKETCH])


def signatures(docs: DataFrame) -> DataFrame:
    return map_texts(docs.select("doc_id", "text"), _sign, _SIGNATURE)


def _alike():
    """Filter on a pair's set sizes and sketches.  By the sizes and the whole sets' sketch
    it loses no link; by the samples' one only a pair whose estimate errs by five deviations."""
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")

    def differ(columns: list[str]):
        return sum((F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in columns), F.lit(0))

    # E[differ] = bits / 2 * (1 - (1 - 2 / bits)^(2 * samples * (1 - similarity)))
    most = SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** (2 * SAMPLES * (1 - SKETCH_FLOOR)))
    # similarity s of sets of n elements together leaves n (1 - s) / (1 + s) in one of them only
    return ((small * 100 >= large * PERCENT) & (differ(_ODD) <= F.lit(int(most)))
            & (differ(_WHOLE) * (100 + PERCENT) <= (F.col("n_a") + F.col("n_b")) * (100 - PERCENT)))


_PAIRED = ["n", *_SKETCH]


def _side(classes: DataFrame, tag: str) -> DataFrame:
    return classes.select(F.col("rep").alias(tag), *[F.col(c).alias(f"{c}_{tag}") for c in _PAIRED])


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Keep the pairs (a, b) whose full shingle sets are similar enough."""
    bounded_batches(pairs.sparkSession)
    rows = (pairs.join(texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b")), "b")
            .select("a", "b", "text_a", "text_b"))
    return rows.mapInArrow(_confirm, "a long, b long")


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last: tuple = (None, None)
    for batch in batches:
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        keep = np.zeros(len(a), bool)
        for i in range(len(a)):
            if last[0] != b[i]:  # rows of one star come one after the other
                last = (b[i], shingle_sets(batch.column("text_b").slice(i, 1))[0])
            mine, other = shingle_sets(batch.column("text_a").slice(i, 1))[0], last[1]
            both = len(np.intersect1d(mine, other, assume_unique=True))
            keep[i] = both > 0 and 100 * both >= PERCENT * (len(mine) + len(other) - both)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(keep)),
                                          batch.column("b").filter(pa.array(keep))], ["a", "b"])


def _apart(bucket: DataFrame, group: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, with the bucket's least one."""
    placed = (bucket.join(group.select(F.col("node").alias("rep"), "component"), "rep", "left")
              .withColumn("component", F.coalesce("component", "rep")))
    mixed = (placed.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most"))
             .where(F.col("least") < F.col("most")).select("key", "least"))
    return placed.join(mixed, "key")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, ...)`` to (doc_id, n_shingles, component_id, kept)."""
    signed = cut_lineage(signatures(docs), "minhash-signatures")
    # equal sets have equal signatures, so any member's stands for the class
    classes = cut_lineage(
        signed.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
        .groupBy("set_hi", "set_lo")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"),
             F.first("bands").alias("bands"), *[F.first(c).alias(c) for c in _SKETCH]),
        "minhash-classes")
    # each class's buckets; x orders a bucket's members, in one of ORDERS ways by its band
    mask = F.element_at(F.array(*[F.lit(m) for m in _MASKS]), F.col("t") % ORDERS + 1)
    member = (classes.select("rep", F.posexplode("bands").alias("t", "key"))
              .withColumn("x", F.col("rep").bitwiseXOR(mask)))
    shared = (member.groupBy("t", "key").agg(F.min("x").alias("low"), F.max("x").alias("high"))
              .where(F.col("low") < F.col("high"))
              .select("key", F.col("low").bitwiseXOR(mask).alias("leader")))
    bucket = cut_lineage(member.select("key", "rep").join(shared, "key"), "minhash-buckets")

    touched = bucket.select("rep").distinct()
    texts = cut_lineage(
        docs.select(F.col("doc_id").alias("rep"), "text").join(touched, "rep", "left_semi")
        .dropDuplicates(["rep"]), "minhash-texts")

    def compared(pairs: DataFrame) -> DataFrame:
        return cut_lineage(_confirmed(pairs.select("a", "b").distinct(), texts), "minhash-links")

    def starred(pairs: DataFrame) -> DataFrame:
        """Confirmed links among pairs (a, b) of a member and a leader."""
        return compared(pairs.distinct().join(_side(classes, "a"), "a").join(_side(classes, "b"), "b")
                        .where(_alike()))

    links = starred(bucket.where(F.col("rep") != F.col("leader"))
                    .select(F.col("rep").alias("a"), F.col("leader").alias("b")))
    group = cut_lineage(connected_components(links), "minhash-groups")

    # second stars, around the member of a bucket that has most links so far
    degree = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("n"))
    apart = _apart(bucket.select("key", "rep").join(degree, "rep", "left"), group)
    hub = apart.groupBy("key").agg(F.max(F.struct(F.coalesce("n", F.lit(0)), "rep", "component")).alias("hub"))
    closer = starred(apart.join(hub, "key").where(F.col("component") != F.col("hub.component"))
                     .select(F.col("rep").alias("a"), F.col("hub.rep").alias("b")))
    star = group.select(F.col("node").alias("a"), F.col("component").alias("b"))
    group = cut_lineage(connected_components(star.unionAll(closer)), "minhash-groups")

    # the rest, pair by pair across the components of a bucket
    apart = cut_lineage(
        _apart(bucket.select("key", "rep"), group).join(classes.select("rep", *_PAIRED), "rep"), "minhash-apart")
    a = apart.where(F.col("component") > F.col("least")).select(
        "key", F.col("rep").alias("a"), F.col("component").alias("component_a"),
        *[F.col(c).alias(f"{c}_a") for c in _PAIRED])
    b = apart.select("key", F.col("rep").alias("b"), F.col("component").alias("component_b"),
                     *[F.col(c).alias(f"{c}_b") for c in _PAIRED])
    more = compared(a.join(b, (a["key"] == b["key"]) & (F.col("component_a") > F.col("component_b")) & _alike()))
    star = group.select(F.col("node").alias("a"), F.col("component").alias("b"))
    final = connected_components(star.unionAll(more))
    named = (classes.select("set_hi", "set_lo", "rep")
             .join(final.select(F.col("node").alias("rep"), "component"), "rep", "left")
             .select("set_hi", "set_lo", F.coalesce("component", "rep").alias("component")))
    return (signed.select("doc_id", "n_shingles", "set_hi", "set_lo")
            .join(named, ["set_hi", "set_lo"], "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("n_shingles") > 0, F.col("component"))
                    .otherwise(F.col("doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that stand for their group, all columns unchanged."""
    gone = near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")
