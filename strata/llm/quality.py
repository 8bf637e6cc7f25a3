"""Quality scores by random Fourier features (operator 4).

One pass over the whole texts gives every document a few statistics.  Random
Fourier features of the standardised statistics approximate a Gaussian kernel;
each partition of the labelled rows sums its normal equations, the sums (one
row for each feature and partition) are added by feature, and the driver
solves one ridge system of a fixed size.  Isotonic regression over the
histogram of the training scores calibrates them.

Labels are learned from all labelled rows that aren't held out.  Defined
results: null and empty texts have zero statistics and a score like any other;
without labelled rows every score is 0.5; repeated label rows of a document
count as its largest label; rows that repeat a doc_id each get a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .textscan import (LOWER, NOT_SPACE, ByteHashes, Words, bounded_batches, crc_class, map_texts,
                       text_buffer)

FOURIER = 256
RIDGE = 1e-3
#: Partial sums of the normal equations before the last one.
SLICES = 256
#: Kernel width in units of the square root of the number of statistics.
WIDTH = 0.7
ACCEPT = 0.7
#: Training scores are calibrated on a grid of this step.
STEP = 0.002

_CLASSES = ("lower", "upper", "digit", "blank", "newline", "stop", "comma", "bang", "bar", "symbol",
            "accent", "control")
_CLASS = np.full(256, _CLASSES.index("symbol"), np.uint8)
for _name, _bytes in (("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)),
                      ("blank", (32, 9)), ("newline", (10, 13)), ("stop", b".?:;"), ("comma", b",'\"()-"),
                      ("bang", b"!"), ("bar", b"|"), ("accent", range(128, 256)),
                      ("control", [*range(9), 11, 12, *range(14, 32), 127])):
    _CLASS[list(_bytes)] = _CLASSES.index(_name)
STATISTICS = (*_CLASSES, "log_bytes", "log_words", "word_size", "word_spread", "distinct", "top_word",
              "stutter", "title_words", "marked_words", "log_lines", "repeated_lines", "line_words")


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each text."""
    data, rows = text_buffer(texts)
    n, size = len(rows) - 1, np.diff(rows)
    out = np.zeros((n, len(STATISTICS)))
    if len(data) == 0:
        return out
    kind = _CLASS[data]
    row_of = np.repeat(np.arange(n), size)
    k = len(_CLASSES)
    out[:, :k] = np.bincount(row_of * k + kind, minlength=n * k).reshape(n, k) / np.maximum(size, 1)[:, None]
    words = Words(LOWER[data], rows, NOT_SPACE)
    count = np.diff(words.at)
    word_row = np.repeat(np.arange(n), count)
    some = np.maximum(count, 1)
    wide = (words.ends - words.starts).astype(float)
    mean = np.bincount(word_row, wide, n) / some
    spread = np.sqrt(np.maximum(0, np.bincount(word_row, wide ** 2, n) / some - mean ** 2))
    h = words.hashes()
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (word_row[1:] == word_row[:-1])
    title = kind[words.starts] == _CLASSES.index("upper")
    mark = (kind == _CLASSES.index("symbol")) | (kind == _CLASSES.index("bar")) | (kind == _CLASSES.index("bang"))
    marks = np.concatenate([[0], np.cumsum(mark)])
    marked = marks[words.ends] > marks[words.starts]
    distinct, top = np.zeros(n), np.zeros(n)
    for i, (a, b) in enumerate(zip(words.at[:-1].tolist(), words.at[1:].tolist())):
        if b > a:
            each = np.unique(h[a:b], return_counts=True)[1]
            distinct[i], top[i] = len(each), each.max()
    lines, repeated = _lines(data, rows)
    out[:, k:] = np.stack([
        np.log1p(size), np.log1p(count), np.log1p(mean), np.log1p(spread), distinct / some, top / some,
        np.bincount(word_row, same, n) / some, np.bincount(word_row, title, n) / some,
        np.bincount(word_row, marked, n) / some, np.log1p(lines), repeated / np.maximum(lines, 1),
        np.log1p(count / np.maximum(lines, 1))], axis=1)
    return out


def _lines(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines of each row that aren't empty, and those that repeat an earlier one."""
    at = Words(data, rows, np.arange(256) != 10)
    h = ByteHashes(data).of(at.starts, at.ends)
    count = np.diff(at.at)
    repeated = np.zeros(len(count))
    for i in np.flatnonzero(count > 1).tolist():
        repeated[i] = count[i] - len(np.unique(h[at.at[i]:at.at[i + 1]]))
    return count, repeated


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of every document."""
    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        x = statistics(piece.column("text"))
        at = np.arange(len(x) + 1, dtype=np.int32) * len(STATISTICS)
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id").cast(pa.int64()), pa.ListArray.from_arrays(at, pa.array(x.ravel()))],
            ["doc_id", "x"])

    return map_texts(docs.select("doc_id", "text"), work, "doc_id long, x array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass
class QualityModel:
    centre: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray | None = None
    #: calibration: raw scores and the values they stand for
    knots: np.ndarray | None = None
    values: np.ndarray | None = None

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -6, 6)
        f = np.sqrt(2 / FOURIER) * np.cos(z @ self.directions + self.phases)
        return np.hstack([f, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0, 1)


def pool_adjacent(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Isotonic regression (non-decreasing) of weighted values in order."""
    level: list[list[float]] = []  # mean, weight, how many
    for v, w in zip(values.tolist(), weights.tolist()):
        level.append([v, w, 1])
        while len(level) > 1 and level[-2][0] >= level[-1][0]:
            v2, w2, n2 = level.pop()
            v1, w1, n1 = level.pop()
            level.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.repeat([m for m, _, _ in level], [n for _, _, n in level])


def _normal_equations(rows: DataFrame, model: QualityModel) -> tuple[np.ndarray, np.ndarray]:
    """Sums of f f' and f y over ``rows(x, y)``: by partition, then by feature."""
    size = FOURIER + 1

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            if batch.num_rows:
                f = model.features(_matrix(batch.column("x")))
                total[:, :size] += f.T @ f
                total[:, size] += f.T @ batch.column("y").to_numpy(zero_copy_only=False)
        at = np.arange(size + 1, dtype=np.int32) * (size + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)),
                                          pa.ListArray.from_arrays(at, pa.array(total.ravel()))], ["i", "row"])

    def add(table: pa.Table) -> pa.Table:
        total = _matrix(table.column("row").combine_chunks()).sum(axis=0)
        return pa.table({"i": table.column("i").slice(0, 1), "slice": table.column("slice").slice(0, 1),
                         "row": pa.array([total], pa.list_(pa.float64()))})

    # two steps, so that no task gets a row of every partition
    schema = "i int, slice int, row array<double>"
    parts = (rows.mapInArrow(part, "i int, row array<double>")
             .withColumn("slice", (F.spark_partition_id() % SLICES).cast("int")))
    summed = (parts.groupBy("i", "slice").applyInArrow(add, schema)
              .groupBy("i").applyInArrow(add, schema).toArrow().sort_by("i"))
    total = _matrix(summed.column("row").combine_chunks())
    return total[:, :size], total[:, size]


def fit(stats: DataFrame, labels: DataFrame) -> QualityModel:
    """Learn from ``stats(doc_id, x)`` and ``labels(doc_id, quality)`` of the rows given."""
    bounded_batches(stats.sparkSession)
    known = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max("quality").cast("double").alias("y")))
    rows = cut_lineage(stats.select("doc_id", "x").join(known, "doc_id").select("x", "y"), "quality-train")
    d = len(STATISTICS)
    moments = rows.agg(F.count("*").alias("n"), F.avg("y").alias("y"),
                       *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(d)],
                       *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(d)]).first()
    rng = np.random.default_rng(44)
    model = QualityModel(np.zeros(d), np.ones(d), rng.normal(size=(d, FOURIER)) / (WIDTH * np.sqrt(d)),
                         rng.uniform(0, 2 * np.pi, FOURIER))
    if not moments["n"]:
        return model
    model.centre = np.array([moments[f"m{i}"] for i in range(d)])
    spread = np.array([moments[f"s{i}"] for i in range(d)])
    model.scale = np.where(spread > 1e-9, spread, 1.0)
    gram, target = _normal_equations(rows, model)
    model.weights = np.linalg.solve(gram + RIDGE * moments["n"] * np.eye(len(gram)) / FOURIER, target)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                step = np.rint(np.clip(model.raw(_matrix(batch.column("x"))), -1, 2) / STEP).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(step), batch.column("y")], ["step", "y"])

    grid = (rows.mapInArrow(raw, "step int, y double").groupBy("step")
            .agg(F.count("*").alias("n"), F.sum("y").alias("good")).orderBy("step").collect())
    model.knots = np.array([r["step"] for r in grid]) * STEP
    weight = np.array([r["n"] for r in grid], float)
    model.values = pool_adjacent(np.array([r["good"] for r in grid]) / weight, weight)
    return model


def score(stats: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``stats``."""
    bounded_batches(stats.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                s = model.score(_matrix(batch.column("x")))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("held_out"), pa.array(s),
                     pa.array((s >= ACCEPT).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = stats.select("doc_id", (crc_class(F.col("doc_id"), 4) == 2).alias("held_out"), "x")
    return rows.mapInArrow(work, "doc_id long, held_out boolean, score double, predicted int")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every document; learn from the labels that aren't held out."""
    stats = cut_lineage(measured(docs), "quality-statistics")
    return score(stats, fit(stats, labels.where(crc_class(F.col("doc_id"), 4) != 2)))
