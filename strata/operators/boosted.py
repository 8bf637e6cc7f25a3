"""Boosted trees grown inside one task per fit (M-07, M-20, J-16).

Spark's own fit runs a job for every level of every tree, and sends a full
histogram (features x bins) for every node of it, even one of two rows: deep trees
on modest rows spend nearly all their time there.  A fit whose rows fill at most
``TASK_BYTES`` is grown here in one task instead, many fits side by side; larger
ones stay with Spark's distributed fit.  The algorithm is Spark's, step by step:
cuts at quantiles, variance gain, the first of equal splits, leaves where the
variance is gone, logistic loss, all rows and all features for every tree.  Cuts come from
all rows of a fit (Spark's from 10,000 of them, where there are more).
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

# functions travel to the executors by value: workers need numpy and pyarrow, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of features (as doubles) that a task takes for one fit.
TASK_BYTES = 256 << 20
#: Rows of a node up to which its splits are found by sorting them, and cells that a step handles at once.
FEW_ROWS, STEP_CELLS = 16, 1 << 21
EPSILON = 2.0 ** -52


@dataclass
class Tree:
    """Nodes from the root (0) on; a leaf has left -1, others left and left + 1 as children."""

    feature: np.ndarray
    cut: np.ndarray  # the last bin that goes left
    left: np.ndarray
    prediction: np.ndarray

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The predictions for the columns of ``bins`` (features x rows)."""
        at = np.zeros(bins.shape[1], np.int32)
        going = np.flatnonzero(self.left[at] >= 0)
        while len(going):
            node = at[going]
            at[going] = self.left[node] + (bins[self.feature[node], going] > self.cut[node])
            going = going[self.left[at[going]] >= 0]
        return self.prediction[at]


def cuts_of(values: np.ndarray, max_bins: int) -> np.ndarray:
    """Spark's cuts of a continuous feature: midpoints at about equal counts, all of them if they are few."""
    known, counts = np.unique(values, return_counts=True)
    middles = (known[:-1] + known[1:]) / 2.0
    splits = min(max_bins, len(values)) - 1
    if len(middles) <= splits:
        return middles
    stride, seen = len(values) / (splits + 1), np.cumsum(counts)
    twice = seen[:-1] + seen[1:]
    found, target, at = [], stride, -1
    while True:
        at = max(at + 1, int(np.searchsorted(twice, 2 * target, side="right")))
        if at >= len(middles):
            return middles[found]
        found.append(at)
        target += stride


def _variance(n, s, q):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n == 0, 0.0, (q - (s * s) / n) / n)


def _gains(parent, left, total, least_rows: int, least_gain: float):
    """Gain of each split, -inf where it isn't allowed; ``left``, ``total``: (count, sum, sum of squares)."""
    right = [t - x for t, x in zip(total, left)]
    both = left[0] + right[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = parent - left[0] / both * _variance(*left) - right[0] / both * _variance(*right)
    return np.where((left[0] >= least_rows) & (right[0] >= least_rows) & (gain >= least_gain), gain, -np.inf)


class _Best:
    """The best split of each node so far: gain, feature, last bin on the left, sums of both sides."""

    def __init__(self, nodes: int):
        self.gain = np.full(nodes, -np.inf)
        self.feature, self.cut = np.zeros(nodes, np.int32), np.zeros(nodes, np.int16)
        self.left, self.right = np.zeros((3, nodes)), np.zeros((3, nodes))

    def offer(self, nodes, gain, feature, cut, left, total):
        better = gain > self.gain[nodes]
        at = nodes[better]
        self.gain[at], self.feature[at], self.cut[at] = gain[better], feature[better], cut[better]
        self.left[:, at] = left[:, better]
        self.right[:, at] = total[:, better] - left[:, better]


def _by_histogram(best, nodes, rows, sizes, bins, splits, y, sums, impurity, limits):
    """Splits of ``nodes`` (``sizes`` of ``rows`` each) from a histogram of every feature."""
    widest = int(splits.max(initial=0)) + 1
    step = max(1, STEP_CELLS // widest)
    ends = np.cumsum(sizes)
    for first in range(0, len(nodes), step):
        some = nodes[first:first + step]
        begin, end = (ends[first - 1] if first else 0), ends[min(first + step, len(nodes)) - 1]
        mine, local = rows[begin:end], np.repeat(np.arange(len(some)), sizes[first:first + step])
        weight = y[mine]
        square, line = weight * weight, np.arange(len(some))
        for f in np.flatnonzero(splits):
            width = splits[f] + 1
            key = local * width + bins[f, mine]
            made = [np.bincount(key, w, len(some) * width).reshape(-1, width).cumsum(axis=1)
                    for w in (None, weight, square)]
            left, total = [x[:, :-1].astype(float) for x in made], [x[:, -1:].astype(float) for x in made]
            if impurity is None:  # the root's sums, as Spark adds them up
                sums[:, 0] = [x[0, 0] + (t[0, 0] - x[0, 0]) for x, t in zip(left, total)]
                impurity = _variance(*sums)
            gain = _gains(impurity[some][:, None], left, total, *limits)
            cut = gain.argmax(axis=1)
            best.offer(some, gain[line, cut], np.full(len(some), f), cut, np.array([x[line, cut] for x in left]),
                       np.array([t[:, 0] for t in total]))
    return impurity


def _by_sorting(best, nodes, starts, sizes, width, order, bins, splits, y, impurity, limits):
    """Splits of nodes of at most ``width`` rows each: their rows in bin order, summed by bin."""
    place = np.arange(width)
    features = np.flatnonzero(splits)
    step = max(1, STEP_CELLS // (width * max(1, len(features))))
    for first in range(0, len(nodes), step):
        some, real = nodes[first:first + step], place < sizes[first:first + step, None]
        rows = order[np.minimum(starts[first:first + step, None] + place, len(order) - 1)]
        n, k = len(some), len(features)
        weight = np.where(real, y[rows], 0.0)
        key = bins[features][:, rows].astype(np.uint16) if k < len(bins) else bins[:, rows].astype(np.uint16)
        key *= width
        key += place.astype(np.uint16)
        key[:, ~real] = 65535
        key.sort(axis=2)
        pos = (np.arange(n)[:, None] * width + (key & (width - 1))).ravel()
        key //= width
        run = np.zeros(key.shape, np.int64)
        np.cumsum(key[:, :, 1:] != key[:, :, :-1], axis=2, out=run[:, :, 1:])
        run += (np.arange(k * n) * width).reshape(k, n, 1)
        run = run.ravel()
        sorted_y, counted = weight.ravel()[pos], real.ravel()[pos].astype(float)
        made = [np.bincount(run, w, k * n * width).reshape(k, n, width).cumsum(axis=2)
                for w in (counted, sorted_y, sorted_y * sorted_y)]
        bin_of = np.zeros(k * n * width, np.uint16)
        bin_of[run] = key.ravel()
        gain = _gains(impurity[some][None, :, None], made, [x[:, :, -1:] for x in made], *limits)
        gain = gain.transpose(1, 0, 2).reshape(n, k * width)
        found = gain.argmax(axis=1)
        f, cell, line = found // width, found % width, np.arange(n)
        best.offer(some, gain[line, found], features[f].astype(np.int32),
                   bin_of.reshape(k, n, width)[f, line, cell].astype(np.int16),
                   np.array([x[f, line, cell] for x in made]), np.array([x[f, line, -1] for x in made]))


def grow(bins: np.ndarray, splits: np.ndarray, y: np.ndarray, rows: np.ndarray, max_depth: int, least_rows: int = 1,
         least_gain: float = 0.0) -> Tree:
    """A regression tree of ``y`` on ``rows`` of the features x rows matrix of bins, level by level."""
    feature, cut, left, prediction = [], [], [], []
    limits = (least_rows, least_gain)
    order, sizes = rows, np.array([len(rows)])
    sums, impurity, made = np.zeros((3, 1)), None, 1
    for depth in range(max_depth + 1):
        nodes = len(sizes)
        best = _Best(nodes)
        if impurity is None or depth < max_depth:
            starts = np.cumsum(sizes) - sizes
            large = np.flatnonzero(sizes > FEW_ROWS) if impurity is not None else np.arange(nodes)
            if len(large):
                taken = order if len(large) == nodes else order[np.repeat(np.isin(np.arange(nodes), large), sizes)]
                impurity = _by_histogram(best, large, taken, sizes[large], bins, splits, y, sums, impurity, limits)
            width = 2
            while width <= FEW_ROWS and len(large) < nodes:
                few = np.flatnonzero((sizes <= width) & (sizes > width // 2))
                if len(few):
                    _by_sorting(best, few, starts[few], sizes[few], width, order, bins, splits, y, impurity, limits)
                width *= 2
            if impurity is None:  # no feature has a split
                sums[:, 0] = len(rows), y[rows].sum(), (y[rows] ** 2).sum()
                impurity = _variance(*sums)
        split = (best.gain > 0) & (depth < max_depth)
        prediction.append(np.where(sums[0] == 0, 0.0, sums[1] / np.maximum(sums[0], 1)))
        feature.append(np.where(split, best.feature, 0))
        cut.append(np.where(split, best.cut, 0))
        pairs = np.flatnonzero(split)
        children = np.full(nodes, -1, np.int64)
        if not len(pairs):
            left.append(children)
            break
        # children that are leaves come first, with those that go on after them, a pair side by side
        below = np.stack([best.left[:, pairs], best.right[:, pairs]], axis=2)  # sums, pair, side
        spread = _variance(*below)
        going = (np.abs(spread) >= EPSILON) & (depth + 1 < max_depth)
        children[pairs] = made + 2 * np.arange(len(pairs))
        left.append(children)
        made += 2 * len(pairs)
        # rows of the children, in node order and among themselves as before
        of = np.repeat(np.arange(nodes), sizes)
        inside = split[of]
        of, order = of[inside], order[inside]
        rank = np.cumsum(split) - 1
        side = bins[best.feature[of], order] > best.cut[of]
        child = 2 * rank[of] + side
        kept = going.ravel()[child]
        order, child = order[kept], child[kept]
        order = order[np.argsort(child, kind="stable")]
        if not going.any():  # only leaves below
            flat = below.reshape(3, -1)
            prediction.append(flat[1] / flat[0])
            feature.append(np.zeros(flat.shape[1], np.int32))
            cut.append(np.zeros(flat.shape[1], np.int16))
            left.append(np.full(flat.shape[1], -1, np.int64))
            break
        sizes = np.bincount(child, minlength=going.size)
        sums, impurity = below.reshape(3, -1), spread.ravel()
    return Tree(np.concatenate(feature).astype(np.int32), np.concatenate(cut).astype(np.int16),
                np.concatenate(left).astype(np.int32), np.concatenate(prediction))


def boost(x: np.ndarray, label: np.ndarray, train: np.ndarray, depth: int, iterations: int, step: float, max_bins: int,
          least_rows: int, least_gain: float):
    """Cuts of the features, and (tree, weight, margins of all rows) after each tree, learned from the ``train`` rows.

    ``x`` is features x rows.
    """
    rows = np.flatnonzero(train)
    if not len(rows):
        raise ValueError("no rows to fit boosted trees on")
    if not (np.isin(label, (0.0, 1.0)).all() and np.isfinite(x).all()):
        raise ValueError("labels must be 0 or 1 and features finite")
    cuts = [cuts_of(values[rows].astype(float), max_bins) for values in x]
    bins = np.stack([np.searchsorted(c, values, side="left").astype(np.uint8) for c, values in zip(cuts, x)])
    splits = np.array([len(c) for c in cuts])

    def trees():
        sign, margin = 2 * label - 1, np.zeros(len(label))
        y, weight = sign, 1.0
        for _ in range(iterations):
            tree = grow(bins, splits, y, rows, depth, least_rows, least_gain)
            margin = margin + tree.leaves(bins) * weight
            yield tree, weight, margin
            y, weight = 4.0 * sign / (1.0 + np.exp(2.0 * sign * margin)), step

    return cuts, trees()


def _settings(est: GBTClassifier, params: dict) -> dict:
    est = est.copy(params)
    return {"depth": est.getMaxDepth(), "iterations": est.getMaxIter(), "step": est.getStepSize(),
            "max_bins": est.getMaxBins(), "least_rows": est.getMinInstancesPerNode(),
            "least_gain": est.getMinInfoGain()}


def fits_a_task(est, df: DataFrame, rows: int | None = None) -> bool:
    """Whether ``est`` is grown in a task for ``df`` (``rows`` of its rows): few enough bytes, and no setting but
    those that ``_settings`` reads and names of columns."""
    if not isinstance(est, GBTClassifier):
        return False
    plain = {"maxDepth", "maxIter", "stepSize", "maxBins", "minInstancesPerNode", "minInfoGain", "seed", "featuresCol",
             "labelCol", "predictionCol", "probabilityCol", "rawPredictionCol", "maxMemoryInMB", "cacheNodeIds",
             "checkpointInterval", "impurity", "leafCol"}
    other = [p.name for p in est.params if est.isSet(p) and p.name not in plain
             and not (est.hasDefault(p) and est.getOrDefault(p) == est._defaultParamMap[p])]
    if other or est.getMaxBins() > 256 or est.getLeafCol():
        return False
    if any(a.get("vals") or a.get("num_vals") for kind, group in df.schema[est.getFeaturesCol()].metadata.get(
            "ml_attr", {}).get("attrs", {}).items() for a in group if kind in ("nominal", "binary")):
        return False  # categorical features
    first = df.select(est.getFeaturesCol()).first()
    width = first[0].size if first and first[0] is not None else 0
    return 0 < width * 8 * (df.count() if rows is None else rows) <= TASK_BYTES


def _dealt(df: DataFrame, key: str, n: int) -> DataFrame:
    """``df`` by its whole ``key`` 0 .. n - 1, a partition each."""
    spark = df.sparkSession
    # numbers that Spark's hash sends to different partitions stand for the keys
    names, tried = {}, spark.range(64 * n).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("at")).toArrow()
    for number, at in zip(tried.column("id").to_pylist(), tried.column("at").to_pylist()):
        names.setdefault(at, number)
    spare = iter(range(64 * n, 65 * n))
    dealt = F.array(*[F.lit(names.get(at, next(spare))) for at in range(n)])
    return df.withColumn("__to", dealt[F.col(key)].cast("long")).repartition(n, "__to").drop("__to")


def _gathered(batches, width: int):
    """The rows of a partition by run, each in the order of ``at``: (run, held, label, features x rows).

    Features that are floats in truth are held as such.
    """
    runs: dict[int, list] = {}
    for batch in batches:
        x, label = batch.column("x"), batch.column("label")
        if label.null_count or x.null_count:
            raise ValueError("labels and features must not be null")
        flat = x.flatten().to_numpy(zero_copy_only=False)
        if len(flat) != batch.num_rows * width:
            raise ValueError("vectors of different sizes")
        with np.errstate(over="ignore"):
            narrow = flat.astype(np.float32)
        flat = (narrow if (narrow == flat).all() else flat.copy()).reshape(-1, width)
        run, at = batch.column("run").to_numpy(), batch.column("at").to_numpy()
        held, label = batch.column("held").to_numpy(zero_copy_only=False), label.to_numpy()
        for one in np.unique(run):
            mine = slice(None) if (run == one).all() else run == one
            runs.setdefault(int(one), []).append((at[mine].copy(), held[mine].copy(), label[mine].copy(), flat[mine]))
    while runs:
        one, parts = runs.popitem()
        order = np.argsort(np.concatenate([p[0] for p in parts]), kind="stable")
        held, label = (np.concatenate([p[i] for p in parts])[order] for i in (1, 2))
        x = np.empty((width, len(order)), np.result_type(*(p[3].dtype for p in parts)))
        end = len(order)
        while parts:  # a part is let go as soon as it is taken over
            part = parts.pop()[3]
            x[:, end - len(part):end] = part.T
            end -= len(part)
        for values in x:
            values[:] = values[order]
        yield one, held, label, x


def _rows(est, df: DataFrame, *columns) -> DataFrame:
    return df.select(*columns, F.monotonically_increasing_id().alias("at"),
                     F.col(est.getLabelCol()).cast("double").alias("label"),
                     vector_to_array(F.col(est.getFeaturesCol())).alias("x"))


def staged_scores(est: GBTClassifier, maps: list, lengths: Sequence[int], df: DataFrame, fold: str,
                  folds: int) -> DataFrame:
    """(run, label, margin) of the held-out rows: run ``"fold map length"``, a fit for each fold and map.

    A fit is grown from the rows of the other folds, and its own rows are scored after each of ``lengths`` trees.
    """
    settings = [_settings(est, {**m, est.maxIter: max(lengths)}) for m in maps]
    runs = F.explode(F.sequence(F.lit(0), F.lit(folds * len(maps) - 1))).alias("run")  # run = map x folds + fold
    rows = _rows(est, df, F.col(fold).alias("fold")).select(
        runs, "at", "label", "x", "fold").withColumn("held", F.col("fold") == F.col("run") % folds).drop("fold")
    width, stops = df.select(est.getFeaturesCol()).first()[0].size, sorted(lengths)

    def run(batches):
        for one, held, label, x in _gathered(batches, width):
            m, k = divmod(one, folds)
            for i, (_, _, margin) in enumerate(boost(x, label, ~held, **settings[m])[1], 1):
                if i in stops and held.any():
                    yield pa.RecordBatch.from_arrays([pa.array([f"{k} {m} {i}"] * int(held.sum())),
                                                      pa.array(label[held]), pa.array(margin[held])],
                                                     ["run", "label", "margin"])

    return _dealt(rows, "run", folds * len(maps)).mapInArrow(run, "run string, label double, margin double")


class BoostedModel:
    """Boosted trees grown in a task; ``transform`` adds the columns that Spark's own model adds."""

    def __init__(self, est: GBTClassifier, cuts: list[np.ndarray], trees: list[Tree], weights: list[float]):
        self.est, self.cuts, self.trees, self.weights = est, cuts, trees, weights

    def transform(self, df: DataFrame) -> DataFrame:
        cuts, trees, weights, features = self.cuts, self.trees, self.weights, self.est.getFeaturesCol()
        schema = df.withColumn("__x", vector_to_array(F.col(features))).withColumn("__margin", F.lit(0.0)).schema
        names = [c for c in df.columns if c != features]

        def run(batches):
            for batch in batches:
                x = batch.column("__x")
                flat = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(cuts))
                bins = np.stack([np.searchsorted(c, v, side="left").astype(np.uint8) for c, v in zip(cuts, flat.T)])
                margin = sum(t.leaves(bins) * w for t, w in zip(trees, weights))
                full = np.zeros(batch.num_rows)
                full[~x.is_null().to_numpy(zero_copy_only=False)] = margin
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in names), x, pa.array(full, mask=x.is_null().to_numpy(zero_copy_only=False))],
                    [*names, "__x", "__margin"])

        kind = ", ".join(f"`{c}` {schema[c].dataType.simpleString()}" for c in [*names, "__x", "__margin"])
        m = F.col("__margin")
        zero = 1.0 / (1.0 + F.exp(2.0 * m))
        scored = df.withColumn("__x", vector_to_array(F.col(features))).drop(features).mapInArrow(run, kind)
        return scored.withColumn(features, array_to_vector("__x")).withColumns({
            self.est.getRawPredictionCol(): array_to_vector(F.array(-m, m)),
            self.est.getProbabilityCol(): array_to_vector(F.array(zero, 1.0 - zero)),
            self.est.getPredictionCol(): F.when(m > 0, 1.0).when(m.isNotNull(), 0.0),
        }).select(*df.columns, self.est.getRawPredictionCol(), self.est.getProbabilityCol(), self.est.getPredictionCol())


def fit(est: GBTClassifier, df: DataFrame) -> BoostedModel:
    """``est`` grown on all rows of ``df`` in one task; the driver holds the finished nodes only."""
    settings, width = _settings(est, {}), df.select(est.getFeaturesCol()).first()[0].size
    rows = _rows(est, df, F.lit(0).alias("run"), F.lit(False).alias("held")).coalesce(1)

    def run(batches):
        for _, held, label, x in _gathered(batches, width):
            cuts, trees = boost(x, label, ~held, **settings)
            yield pa.RecordBatch.from_arrays([pa.array([-1 - i for i in range(width)]), pa.array([0.0] * width),
                                              *[pa.array([None] * width, pa.list_(pa.int32())) for _ in range(3)],
                                              pa.array([c.tolist() for c in cuts], pa.list_(pa.float64()))], names)
            for i, (tree, weight, _) in enumerate(trees):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i]), pa.array([weight]),
                     *[pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v.astype(np.int32)))
                       for v in (tree.feature, tree.cut, tree.left)],
                     pa.ListArray.from_arrays(pa.array([0, len(tree.left)], pa.int32()), pa.array(tree.prediction))],
                    names)

    names = ["tree", "weight", "feature", "cut", "left", "values"]
    grown = cut_lineage(rows.mapInArrow(run, "tree long, weight double, feature array<int>, cut array<int>, "
                                             "left array<int>, values array<double>"), "grown").orderBy("tree").toArrow()
    column = {c: grown.column(c) for c in names}

    def array(c, i, kind):
        return column[c][i].values.to_numpy(zero_copy_only=False).astype(kind)

    numbers = column["tree"].to_pylist()
    cuts = [array("values", i, float) for i in sorted((i for i, n in enumerate(numbers) if n < 0),
                                                      key=lambda i: -numbers[i])]
    trees = [Tree(array("feature", i, np.int32), array("cut", i, np.int16), array("left", i, np.int32),
                  array("values", i, float)) for i, n in enumerate(numbers) if n >= 0]
    return BoostedModel(est, cuts, trees, [column["weight"][i].as_py() for i, n in enumerate(numbers) if n >= 0])
