"""Hyper-parameter search (M-19 .. M-23).

``CrossValidator`` fits folds × grid models; ``parallelism`` runs several
fits at once from the driver, each a distributed job.  The validation
curve and the best setting come back as DataFrames.  The best setting
honours the metric's direction (the reference always took the minimum,
picking the worst F1, D-05).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from statistics import fmean, stdev

from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import boosted
from .metrics import roc_auc

#: Rows that one task of a fit should have; smaller inputs use fewer tasks.
ROWS_PER_TASK = 20_000


@dataclass
class TunedGrid:
    """What a search found: the settings and each one's mean and deviation over the folds."""

    maps: list
    means: list[float]
    stds: list[float]
    larger_is_better: bool

    def best(self) -> int:
        """Index of the best mean metric, honouring the metric's direction (M-21)."""
        return max(range(len(self.means)),
                   key=lambda i: self.means[i] if self.larger_is_better else -self.means[i])


def tuned_grid(found) -> TunedGrid:
    """A fitted CrossValidatorModel (or a TunedGrid) as a TunedGrid."""
    if isinstance(found, TunedGrid):
        return found
    means = list(found.avgMetrics)
    stds = list(getattr(found, "stdMetrics", []) or [0.0] * len(means))
    return TunedGrid(found.getEstimatorParamMaps(), means, stds, found.getEvaluator().isLargerBetter())


def few_tasks(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """A written ``df`` in no more partitions than its rows fill: a fit runs a job per tree level."""
    return df.coalesce(max(1, -(-df.count() // rows_per_task)))


def grid(pairs: Sequence[tuple]) -> list:
    """Grid from (param, values) pairs (M-19)."""
    b = ParamGridBuilder()
    for param, values in pairs:
        b = b.addGrid(param, list(values))
    return b.build()


def written_folds(df: DataFrame, folds: int, seed: int, fold_col: str = "fold") -> DataFrame:
    """``df`` written once with ``fold_col``: the folds that CrossValidator's own random split by ``seed`` deals.

    For a ``df`` that costs more to derive than to read (a small sample of a large table): a
    search derives its data anew for both sides of every fold and again for each pass of its last fit.
    """
    return cut_lineage(df.withColumn(fold_col, F.floor(F.rand(seed) * folds).cast("int")), "folds")


def cross_validate(estimator, param_maps: list, evaluator, df: DataFrame, folds: int = 3,
                   seed: int = 42, parallelism: int = 4, fold_col: str | None = None):
    """Fit a k-fold cross-validation (M-20); returns the fitted CrossValidatorModel."""
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=param_maps, evaluator=evaluator,
                        numFolds=folds, seed=seed, parallelism=parallelism)
    if fold_col:
        cv.setFoldCol(fold_col)
    return cv.fit(df)


def best_index(found) -> int:
    """Grid index of the best mean metric (M-21)."""
    return tuned_grid(found).best()


def refit_best(estimator, found, df: DataFrame):
    """Fit ``estimator`` with the selected setting on ``df`` (tune small, refit large).

    Boosted trees on rows that one task can hold are grown there (``boosted.fit``).
    """
    chosen = estimator.copy(tuned_grid(found).maps[best_index(found)])
    return boosted.fit(chosen, df) if boosted.fits_a_task(chosen, df) else chosen.fit(df)


def validation_curve(spark: SparkSession, found, model_name: str = "") -> DataFrame:
    """(model, setting, mean_metric, std_metric, is_best) per grid point (M-21, M-23)."""
    result = tuned_grid(found)
    best = result.best()
    rows = []
    for i, pm in enumerate(result.maps):
        setting = ", ".join(f"{p.name}={v}" for p, v in sorted(pm.items(), key=lambda kv: kv[0].name))
        rows.append((model_name, setting, float(result.means[i]), float(result.stds[i]), i == best))
    return spark.createDataFrame(
        rows, "model string, setting string, mean_metric double, std_metric double, is_best boolean")


def staged_margins(model, df: DataFrame, lengths: Sequence[int], prefix: str = "margin_") -> DataFrame:
    """``df`` with the boosted margin after each of ``lengths`` trees (``margin_<length>``).

    The margin of a shorter fit is a prefix of the longest one's sum, so all lengths
    come from one pass in which every tree scores a row once.
    """
    trees, weights = model.trees, list(model.treeWeights)
    names = [f"__tree_{i}" for i in range(len(trees))]
    out = df
    for tree, name in zip(trees, names):
        out = tree.transform(out, {tree.predictionCol: name})
    margins = {}
    for length in lengths:
        terms = [F.col(n) * F.lit(float(w)) for n, w in zip(names[:length], weights[:length])]
        margins[f"{prefix}{length}"] = sum(terms[1:], terms[0])
    return out.withColumns(margins).drop(*names)


def _fitted_scores(estimator, base_maps: list, lengths: Sequence[int], dealt: DataFrame, label: str, folds: int,
                   parallelism: int) -> DataFrame:
    """``boosted.staged_scores`` by Spark's own fits, each over the whole cluster."""
    longest = estimator.copy({estimator.maxIter: lengths[-1]})
    jobs = [(fold, i) for i in range(len(base_maps)) for fold in range(folds)]
    models = fit_concurrently([(longest.copy(base_maps[i]), dealt.filter(F.col("__fold") != fold).drop("__fold"))
                               for fold, i in jobs], parallelism)
    scores = None
    for (fold, i), model in zip(jobs, models):
        held = staged_margins(model, dealt.filter(F.col("__fold") == fold), lengths)
        at = F.explode(F.array(*[F.struct(F.lit(f"{fold} {i} {n}").alias("run"), F.col(f"margin_{n}").alias("margin"))
                                 for n in lengths])).alias("at")
        part = held.select(F.col(label).alias("label"), at).select("label", "at.*")
        scores = part if scores is None else scores.unionByName(part)
    return scores


def staged_cross_validate(estimator, base_maps: list, lengths: Sequence[int], df: DataFrame, label: str,
                          folds: int = 3, seed: int = 42, parallelism: int = 8) -> TunedGrid:
    """k-fold CV of boosted trees on ROC area over ``base_maps`` x ``lengths`` (M-20, J-16).

    One fit of the longest length serves all shorter ones: its first trees and
    weights are those of a shorter fit.  So there are folds x len(base_maps) fits, not
    another for each length.  The folds are a written column (a lost task can't deal
    rows anew), and all settings' areas, exact, come from one prefix sum over the
    written margins.  Null where a fold's held-out rows are of one class: such a fold
    is left out of the mean.  Fits whose rows one task can hold are grown in a task each,
    where the held-out rows are scored as well (``boosted.staged_scores``).
    """
    lengths = sorted(lengths)
    dealt = few_tasks(cut_lineage(
        df.withColumn("__fold", F.floor(F.rand(seed) * folds).cast("int")), "folds"))
    if boosted.fits_a_task(estimator, dealt):
        scores = boosted.staged_scores(estimator, base_maps, lengths, dealt, "__fold", folds)
    else:
        scores = _fitted_scores(estimator, base_maps, lengths, dealt, label, folds, parallelism)
    areas = {r["run"]: r["auc"] for r in
             roc_auc(cut_lineage(scores, "staged-scores"), "label", "margin", by="run").collect()}
    maps, means, stds = [], [], []
    for i, base in enumerate(base_maps):
        for n in lengths:
            known = [a for fold in range(folds) if (a := areas.get(f"{fold} {i} {n}")) is not None]
            maps.append({**base, estimator.maxIter: n})
            means.append(fmean(known) if known else float("nan"))
            stds.append(stdev(known) if len(known) > 1 else 0.0)
    return TunedGrid(maps, means, stds, True)


def fit_concurrently(jobs: Sequence[tuple], parallelism: int = 4) -> list:
    """Fit independent (estimator, dataset) pairs concurrently; models in input order.

    Each fit is its own set of distributed Spark jobs; running a few at once
    from driver threads (as ``CrossValidator(parallelism=…)`` does) keeps
    the cluster busy when single fits have small stages.
    """
    from concurrent.futures import ThreadPoolExecutor

    if parallelism <= 1 or len(jobs) <= 1:
        return [est.fit(df) for est, df in jobs]
    with ThreadPoolExecutor(max_workers=min(parallelism, len(jobs))) as pool:
        return list(pool.map(lambda job: job[0].fit(job[1]), jobs))
