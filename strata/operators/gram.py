"""Penalised least squares for every fold and penalty from one pass of sums (M-01, M-02, M-20, J-14).

A task adds up the products of (1, features, label) of its rows by fold; these
(width + 2)² numbers a fold are all that a fit and its error need.  Leaving a fold
out is a subtraction, ridge solutions are closed, lasso and elastic-net ones come
from coordinate descent on the sums, and the held-out squared error is a quadratic
form: the grid of folds x penalties costs one scan of the data instead of a fit and
a scoring pass each.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decompose import MAX_LOCAL_WIDTH

# functions travel to the executors by value: workers need numpy and pyarrow, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def fold_sums(df: DataFrame, fold: str, label: str, features: str = "features") -> dict[int, np.ndarray]:
    """Products of (1, features, label), summed over the rows of each fold: one scan.

    Rows with a null fold, label or feature vector are left out.  The width is
    checked; a task and the driver hold folds x width² numbers.
    """
    rows = (df.select(F.col(fold).cast("int").alias("fold"), vector_to_array(F.col(features)).alias("x"),
                      F.col(label).cast("double").alias("y"))
            .where(F.col("fold").isNotNull() & F.col("x").isNotNull() & F.col("y").isNotNull()))

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            if x.shape[1] > MAX_LOCAL_WIDTH:
                raise ValueError(f"{x.shape[1]} features exceed the bound of {MAX_LOCAL_WIDTH}")
            a = np.column_stack([np.ones(n), x, batch.column("y").to_numpy()])
            folds = batch.column("fold").to_numpy()
            for f in np.unique(folds):
                part = a[folds == f]
                total[int(f)] = total.get(int(f), 0.0) + part.T @ part
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int32()), pa.array([g.ravel() for g in total.values()])], ["fold", "g"])

    sums = (rows.mapInArrow(run, "fold int, g array<double>").select("fold", F.posexplode("g").alias("at", "x"))
            .groupBy("fold", "at").agg(F.sum("x").alias("x")).toArrow())
    fold_of, at, value = (sums.column(c).to_numpy() for c in ("fold", "at", "x"))
    out = {}
    for f in np.unique(fold_of):
        flat = np.zeros((fold_of == f).sum())
        flat[at[fold_of == f]] = value[fold_of == f]
        out[int(f)] = flat.reshape(int(round(np.sqrt(len(flat)))), -1)
    return out


@dataclass
class LinearFit:
    intercept: float
    coefficients: np.ndarray

    def squared_error(self, sums: np.ndarray) -> float:
        """Sum of squared errors over the rows behind ``sums``."""
        w = np.r_[self.intercept, self.coefficients, -1.0]
        return max(0.0, float(w @ sums @ w))


def fit_from_sums(sums: np.ndarray, reg: float, elastic: float = 0.0, rounds: int = 10_000,
                  tolerance: float = 1e-13) -> LinearFit:
    """Elastic-net least squares with an intercept, as Spark's normal-equation solver defines it.

    Features and label are standardised by their population deviations, the
    penalty is ``reg`` over the label's deviation.  Features without spread get 0.
    """
    n = sums[0, 0]
    mean = sums[0, 1:] / n
    centred = sums[1:, 1:] / n - np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(centred), 0))
    d = len(mean) - 1
    coefficients = np.zeros(d)
    some = np.flatnonzero(sd[:d] > 1e-12 * np.maximum(1.0, np.abs(mean[:d])))
    if sd[d] > 0 and len(some):
        scaled = centred / np.outer(np.where(sd > 0, sd, 1.0), np.where(sd > 0, sd, 1.0))
        c, r, penalty = scaled[np.ix_(some, some)], scaled[some, d], reg / sd[d]
        ridge = c + penalty * (1 - elastic) * np.eye(len(some))
        lasso = penalty * elastic
        if lasso == 0:
            beta = np.linalg.lstsq(ridge, r, rcond=1e-13)[0]
        else:
            beta = np.zeros(len(some))
            for _ in range(rounds):
                before = beta.copy()
                for j in range(len(some)):
                    rest = r[j] - ridge[j] @ beta + ridge[j, j] * beta[j]
                    beta[j] = np.sign(rest) * max(0.0, abs(rest) - lasso) / ridge[j, j]
                if np.abs(beta - before).max() <= tolerance:
                    break
        coefficients[some] = beta * sd[d] / sd[some]
    return LinearFit(float(mean[d] - coefficients @ mean[:d]), coefficients)


def penalty_curve(spark: SparkSession, sums: dict[int, np.ndarray], regs: Sequence[float],
                  elastics: Sequence[float] = (0.0,)) -> DataFrame:
    """(elastic, reg_param, mean_rmse, std_rmse, is_best): k-fold errors of the whole grid, from the sums.

    Each fold is held out once and predicted by the fit on all others.  ``is_best``
    marks the least mean of each elastic.  Fewer than two folds: no rows.
    """
    rows = []
    whole = sum(sums.values()) if sums else None
    for elastic in elastics if len(sums) > 1 else ():
        means = []
        for reg in regs:
            errors = []
            for held in sums.values():
                fit = fit_from_sums(whole - held, reg, elastic)
                errors.append(np.sqrt(fit.squared_error(held) / held[0, 0]))
            means.append((float(reg), float(np.mean(errors)), float(np.std(errors, ddof=1))))
        best = min(range(len(means)), key=lambda i: means[i][1])
        rows += [(float(elastic), *m, i == best) for i, m in enumerate(means)]
    return spark.createDataFrame(rows, "elastic double, reg_param double, mean_rmse double, std_rmse double, "
                                       "is_best boolean")
