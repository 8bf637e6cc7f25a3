"""Model estimators and read-outs (M-01 .. M-07, M-17, M-18, M-22).

Estimators are ``pyspark.ml`` (distributed fits: normal equations,
IRLS, L-BFGS/OWL-QN, tree induction by histogram aggregation).  Read-outs
turn a fitted model's small local state (coefficients, parameters) into
DataFrames with named rows instead of printed arrays.  Their size is the
model's width, never the data's.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# functions travel to the executors by value: workers need numpy and pyarrow, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def linear(label: str, reg: float = 0.0, elastic: float = 0.0, solver: str = "auto",
           max_iter: int = 100, features: str = "features") -> LinearRegression:
    """Least squares with optional L1/L2 penalty (M-01, M-02)."""
    return LinearRegression(featuresCol=features, labelCol=label, regParam=reg,
                            elasticNetParam=elastic, solver=solver, maxIter=max_iter)


def poisson(label: str, reg: float = 0.0, link: str = "log", max_iter: int = 25,
            features: str = "features", offset: str | None = None) -> GeneralizedLinearRegression:
    """Poisson GLM (M-03); ``offset`` takes e.g. log exposure."""
    glm = GeneralizedLinearRegression(featuresCol=features, labelCol=label, family="poisson",
                                      link=link, regParam=reg, maxIter=max_iter)
    if offset:
        glm.setOffsetCol(offset)
    return glm


def logistic(label: str, reg: float = 0.0, elastic: float = 0.0, family: str = "auto",
             max_iter: int = 100, features: str = "features") -> LogisticRegression:
    """Logistic regression, binomial or multinomial (M-04, M-05)."""
    return LogisticRegression(featuresCol=features, labelCol=label, regParam=reg,
                              elasticNetParam=elastic, family=family, maxIter=max_iter)


def random_forest(label: str, max_depth: int = 5, max_bins: int = 32, num_trees: int = 20,
                  impurity: str = "gini", seed: int = 42, features: str = "features") -> RandomForestClassifier:
    """Random forest classifier (M-06)."""
    return RandomForestClassifier(featuresCol=features, labelCol=label, maxDepth=max_depth,
                                  maxBins=max_bins, numTrees=num_trees, impurity=impurity, seed=seed)


def boosted_trees(label: str, max_depth: int = 5, max_iter: int = 10, step: float = 0.1,
                  max_bins: int = 32, seed: int = 42, features: str = "features") -> GBTClassifier:
    """Gradient-boosted trees classifier (M-07)."""
    return GBTClassifier(featuresCol=features, labelCol=label, maxDepth=max_depth, maxIter=max_iter,
                         stepSize=step, maxBins=max_bins, seed=seed)


def pipeline(stages: Sequence) -> Pipeline:
    """Chain of stages fitted together (M-17)."""
    return Pipeline(stages=list(stages))


def feature_names(df: DataFrame, vec_col: str = "features") -> list[str]:
    """Slot names of a vector column from its ML attribute metadata."""
    meta = df.schema[vec_col].metadata.get("ml_attr", {})
    size = meta.get("num_attrs")
    names: dict[int, str] = {}
    for group in meta.get("attrs", {}).values():
        for a in group:
            names[a["idx"]] = a.get("name", f"f{a['idx']}")
    size = size or (max(names) + 1 if names else 0)
    return [names.get(i, f"f{i}") for i in range(size)]


def _last(model):
    return model.stages[-1] if isinstance(model, PipelineModel) else model


def coefficient_table(spark: SparkSession, model, names: Sequence[str], model_name: str = "") -> DataFrame:
    """(model, class, term, coefficient) with the intercept as term ``(intercept)`` (M-18).

    Dense, named rows: zero coefficients of an L1 fit are kept, unlike the
    reference's printout of the sparse values only (D-19).
    """
    m = _last(model)
    rows = []
    if hasattr(m, "coefficientMatrix") and m.coefficientMatrix.numRows > 1:
        mat = m.coefficientMatrix.toArray()
        icpt = m.interceptVector.toArray()
        for k in range(mat.shape[0]):
            rows.append((model_name, k, "(intercept)", float(icpt[k])))
            rows += [(model_name, k, names[j] if j < len(names) else f"f{j}", float(mat[k, j]))
                     for j in range(mat.shape[1])]
    else:
        coef = m.coefficients.toArray()
        rows.append((model_name, 1, "(intercept)", float(m.intercept)))
        rows += [(model_name, 1, names[j] if j < len(names) else f"f{j}", float(v))
                 for j, v in enumerate(coef)]
    return spark.createDataFrame(rows, "model string, class int, term string, coefficient double")


def penalty_gaps(df: DataFrame, fits: Sequence[tuple], features: str = "features") -> DataFrame:
    """(model, n_slots, gap): how far penalised fits are from their optimality conditions (M-02, M-04, J-13).

    ``fits`` are (name, kind, reg, elastic, label, model) with kind ``linear`` (normal
    solver) or ``logistic``.  With standardised slots, the mean gradient of each slot
    must cancel the penalty's: reg * elastic * sign + reg * (1 - elastic) * coefficient, or
    lie within reg * elastic where the coefficient is zero; the intercept's must vanish.
    ``gap`` is the largest miss over the label's deviation.  One pass of sums over the
    rows for all fits (the residuals' products with the features, by task).
    """
    fits = [(name, kind, float(reg), float(elastic), label, _last(model)) for name, kind, reg, elastic, label, model in fits]
    labels = sorted({f[4] for f in fits})
    weights = []
    for _, kind, _, _, label, m in fits:
        if kind == "logistic":
            many = m.numClasses > 2 or m.coefficientMatrix.numRows > 1
            b, c = m.interceptVector.toArray(), m.coefficientMatrix.toArray()
            weights.append((label, "multinomial" if many else "binomial", b, c))
        else:
            weights.append((label, "linear", np.array([m.intercept]), m.coefficients.toArray()[None, :]))
    rows = df.select(vector_to_array(F.col(features)).alias("x"), *[F.col(c).cast("double").alias(c) for c in labels])

    def run(batches):
        total = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            a = np.column_stack([np.ones(n), x])
            parts = [a.sum(axis=0), (a * a).sum(axis=0)]
            for label, kind, b, c in weights:
                y = batch.column(label).to_numpy()
                parts.append(np.array([y.sum(), (y * y).sum()]))
                z = x @ c.T + b
                if kind == "linear":
                    rest = z - y[:, None]
                elif kind == "binomial":
                    rest = 1 / (1 + np.exp(-z)) - y[:, None]
                else:
                    z = np.exp(z - z.max(axis=1, keepdims=True))
                    rest = z / z.sum(axis=1, keepdims=True) - (y[:, None] == np.arange(len(b)))
                parts.append((rest.T @ a).ravel())
            flat = np.concatenate(parts)
            total = flat if total is None else total + flat
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total])], ["s"])

    sums = (rows.mapInArrow(run, "s array<double>").select(F.posexplode("s").alias("at", "s"))
            .groupBy("at").agg(F.sum("s").alias("s")).orderBy("at").toArrow().column("s").to_numpy())
    d = weights[0][3].shape[1]
    n, at = sums[0], 2 * (d + 1)
    mean, square = sums[1:d + 1] / n, sums[d + 2:2 * d + 2] / n
    spread = np.sqrt(np.maximum(square - mean ** 2, 0))
    out = []
    for (name, kind, reg, elastic, _, _), (_, _, b, c) in zip(fits, weights):
        y_mean, y_square = sums[at:at + 2] / n
        size = len(b) * (d + 1)
        gradient = sums[at + 2:at + 2 + size].reshape(len(b), d + 1) / n
        at += 2 + size
        # the linear solver uses population deviations and divides the penalty by the label's
        sd = spread if kind == "linear" else spread * np.sqrt(n / (n - 1))
        y_sd = np.sqrt(max(y_square - y_mean ** 2, 0)) if kind == "linear" else 1.0
        some = sd > 1e-12
        g, beta = gradient[:, 1:][:, some] / sd[some], c[:, some] * sd[some]
        ridge = g + reg * (1 - elastic) * beta / y_sd
        lasso = reg * elastic
        miss = np.where(np.abs(beta) > 1e-9, np.abs(ridge + lasso * np.sign(beta)),
                        np.maximum(0, np.abs(ridge) - lasso))
        gap = max(miss.max(initial=0.0), np.abs(gradient[:, 0]).max()) / max(y_sd, 1e-12)
        out.append((name, int(c.size), float(gap)))
    return df.sparkSession.createDataFrame(out, "model string, n_slots int, gap double")


def param_table(spark: SparkSession, model, model_name: str = "") -> DataFrame:
    """(model, param, value) of a fitted model's explicit and default params (M-22)."""
    m = _last(model)
    rows = [(model_name, p.name, str(v)) for p, v in sorted(m.extractParamMap().items(),
                                                            key=lambda kv: kv[0].name)]
    return spark.createDataFrame(rows, "model string, param string, value string")
