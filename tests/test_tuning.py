"""Searches: staged boosting against separate fits."""

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from strata.operators import models as MO
from strata.operators import tune as TU
from strata.plans import ml_claims as MC

from .conftest import SMALL


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(240, 4))
    y = (x[:, 0] + x[:, 1] ** 2 + rng.normal(scale=0.7, size=240) > 0.8).astype(float)
    df = spark.createDataFrame([(int(i), float(b), a.tolist()) for i, (a, b) in enumerate(zip(x, y))],
                               "id long, label double, a array<double>")
    return df.select("id", "label", array_to_vector("a").alias("features")).coalesce(1).cache()


def test_margins_of_prefixes_are_those_of_shorter_fits(rows):
    est = MO.boosted_trees("label", max_depth=3, max_iter=8, seed=3)
    staged = TU.staged_margins(est.fit(rows), rows, [1, 3, 8])
    for length in (1, 3, 8):
        short = est.copy({est.maxIter: length}).fit(rows).transform(rows)
        want = {r.id: r.m for r in short.select("id", vector_to_array("rawPrediction")[1].alias("m")).collect()}
        got = {r.id: r[1] for r in staged.select("id", f"margin_{length}").collect()}
        assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in want)


def test_staged_search_equals_fold_by_fold_fits(spark, rows):
    est = MO.boosted_trees("label", seed=3)
    maps = TU.grid([(est.maxDepth, [1, 3])])
    found = TU.staged_cross_validate(est, maps, [5, 2], rows, "label", folds=3, seed=11)
    dealt = rows.withColumn("fold", F.floor(F.rand(11) * 3)).cache()
    ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction")
    for pm, mean in zip(found.maps, found.means):
        areas = [ev.evaluate(est.copy(pm).fit(dealt.filter(F.col("fold") != k))
                             .transform(dealt.filter(F.col("fold") == k))) for k in range(3)]
        assert mean == pytest.approx(np.mean(areas), abs=1e-9)
    curve = TU.validation_curve(spark, found, "gbt").collect()
    assert [r.setting for r in curve] == [f"maxDepth={d}, maxIter={n}" for d in (1, 3) for n in (2, 5)]
    assert sum(r.is_best for r in curve) == 1


def test_written_folds_are_those_of_the_random_split(spark):
    rng = np.random.default_rng(9)
    data = spark.createDataFrame([(float(a), [float(a) + float(b)]) for a, b in rng.normal(size=(300, 2))],
                                 "y double, a array<double>").select("y", array_to_vector("a").alias("features"))
    data = data.repartition(3).cache()
    est = MO.linear("y", solver="normal")
    maps, ev = TU.grid([(est.regParam, [0.01, 1.0])]), RegressionEvaluator(labelCol="y", metricName="rmse")
    written = TU.written_folds(data, 3, 42)
    got = TU.cross_validate(est, maps, ev, written, folds=3, seed=42, fold_col="fold")
    want = TU.cross_validate(est, maps, ev, data, folds=3, seed=42)
    assert got.avgMetrics == pytest.approx(want.avgMetrics, abs=1e-9)
    assert got.stdMetrics == pytest.approx(want.stdMetrics, abs=1e-9)


def test_claims_search_reads_its_sample_only(spark, monkeypatch):
    seen = []

    def stop(estimator, maps, evaluator, df, **_):
        seen.append(df)
        raise StopIteration

    monkeypatch.setattr(TU, "cross_validate", stop)
    with pytest.raises(StopIteration):
        MC.q_cv_curve(spark, SMALL)
    assert 0 < seen[0].count() == spark.read.parquet(*seen[0].inputFiles()).count()
