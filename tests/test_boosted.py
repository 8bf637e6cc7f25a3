"""Boosted trees grown in a task: Spark's own fits, cuts, deep trees and rows that Spark refuses."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from strata.operators import boosted as BO
from strata.operators import models as MO
from strata.operators import tune as TU


def _frame(spark, x, y):
    df = spark.createDataFrame([(i, b, a) for i, (a, b) in enumerate(zip(x, y))],
                               "id long, label double, a array<double>")
    return df.select("id", "label", array_to_vector("a").alias("features")).coalesce(1).cache()


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(700, 5))
    x[:, 1] = rng.integers(0, 3, 700)  # fewer values than bins
    x[:, 2] = np.where(rng.random(700) < 0.6, 0.0, x[:, 2])  # mostly zero
    x[:, 3] = 1.5  # no split
    x[:40] = x[40:80]  # equal rows, of either class
    y = (x[:, 0] + x[:, 2] * x[:, 4] + rng.normal(size=700) > 0.3).astype(float)
    return _frame(spark, x.tolist(), y.tolist())


def _margins(df, column="rawPrediction"):
    return {r.id: (r.m, r.p, r.prediction) for r in df.select(
        "id", vector_to_array(column)[1].alias("m"), vector_to_array("probability")[1].alias("p"),
        "prediction").collect()}


@pytest.mark.parametrize("depth, bins", [(1, 32), (4, 5), (12, 32), (30, 20)])
def test_grown_trees_are_those_of_spark(rows, depth, bins):
    est = MO.boosted_trees("label", max_depth=depth, max_bins=bins, max_iter=4, seed=3)
    assert BO.fits_a_task(est, rows)
    got, want = (_margins(m.transform(rows)) for m in (BO.fit(est, rows), est.fit(rows)))
    assert got.keys() == want.keys()
    assert all(np.allclose(got[i], want[i], atol=1e-9) for i in want)


def test_no_job_for_each_level_and_tree(spark, rows):
    """A search over deep trees takes as many Spark jobs as one over stumps."""
    sc = spark.sparkContext

    def jobs(depth, group):
        est = MO.boosted_trees("label", seed=3)
        sc.setJobGroup(group, group)
        try:
            found = TU.staged_cross_validate(est, TU.grid([(est.maxDepth, [depth])]), [1, 6], rows, "label", 3, 5)
            TU.refit_best(est, found, rows).transform(rows).count()
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        return len(sc.statusTracker().getJobIdsForGroup(group))

    assert jobs(20, "deep") <= jobs(1, "stumps") + 2 < 40


def test_cuts_are_quantiles_of_distinct_values():
    values = np.repeat([1.0, 2.0, 3.0, 4.0, 5.0, 6.0], [1, 1, 6, 1, 1, 2])
    assert BO.cuts_of(values, 32).tolist() == [1.5, 2.5, 3.5, 4.5, 5.5]
    assert BO.cuts_of(np.arange(100.0), 4).tolist() == [24.5, 49.5, 74.5]
    assert BO.cuts_of(np.full(9, 2.0), 4).tolist() == []


def test_large_fits_and_other_settings_stay_with_spark(rows, monkeypatch):
    est = MO.boosted_trees("label")
    assert not BO.fits_a_task(est.copy({est.subsamplingRate: 0.5}), rows)
    assert not BO.fits_a_task(est.copy({est.featureSubsetStrategy: "sqrt"}), rows)
    monkeypatch.setattr(BO, "TASK_BYTES", 700 * 5 * 8 - 1)
    assert not BO.fits_a_task(est, rows)
    maps = TU.grid([(est.maxDepth, [2])])
    spread = TU.staged_cross_validate(est, maps, [2], rows, "label", folds=2, seed=4).means
    monkeypatch.undo()
    assert TU.staged_cross_validate(est, maps, [2], rows, "label", folds=2, seed=4).means == pytest.approx(spread)


@pytest.mark.parametrize("label, value", [(None, 1.0), (2.0, 1.0), (1.0, float("nan"))])
def test_rows_that_spark_refuses_are_refused(spark, label, value):
    df = _frame(spark, [[0.0], [1.0], [value]], [0.0, 1.0, label])
    est = MO.boosted_trees("label", max_iter=2)
    with pytest.raises(Exception):
        est.fit(df)
    with pytest.raises(Exception):
        BO.fit(est, df)


def test_model_keeps_the_other_columns(rows):
    est = MO.boosted_trees("label", max_iter=2)
    out = BO.fit(est, rows).transform(rows.where("id < 0"))
    assert out.columns == est.fit(rows).transform(rows).columns and out.count() == 0
    assert rows.join(BO.fit(est, rows).transform(rows).select("id", F.col("features").alias("f")), "id") \
        .where("features = f").count() == 700
