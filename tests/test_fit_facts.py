"""Fits from sums, node tables and checked sources against direct computations."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from strata.operators import gram as GR
from strata.operators import models as MO
from strata.operators import recommend as RE
from strata.operators import trees as TR
from strata.sources.delimited import read_checked
from strata.sources.wide import read_wide_matrix


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 5)) * [1, 10, 0.1, 3, 0] + [0, 5, 0, 0, 2]  # the last has no spread
    y = x @ [1.0, 0.2, -4.0, 0.0, 1.0] + rng.normal(size=300)
    df = spark.createDataFrame([(i, i % 3, float(b), a.tolist()) for i, (a, b) in enumerate(zip(x, y))],
                               "id long, fold int, y double, a array<double>")
    odd = spark.createDataFrame([(-1, None, 1.0, [0.0] * 5), (-2, 0, None, [0.0] * 5)], df.schema)
    return df.unionByName(odd).select("id", "fold", "y", array_to_vector("a").alias("features")).cache()


@pytest.mark.parametrize("elastic,close", [(0.0, 1e-8), (1.0, 1e-5), (0.3, 1e-5)])
def test_fold_fits_from_sums_equal_refits(spark, rows, elastic, close):
    regs, sums = [0.0, 0.01, 0.3, 2.0], GR.fold_sums(rows, "fold", "y")
    curve = GR.penalty_curve(spark, sums, regs, [elastic]).orderBy("reg_param").collect()
    sound = rows.where("id >= 0")
    for got, reg in zip(curve, regs):
        errors = []
        for fold in range(3):
            est = MO.linear("y", reg, elastic, solver="normal", max_iter=1000).setTol(1e-14)
            held = est.fit(sound.where(F.col("fold") != fold)).transform(sound.where(F.col("fold") == fold))
            errors.append(held.agg(F.sqrt(F.avg((F.col("y") - F.col("prediction")) ** 2))).first()[0])
        assert got.mean_rmse == pytest.approx(np.mean(errors), abs=close)
    assert [r.is_best for r in curve].count(True) == 1


def test_no_folds_no_curve(spark, rows):
    assert GR.penalty_curve(spark, GR.fold_sums(rows.limit(0), "fold", "y"), [0.1]).count() == 0


def test_node_table_and_walk(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(200, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    df = spark.createDataFrame([(i, float(b), a.tolist()) for i, (a, b) in enumerate(zip(x, y))],
                               "id long, label double, x array<double>").withColumn("features", array_to_vector("x"))
    model = MO.random_forest("label", max_depth=3, num_trees=3).fit(df)
    nodes = TR.node_table(spark, model).cache()
    assert nodes.count() == model.totalNumNodes
    inner = nodes.where("feature IS NOT NULL")
    assert inner.where("left IS NULL OR right IS NULL OR cut IS NULL").count() == 0
    voted = {r.id: r.prediction for r in TR.vote(TR.walk(nodes, df, "id", "x", 3, 3), "id").collect()}
    assert voted == {r.id: r.prediction for r in model.transform(df).collect()}


def test_optimality_fails_on_other_factors(spark):
    rng = np.random.default_rng(8)
    ratings = spark.createDataFrame([(int(u), int(i), float(rng.integers(1, 6))) for u in range(30) for i in range(20)
                                     if rng.random() < 0.5], "user_id int, item_id int, rating double")
    model = RE.als("user_id", "item_id", "rating", rank=3, max_iter=4).fit(ratings)
    right = RE.user_optimality(model, ratings, 0.1).agg(F.max("residual")).first()[0]
    wrong = RE.user_optimality(model, ratings.withColumn("rating", 6 - F.col("rating")), 0.1)
    assert right < 1e-4 and wrong.agg(F.min("residual")).first()[0] > 1e-2


def test_wide_file_by_position_with_rejects(spark, tmp_path):
    (tmp_path / "a.txt").write_text("id\tp1\tp2\tp3\nw1\t1\t0\t2.5\nw2\t\t4\t\n\nw3\t1\t2\nw4\t1\tx\t2\nw5\t1\t2\t3\t4\n")
    (tmp_path / "b.txt").write_text("id\tp9\tp1\nw1\t7\t0\nw6\t0\t8\n")
    cells, rejects = read_wide_matrix(spark, str(tmp_path))
    assert sorted(map(tuple, cells.collect())) == [
        ("w1", "p1", 1.0), ("w1", "p3", 2.5), ("w1", "p9", 7.0), ("w2", "p2", 4.0), ("w6", "p1", 8.0)]
    assert sorted((r.line, r.reason) for r in rejects.collect()) == [
        ("w3\t1\t2", "width"), ("w4\t1\tx\t2", "cell"), ("w5\t1\t2\t3\t4", "width")]


def test_delimited_rows_and_rejects_add_up(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,a,2.5\n2,b\n3,c,x\n\n4,d,1,9\n5,,\n")
    kept, rejects = read_checked(spark, str(tmp_path), "id long, name string, value double")
    assert sorted(map(tuple, kept.collect())) == [(1, "a", 2.5), (5, None, None)]
    assert sorted(r.line for r in rejects.collect()) == ["2,b", "3,c,x", "4,d,1,9"]
    assert kept.select("id").count() == 2  # whichever columns a query needs


def test_penalty_gaps_tell_wrong_fits_from_right_ones(spark, rows):
    sound = rows.where("id >= 0").withColumn("flag", (F.col("y") > 0).cast("double"))
    fits = []
    for kind, label in (("linear", "y"), ("logistic", "flag")):
        for elastic in (0.0, 1.0):
            est = (MO.linear(label, 0.05, elastic, solver="normal", max_iter=2000) if kind == "linear"
                   else MO.logistic(label, 0.05, elastic, max_iter=2000)).setTol(1e-13)
            fits.append((f"{kind} {elastic}", kind, 0.05, elastic, label, est.fit(sound)))
    gaps = {r.model: r.gap for r in MO.penalty_gaps(sound, fits).collect()}
    assert len(gaps) == 4 and max(gaps.values()) < 1e-5
    wrong = [(n, k, 0.2, e, label, m) for n, k, _, e, label, m in fits]
    assert min(r.gap for r in MO.penalty_gaps(sound, wrong).collect()) > 1e-3
