"""Model goldens (re-typed from the reference's comments) and invariants."""

import math

import numpy as np
import pytest
from pyspark.ml.evaluation import (BinaryClassificationEvaluator, MulticlassClassificationEvaluator,
                                   RegressionEvaluator)
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from strata.operators import cluster as CL
from strata.operators import decompose as D
from strata.operators import features as FE
from strata.operators import metrics as ME
from strata.operators import models as MO
from strata.operators import recommend as RE


def test_kmeans_golden_centres(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([1.0, 1.0],), ([9.0, 8.0],), ([8.0, 9.0],)], "a array<double>")
    data = FE.array_vector(df, "a")
    model = CL.kmeans(2, seed=1).fit(data)
    centres = sorted(tuple(c) for c in model.clusterCenters())
    assert centres == [(0.5, 0.5), (8.5, 8.5)]
    out = model.transform(data).select("cluster", CL.nearest_centre(F.col("a"), model).alias("nearest"))
    assert all(r["cluster"] == r["nearest"] for r in out.collect())


def test_plain_columns_are_clustered_without_a_pass_that_counts_zeros(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(200, 2)))],
                               "id long, a double, b double").repartition(2).cache()
    model, kept = CL.fit_assign(df, ["a", "b"], 4, seed=3, keep=["id"])
    assert model.getSolver() == "row"
    data = FE.assembler(["a", "b"]).transform(df)
    auto = CL.kmeans(4, seed=3).fit(data)
    assert {(r.id, r.cluster) for r in kept.collect()} == {
        (r.id, r.cluster) for r in auto.transform(data).select("id", "cluster").collect()}


def _pca_rows(spark):
    return spark.createDataFrame([(Vectors.sparse(5, [(1, 1.0), (3, 7.0)]),),
                                  (Vectors.dense([2.0, 0.0, 3.0, 4.0, 5.0]),),
                                  (Vectors.dense([4.0, 0.0, 0.0, 6.0, 7.0]),)], ["features"])


def test_pca_golden(spark):
    model = D.pca(_pca_rows(spark), 2)
    ev = [round(v, 4) for v in model.explainedVariance.toArray()]
    assert ev == [0.7944, 0.2056]
    pc1 = np.abs(model.pc.toArray()[:, 0])
    assert np.allclose(pc1, [0.44859172, 0.13301986, 0.12523156, 0.21650757, 0.84765129], atol=1e-7)
    comp = D.components_table(spark, model).filter("component = 2").orderBy("feature").collect()
    norm = math.sqrt(sum(r["loading"] ** 2 for r in comp))
    assert abs(norm - 1) < 1e-9


def test_row_matrix_components_golden(spark):
    pc = D.principal_components(_pca_rows(spark), 2).toArray()
    assert np.allclose(np.abs(pc[:, 1]), [0.28423808, 0.05621156, 0.76362648, 0.56529588, 0.11560341],
                       atol=1e-7)


def test_centring_golden(spark):
    data = _pca_rows(spark)
    out = FE.scaler("features", "c", with_mean=True, with_std=False).fit(data).transform(data)
    first = [round(x, 4) for x in out.first()["c"].toArray()]
    assert first == [-2.0, 0.6667, -1.0, 1.3333, -4.0]


def test_svd_shares(spark):
    data = FE.scaler("features", "c", with_mean=True, with_std=False).fit(_pca_rows(spark)) \
        .transform(_pca_rows(spark)).select(F.col("c").alias("features"))
    res = D.svd(data, 2)
    table = D.eigen_table(spark, res.s, None, 3).orderBy("component").collect()
    assert abs(sum(r["share_of_kept"] for r in table) - 1) < 1e-12


def test_text_classifier_golden(spark):
    train = spark.createDataFrame([(0, "a b c d e spark", 1.0), (1, "b d", 0.0), (2, "spark f g h", 1.0),
                                   (3, "hadoop mapreduce", 0.0)], ["id", "text", "label"])
    test = spark.createDataFrame([(4, "spark hadoop"), (5, "spark a b c"), (6, "mapreduce spark")],
                                 ["id", "text"])
    model = MO.pipeline(FE.text_features("text") + [MO.logistic("label", reg=0.001, max_iter=10)]).fit(train)
    preds = [r["prediction"] for r in model.transform(test).orderBy("id").collect()]
    assert preds == [0.0, 1.0, 0.0]


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(float(i % 7), float((i * 3) % 7) + 0.5, i % 2, ((i * 37) % 101) / 101.0, (i * 13) % 2)
            for i in range(400)]
    return spark.createDataFrame(rows, "y double, y_hat double, label int, score double, pred int")


def test_regression_metrics_match_evaluator(scored):
    ours = ME.regression_metrics(scored, "y", "y_hat").first()
    for metric in ("rmse", "mse", "mae", "r2"):
        ev = RegressionEvaluator(labelCol="y", predictionCol="y_hat", metricName=metric).evaluate(scored)
        assert abs(ours[metric] - ev) < 1e-9, metric


def test_classification_metrics_match_evaluator(scored):
    df = scored.withColumn("label", F.col("label").cast("double")).withColumn("pred", F.col("pred").cast("double"))
    ours = ME.classification_metrics(df, "label", "pred").first()
    for metric, col in (("accuracy", "accuracy"), ("f1", "weighted_f1"),
                        ("weightedPrecision", "weighted_precision"), ("weightedRecall", "weighted_recall")):
        ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="pred",
                                               metricName=metric).evaluate(df)
        assert abs(ours[col] - ev) < 1e-9, metric


def test_roc_auc_matches_exact_evaluator(scored):
    df = scored.withColumn("label", F.col("label").cast("double"))
    ours = ME.roc_auc(df, "label", "score").first()["auc"]
    ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0).evaluate(df)
    assert abs(ours - ev) < 1e-9


def test_degenerate_inputs_give_null_not_errors(spark):
    one_class = spark.createDataFrame([(1, 0.3), (1, 0.5)], "label int, score double")
    assert ME.roc_auc(one_class, "label", "score").first()["auc"] is None
    constant = spark.createDataFrame([(1.0, 0.5), (1.0, 0.7)], "y double, p double")
    assert ME.regression_metrics(constant, "y", "p").first()["r2"] is None


def test_prefix_sums_layout_free(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"), F.lit(1).alias("v"))
    out = ME.ordered_prefix_sums(df, "k", ["v"], partitions=7)
    assert all(r["v_before"] == r["k"] for r in out.collect())


def test_poisson_score_equation(spark):
    """Unpenalised Poisson with intercept: fitted means sum to the observed counts."""
    rows = [(float(i % 5), float(i % 3), float((i * 7) % 4)) for i in range(300)]
    df = FE.assembler(["x1", "x2"]).transform(spark.createDataFrame(rows, "x1 double, x2 double, y double"))
    pred = MO.poisson("y", 0.0).fit(df).transform(df)
    tot = pred.agg(F.sum("y").alias("y"), F.sum("prediction").alias("mu")).first()
    assert abs(tot["y"] - tot["mu"]) < 1e-6 * tot["y"]


def test_als_topn_invariants(spark):
    rows = [(u, i, float((u * i) % 5 + 1)) for u in range(30) for i in range(20) if (u + i) % 3]
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating double")
    model = RE.als("user_id", "item_id", "rating", rank=4, max_iter=5).fit(df)
    recs = RE.top_items_for_users(model, 5).collect()
    by_user = {}
    for r in recs:
        by_user.setdefault(r["user_id"], []).append((r["rank"], r["score"], r["item_id"]))
    for lst in by_user.values():
        lst.sort()
        assert len(lst) <= 5 and len({x[2] for x in lst}) == len(lst)
        scores = [x[1] for x in lst]
        assert scores == sorted(scores, reverse=True)


def test_coefficient_table_named(spark):
    rows = [("a" if i % 3 else "b", float(i % 4), float(i % 4) * 2 + (1.0 if i % 3 else 0.0)) for i in range(60)]
    df = spark.createDataFrame(rows, "cat string, x double, y double")
    stages = FE.tabular_stages(["cat"], ["x"], standardise=False) + [MO.linear("y")]
    model = MO.pipeline(stages).fit(df)
    names = MO.feature_names(model.transform(df), "features")
    table = MO.coefficient_table(spark, model, names, "lin").collect()
    terms = [r["term"] for r in table]
    assert terms[0] == "(intercept)" and len(terms) == 1 + len(names)
