"""Claim-frequency modelling (J-13, J-14), regression labs (M-01) and metrics (Y-01..Y-05)."""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as FE
from ..operators import metrics as ME
from ..operators import models as MO
from ..operators import tune as TU
from ..operators.sampling import bernoulli_sample, hash_split
from ..session import cut_lineage
from ..sources.tables import read_table
from . import fixtures as fx

CATS = fx.CLAIM_CATEGORIES
NUMS = fx.CLAIM_NUMERICS
# Fixed values of the reference claims job: seed 37, regParam 0.01, the
# regParam grid 0.001/0.01/0.1/1/10 and the lab sweep 0/0.1/0.2/0.5.
SEED = 37
REG = 0.01
REG_GRID = [0.001, 0.01, 0.1, 1.0, 10.0]
SWEEP = [0.0, 0.1, 0.2, 0.5]


def claims_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims table with the three targets: count, non-zero flag, log count."""
    df = fx.claims(spark, sf_dir)
    return df.withColumns({"nz_claim": FE.nonzero_flag(F.col("claim_nb")),
                           "log_claim": FE.log_target(F.col("claim_nb"))})


def q_claims_features(spark, sf_dir):
    """Indexed categories, z-scored numbers, log and flag targets (E-01, E-03..E-07)."""
    df = claims_targets(spark, sf_dir)
    stages = [FE.indexer(CATS), FE.assembler(NUMS, "__num"), FE.scaler("__num", "__z")]
    out = FE.vector_columns(FE.fit_transform(df, stages), "__z", [c + "_z" for c in NUMS])
    return out.select("policy_id", "nz_claim", F.round("log_claim", 9).alias("log_claim"),
                      *[c + "_idx" for c in CATS], *[F.round(c + "_z", 6).alias(c + "_z") for c in NUMS])


def _idx_sql(c: str) -> str:
    return (f"idx_{c} AS (SELECT {c}, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 "
            f"AS DOUBLE) AS {c}_idx FROM claims GROUP BY {c})")


S_CLAIMS_FEATURES = f"""WITH {fx.CLAIMS_SQL},
{", ".join(_idx_sql(c) for c in CATS)},
stats AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in NUMS)} FROM claims)
SELECT policy_id, CASE WHEN claim_nb > 0 THEN 1 ELSE 0 END AS nz_claim,
  round(ln(CASE WHEN claim_nb = 0 THEN CAST(0.0001 AS DOUBLE) ELSE claim_nb END), 9) AS log_claim,
  {", ".join(f"{c}_idx" for c in CATS)},
  {", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}_z" for c in NUMS)}
FROM claims {" ".join(f"JOIN idx_{c} USING ({c})" for c in CATS)} CROSS JOIN stats"""


def _prepared(spark, sf_dir):
    """Train/test feature tables, split 70/30 by policy hash (repeatable).

    The joined claims table is written once to the shared folder; the
    indexer → one-hot → scaler chain is fitted on its training rows only
    (D-06), and its features are written too: every fit and every scoring
    pass below reads the written features.
    """
    df = cut_lineage(hash_split(claims_targets(spark, sf_dir), ["policy_id"], [0.7, 0.3], seed=SEED),
                     "claims")
    train, test = df.filter("part = 0"), df.filter("part = 1")
    prep = MO.pipeline(FE.tabular_stages(CATS, NUMS)).fit(train)
    cols = ["policy_id", "claim_nb", "log_claim", "nz_claim", "features", "part"]
    ready = cut_lineage(prep.transform(df).select(*cols), "claims-features")
    return ready.filter("part = 0").drop("part"), ready.filter("part = 1").drop("part")


def _claim_models():
    return [
        ("poisson", MO.poisson("claim_nb", REG, max_iter=50), "claim_nb", "regression"),
        ("linear_l1", MO.linear("log_claim", REG, 1.0, solver="normal", max_iter=50),
         "log_claim", "regression"),
        ("linear_l2", MO.linear("log_claim", REG, 0.0, solver="normal", max_iter=50),
         "log_claim", "regression"),
        ("logistic_l1", MO.logistic("nz_claim", REG, 1.0, "multinomial", 50), "nz_claim", "classification"),
        ("logistic_l2", MO.logistic("nz_claim", REG, 0.0, "multinomial", 50), "nz_claim", "classification"),
    ]


def _long_metrics(frame: DataFrame, model: str) -> DataFrame:
    cols = [c for c in frame.columns]
    return (frame.select(*[F.col(c).cast("double") for c in cols])
            .unpivot([], cols, "metric", "value").select(F.lit(model).alias("model"), "metric", "value"))


def q_glm_models(spark, sf_dir, families: tuple[str, ...] = ("poisson", "linear", "logistic")):
    """Poisson, L1/L2 linear and L1/L2 logistic fits on train, scored on test (J-13)."""
    train, test = _prepared(spark, sf_dir)
    specs = [m for m in _claim_models() if m[0].split("_")[0] in families]
    fitted = TU.fit_concurrently([(est, train) for _, est, _, _ in specs])
    # one long table (model, label, prediction, score) of all models, written once
    scores = None
    for (name, _est, label, kind), model in zip(specs, fitted):
        score = ME.positive_score() if kind == "classification" else F.lit(None).cast("double")
        part = model.transform(test).select(F.lit(name).alias("model"), F.col(label).cast("double").alias("label"),
                                            "prediction", score.alias("score"))
        scores = part if scores is None else scores.unionByName(part)
    scores = cut_lineage(scores, "claims-scores")
    out = None
    for name, _est, _label, kind in specs:
        pred = scores.filter(F.col("model") == name)
        if kind == "regression":
            part = _long_metrics(ME.regression_metrics(pred, "label", "prediction").select("rmse", "mse", "mae"), name)
        else:
            part = _long_metrics(ME.classification_metrics(pred, "label", "prediction")
                                 .select("accuracy", "weighted_f1"), name)
        out = part if out is None else out.unionByName(part)
    ranked = scores.filter(F.col("score").isNotNull())
    if any(kind == "classification" for *_, kind in specs):
        areas = ME.roc_auc(ranked, "label", "score", by="model")
        out = out.unionByName(areas.select("model", F.lit("auc").alias("metric"), F.col("auc").alias("value")))
    return out


def q_poisson(spark, sf_dir):
    """Poisson regression with log link on the claim count (M-03)."""
    return q_glm_models(spark, sf_dir, ("poisson",))


def q_linreg(spark, sf_dir):
    """L1 and L2 linear regression on the log claim count (M-02)."""
    return q_glm_models(spark, sf_dir, ("linear",))


def q_logistic(spark, sf_dir):
    """L1 and L2 multinomial-family logistic regression on the non-zero flag (M-04)."""
    return q_glm_models(spark, sf_dir, ("logistic",))


def q_model_coefficients(spark, sf_dir):
    """Named, dense coefficient tables of the five claim models (M-18)."""
    train, _ = _prepared(spark, sf_dir)
    names = MO.feature_names(train, "features")
    specs = _claim_models()
    fitted = TU.fit_concurrently([(est, train) for _, est, _, _ in specs])
    out = None
    for (name, _est, _label, _kind), model in zip(specs, fitted):
        part = MO.coefficient_table(spark, model, names, name)
        out = part if out is None else out.unionByName(part)
    return out


def q_cv_curve(spark, sf_dir):
    """Validation curves over regParam on a 10% sample for five models (J-14, M-19..M-23).

    Folds re-fit the model only; the encoders were fitted on the whole
    training side before the sample was drawn.  The sample is written with its
    folds, so no fit draws it again from all rows.
    """
    train, _ = _prepared(spark, sf_dir)
    subset = TU.written_folds(bernoulli_sample(train, 0.1, seed=SEED), 3, SEED)
    out = None
    for name, est, label, kind in _claim_models():
        final = est
        if kind == "regression":
            ev = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")
        else:
            from pyspark.ml.evaluation import MulticlassClassificationEvaluator
            ev = MulticlassClassificationEvaluator(labelCol=label, metricName="f1")
        cvm = TU.cross_validate(est, TU.grid([(final.regParam, REG_GRID)]), ev, subset,
                                folds=3, seed=SEED, parallelism=4, fold_col="fold")
        part = TU.validation_curve(spark, cvm, name)
        out = part if out is None else out.unionByName(part)
    return out


def q_linreg_one_feature(spark, sf_dir):
    """Unpenalised one-feature least squares: extended price on quantity (M-01)."""
    li = read_table(spark, sf_dir, "lineitem", ["l_quantity", "l_extendedprice"])
    data = FE.fit_transform(li, [FE.assembler(["l_quantity"])])
    model = MO.linear("l_extendedprice", 0.0, solver="normal").fit(data)
    rmse = ME.regression_metrics(model.transform(data), "l_extendedprice", "prediction")
    return rmse.select(F.round(F.lit(float(model.coefficients[0])), 4).alias("slope"),
                       F.round(F.lit(float(model.intercept)), 4).alias("intercept"),
                       F.round("rmse", 4).alias("rmse"), "n")


S_LINREG_ONE_FEATURE = """
SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
       round(sqrt((regr_syy(l_extendedprice, l_quantity)
                   - regr_sxy(l_extendedprice, l_quantity) * regr_sxy(l_extendedprice, l_quantity)
                     / regr_sxx(l_extendedprice, l_quantity)) / count(*)), 4) AS rmse,
       count(*) AS n
FROM lineitem"""


def q_linreg_sweep(spark, sf_dir):
    """Test RMSE of linear regression for regParam 0/.1/.2/.5 on a 60/40 hash split (M-01)."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_extendedprice"])
    data = FE.fit_transform(hash_split(li, ["l_orderkey", "l_linenumber"], [0.6, 0.4], seed=SEED),
                            [FE.assembler(["l_quantity", "l_discount", "l_tax"])])
    train, test = data.filter("part = 0"), data.filter("part = 1")
    fitted = TU.fit_concurrently([(MO.linear("l_extendedprice", reg), train) for reg in SWEEP])
    out = None
    for reg, model in zip(SWEEP, fitted):
        m = ME.regression_metrics(model.transform(test), "l_extendedprice", "prediction").select(
            F.lit(reg).alias("reg_param"), "rmse")
        out = m if out is None else out.unionByName(m)
    return out


def q_metric_table(spark, sf_dir):
    """RMSE/MSE/MAE/R², accuracy, weighted F1 and exact ROC area as aggregates (Y-01..Y-05).

    Scored columns of ``lineitem``: regression y = quantity, ŷ = floor(price/2000);
    classification y = returned, score = discount, prediction = discount ≥ 0.05.
    """
    li = read_table(spark, sf_dir, "lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_returnflag"])
    scored = li.select(F.col("l_quantity").alias("y"),
                       F.floor(F.col("l_extendedprice") / 2000.0).cast("double").alias("y_hat"),
                       (F.col("l_returnflag") == "R").cast("int").alias("label"),
                       F.col("l_discount").alias("score"),
                       (F.col("l_discount") >= 0.05).cast("int").alias("prediction"))
    reg = ME.regression_metrics(scored, "y", "y_hat").select("rmse", "mse", "mae", "r2")
    cls = ME.classification_metrics(scored, "label", "prediction").select(
        "accuracy", "weighted_precision", "weighted_recall", "weighted_f1")
    auc = ME.roc_auc(scored, "label", "score")
    out = _long_metrics(reg, "").unionByName(_long_metrics(cls, "")).unionByName(_long_metrics(auc, ""))
    return out.select("metric", F.round("value", 9).alias("value"))


S_METRIC_TABLE = """
WITH s AS (
  SELECT l_quantity AS y, CAST(floor(l_extendedprice / CAST(2000 AS DOUBLE)) AS DOUBLE) AS y_hat,
         CAST(l_returnflag = 'R' AS INTEGER) AS label, l_discount AS score,
         CAST(l_discount >= 0.05 AS INTEGER) AS prediction
  FROM lineitem),
reg AS (
  SELECT avg((y - y_hat) * (y - y_hat)) AS mse, avg(abs(y - y_hat)) AS mae, var_pop(y) AS v FROM s),
conf AS (SELECT label, prediction, count(*) AS n FROM s GROUP BY 1, 2),
per AS (
  SELECT l.label, l.n_true, l.tp, coalesce(p.n_pred, 0) AS n_pred FROM
    (SELECT label, sum(n) AS n_true, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp
     FROM conf GROUP BY label) l
    LEFT JOIN (SELECT prediction AS label, sum(n) AS n_pred FROM conf GROUP BY prediction) p
    ON l.label = p.label),
per2 AS (
  SELECT n_true, tp,
    CASE WHEN n_pred > 0 THEN CAST(tp AS DOUBLE) / n_pred ELSE 0.0 END AS pr,
    CAST(tp AS DOUBLE) / n_true AS rc FROM per),
cls AS (
  SELECT CAST(sum(tp) AS DOUBLE) / sum(n_true) AS accuracy,
    sum(pr * n_true) / sum(n_true) AS wp, sum(rc * n_true) / sum(n_true) AS wr,
    sum(CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END * n_true) / sum(n_true) AS wf
  FROM per2),
ps AS (
  SELECT score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
         sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg
  FROM s GROUP BY score),
cum AS (
  SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING
                                           AND 1 PRECEDING), 0) AS neg_before FROM ps),
auc AS (
  SELECT sum(CAST(pos AS DOUBLE) * (CAST(neg_before AS DOUBLE) + neg * 0.5))
         / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc FROM cum)
SELECT metric, round(value, 9) AS value FROM (
  SELECT 'rmse' AS metric, sqrt(mse) AS value FROM reg
  UNION ALL SELECT 'mse', mse FROM reg
  UNION ALL SELECT 'mae', mae FROM reg
  UNION ALL SELECT 'r2', 1.0 - mse / v FROM reg
  UNION ALL SELECT 'accuracy', accuracy FROM cls
  UNION ALL SELECT 'weighted_precision', wp FROM cls
  UNION ALL SELECT 'weighted_recall', wr FROM cls
  UNION ALL SELECT 'weighted_f1', wf FROM cls
  UNION ALL SELECT 'auc', auc FROM auc)"""


def q_roc_auc_fine(spark, sf_dir):
    """ROC area of a score with many distinct values: extended price against returned (Y-05)."""
    li = read_table(spark, sf_dir, "lineitem", ["l_extendedprice", "l_returnflag"])
    scored = li.select((F.col("l_returnflag") == "R").cast("int").alias("label"), F.col("l_extendedprice").alias("s"))
    return ME.roc_auc(scored, "label", "s").select(F.round("auc", 9).alias("auc"))


S_ROC_AUC_FINE = """
WITH ps AS (
  SELECT l_extendedprice AS s, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS pos,
         sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END) AS neg FROM lineitem GROUP BY 1),
cum AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        AS below FROM ps)
SELECT round(sum(CAST(pos AS DOUBLE) * (CAST(below AS DOUBLE) + neg * 0.5))
             / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 9) AS auc FROM cum"""


QUERIES = {
    "roc_auc_fine": q_roc_auc_fine,
    "claims_features": q_claims_features,
    "glm_models": q_glm_models,
    "poisson": q_poisson,
    "linreg": q_linreg,
    "logistic": q_logistic,
    "model_coefficients": q_model_coefficients,
    "cv_curve": q_cv_curve,
    "linreg_one_feature": q_linreg_one_feature,
    "linreg_sweep": q_linreg_sweep,
    "metric_table": q_metric_table,
}

ORACLES = {
    "roc_auc_fine": S_ROC_AUC_FINE,
    "claims_features": S_CLAIMS_FEATURES,
    "linreg_one_feature": S_LINREG_ONE_FEATURE,
    "metric_table": S_METRIC_TABLE,
}
