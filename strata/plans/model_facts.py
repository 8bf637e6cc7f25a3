"""Facts of fitted models that SQL can state from the data alone (M-01 .. M-04, M-10 .. M-16, A-01 .. A-08).

An unpenalised model with an intercept and dummy slots reproduces the observed
total of every level of every category (its score equations); components are
unit vectors that the covariance only stretches; a score is the product of its
two factors.  Each query fits the model and reports what must then hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import decompose as D
from ..operators import features as FE
from ..operators import metrics as ME
from ..operators import models as MO
from ..operators import tune as TU
from ..session import cut_lineage
from . import fixtures as fx
from .ml_claims import CATS, NUMS, claims_targets
from .ml_decompose import WIDTH, _embeddings, _standardised
from .ml_recommend import _fit, _ratings


def q_glm_margins(spark, sf_dir):
    """Fitted against observed totals per category level, unpenalised fits on all claims (M-01, M-03, M-04, J-13)."""
    claims = claims_targets(spark, sf_dir)
    prep = MO.pipeline(FE.tabular_stages(CATS, NUMS)).fit(claims)
    ready = cut_lineage(prep.transform(claims).select("claim_nb", "nz_claim", "features", *CATS), "claims-all")
    specs = [("poisson", MO.poisson("claim_nb", max_iter=50).setTol(1e-10), F.col("prediction")),
             ("linear", MO.linear("claim_nb", solver="normal"), F.col("prediction")),
             ("logistic", MO.logistic("nz_claim", family="binomial", max_iter=300).setTol(1e-10),
              ME.positive_score("probability"))]
    out = None
    for (name, _, fitted), model in zip(specs, TU.fit_concurrently([(est, ready) for _, est, _ in specs])):
        rows = model.transform(ready).select(fitted.alias("__f"), *CATS).unpivot(
            ["__f"], CATS, "feature", "level")
        part = rows.groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n"),
                                                    F.round(F.sum("__f"), 1).alias("total"))
        part = part.select(F.lit(name).alias("model"), "feature", "level", "n", "total")
        out = part if out is None else out.unionByName(part)
    return out


S_GLM_MARGINS = f"WITH {fx.CLAIMS_SQL}\n" + "\nUNION ALL\n".join(
    f"""SELECT '{model}' AS model, '{c}' AS feature, {c} AS level, count(*) AS n,
  CAST(sum({target}) AS DOUBLE) AS total FROM claims GROUP BY {c}"""
    for model, target in (("poisson", "claim_nb"), ("linear", "claim_nb"),
                          ("logistic", "CASE WHEN claim_nb > 0 THEN 1 ELSE 0 END")) for c in CATS)


def q_als_score_facts(spark, sf_dir):
    """Predicted ratings as products of the two factors, for every rating of every user (M-10, M-16)."""
    ratings = _ratings(spark, sf_dir)
    model = _fit(ratings, "default", light=True)
    user = model.userFactors.select(F.col("id").alias("user_id"), F.col("features").alias("uf"))
    item = model.itemFactors.select(F.col("id").alias("item_id"), F.col("features").alias("vf"))
    dot = F.aggregate(F.zip_with("uf", "vf", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0),
                      lambda acc, x: acc + x)
    # each side's factors join next to the model's own look-up by the same key: no further exchange of the ratings
    known = ratings.select("user_id", "item_id", "rating").join(user, "user_id")
    scored = model.transform(known).join(item, "item_id")
    return scored.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_ratings"), F.min("rating").alias("lowest"), F.max("rating").alias("highest"),
        F.min(F.abs(dot - F.col("prediction")) < 1e-3).alias("scores_are_products"))


S_ALS_SCORE_FACTS = f"""WITH {fx.RATINGS_SQL}
SELECT user_id, count(*) AS n_ratings, min(rating) AS lowest, max(rating) AS highest, TRUE AS scores_are_products
FROM ratings GROUP BY user_id"""


def _symmetric(cov: DataFrame) -> DataFrame:
    cov = cov.select(F.col("i").cast("int").alias("i"), F.col("j").cast("int").alias("j"), "cov")
    return cov.unionByName(cov.filter("i <> j").select(F.col("j").alias("i"), F.col("i").alias("j"), "cov"))


def q_pca_facts(spark, sf_dir):
    """Components against the covariance: C v = λ v, unit length, and λ as the variance of the projection
    (A-01, A-04, A-06, A-08)."""
    data = _embeddings(spark, sf_dir)
    model = D.pca(data, 2)
    cov = cut_lineage(_symmetric(D.covariance_table(spark, data, names=[str(i) for i in range(WIDTH)])), "cov")
    load = D.components_table(spark, model, [str(i) for i in range(WIDTH)]).select(
        F.col("feature").cast("int").alias("j"), "component", "loading")
    trace = cov.filter("i = j").select(F.sum("cov")).scalar()
    share = D.variance_table(spark, model)
    turned = cov.join(F.broadcast(load), "j").groupBy("component", "i").agg(F.sum(F.col("cov") * F.col("loading")).alias("cv"))
    cells = (turned.join(load.withColumnRenamed("j", "i"), ["component", "i"]).join(share, "component")
                   .withColumn("stretch", F.col("explained_variance") * trace))
    spread = D.project(model, data, ["vec_id"]).agg(F.var_samp("pc1").alias("s1"), F.var_samp("pc2").alias("s2"))
    spread = spread.select(F.inline(F.array(F.struct(F.lit(1).alias("component"), F.col("s1").alias("spread")),
                                            F.struct(F.lit(2).alias("component"), F.col("s2").alias("spread")))))
    facts = cells.groupBy("component").agg(
        (F.max(F.abs(F.col("cv") - F.col("stretch") * F.col("loading"))) < 1e-9).alias("is_eigenvector"),
        F.round(F.sum(F.col("loading") * F.col("loading")), 6).alias("length"), F.max("stretch").alias("stretch"))
    return facts.join(spread, "component").select(
        "component", "is_eigenvector", "length",
        (F.abs(F.col("stretch") - F.col("spread")) < 1e-9).alias("is_variance"),
        F.round(trace, 6).alias("total_variance"))


_TRACE = " + ".join(f"var_samp(embedding[{i + 1}])" for i in range(WIDTH))
S_PCA_FACTS = f"""SELECT CAST(k AS INTEGER) AS component, TRUE AS is_eigenvector, CAST(1 AS DOUBLE) AS length,
  TRUE AS is_variance, t AS total_variance
FROM (SELECT round({_TRACE}, 6) AS t FROM embeddings), (VALUES (1), (2)) c(k)"""


def q_svd_facts(spark, sf_dir):
    """Left vectors: one row per input row and component, of unit length, orthogonal (A-05)."""
    std = _standardised(spark, sf_dir)
    u = cut_lineage(D.left_vectors(std, D.svd(std, 2), "vec_id"), "svd-u")
    both = u.groupBy("vec_id").agg(F.product("u").alias("uv")).select(F.sum("uv")).scalar()
    return u.groupBy("component").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum(F.col("u") * F.col("u")), 6)
                                      .alias("length")).withColumn("orthogonal", F.abs(both) < 1e-6)


S_SVD_FACTS = """SELECT CAST(k AS INTEGER) AS component, n AS n_rows, CAST(1 AS DOUBLE) AS length, TRUE AS orthogonal
FROM (SELECT count(*) AS n FROM embeddings), (VALUES (1), (2)) c(k)"""


QUERIES = {
    "glm_margins": q_glm_margins,
    "als_score_facts": q_als_score_facts,
    "pca_facts": q_pca_facts,
    "svd_facts": q_svd_facts,
}

ORACLES = {
    "glm_margins": S_GLM_MARGINS,
    "als_score_facts": S_ALS_SCORE_FACTS,
    "pca_facts": S_PCA_FACTS,
    "svd_facts": S_SVD_FACTS,
}
