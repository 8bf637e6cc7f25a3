"""Invariants of registered model queries, and layout independence of
deterministic operators (SURVEY §5)."""

import numpy as np
from pyspark.sql import functions as F

from __spark_entry__ import queries
from strata.operators import genres, logs, sampling, topk
from strata.plans import fixtures as fx
from strata.plans.log_reports import parsed_log

from .conftest import SMALL


def _same(a, b):
    return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_reports_independent_of_layout(spark):
    p = parsed_log(spark, SMALL)
    q = p.repartition(7, "line_id")
    assert _same(logs.top_hosts(p, 9), logs.top_hosts(q, 9))
    assert _same(logs.host_shares(p, 9), logs.host_shares(q, 9))
    assert _same(logs.top_host_day_hour(p), logs.top_host_day_hour(q))


def test_kmeans_assigns_nearest_centre(spark):
    assigned = {r["vec_id"]: r["cluster"] for r in queries()["kmeans_assign"](spark, SMALL).collect()}
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    x = np.array([r["embedding"] for r in rows], float)
    of = np.array([assigned[r["vec_id"]] for r in rows])
    assert len(assigned) == len(rows) > 0
    centres = np.stack([x[of == c].mean(axis=0) for c in range(10)])  # converged: means of their members
    nearest = ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (nearest == of).mean() > 0.98


def test_repeated_users_weigh_as_often_as_listed(spark):
    ratings = spark.createDataFrame([(1, 7, 10), (2, 7, 40), (2, 8, None), (3, 7, 50)], "u int, i int, r long")
    users = spark.createDataFrame([(1,), (2,), (2,)], "u int")
    out = {r["i"]: (r["n_ratings"], r["avg_rating"]) for r in
           genres.item_means(ratings, "i", "r", users=users, user_col="u").collect()}
    assert out == {7: (3, 30.0), 8: (2, None)}


def test_md5_sample_follows_the_key(spark):
    df = spark.range(4000).withColumn("g", F.col("id") % 2)
    picked = sampling.md5_sample(df, ["id"], 0.25, seed=5)
    assert _same(picked, sampling.md5_sample(df.repartition(9), ["id"], 0.25, seed=5))
    assert 850 < picked.count() < 1150
    shares = spark.createDataFrame([(0, 1.0)], "g long, fraction double")
    assert _same(sampling.md5_sample(df, ["id"], shares, "g"), df.filter("g = 0"))


def test_frequent_values_are_exact(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 3 + [("c",)] + [(None,)] * 5, "v string")
    assert sorted(map(tuple, topk.frequent_values(df, "v", 0.3).collect())) == [("a", 6), ("b", 3)]
    assert topk.frequent_values(df.limit(0), "v", 0.3).count() == 0


def test_pca_components_orthonormal_and_shares(spark):
    comp = queries()["pca_components"](spark, SMALL).collect()
    m = np.zeros((64, 2))
    for r in comp:
        m[int(r["feature"][1:]), r["component"] - 1] = r["loading"]
    assert np.allclose(m.T @ m, np.eye(2), atol=1e-9)
    shares = [r["explained_variance"] for r in queries()["pca_variance"](spark, SMALL).collect()]
    assert all(0 <= s <= 1 for s in shares) and sum(shares) <= 1 + 1e-12
    assert shares == sorted(shares, reverse=True)


def test_time_split_partitions_ratings(spark):
    r = fx.ratings(spark, SMALL)
    out = {row["is_train"]: row["n_rows"] for row in queries()["split_time"](spark, SMALL).collect()}
    assert sum(out.values()) == r.count()
    assert abs(out[True] - 0.8 * r.count()) <= r.groupBy("ts").count().agg(F.max("count")).first()[0]


def test_hash_split_counts_complete(spark):
    out = queries()["split_hash"](spark, SMALL).collect()
    assert sum(r["n"] for r in out) == fx.ratings(spark, SMALL).count()


def test_als_topn_lists_ordered(spark):
    recs = queries()["als_topn_users"](spark, SMALL)
    bad = (recs.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"),
                                       F.count_distinct("item_id").alias("d"))
               .filter((F.col("n") > 10) | (F.col("n") != F.col("d"))).count())
    assert bad == 0


def test_freq_items_superset_of_frequent_hosts(spark):
    items = set(queries()["freq_items"](spark, SMALL).first()["host_freqItems"])
    hosts = parsed_log(spark, SMALL).groupBy("host").count()
    total = hosts.agg(F.sum("count")).first()[0]
    frequent = {r["host"] for r in hosts.filter(F.col("count") > 0.01 * total).collect()}
    assert frequent and frequent <= items
