"""Split and sample queries (B-01 .. B-08)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sampling as S
from ..sources.tables import read_table
from . import fixtures as fx

# 70/30 split, 0.8 time fraction and seed 37 of the reference jobs.
TRAIN_FRACTION = 0.7
TIME_FRACTION = 0.8
SEED = 37
CUT_FRACTIONS = (0.1, 0.35, 0.8)
MD5_WEIGHTS = [0.7, 0.2, 0.1]


def q_split_time(spark, sf_dir):
    """Time-ordered 0.8 split of ratings: sizes and date ranges per side (B-07)."""
    r = S.time_split(fx.ratings(spark, sf_dir).select("ts"), "ts", TIME_FRACTION)
    return r.groupBy("is_train").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.date_format(F.min("ts"), "yyyy-MM-dd").alias("first_day"),
        F.date_format(F.max("ts"), "yyyy-MM-dd").alias("last_day"))


S_SPLIT_TIME = f"""WITH {fx.RATINGS_SQL},
cut AS (
  SELECT min(ts) AS cutoff FROM (
    SELECT ts, sum(count(*)) OVER (ORDER BY ts) AS cum FROM ratings GROUP BY ts)
  WHERE cum >= greatest(((SELECT count(*) FROM ratings) * {2 * int(round(TIME_FRACTION * 1e6))}
                         + 1000000) // 2000000, 1))
SELECT ts <= (SELECT cutoff FROM cut) AS is_train, count(*) AS n_rows,
       strftime(min(ts), '%Y-%m-%d') AS first_day, strftime(max(ts), '%Y-%m-%d') AS last_day
FROM ratings GROUP BY 1"""


def _claims_labelled(spark, sf_dir):
    return fx.claims(spark, sf_dir).withColumn("nz_claim", (F.col("claim_nb") > 0).cast("int"))


def q_split_stratified(spark, sf_dir):
    """Exact disjoint 0.7 split per label of the non-zero-claim flag (B-08)."""
    split = S.stratified_split(_claims_labelled(spark, sf_dir), "nz_claim", ["policy_id"],
                               TRAIN_FRACTION, seed=SEED)
    return split.groupBy("nz_claim", "is_train").agg(F.count(F.lit(1)).alias("n"))


S_SPLIT_STRATIFIED = f"""WITH {fx.CLAIMS_SQL},
per_label AS (
  SELECT CAST(claim_nb > 0 AS INTEGER) AS nz_claim, count(*) AS n FROM claims GROUP BY 1),
targets AS (
  SELECT nz_claim, n, (n * {2 * int(round(TRAIN_FRACTION * 1e6))} + 1000000) // 2000000 AS t
  FROM per_label)
SELECT nz_claim, TRUE AS is_train, t AS n FROM targets WHERE t > 0
UNION ALL
SELECT nz_claim, FALSE AS is_train, n - t AS n FROM targets WHERE n - t > 0"""


def q_split_hash(spark, sf_dir):
    """Key-hash 0.8/0.2 split of ratings; layout-independent (B-01 repeatable form)."""
    r = S.hash_split(fx.ratings(spark, sf_dir), ["order_key", "item_id"], [0.8, 0.2], seed=SEED)
    return r.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


def q_split_random(spark, sf_dir):
    """Spark's seeded randomSplit 0.7/0.3 of the claims table (B-01)."""
    train, test = S.random_split(fx.claims(spark, sf_dir), [0.7, 0.3], SEED)
    return (train.withColumn("part", F.lit(0)).unionByName(test.withColumn("part", F.lit(1)))
            .groupBy("part").agg(F.count(F.lit(1)).alias("n")))


def q_sample_stratified(spark, sf_dir):
    """Per-label 1/2 Bernoulli sample of the collision table (B-04, B-05, B-06)."""
    df = fx.collisions(spark, sf_dir)
    sample = S.stratified_sample(df, "label", S.constant_fractions(df, "label", 0.5), seed=42)
    return sample.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def q_sample_bernoulli(spark, sf_dir):
    """10% Bernoulli row sample of the claims table, seeded (B-02)."""
    return S.bernoulli_sample(fx.claims(spark, sf_dir), 0.1, seed=SEED).agg(
        F.count(F.lit(1)).alias("n"))


def q_event_cutoffs(spark, sf_dir):
    """Exact time cut-offs of the events at several fractions, microsecond stamps (B-07)."""
    events = read_table(spark, sf_dir, "events", ["ts"])
    row = S.time_cutoffs(events, "ts", CUT_FRACTIONS)
    return row.select(*[F.date_format(f"c{i}", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(f"c{i}")
                        for i in range(len(CUT_FRACTIONS))])


def _cut(f: float) -> str:
    return f"""(SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') FROM (
    SELECT ts, sum(count(*)) OVER (ORDER BY ts) AS cum FROM events GROUP BY ts)
  WHERE cum >= greatest(((SELECT count(*) FROM events) * {2 * int(round(f * 1e6))} + 1000000) // 2000000, 1))"""


S_EVENT_CUTOFFS = "SELECT " + ", ".join(f"{_cut(f)} AS c{i}" for i, f in enumerate(CUT_FRACTIONS))


def q_split_md5(spark, sf_dir):
    """Key-hash 0.7/0.2/0.1 split of the orders by md5, the same in any engine (B-01)."""
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey"])
    return S.md5_split(orders, ["o_orderkey"], MD5_WEIGHTS, seed=SEED)


_EDGES = [S.md5_edge(sum(MD5_WEIGHTS[:i]) / sum(MD5_WEIGHTS)) for i in (1, 2)]
S_SPLIT_MD5 = f"""SELECT o_orderkey, CASE
  WHEN substr(md5('{SEED}|' || CAST(o_orderkey AS VARCHAR)), 1, 8) < '{_EDGES[0]}' THEN 0
  WHEN substr(md5('{SEED}|' || CAST(o_orderkey AS VARCHAR)), 1, 8) < '{_EDGES[1]}' THEN 1
  ELSE 2 END AS part FROM orders"""


QUERIES = {
    "event_cutoffs": q_event_cutoffs,
    "split_md5": q_split_md5,
    "split_time": q_split_time,
    "split_stratified": q_split_stratified,
    "split_hash": q_split_hash,
    "split_random": q_split_random,
    "sample_stratified": q_sample_stratified,
    "sample_bernoulli": q_sample_bernoulli,
}

ORACLES = {
    "event_cutoffs": S_EVENT_CUTOFFS,
    "split_md5": S_SPLIT_MD5,
    "split_time": S_SPLIT_TIME,
    "split_stratified": S_SPLIT_STRATIFIED,
}
