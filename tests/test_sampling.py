"""Split invariants: disjoint, complete, exact per-stratum sizes, layout-free."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators import metrics as M
from strata.operators import sampling as S


def _frame(spark):
    # A skewed label: label 0 holds about two thirds of the rows.
    return spark.range(0, 20000).select(
        F.col("id").alias("key"), F.when(F.col("id") % 3 == 0, 1).otherwise(0).alias("label"))


def test_stratified_split_exact_and_disjoint(spark):
    df = _frame(spark).withColumn("label", F.when(F.col("key") % 10 == 9, F.lit(None)).otherwise(F.col("label")))
    out = S.stratified_split(df, "label", ["key"], 0.7, seed=5)
    assert out.count() == df.count() and out.columns == [*df.columns, "is_train"]
    assert out.select("key").distinct().count() == df.count()
    counts = {(r["label"], r["is_train"]): r["n"]
              for r in out.groupBy("label", "is_train").agg(F.count("*").alias("n")).collect()}
    for label in (0, 1, None):  # null labels are a label of their own
        n = counts[(label, True)] + counts[(label, False)]
        assert counts[(label, True)] == int(n * 0.7 + 0.5)


def test_stratified_split_edges(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "key int, label string")
    assert S.stratified_split(df, "label", ["key"], 1.0).filter("is_train").count() == 3
    assert S.stratified_split(df, "label", ["key"], 0.0).filter("is_train").count() == 0
    assert S.stratified_split(df.limit(0), "label", ["key"], 0.5).count() == 0


def test_stratified_split_independent_of_layout(spark):
    df = _frame(spark)
    a = S.stratified_split(df, "label", ["key"], 0.3, seed=1).filter("is_train").select("key")
    b = S.stratified_split(df.repartition(7), "label", ["key"], 0.3, seed=1).filter("is_train").select("key")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stratified_split_does_not_shuffle_whole_rows(spark):
    df = _frame(spark).withColumn("text", F.repeat(F.lit("x"), 100))
    plan = S.stratified_split(df, "label", ["key"], 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning(label" not in plan


def test_hash_split_complete_and_repeatable(spark):
    df = _frame(spark)
    a = S.hash_split(df, ["key"], [0.8, 0.2], seed=3)
    b = S.hash_split(df.repartition(5), ["key"], [0.8, 0.2], seed=3)
    assert a.count() == 20000
    assert a.exceptAll(b).count() == 0
    frac = a.filter("part = 0").count() / 20000
    assert 0.77 < frac < 0.83
    parts = {r["part"]: r["n"] for r in S.hash_split(df, ["key"], [0.5, 0.3, 0.2])
             .groupBy("part").agg(F.count("*").alias("n")).collect()}
    assert 9400 < parts[0] < 10600 and 5500 < parts[1] < 6500 and 3500 < parts[2] < 4500


def test_stratified_sample_by_fraction_table(spark):
    df = _frame(spark)
    table = spark.createDataFrame([(0, 0.5), (1, 0.1)], "label int, fraction double")
    n = {r["label"]: r["n"] for r in S.stratified_sample(df, "label", table, seed=2)
         .groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert 6200 < n[0] < 7200 and 550 < n[1] < 800


def test_time_split_cutoff_exact(spark):
    rows = [(i, dt.datetime(2024, 1, 1 + i // 10, i % 10)) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz")
    out = S.time_split(df, "ts", 0.35)
    train = out.filter("is_train").count()
    assert train == 35


def test_time_cutoffs_match_single(spark):
    rows = [(i, dt.datetime(2024, 1, 1 + (i * 7) % 20, i % 24)) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz")
    fr = (0.8, 0.35, 0.1)
    multi = S.time_cutoffs(df, "ts", fr).first()
    for i, f in enumerate(fr):
        assert multi[f"c{i}"] == S.time_cutoff(df, "ts", f).first()["cutoff"]


def test_cutoffs_and_roc_of_many_distinct_values(spark):
    """Far more distinct values than range bounds are sampled from, twice."""
    n = 240_000
    df = spark.range(0, n, 1, 8).select(
        F.expr("timestamp_micros(1700000000000000 + (id * 7919 % 240000) * 720000)").alias("ts"),
        (F.col("id") * 104729 % n).alias("score"), ((F.col("id") * 31 % 97) < 40).cast("int").alias("label"))
    start = df.agg(F.min("ts")).first()[0]
    for _ in range(2):
        got = S.time_cutoffs(df, "ts", (0.3, 0.8)).first()
        for c, f in zip(got, (0.3, 0.8)):
            assert (c - start) == dt.timedelta(microseconds=(int(n * f) - 1) * 720_000)
    rows = sorted((r["score"], r["label"]) for r in df.select("score", "label").collect())
    below = wins = 0
    for _, label in rows:
        wins += below if label else 0
        below += not label
    exact = wins / below / (n - below)
    for _ in range(2):
        assert abs(M.roc_auc(df, "label", "score").first()["auc"] - exact) < 1e-12
    both = df.withColumn("m", F.lit("a")).unionAll(df.select("ts", -F.col("score"), "label", F.lit("b")))
    areas = {r["m"]: r["auc"] for r in M.roc_auc(both, "label", "score", by="m").collect()}
    assert abs(areas["a"] - exact) < 1e-12 and abs(areas["b"] - (1 - exact)) < 1e-12


def test_rows_without_a_time_are_in_neither_part(spark):
    rows = [(i, f"2024-01-0{1 + i // 3} 0{i}:00:00" if i < 6 else None) for i in range(12)]
    df = spark.createDataFrame(rows, "id int, t string").withColumn("ts", F.col("t").cast("timestamp"))
    flags = {r["id"]: r["is_train"] for r in S.time_split(df, "ts", 0.5).collect()}
    assert [flags[i] for i in range(12)] == [True] * 3 + [False] * 3 + [None] * 6
    assert S.time_cutoffs(df, "ts", (0.5,)).first()["c0"] == S.time_cutoff(df, "ts", 0.5).first()["cutoff"]
    assert S.time_cutoff(df.filter("ts IS NULL"), "ts", 0.5).first()["cutoff"] is None


def test_area_leaves_out_rows_without_a_label_or_score(spark):
    rows = [(1, 0.9), (0, 0.1), (1, 0.4), (0, 0.4), (None, 0.2), (1, None), (0, float("nan"))]
    df = spark.createDataFrame(rows, "label int, score double")
    assert M.roc_auc(df, "label", "score").first()["auc"] == 0.875
