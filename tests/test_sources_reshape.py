"""Sources (CSV, text logs, schema read-back) and reshaping operators."""

import gzip
import os

from pyspark.sql import functions as F

from strata.operators import reshape
from strata.operators.genres import genre_ranking, largest_cluster
from strata.session import shared_path
from strata.sources.access_log import read_access_log
from strata.sources.delimited import read_delimited, rename_positional, write_delimited
from strata.sources.tables import schema_table, spread


def test_csv_positional_and_header(spark):
    df = spark.createDataFrame([(1, "a", 2.5), (2, "b", None)], "id int, s string, x double")
    path = write_delimited(df, shared_path(spark, "t-csv"), sep="\t")
    back = rename_positional(read_delimited(spark, path, sep="\t", infer=True), ["id", "s", "x"])
    assert sorted(map(tuple, back.collect())) == [(1, "a", 2.5), (2, "b", None)]
    hpath = write_delimited(df, shared_path(spark, "t-csv-h"), header=True)
    hb = read_delimited(spark, hpath, header=True, infer=True)
    assert hb.columns == ["id", "s", "x"]


def test_malformed_rows_become_null(spark):
    df = spark.createDataFrame([("1,a",), ("x,b",)], "value string")
    path = shared_path(spark, "t-bad")
    df.write.text(path)
    back = read_delimited(spark, path, schema="id int, s string")
    assert sorted(map(tuple, back.collect()), key=str) == [(1, "a"), (None, "b")]


def test_gzip_text_log_is_spread(spark, tmp_path):
    p = os.path.join(str(tmp_path), "log.gz")
    with gzip.open(p, "wt") as f:
        for i in range(50):
            f.write(f'h{i}.de - - [01/Aug/1995:00:00:{i % 60:02d} -0400] "GET / HTTP/1.0" 200 {i}\n')
    lines = read_access_log(spark, p, partitions=4)
    assert lines.rdd.getNumPartitions() == 4 and lines.count() == 50


def test_spread_only_when_narrow(spark):
    wide = spark.range(0, 100, numPartitions=64)
    assert spread(wide, 8) is wide
    assert spread(spark.range(0, 100, numPartitions=1), 8).rdd.getNumPartitions() == 8


def test_declared_table_and_widening_union(spark):
    from strata.sources.tables import declared_table
    empty = declared_table(spark, "split double, genre string")
    assert empty.count() == 0 and empty.columns == ["split", "genre"]
    rows = declared_table(spark, "split int, genre string", [(1, "a")])
    out = empty.unionByName(rows.withColumn("split", F.col("split").cast("double")))
    assert [tuple(r) for r in out.collect()] == [(1.0, "a")]


def test_schema_table(spark):
    df = spark.createDataFrame([(1, "a")], "id long, s string")
    rows = schema_table(df).collect()
    assert [(r["name"], r["type"]) for r in rows] == [("id", "bigint"), ("s", "string")]


def test_transpose_round_trip(spark):
    wide = spark.createDataFrame([("w1", 1, 2), ("w2", 3, 4)], "word string, p1 int, p2 int")
    long = reshape.to_long(wide, "word", key_name="paper", value_name="n")
    t = reshape.transpose_long(long, "word", "paper")
    back = reshape.transpose_long(t, "word", "paper")
    assert sorted(map(tuple, back.select("word", "paper", "n").collect())) == \
        sorted(map(tuple, long.select("word", "paper", "n").collect()))
    papers = reshape.to_wide(t.withColumnRenamed("paper", "p"), "word", "p", "n", ["w1", "w2"])
    got = {r["word"]: (r["w1"], r["w2"]) for r in papers.collect()}
    assert got == {"p1": (1, 3), "p2": (2, 4)}


def test_token_counts_skip_empty(spark):
    df = spark.createDataFrame([("a|b|",), ("b",)], "g string")
    got = {r["token"]: r["n"] for r in reshape.token_counts(df, "g").collect()}
    assert got == {"a": 1, "b": 2}


def test_genre_ranking_small(spark):
    assign = spark.createDataFrame([(1, 0), (1, 0), (2, 0), (3, 1)], "user_id int, cluster int")
    ratings = spark.createDataFrame([(1, 10, 5.0), (2, 10, 4.0), (2, 11, 1.0), (3, 12, 5.0)],
                                    "user_id int, item_id int, rating double")
    cat = spark.createDataFrame([(10, "x|y"), (11, "y"), (12, "z")], "item_id int, genres string")
    assert largest_cluster(assign).first()["cluster"] == 0
    out = genre_ranking(assign, ratings, cat, "user_id", "item_id", "rating", "genres", 3.0, k=5)
    assert [(r["rank"], r["genre"], r["n"]) for r in out.orderBy("rank").collect()] == \
        [(1, "x", 1), (2, "y", 1)]


def test_wide_lines_are_built_in_small_groups(spark, tmp_path, monkeypatch):
    from strata.sources import wide
    monkeypatch.setattr(wide, "LINES", 3)
    cells = spark.range(40).selectExpr("id % 10 AS row", "concat('c', id % 7) AS column", "id + 1.0D AS value") \
        .groupBy("row", "column").agg({"value": "max"}).toDF("row", "column", "value")
    path = wide.write_wide_matrix(cells, [f"c{i}" for i in range(7)], str(tmp_path / "wide"), tasks=1)
    found, rejects = wide.read_wide_matrix(spark, path)
    assert rejects.count() == 0
    assert {(int(r["row"]), r["column"], r["value"]) for r in found.collect()} == {
        (r["row"], r["column"], r["value"]) for r in cells.collect()}
