"""Access-log parsing goldens and report invariants."""

from pyspark.sql import functions as F

from strata.operators import logs
from strata.operators.topk import top_k_per_group, top_one_per_group

# Golden lines and their parse, re-typed from a recorded run of the
# reference's log lab (August 1995 server log).
GOLDEN = [
    ('in24.inetnebr.com - - [01/Aug/1995:00:00:01 -0400] "GET /shuttle/missions/sts-68/news/sts-68-mcc-05.txt HTTP/1.0" 200 1839',
     ("in24.inetnebr.com", "01/Aug/1995:00:00:01 -0400",
      "GET /shuttle/missions/sts-68/news/sts-68-mcc-05.txt HTTP/1.0", 200, 1839)),
    ('uplherc.upl.com - - [01/Aug/1995:00:00:07 -0400] "GET / HTTP/1.0" 304 0',
     ("uplherc.upl.com", "01/Aug/1995:00:00:07 -0400", "GET / HTTP/1.0", 304, 0)),
    ('133.43.96.45 - - [01/Aug/1995:00:00:16 -0400] "GET /shuttle/missions/sts-69/mission-sts-69.html HTTP/1.0" 200 10566',
     ("133.43.96.45", "01/Aug/1995:00:00:16 -0400",
      "GET /shuttle/missions/sts-69/mission-sts-69.html HTTP/1.0", 200, 10566)),
    ('d0ucr6.fnal.gov - - [01/Aug/1995:00:00:20 -0400] "GET /history/apollo/apollo-16/apollo-16-patch-small.gif HTTP/1.0" 200 14897',
     ("d0ucr6.fnal.gov", "01/Aug/1995:00:00:20 -0400",
      "GET /history/apollo/apollo-16/apollo-16-patch-small.gif HTTP/1.0", 200, 14897)),
]


def test_parse_goldens(spark):
    lines = spark.createDataFrame([(g[0],) for g in GOLDEN], "value string")
    got = logs.parse_access_log(lines).select(*logs.PARSED_COLUMNS).collect()
    assert [tuple(r) for r in got] == [g[1] for g in GOLDEN]


def test_dirty_lines_do_not_fail(spark):
    lines = spark.createDataFrame([("garbage",), ("a.de - - [01/Aug/1995:00:00:01 -0400] \"GET /x HTTP/1.0\" 404 -",)],
                                  "value string")
    rows = logs.parse_access_log(lines).orderBy("host").collect()
    assert rows[0]["host"] == "" and rows[0]["malformed"] and rows[0]["reply_code"] is None
    assert rows[1]["reply_code"] == 404 and rows[1]["reply_bytes"] is None


def test_region_by_host_suffix_not_substring(spark):
    lines = spark.createDataFrame(
        [("x.com - - [01/Aug/1995:00:00:01 -0400] \"GET /a.de HTTP/1.0\" 200 1",),
         ("y.de - - [01/Aug/1995:00:00:01 -0400] \"GET /b HTTP/1.0\" 200 1",)], "value string")
    out = logs.region_summary(logs.parse_access_log(lines)).collect()
    assert [(r["region"], r["n_requests"]) for r in out] == [("Germany", 1)]


def test_topk_salted_equals_plain(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("g"), (F.col("id") % 101).alias("key"),
                                     ((F.col("id") * 7919) % 53).alias("score"))
    order = [F.col("score").desc(), F.col("key").asc(), F.col("id_").asc()]
    df = df.withColumn("id_", F.monotonically_increasing_id())
    a = top_k_per_group(df, ["g"], order, 7, salt_buckets=16).select("g", "rank", "id_").collect()
    b = top_k_per_group(df, ["g"], order, 7, salt_buckets=1).select("g", "rank", "id_").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert len(a) == 21


def test_top_one_tie_break(spark):
    df = spark.createDataFrame([("r", "b", 5), ("r", "a", 5), ("r", "c", 1)], "g string, h string, n int")
    row = top_one_per_group(df, ["g"], "h", "n").collect()[0]
    assert (row["h"], row["n"]) == ("a", 5)


def test_share_rest_sums_to_total(spark):
    from strata.plans.log_reports import parsed_log
    from .conftest import SMALL
    shares = logs.host_shares(parsed_log(spark, SMALL), k=9)
    summary = logs.region_summary(parsed_log(spark, SMALL))
    tot = {r["region"]: (r["n_requests"], r["n_hosts"]) for r in summary.collect()}
    for region, (n, hosts) in tot.items():
        rows = shares.filter(F.col("region") == region).collect()
        assert sum(r["n"] for r in rows) == n
        assert len(rows) == min(9, hosts) + 1
