"""Stand-in inputs derived by Spark from the driver tables.

Each reference input (ratings, movies, claims, labelled text, collision
events, word × paper counts) is mapped onto the driver tables so every
query's work grows with them.  SQL twins of the same derivations feed the
DuckDB oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, item_id, rating, rating_tenths, ts) from ``lineitem ⋈ orders``.

    user = order's customer, item = part, rating = quantity / 10 (0.1–5.0),
    ts = order date.  ``rating_tenths`` is the same rating as an exact
    integer (used where means must be exact).  Keys stay 64-bit: ALS does
    its own checked cast to int, and nothing else needs narrower ids.
    """
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_quantity"])
    od = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    return (li.join(od, li.l_orderkey == od.o_orderkey, "inner")
              .select(F.col("o_custkey").alias("user_id"),
                      F.col("l_partkey").alias("item_id"),
                      (F.col("l_quantity") / 10.0).alias("rating"),
                      F.col("l_quantity").cast("long").alias("rating_tenths"),
                      F.col("o_orderdate").alias("ts"),
                      F.col("l_orderkey").alias("order_key")))


RATINGS_SQL = """
ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         l_quantity / 10.0 AS rating, CAST(l_quantity AS BIGINT) AS rating_tenths,
         o_orderdate AS ts, l_orderkey AS order_key
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, title, genres): genres = type | brand | words of the part name."""
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type"])
    genres = F.concat_ws("|", F.col("p_type"), F.col("p_brand"),
                         F.regexp_replace(F.col("p_name"), " ", "|"))
    return part.select(F.col("p_partkey").alias("item_id"),
                       F.col("p_name").alias("title"), genres.alias("genres"))


CATALOGUE_SQL = """
catalogue AS (
  SELECT p_partkey AS item_id, p_name AS title,
         concat_ws('|', p_type, p_brand, replace(p_name, ' ', '|')) AS genres
  FROM part)
"""


def user_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, cluster): a deterministic clustering of users by market segment."""
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    return cust.select(F.col("c_custkey").alias("user_id"),
                       F.col("c_mktsegment").alias("cluster"))


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claim-frequency table: one row per order (J-13 stand-in).

    claim_nb = returned lines (``l_returnflag = 'R'``; zero kept by a left
    join), exposure = line count; categories: order status, priority,
    market segment, region; numbers: total price, account balance.
    """
    od = read_table(spark, sf_dir, "orders",
                    ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"])
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_returnflag"])
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    per_order = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum((F.col("l_returnflag") == "R").cast("long")).alias("n_returned"))
    # nation and region are fixed-size dimensions (25 and 5 rows).
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "r_name")
    return (od.join(per_order, od.o_orderkey == per_order.l_orderkey, "left")
              .join(cust, od.o_custkey == cust.c_custkey, "inner")
              .join(F.broadcast(geo), cust.c_nationkey == geo.n_nationkey, "inner")
              .select(F.col("o_orderkey").alias("policy_id"),
                      F.coalesce(F.col("n_returned"), F.lit(0)).cast("double").alias("claim_nb"),
                      F.coalesce(F.col("n_lines"), F.lit(0)).cast("double").alias("exposure"),
                      F.col("o_totalprice").alias("total_price"),
                      F.col("c_acctbal").alias("acct_balance"),
                      F.col("o_orderstatus").alias("status"),
                      F.col("o_orderpriority").alias("priority"),
                      F.col("c_mktsegment").alias("segment"),
                      F.col("r_name").alias("region")))


CLAIMS_SQL = """
per_order AS (
  SELECT l_orderkey, count(*) AS n_lines,
         sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n_returned
  FROM lineitem GROUP BY l_orderkey),
claims AS (
  SELECT o_orderkey AS policy_id,
         CAST(coalesce(n_returned, 0) AS DOUBLE) AS claim_nb,
         CAST(coalesce(n_lines, 0) AS DOUBLE) AS exposure,
         o_totalprice AS total_price, c_acctbal AS acct_balance,
         o_orderstatus AS status, o_orderpriority AS priority,
         c_mktsegment AS segment, r_name AS region
  FROM orders LEFT JOIN per_order ON o_orderkey = l_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)
"""

CLAIM_CATEGORIES = ["status", "priority", "segment", "region"]
CLAIM_NUMERICS = ["exposure", "total_price", "acct_balance"]


def collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, label, f0..f63): embeddings with label < 5 as the positive class."""
    emb = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    width = 64
    return emb.select("vec_id", (F.col("label") < 5).cast("double").alias("label"),
                      *[F.col("embedding")[i].cast("double").alias(f"f{i}") for i in range(width)])


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text, label) for documents with a quality label."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"], spread_out=True)
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    return docs.join(labels, "doc_id", "inner").select(
        "doc_id", "text", F.col("quality").cast("double").alias("label"))
