"""Source, schema and sampling basics with SQL twins (S-04 .. S-09, J-05, G-08, B-02 .. B-06)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import genres as G
from ..operators import sampling as S
from ..operators.topk import frequent_values
from ..session import cut_lineage, shared_path
from ..sources.delimited import read_delimited, rename_positional, write_delimited
from ..sources.tables import declared_table, read_table, schema_table
from . import fixtures as fx
from .relational import MIN_MEAN_TENTHS

SEED = 37
SUPPORT = 0.01
ROW_SHARE, LABEL_SHARE = 0.1, 0.5
#: Days to ship per order priority: a parameter table of literal rows.
TARGET_DAYS = [("1-URGENT", 1), ("2-HIGH", 3), ("3-MEDIUM", 7)]


def _orders_csv(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice"])
    path = write_delimited(orders, shared_path(spark, "csv-orders"))
    return read_delimited(spark, path, infer=True)


def q_csv_inferred(spark, sf_dir):
    """Headerless CSV with inferred types and positional names (S-04).

    The key is widened, since inference picks int or long by the values."""
    return _orders_csv(spark, sf_dir).withColumn("_c0", F.col("_c0").cast("long"))


S_CSV_INFERRED = "SELECT o_orderkey AS _c0, o_orderstatus AS _c1, o_totalprice AS _c2 FROM orders"


def q_csv_renamed(spark, sf_dir):
    """The same file under real names, summed up by status (S-06)."""
    named = rename_positional(_orders_csv(spark, sf_dir), ["order_key", "status", "price"])
    return named.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.max("price").alias("highest"),
                                       F.max("order_key").cast("long").alias("last_key"))


S_CSV_RENAMED = """SELECT o_orderstatus AS status, count(*) AS n, max(o_totalprice) AS highest,
  max(o_orderkey) AS last_key FROM orders GROUP BY 1"""


def q_declared_rows(spark, sf_dir):
    """Orders per priority next to literal rows, on top of an empty declared table (S-05, S-07, S-08)."""
    empty = declared_table(spark, "priority string, target_days int, n_orders long")
    targets = declared_table(spark, "priority string, target_days int", TARGET_DAYS)
    orders = (read_table(spark, sf_dir, "orders", ["o_orderpriority"])
              .groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count(F.lit(1)).alias("n_orders")))
    return empty.unionByName(orders.join(targets, "priority", "left").select("priority", "target_days", "n_orders"))


S_DECLARED_ROWS = f"""SELECT o_orderpriority AS priority, any_value(days) AS target_days, count(*) AS n_orders
FROM orders LEFT JOIN (VALUES {", ".join(f"('{p}', {d})" for p, d in TARGET_DAYS)}) t(p, days)
  ON p = o_orderpriority GROUP BY 1"""

PROFILED = ["event_id", "ts", "user_id", "event_type", "value"]


def q_table_profile(spark, sf_dir):
    """Position, name and type of the event columns (S-09), with their non-null counts."""
    events = read_table(spark, sf_dir, "events", PROFILED)
    counts = events.agg(*[F.count(c).alias(c) for c in PROFILED]).unpivot([], PROFILED, "name", "n_values")
    return schema_table(events).join(counts, "name").select("position", "name", "type", "n_values")


_SPARK_TYPE = ("CASE typeof({c}) WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' "
               "WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE typeof({c}) END")
S_TABLE_PROFILE = "\nUNION ALL\n".join(
    f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS name, any_value({_SPARK_TYPE.format(c=c)}) AS type, "
    f"count({c}) AS n_values FROM events" for i, c in enumerate(PROFILED))


def q_item_means_repeats(spark, sf_dir):
    """Item means of the largest segment in which a member counts once per rating made (J-05)."""
    r = cut_lineage(fx.ratings(spark, sf_dir).select("user_id", "item_id", "rating_tenths"), "ratings")
    assigned = r.select("user_id").join(fx.user_segments(spark, sf_dir), "user_id", "inner")
    users = G.largest_cluster_members(assigned, "user_id", distinct=False)
    means = G.item_means(r, "item_id", "rating_tenths", MIN_MEAN_TENTHS, users, "user_id")
    return means.select("item_id", "n_ratings", F.round("avg_rating", 9).alias("avg_rating"))


S_ITEM_MEANS_REPEATS = f"""WITH {fx.RATINGS_SQL},
assign AS (SELECT user_id, c_mktsegment AS cluster FROM ratings JOIN customer ON user_id = c_custkey),
best AS (SELECT cluster FROM assign GROUP BY cluster ORDER BY count(*) DESC, cluster LIMIT 1)
SELECT item_id, count(*) AS n_ratings, round(CAST(sum(rating_tenths) AS DOUBLE) / count(*), 9) AS avg_rating
FROM assign JOIN best USING (cluster) JOIN ratings USING (user_id)
GROUP BY item_id HAVING CAST(sum(rating_tenths) AS DOUBLE) / count(*) >= {MIN_MEAN_TENTHS}"""


def q_frequent_values(spark, sf_dir):
    """Event types that make up at least the given share of all events: exact frequent items (G-08)."""
    return frequent_values(read_table(spark, sf_dir, "events", ["event_type"]), "event_type", SUPPORT)


S_FREQUENT_VALUES = f"""SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1
HAVING count(*) >= CAST({SUPPORT} AS DOUBLE) * (SELECT count(event_type) FROM events)"""


def q_sample_md5(spark, sf_dir):
    """10% row sample of the claims by key, the same rows in any engine (B-02, B-03)."""
    return S.md5_sample(fx.claims(spark, sf_dir), ["policy_id"], ROW_SHARE, seed=SEED).select("policy_id", "claim_nb")


def _share(key: str) -> str:
    return f"CAST('0x' || substr(md5('{SEED}|' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT)"


S_SAMPLE_MD5 = f"""WITH {fx.CLAIMS_SQL}
SELECT policy_id, claim_nb FROM claims WHERE {_share("policy_id")} < {int(ROW_SHARE * 2 ** 32)}"""


def q_sample_md5_stratified(spark, sf_dir):
    """Per-label 1/2 sample of the claims by key, fractions from a table (B-04 .. B-06)."""
    df = fx.claims(spark, sf_dir)
    picked = S.md5_sample(df, ["policy_id"], S.constant_fractions(df, "segment", LABEL_SHARE), "segment", SEED)
    return picked.select("policy_id", "segment")


S_SAMPLE_MD5_STRATIFIED = f"""WITH {fx.CLAIMS_SQL}
SELECT policy_id, segment FROM claims WHERE {_share("policy_id")} < {int(LABEL_SHARE * 2 ** 32)}"""


QUERIES = {
    "csv_inferred": q_csv_inferred,
    "csv_renamed": q_csv_renamed,
    "declared_rows": q_declared_rows,
    "table_profile": q_table_profile,
    "item_means_repeats": q_item_means_repeats,
    "frequent_values": q_frequent_values,
    "sample_md5": q_sample_md5,
    "sample_md5_stratified": q_sample_md5_stratified,
}

ORACLES = {
    "csv_inferred": S_CSV_INFERRED,
    "csv_renamed": S_CSV_RENAMED,
    "declared_rows": S_DECLARED_ROWS,
    "table_profile": S_TABLE_PROFILE,
    "item_means_repeats": S_ITEM_MEANS_REPEATS,
    "frequent_values": S_FREQUENT_VALUES,
    "sample_md5": S_SAMPLE_MD5,
    "sample_md5_stratified": S_SAMPLE_MD5_STRATIFIED,
}
