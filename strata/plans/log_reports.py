"""Log-report queries over the ``events``-derived access log, with SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import logfields as lf
from ..functions.numeric import sql_percent
from ..operators import logs
from ..session import shared_path
from ..sources.access_log import ACCESS_LOG_SQL, access_log_from_events, read_access_log
from ..sources.tables import read_table
from ..streaming import logs as stream_logs

# Fixed value: hosts shown per region, as in the reference report.
TOP_K = 9


def parsed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events",
                        ["event_id", "ts", "user_id", "event_type", "value"], spread_out=True)
    return logs.parse_access_log(access_log_from_events(events), keep=("line_id",))


def q_log_parse(spark, sf_dir):
    return parsed_log(spark, sf_dir)


def q_log_instants(spark, sf_dir):
    """The instant of every line in seconds since 1970, and its hour in UTC (X-02)."""
    at = lf.log_time(F.col("timestamp"))
    return parsed_log(spark, sf_dir).select("line_id", F.unix_timestamp(at).alias("seconds"),
                                            F.pmod(F.floor(F.unix_timestamp(at) / 3600), F.lit(24)).alias("utc_hour"))


def q_log_region_counts(spark, sf_dir):
    return logs.region_summary(parsed_log(spark, sf_dir))


def q_log_unique_hosts(spark, sf_dir):
    """Distinct hosts per region (J-10, G-07)."""
    return logs.region_summary(parsed_log(spark, sf_dir)).select("region", "n_hosts")


def q_log_top_hosts(spark, sf_dir):
    return logs.top_hosts(parsed_log(spark, sf_dir), k=TOP_K)


def q_log_top1(spark, sf_dir):
    return logs.top_host(parsed_log(spark, sf_dir))


def q_log_share_rest(spark, sf_dir):
    return logs.host_shares(parsed_log(spark, sf_dir), k=TOP_K)


def q_log_share_display(spark, sf_dir):
    """The share table for display: percentages as text with two decimals (X-09).

    Formatting happens last, on the final numeric column; sums and the
    residual are computed on numbers (the reference summed the strings).
    """
    shares = logs.host_shares(parsed_log(spark, sf_dir), k=TOP_K)
    return shares.select("region", "rank", "host", F.format_number("percentage", 2).alias("percentage_text"))


def q_log_day_hour(spark, sf_dir):
    return logs.top_host_day_hour(parsed_log(spark, sf_dir))


def q_log_day_hour_pivot(spark, sf_dir):
    return logs.day_hour_pivot(logs.top_host_day_hour(parsed_log(spark, sf_dir)))


def q_log_malformed(spark, sf_dir):
    """Count of lines that do not parse, by reason (dirty input is counted, not fatal)."""
    p = parsed_log(spark, sf_dir)
    return p.agg(F.count(F.lit(1)).alias("n_lines"),
                 F.sum(F.col("malformed").cast("long")).alias("n_malformed"),
                 F.sum(F.col("reply_bytes").isNull().cast("long")).alias("n_no_bytes"))


def q_log_text_parse(spark, sf_dir):
    """Log lines written as gzip text, scanned back as a text source and parsed (S-01, J-08)."""
    events = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    path = shared_path(spark, "log-text")
    access_log_from_events(events).select("value").write.option("compression", "gzip").text(path)
    return logs.parse_access_log(read_access_log(spark, path))


def q_log_stream_region_counts(spark, sf_dir):
    """Region report over a log parsed incrementally by Structured Streaming.

    ``events`` is read as a file stream, turned into log lines and parsed
    into day-partitioned Parquet in the shared folder (availableNow
    trigger, exactly-once file sink); the batch report reads that table.
    """
    schema = read_table(spark, sf_dir, "events").schema
    events = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
              .parquet(sf_dir))
    base = shared_path(spark, "log-stream")
    parsed = stream_logs.parse_stream(access_log_from_events(events), keep=("line_id",))
    query = stream_logs.write_parsed(parsed, f"{base}/data", f"{base}/_checkpoint")
    query.awaitTermination()
    return logs.region_summary(stream_logs.read_parsed(spark, f"{base}/data", parsed.schema))


# ---------------------------------------------------------------- SQL twins

def _region_case(col: str) -> str:
    whens = " ".join(f"WHEN '{s}' THEN '{n}'" for s, n in lf.DEFAULT_REGIONS.items())
    return (f"CASE lower(regexp_extract({col}, '\\.([A-Za-z0-9-]+)$', 1)) {whens} END")


PARSED_SQL = f"""
lines AS ({ACCESS_LOG_SQL}),
parsed AS (
  SELECT line_id,
    regexp_extract(value, '{lf.HOST_PATTERN}', 1) AS host,
    regexp_extract(value, '{lf.TIMESTAMP_PATTERN}', 1) AS timestamp,
    regexp_extract(value, '{lf.REQUEST_PATTERN}', 1) AS request,
    TRY_CAST(string_split(value, ' ')[-2] AS INTEGER) AS reply_code,
    TRY_CAST(string_split(value, ' ')[-1] AS BIGINT) AS reply_bytes
  FROM lines),
regioned AS (
  SELECT *, {_region_case('host')} AS region FROM parsed),
host_counts AS (
  SELECT region, host, count(*) AS n FROM regioned
  WHERE region IS NOT NULL GROUP BY region, host),
ranked AS (
  SELECT region, host, n,
    CAST(row_number() OVER (PARTITION BY region ORDER BY n DESC, host ASC) AS BIGINT) AS rank
  FROM host_counts)
"""

S_LOG_PARSE = f"""WITH {PARSED_SQL}
SELECT line_id, host, timestamp, request, reply_code, reply_bytes,
       (host = '' OR timestamp = '') AS malformed
FROM parsed"""

S_LOG_INSTANTS = f"""WITH {PARSED_SQL},
instants AS (
  SELECT line_id, CAST(epoch(try_strptime(left(timestamp, 20), '%d/%b/%Y:%H:%M:%S')) AS BIGINT)
    - CAST(right(timestamp, 5)[1] || '1' AS BIGINT)
      * (CAST(right(timestamp, 4)[1:2] AS BIGINT) * 3600 + CAST(right(timestamp, 2) AS BIGINT) * 60) AS seconds
  FROM parsed WHERE timestamp <> '' UNION ALL SELECT line_id, NULL FROM parsed WHERE timestamp = '')
SELECT line_id, seconds, ((seconds // 3600) % 24 + 24) % 24 AS utc_hour FROM instants"""

S_LOG_TEXT_PARSE = f"""WITH {PARSED_SQL}
SELECT host, timestamp, request, reply_code, reply_bytes,
       (host = '' OR timestamp = '') AS malformed
FROM parsed"""

S_LOG_REGION_COUNTS = f"""WITH {PARSED_SQL}
SELECT region, CAST(sum(n) AS BIGINT) AS n_requests, count(*) AS n_hosts
FROM host_counts GROUP BY region"""

S_LOG_UNIQUE_HOSTS = f"""WITH {PARSED_SQL}
SELECT region, count(DISTINCT host) AS n_hosts FROM regioned WHERE region IS NOT NULL GROUP BY region"""

S_LOG_TOP_HOSTS = f"""WITH {PARSED_SQL}
SELECT region, rank, host, n FROM ranked WHERE rank <= {TOP_K}"""

S_LOG_TOP1 = f"""WITH {PARSED_SQL}
SELECT region, host, n FROM ranked WHERE rank = 1"""

S_LOG_SHARE_REST = f"""WITH {PARSED_SQL},
totals AS (SELECT region, CAST(sum(n) AS BIGINT) AS total FROM host_counts GROUP BY region),
rows_ AS (
  SELECT region, rank, host, n FROM ranked WHERE rank <= {TOP_K}
  UNION ALL
  SELECT t.region, CAST({TOP_K + 1} AS BIGINT) AS rank, 'the rest' AS host,
         t.total - coalesce(s.shown, 0) AS n
  FROM totals t LEFT JOIN (
    SELECT region, CAST(sum(n) AS BIGINT) AS shown FROM ranked WHERE rank <= {TOP_K}
    GROUP BY region) s ON t.region = s.region)
SELECT r.region, r.rank, r.host, r.n, {sql_percent('r.n', 't.total')} AS percentage
FROM rows_ r JOIN totals t ON r.region = t.region"""

S_LOG_SHARE_DISPLAY = f"""WITH share AS ({S_LOG_SHARE_REST})
SELECT region, rank, host, printf('%.2f', percentage) AS percentage_text FROM share"""

DAY_HOUR_SQL = f"""{PARSED_SQL},
day_hour AS (
  SELECT g.region, g.host,
    regexp_extract(g.timestamp, '{lf.DAY_PATTERN}', 1) AS day,
    regexp_extract(g.timestamp, '{lf.HOUR_PATTERN}', 1) AS hour,
    count(*) AS n
  FROM regioned g JOIN ranked r ON g.region = r.region AND g.host = r.host AND r.rank = 1
  GROUP BY 1, 2, 3, 4)
"""

S_LOG_DAY_HOUR = f"""WITH {DAY_HOUR_SQL}
SELECT region, host, day, hour, n FROM day_hour"""

S_LOG_DAY_HOUR_PIVOT = f"""WITH {DAY_HOUR_SQL}
SELECT region, host, hour,
  {", ".join(f"CAST(sum(CASE WHEN day = '{d}' THEN n END) AS BIGINT) AS \"{d}\"" for d in logs.DAYS)},
  CAST(sum(CASE WHEN day IN ({", ".join(f"'{d}'" for d in logs.DAYS)}) THEN NULL ELSE n END) AS BIGINT) AS other
FROM day_hour GROUP BY region, host, hour"""

S_LOG_MALFORMED = f"""WITH {PARSED_SQL}
SELECT count(*) AS n_lines,
  CAST(sum(CASE WHEN host = '' OR timestamp = '' THEN 1 ELSE 0 END) AS BIGINT) AS n_malformed,
  CAST(sum(CASE WHEN reply_bytes IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_no_bytes
FROM parsed"""

QUERIES = {
    "log_parse": q_log_parse,
    "log_instants": q_log_instants,
    "log_region_counts": q_log_region_counts,
    "log_unique_hosts": q_log_unique_hosts,
    "log_top_hosts": q_log_top_hosts,
    "log_top1": q_log_top1,
    "log_share_rest": q_log_share_rest,
    "log_share_display": q_log_share_display,
    "log_day_hour": q_log_day_hour,
    "log_day_hour_pivot": q_log_day_hour_pivot,
    "log_malformed": q_log_malformed,
    "log_text_parse": q_log_text_parse,
    "log_stream_region_counts": q_log_stream_region_counts,
}

ORACLES = {
    "log_parse": S_LOG_PARSE,
    "log_instants": S_LOG_INSTANTS,
    "log_region_counts": S_LOG_REGION_COUNTS,
    "log_unique_hosts": S_LOG_UNIQUE_HOSTS,
    "log_top_hosts": S_LOG_TOP_HOSTS,
    "log_top1": S_LOG_TOP1,
    "log_share_rest": S_LOG_SHARE_REST,
    "log_share_display": S_LOG_SHARE_DISPLAY,
    "log_day_hour": S_LOG_DAY_HOUR,
    "log_day_hour_pivot": S_LOG_DAY_HOUR_PIVOT,
    "log_malformed": S_LOG_MALFORMED,
    "log_text_parse": S_LOG_TEXT_PARSE,
    "log_stream_region_counts": S_LOG_REGION_COUNTS,
}
