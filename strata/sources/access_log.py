"""Access-log sources (S-01).

``read_access_log`` scans real text logs (gzip is not splittable, so the
scan is followed by one repartition).  ``access_log_from_events`` derives
Common-Log-Format lines from the ``events`` table: the stand-in input for
every log query, computed by Spark so its size grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import spread

# Fixed values of the stand-in log: host suffix chosen by user_id mod 4,
# time-zone text, request method/protocol, and the malformed-line marker.
SUFFIXES = [".de", ".ca", ".sg", ".com"]
ZONE_TEXT = "-0400"
GARBAGE_EVERY = 97
GARBAGE_TEXT = "garbage"


def read_access_log(spark: SparkSession, path: str,
                    partitions: int | None = None) -> DataFrame:
    """One row per line in column ``value``.

    gzip files are not splittable (one task per file): the scan is spread
    over the cluster when it is narrower than that, or over ``partitions``.
    """
    lines = spark.read.text(path)
    if partitions:
        return lines.repartition(partitions)
    return spread(lines)


def _suffix(user_id: Column) -> Column:
    arr = F.array(*[F.lit(s) for s in SUFFIXES])
    return F.element_at(arr, (F.pmod(user_id, F.lit(len(SUFFIXES))) + 1).cast("int"))


def access_log_from_events(events: DataFrame) -> DataFrame:
    """``value`` lines synthesised row by row from ``events``.

    ``host<user_id><suffix> - - [<dd/MMM/yyyy:HH:mm:ss> -0400] "GET /<type>
    HTTP/1.0" <code> <bytes>`` with ``404 -`` for errors and ``200
    floor(value)`` otherwise; every 97th event id is an unparsable line.
    """
    host = F.concat(F.lit("host"), F.col("user_id").cast("string"), _suffix(F.col("user_id")))
    ts_text = F.date_format(F.col("ts"), "dd/MMM/yyyy:HH:mm:ss")
    tail = F.when(F.col("event_type") == "error", F.lit("404 -")).otherwise(
        F.concat(F.lit("200 "), F.floor(F.col("value")).cast("long").cast("string")))
    line = F.concat(host, F.lit(" - - ["), ts_text, F.lit(f" {ZONE_TEXT}] \"GET /"),
                    F.col("event_type"), F.lit(" HTTP/1.0\" "), tail)
    value = F.when(F.pmod(F.col("event_id"), F.lit(GARBAGE_EVERY)) == 0,
                   F.lit(GARBAGE_TEXT)).otherwise(line)
    return events.select(F.col("event_id").alias("line_id"), value.alias("value"))


# DuckDB twin of ``access_log_from_events`` for the SQL oracles.
ACCESS_LOG_SQL = f"""
SELECT event_id AS line_id,
  CASE WHEN event_id % {GARBAGE_EVERY} = 0 THEN '{GARBAGE_TEXT}' ELSE
    'host' || CAST(user_id AS VARCHAR)
    || (['.de', '.ca', '.sg', '.com'])[CAST(((user_id % 4) + 4) % 4 AS INTEGER) + 1]
    || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' {ZONE_TEXT}] "GET /'
    || event_type || ' HTTP/1.0" '
    || CASE WHEN event_type = 'error' THEN '404 -'
            ELSE '200 ' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END
  END AS value
FROM events
"""
