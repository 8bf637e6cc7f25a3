"""Access-log analytics (J-08 .. J-12, G-01 .. G-11, F-01 .. F-03).

The reference scans the log once per country and embeds driver-side
literals (totals, the top host) into later jobs.  Here the line is parsed
once in one projection, the region is a column, and every report is one
plan: group-by with map-side combine, exact salted top-k, and a join to a
per-region top host whose size is bounded by the number of regions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import logfields as lf
from .shares import share_with_rest
from .topk import top_k_per_group, top_one_per_group

PARSED_COLUMNS = ["host", "timestamp", "request", "reply_code", "reply_bytes"]
DAYS = [f"{d:02d}" for d in range(1, 32)]


def parse_access_log(lines: DataFrame, value_col: str = "value",
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """Five log fields from raw lines (J-08), plus a ``malformed`` flag.

    ``host``/``timestamp``/``request`` are ``''`` when the pattern does not
    match; ``reply_code``/``reply_bytes`` are null when absent or not a
    number (``-`` bytes on errors).  Columns named in ``keep`` are carried.
    """
    line = F.col(value_col)
    tokens = F.split(line, " ")
    out = lines.select(
        *[F.col(c) for c in keep],
        lf.host(line).alias("host"),
        lf.timestamp_text(line).alias("timestamp"),
        lf.request(line).alias("request"),
        lf.reply_code(tokens).alias("reply_code"),
        lf.reply_bytes(tokens).alias("reply_bytes"),
    )
    return out.withColumn("malformed", (F.col("host") == "") | (F.col("timestamp") == ""))


def with_region(parsed: DataFrame, regions: dict[str, str] | None = None) -> DataFrame:
    """Rows whose host suffix is a listed region, with a ``region`` column.

    Both null tests are stated here so that every branch of a report has
    the same scan predicate (joins would otherwise infer extra ones on one
    side only) and Spark can reuse one scan's exchange for all branches.
    """
    return (parsed.withColumn("region", lf.region_of(F.col("host"), regions))
                  .filter(F.col("region").isNotNull() & F.col("host").isNotNull()))


def host_counts(parsed: DataFrame, regions: dict[str, str] | None = None) -> DataFrame:
    """Requests per (region, host) — the aggregate every report starts from."""
    return (with_region(parsed.select("host"), regions)
            .groupBy("region", "host").agg(F.count(F.lit(1)).alias("n")))


def region_summary(parsed: DataFrame, regions: dict[str, str] | None = None) -> DataFrame:
    """Requests and distinct hosts per region (J-09, G-01, G-07) in one pass."""
    return (host_counts(parsed, regions).groupBy("region")
            .agg(F.sum("n").cast("long").alias("n_requests"),
                 F.count(F.lit(1)).alias("n_hosts")))


def top_hosts(parsed: DataFrame, k: int = 9, regions: dict[str, str] | None = None) -> DataFrame:
    """The k busiest hosts of every region, ties broken by host (J-10)."""
    counts = host_counts(parsed, regions)
    return (top_k_per_group(counts, ["region"], [F.col("n").desc(), F.col("host").asc()], k)
            .select("region", "rank", "host", "n"))


def top_host(parsed: DataFrame, regions: dict[str, str] | None = None) -> DataFrame:
    """The busiest host of every region (O-04), as an aggregate."""
    return top_one_per_group(host_counts(parsed, regions), ["region"], "host", "n")


def host_shares(parsed: DataFrame, k: int = 9, regions: dict[str, str] | None = None,
                decimals: int = 2) -> DataFrame:
    """Percent of each region's requests for its top-k hosts and the rest (J-11)."""
    return share_with_rest(host_counts(parsed, regions), ["region"], "host", "n", k,
                           decimals=decimals)


def top_host_day_hour(parsed: DataFrame, regions: dict[str, str] | None = None) -> DataFrame:
    """Visits of each region's top host per (day, hour) of local log time (J-12).

    One scan: requests are counted per (region, host, day, hour) with
    map-side combine; host totals and the top host per region come from
    that aggregate, and the top-host table (one row per region, a size
    fixed by ``regions``) is broadcast back onto it.
    """
    rows = with_region(parsed.select("host", "timestamp"), regions).select(
        "region", "host", lf.day_of_log(F.col("timestamp")).alias("day"),
        lf.hour_of_log(F.col("timestamp")).alias("hour"))
    cells = rows.groupBy("region", "host", "day", "hour").agg(F.count(F.lit(1)).alias("n"))
    totals = cells.groupBy("region", "host").agg(F.sum("n").alias("n"))
    tops = F.broadcast(top_one_per_group(totals, ["region"], "host", "n").select("region", "host"))
    return cells.join(tops, ["region", "host"], "inner").select("region", "host", "day", "hour", "n")


def day_hour_pivot(day_hour: DataFrame, days: list[str] | None = None) -> DataFrame:
    """Hour × day table of visit counts (G-11); missing cells are null.

    The day values are given up front, so the pivot needs no extra job to
    discover them and the output schema is fixed.  Visits of any other day
    text are counted in the column ``other``.
    """
    days = days or DAYS
    known = F.when(F.col("day").isin(days), F.col("day")).otherwise(F.lit("other"))
    return (day_hour.withColumn("day", known).groupBy("region", "host", "hour").pivot("day", [*days, "other"])
            .agg(F.sum("n").cast("long")))
