"""Column expressions for Common-Log-Format access lines (X-01..X-08).

All are built-in JVM expressions, so a parse stays inside one
whole-stage-codegen span.  Dirty input never fails the job under ANSI
mode: positional fields use ``try_element_at`` and ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The field patterns of the access-log parse.  Results must
# equal the reference's, so these are kept exactly as it states them.
HOST_PATTERN = r"^(.*) - -.*"
TIMESTAMP_PATTERN = r".* - - \[(.*)\].*"
REQUEST_PATTERN = r'.*"(.*)".*'
# Day of month and hour inside the timestamp text
# ``dd/MMM/yyyy:HH:mm:ss Z`` (local log time; the zone's offset has either sign).
DAY_PATTERN = r"^(.*)/.*/.*"
HOUR_PATTERN = r".*:(.*):.*:.* [-+].*"
# The region suffixes of the report.
DEFAULT_REGIONS = {"de": "Germany", "ca": "Canada", "sg": "Singapore"}


def host(line: Column) -> Column:
    return F.regexp_extract(line, HOST_PATTERN, 1)


def timestamp_text(line: Column) -> Column:
    return F.regexp_extract(line, TIMESTAMP_PATTERN, 1)


def log_time(ts_text: Column) -> Column:
    """The instant of ``dd/MMM/yyyy:HH:mm:ss Z``, its zone's offset applied; null where it can't be read.

    Month names are English whatever the session's locale.
    """
    return F.try_to_timestamp(ts_text, F.lit("dd/MMM/yyyy:HH:mm:ss Z"))


def request(line: Column) -> Column:
    return F.regexp_extract(line, REQUEST_PATTERN, 1)


def token_from_end(tokens: Column, pos: int) -> Column:
    """``pos``-th token from the end (1 = last); null when absent."""
    return F.try_element_at(tokens, F.lit(-pos))


def reply_code(tokens: Column) -> Column:
    return token_from_end(tokens, 2).try_cast("int")


def reply_bytes(tokens: Column) -> Column:
    return token_from_end(tokens, 1).try_cast("long")


def day_of_log(ts_text: Column) -> Column:
    return F.regexp_extract(ts_text, DAY_PATTERN, 1)


def hour_of_log(ts_text: Column) -> Column:
    return F.regexp_extract(ts_text, HOUR_PATTERN, 1)


def host_suffix(h: Column) -> Column:
    """Top-level domain of a host name (``''`` when none)."""
    return F.regexp_extract(h, r"\.([A-Za-z0-9-]+)$", 1)


def region_of(h: Column, regions: dict[str, str] | None = None) -> Column:
    """Map a host's suffix to a region label; null when not listed.

    The suffix is tested on the parsed host, not as a substring of the
    whole line, so ``.de`` inside a request path never counts.
    """
    regions = regions or DEFAULT_REGIONS
    suffix = F.lower(host_suffix(h))
    expr = None
    for sfx, name in regions.items():
        cond = suffix == F.lit(sfx.lower().lstrip("."))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr
