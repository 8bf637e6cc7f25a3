"""Numeric helpers that give bit-identical answers on any SQL engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_div(a: Column, b: Column) -> Column:
    """Integral division of two integer columns (SQL ``div``)."""
    return F.call_function("div", a, b)


def round_ratio(num: Column, den: Column, decimals: int = 2, scale: int = 1) -> Column:
    """``round(num * scale / den, decimals)`` half-up, for non-negative counts.

    Computed in exact integer arithmetic and divided once at the end, so the
    result does not depend on how an engine rounds a binary double.  Null
    when ``den`` is zero.
    """
    unit = 10 ** decimals
    n = num.cast("long") * F.lit(2 * scale * unit) + den.cast("long")
    d = den.cast("long") * F.lit(2)
    q = F.when(den != 0, int_div(n, d))
    return q.cast("double") / F.lit(float(unit))


def percent(num: Column, den: Column, decimals: int = 2) -> Column:
    """Share of ``den`` in percent, exact half-up to ``decimals``."""
    return round_ratio(num, den, decimals, scale=100)


def sql_round_ratio(num: str, den: str, decimals: int = 2, scale: int = 1) -> str:
    """DuckDB twin of :func:`round_ratio`."""
    unit = 10 ** decimals
    return (f"CASE WHEN ({den}) <> 0 THEN CAST((CAST({num} AS BIGINT) * {2 * scale * unit} "
            f"+ CAST({den} AS BIGINT)) // (CAST({den} AS BIGINT) * 2) AS DOUBLE) "
            f"/ CAST({unit} AS DOUBLE) END")


def sql_percent(num: str, den: str, decimals: int = 2) -> str:
    return sql_round_ratio(num, den, decimals, scale=100)
