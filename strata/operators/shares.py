"""Shares of a total with a residual bucket (G-09, G-10, U-01).

The reference keeps percentages as formatted strings and derives "the
rest" as 100 minus the rounded shown values.  Here counts stay numeric, the
residual comes from counts (total minus shown), and every percentage is an
exact half-up rounding of its own count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import percent
from .topk import top_k_per_group

# Fixed value: label of the residual bucket, as in the reference report.
REST_LABEL = "the rest"


def share_with_rest(counts: DataFrame, group_cols: Sequence[str], key_col: str,
                    count_col: str, k: int, rest_label: str = REST_LABEL,
                    decimals: int = 2) -> DataFrame:
    """Top-k keys per group with their share, plus one residual row.

    ``counts`` holds one row per (group, key) with a non-negative count.
    Output: group cols, ``rank`` (k+1 for the residual), key, ``n``,
    ``percentage``.  Totals come from one aggregate per group (a handful
    of rows), the residual from totals minus the shown counts.
    """
    group_cols = list(group_cols)
    top = (top_k_per_group(counts.select(*group_cols, key_col, count_col), group_cols,
                           [F.col(count_col).desc(), F.col(key_col).asc()], k)
           .select(*group_cols, "rank", key_col, F.col(count_col).cast("long").alias("n")))
    # One carrier row per group holds the group total; after the union each
    # group has at most k + 1 rows, so the windows below are tiny.
    totals = (counts.groupBy(*group_cols).agg(F.sum(count_col).cast("long").alias("n"))
              .select(*group_cols, F.lit(k + 1).cast("long").alias("rank"),
                      F.lit(rest_label).alias(key_col), "n"))
    w = Window.partitionBy(*group_cols)
    is_rest = F.col("rank") == k + 1
    total = F.max(F.when(is_rest, F.col("n"))).over(w)
    shown = F.sum(F.when(~is_rest, F.col("n")).otherwise(0)).over(w)
    rows = top.unionByName(totals).withColumns({"__total": total, "__shown": shown})
    rows = rows.withColumn("n", F.when(is_rest, F.col("__total") - F.col("__shown")).otherwise(F.col("n")))
    return (rows.withColumn("percentage", percent(F.col("n"), F.col("__total"), decimals))
                .drop("__total", "__shown"))
