"""Mergeable summaries: heavy hitters with an exact recount, distinct counts over any range (G-07, G-08)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Registers of a distinct-count sketch: 2^14, a relative standard error of 0.8%.
LOG_REGISTERS = 14


def heavy_hitter_candidates(df: DataFrame, col: str, support: float) -> DataFrame:
    """(candidate): every value, as text, with at least ``support`` of the non-null rows, and a few others.

    Each task keeps a Misra-Gries summary of 2/support counters (Misra and Gries 1982,
    merged as by Agarwal et al. 2012), so what is shuffled is a few counters a task,
    not every value.  A counter falls short of the truth by less than support/2 of
    the rows; at most 2/support + 1 candidates are left.
    """
    size = max(1, math.ceil(2 / support))

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, int] = {}
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            for x in pc.value_counts(batch.column("v")).to_pylist():
                kept[x["values"]] = kept.get(x["values"], 0) + x["counts"]
            if len(kept) > size:
                # what the (size + 1)-th counter holds is taken from all
                less = sorted(kept.values(), reverse=True)[size]
                kept = {v: n - less for v, n in kept.items() if n > less}
        if rows:  # the task's rows travel as a row without a value
            yield pa.RecordBatch.from_arrays([pa.array([None, *kept], pa.string()),
                                              pa.array([rows, *kept.values()], pa.int64())], ["v", "n"])

    values = df.select(F.col(col).cast("string").alias("v")).where("v IS NOT NULL")
    merged = values.mapInArrow(summary, "v string, n long").groupBy("v").agg(F.sum("n").alias("n"))
    total = merged.where("v IS NULL").select("n").scalar()
    return merged.where(F.col("v").isNotNull() & (F.col("n") >= F.lit(support / 2) * total)).select(
        F.col("v").alias("candidate"))


def heavy_hitters(df: DataFrame, col: str, support: float) -> DataFrame:
    """(col, n): the values with at least ``support`` of the non-null rows, counted exactly, in two passes (G-08).

    The second pass counts candidates only; their table has at most 2/support + 1
    rows, so it is broadcast.  Equals a full group count and filter.
    """
    candidates = F.broadcast(heavy_hitter_candidates(df, col, support))
    rows = df.where(F.col(col).isNotNull())
    counts = (rows.join(candidates, F.col(col).cast("string") == F.col("candidate"))
              .groupBy(col).agg(F.count("*").alias("n")))
    return counts.where(F.col("n") >= F.lit(support) * rows.agg(F.count("*")).scalar())


def distinct_sketches(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """(keys, sketch): one sketch of the distinct values of ``col`` for each key, a few kB; nulls don't count."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(col), F.lit(LOG_REGISTERS)).alias("sketch"))


def distinct_estimates(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n): estimated distinct values of the union of ``sketches`` by ``keys``, without the data.

    The relative error is below ``relative_error()`` (three deviations) in 99.7% of cases.
    """
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n"))


def relative_error(deviations: float = 3.0) -> float:
    return deviations * 1.04 / math.sqrt(1 << LOG_REGISTERS)
