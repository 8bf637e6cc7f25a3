"""Sampling and splitting (B-01 .. B-08).

``randomSplit``/``sample`` follow the input's partitioning: the same seed
gives other rows after a repartition.  The hash-based operators here depend
only on each row's key and the seed, so they are repeatable on any cluster
layout.  The exact operators (stratified split, time split) find their
cut points from small histograms and rank rows only inside one small
boundary bucket, so no task ever holds a whole stratum, however skewed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import int_div
from ..session import cut_lineage

_FRACTION_UNIT = 1_000_000


def key_hash(key_cols: Sequence[str], seed: int) -> Column:
    """A 64-bit hash of the key columns, salted by ``seed``."""
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in key_cols])


def random_split(df: DataFrame, weights: Sequence[float], seed: int | None = None) -> list[DataFrame]:
    """Spark's ``randomSplit`` (B-01): fast, but layout-dependent."""
    return df.randomSplit(list(weights), seed)


def bernoulli_sample(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """Row sample without replacement (B-02, B-03)."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def stratified_sample(df: DataFrame, label_col: str, fractions, seed: int | None = None) -> DataFrame:
    """Per-label Bernoulli sample (B-04, B-05).

    ``fractions`` is a dict (``sampleBy``) or a (label, fraction) DataFrame
    (B-06), which is joined: it never comes to the driver.  Labels without a
    fraction are left out.
    """
    if not isinstance(fractions, DataFrame):
        return df.sampleBy(label_col, fractions, seed)
    table = _per_label(fractions.select(F.col(label_col).alias("__of"), F.col("fraction").alias("__share")))
    draw = F.rand(seed) if seed is not None else F.rand()
    return (df.withColumn("__draw", draw).join(table, F.col(label_col).eqNullSafe(F.col("__of")))
              .filter(F.col("__draw") < F.col("__share")).drop("__of", "__share", "__draw"))


def constant_fractions(df: DataFrame, label_col: str, fraction: float) -> DataFrame:
    """Per-label fraction table (B-06) as a DataFrame (one row per label)."""
    return df.select(label_col).distinct().withColumn("fraction", F.lit(float(fraction)))


def hash_split(df: DataFrame, key_cols: Sequence[str], weights: Sequence[float], seed: int = 0,
               part_col: str = "part") -> DataFrame:
    """Label every row with a part index 0..len(weights)-1 by key hash.

    Proportions hold in expectation; parts are disjoint and complete, and
    a row's part never changes with partitioning or cluster size.
    """
    total = float(sum(weights))
    h, expr, acc = key_hash(key_cols, seed), F.lit(len(weights) - 1), total
    for i in reversed(range(len(weights) - 1)):
        acc -= weights[i + 1]
        edge = int(acc / total * 2 ** 64) - 2 ** 63  # on the whole 64-bit hash: no rounding to buckets
        expr = F.when(h < F.lit(max(-2 ** 63, min(2 ** 63 - 1, edge))), F.lit(i)).otherwise(expr)
    return df.withColumn(part_col, expr.cast("int"))


def md5_split(df: DataFrame, key_cols: Sequence[str], weights: Sequence[float], seed: int = 0,
              part_col: str = "part") -> DataFrame:
    """As ``hash_split``, by the md5 of ``seed|key|...`` text, which other engines have too."""
    total = float(sum(weights))
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key_cols])
    share = F.substring(F.md5(text.cast("binary")), 1, 8)
    expr = F.lit(len(weights) - 1)
    for i in reversed(range(len(weights) - 1)):
        edge = md5_edge(sum(weights[:i + 1]) / total)
        expr = F.when(share < F.lit(edge), F.lit(i)).otherwise(expr)
    return df.withColumn(part_col, expr.cast("int"))


def md5_edge(share: float) -> str:
    """The first eight hex digits below which the given share of all md5 sums lies."""
    return f"{int(share * 2 ** 32):08x}" if share < 1 else "g"


def md5_share(key_cols: Sequence[str], seed: int = 0) -> Column:
    """A number below 2^32 from the md5 of ``seed|key|...``, the same in any engine."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key_cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def md5_sample(df: DataFrame, key_cols: Sequence[str], fractions, label_col: str | None = None,
               seed: int = 0) -> DataFrame:
    """Bernoulli sample by key (B-02 .. B-06): a row's fate depends on its key alone.

    ``fractions`` is a number, or a (label, fraction) DataFrame that is joined
    on ``label_col``; labels without a fraction are left out.
    """
    share = md5_share(key_cols, seed)
    if not isinstance(fractions, DataFrame):
        return df.filter(share < F.lit(int(fractions * 2 ** 32)))
    table = _per_label(fractions.select(F.col(label_col).alias("__of"), F.col("fraction").alias("__share")))
    return (df.withColumn("__draw", share).join(table, F.col(label_col).eqNullSafe(F.col("__of")))
              .filter(F.col("__draw") < F.col("__share") * F.lit(2.0 ** 32)).drop("__of", "__share", "__draw"))


def _target(n: Column, fraction: float) -> Column:
    """round-half-up(fraction * n) in integer arithmetic."""
    num = int(round(fraction * _FRACTION_UNIT))
    return int_div(n * F.lit(2 * num) + F.lit(_FRACTION_UNIT), F.lit(2 * _FRACTION_UNIT))


LEVEL_BITS = 14  # buckets of one level: 2^14 of a label's rows, and as many of a bucket's
BROADCAST_LABELS = 100_000


def _per_label(table: DataFrame) -> DataFrame:
    """A table of one row per label: broadcast while it is small, joined by a shuffle beyond."""
    return F.broadcast(table) if table.count() <= BROADCAST_LABELS else table


def _boundary(hist: DataFrame, target: Column) -> DataFrame:
    """Per label, the bucket in which the target-th row lies and the rows still needed from it."""
    w = Window.partitionBy("__label").orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    cum = hist.withColumn("__cum", F.sum("__cnt").over(w)).withColumn("__target", target)
    return (cum.filter((F.col("__cum") >= F.col("__target")) & (F.col("__cum") - F.col("__cnt") < F.col("__target")))
               .select("__label", F.col("__b").alias("__edge"),
                       (F.col("__target") - (F.col("__cum") - F.col("__cnt"))).alias("__need")))


def stratified_split(df: DataFrame, label_col: str, key_cols: Sequence[str], fraction: float,
                     seed: int = 0, flag_col: str = "is_train") -> DataFrame:
    """Disjoint train/test split with exactly round(fraction·n) train rows per label (B-08).

    Rows are ordered inside each label by (hash, key).  Two levels of
    histograms over (label, leading hash bits) locate a bucket with about
    1/2^28 of a label's rows; only those are ranked, to find each label's
    last training row.  All this reads the label and the keys alone; the
    whole rows are then flagged against the cut of their label, in one pass
    and without a shuffle by label.  Null labels are a label of their own.
    Rows that repeat a key are flagged alike.
    """
    names = [f"__k{i}" for i in range(len(key_cols))]
    narrow = df.select(F.col(label_col).alias("__label"), key_hash(key_cols, seed).alias("__h"),
                       *[F.col(k).alias(n) for k, n in zip(key_cols, names)])

    def bucket(bits: int) -> Column:
        return F.shiftright(F.col("__h"), 64 - bits)

    hist = narrow.groupBy("__label", bucket(LEVEL_BITS).alias("__b")).agg(F.count(F.lit(1)).alias("__cnt"))
    whole = Window.partitionBy("__label")
    edges = cut_lineage(_boundary(hist.withColumn("__n", F.sum("__cnt").over(whole)),
                                  _target(F.col("__n"), fraction)), "split-edges")
    for bits in (LEVEL_BITS, 2 * LEVEL_BITS):
        edge = _per_label(edges.withColumnRenamed("__label", "__of"))
        narrow = (narrow.drop("__edge", "__need")
                  .join(edge, F.col("__label").eqNullSafe(F.col("__of")) & (bucket(bits) == F.col("__edge")))
                  .drop("__of"))
        if bits == LEVEL_BITS:
            hist = (narrow.groupBy("__label", "__need", bucket(2 * bits).alias("__b"))
                    .agg(F.count(F.lit(1)).alias("__cnt")))
            edges = cut_lineage(_boundary(hist, F.col("__need")), "split-edges")
    last = Window.partitionBy("__label").orderBy("__h", *names)
    cuts = cut_lineage(narrow.withColumn("__r", F.row_number().over(last)).filter(F.col("__r") == F.col("__need"))
                       .select(F.col("__label").alias("__of"), F.col("__h").alias("__cut"),
                               F.struct(*names).alias("__keys")), "split-cuts")
    h, keys = key_hash(key_cols, seed), F.struct(*[F.col(k).alias(n) for k, n in zip(key_cols, names)])
    flag = (h < F.col("__cut")) | ((h == F.col("__cut")) & (keys <= F.col("__keys")))
    return (df.join(_per_label(cuts), F.col(label_col).eqNullSafe(F.col("__of")), "left")
              .withColumn(flag_col, F.coalesce(flag, F.lit(False))).drop("__of", "__cut", "__keys"))


def time_cutoff(df: DataFrame, ts_col: str, fraction: float) -> DataFrame:
    """One row: the smallest ``ts`` with at least round(fraction·n) rows at or before it.

    Exact, in two passes.  Counts per day (one row per day) locate the
    boundary day; inside that day the counts per distinct ``ts`` get a
    distributed prefix sum (range partitions + per-partition offsets), so
    even a day holding a third of all rows is never ranked in one task.
    Rows without a ``ts`` have no place in time and count for nothing here; no
    dated row: a null cut-off.
    """
    from .metrics import ordered_prefix_sums

    df = df.filter(F.col(ts_col).isNotNull())
    day = F.date_trunc("day", F.col(ts_col))
    daily = df.groupBy(day.alias("__day")).agg(F.count(F.lit(1)).alias("__cnt"))
    wd = Window.orderBy("__day").rowsBetween(Window.unboundedPreceding, 0)
    daily = (daily.withColumn("__cum", F.sum("__cnt").over(wd))
                  .withColumn("__n", F.sum("__cnt").over(Window.partitionBy()))
                  .withColumn("__target", F.greatest(_target(F.col("__n"), fraction), F.lit(1)))
                  .filter((F.col("__cum") >= F.col("__target"))
                          & (F.col("__cum") - F.col("__cnt") < F.col("__target")))
                  .select("__day", (F.col("__target") - (F.col("__cum") - F.col("__cnt"))).alias("__need")))
    # ``daily`` is one row (the boundary day): a bounded broadcast.
    in_day = (df.select(F.col(ts_col).alias("__ts"), day.alias("__day"))
                .join(F.broadcast(daily), "__day", "inner")
                .groupBy("__ts", "__need").agg(F.count(F.lit(1)).alias("__cnt")))
    cum = ordered_prefix_sums(in_day, "__ts", ["__cnt"])
    return (cum.filter(F.col("__cnt_before") + F.col("__cnt") >= F.col("__need"))
               .agg(F.min("__ts").alias("cutoff")))


def time_cutoffs(df: DataFrame, ts_col: str, fractions: Sequence[float]) -> DataFrame:
    """Exact cut-offs for several fractions at once: one row, column ``c{i}`` per fraction.

    One daily histogram and one pass over the boundary days serve every
    fraction.  The row is bounded by ``len(fractions)``; callers may fetch
    it (``first()``) and filter with literals, which reach the scan.
    Rows without a ``ts`` count for nothing.
    """
    from .metrics import ordered_prefix_sums

    df = df.filter(F.col(ts_col).isNotNull())
    day = F.date_trunc("day", F.col(ts_col))
    daily = df.groupBy(day.alias("__day")).agg(F.count(F.lit(1)).alias("__cnt"))
    wd = Window.orderBy("__day").rowsBetween(Window.unboundedPreceding, 0)
    daily = (daily.withColumn("__cum", F.sum("__cnt").over(wd))
                  .withColumn("__n", F.sum("__cnt").over(Window.partitionBy())))
    # one boundary row per fraction (bounded by len(fractions))
    targets = F.array(*[F.struct(F.lit(i).alias("i"), F.greatest(_target(F.col("__n"), f), F.lit(1)).alias("t"))
                        for i, f in enumerate(fractions)])
    bounds = (daily.select("__day", "__cnt", "__cum", F.explode(targets).alias("__f"))
                   .filter((F.col("__cum") >= F.col("__f.t")) & (F.col("__cum") - F.col("__cnt") < F.col("__f.t")))
                   .select(F.col("__f.i").alias("__i"), "__day",
                           (F.col("__f.t") - (F.col("__cum") - F.col("__cnt"))).alias("__need")))
    in_day = (df.select(F.col(ts_col).alias("__ts"), day.alias("__day"))
                .join(F.broadcast(bounds), "__day", "inner")
                .groupBy("__i", "__need", "__ts").agg(F.count(F.lit(1)).alias("__cnt")))
    # prefix sums within each fraction's boundary day: order by (fraction, ts)
    keyed = in_day.withColumn("__k", F.struct("__i", "__ts"))
    cum = ordered_prefix_sums(keyed, "__k", ["__cnt"])
    # rows of earlier fractions come first in (fraction, ts) order: subtract
    # each fraction's smallest prefix (one row per fraction, broadcast).
    base = cum.groupBy("__i").agg(F.min("__cnt_before").alias("__base"))
    hits = (cum.join(F.broadcast(base), "__i", "inner")
               .withColumn("__within", F.col("__cnt_before") - F.col("__base") + F.col("__cnt"))
               .filter(F.col("__within") >= F.col("__need"))
               .groupBy("__i").agg(F.min("__ts").alias("cutoff")))
    row = hits.agg(*[F.max(F.when(F.col("__i") == i, F.col("cutoff"))).alias(f"c{i}")
                     for i in range(len(fractions))])
    return row


def time_split(df: DataFrame, ts_col: str, fraction: float, flag_col: str = "is_train") -> DataFrame:
    """Rows at or before the exact ``fraction`` time cut-off are training (B-07).

    The cut-off is a one-row scalar subquery, evaluated once, from the rows that
    have a ``ts``.  A row without one has a null flag: it is in neither part.
    """
    cut = time_cutoff(df, ts_col, fraction).scalar()
    return df.withColumn(flag_col, F.col(ts_col) <= cut)
