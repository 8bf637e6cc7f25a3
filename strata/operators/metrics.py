"""Evaluation metrics as plain aggregates (Y-01 .. Y-05).

One ``agg`` computes RMSE/MSE/MAE (the reference runs one evaluator job
per metric).  Classification metrics come from a (label, prediction)
confusion table, a handful of rows.  ROC area is exact (mid-rank /
Mann–Whitney, ties counted half) and distributed: scores are aggregated
per distinct value, then a two-level prefix sum over range partitions
gives each score the number of negatives below it — no global sort in one
task, no binning.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, shuffle_width


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: rmse, mse, mae, r2 and n."""
    err = F.col(label) - F.col(prediction)
    out = df.agg(F.count(F.lit(1)).alias("n"), F.avg(err * err).alias("mse"),
                 F.avg(F.abs(err)).alias("mae"), F.var_pop(F.col(label)).alias("__var"))
    return out.select("n", F.sqrt("mse").alias("rmse"), "mse", "mae",
                      (F.lit(1.0) - F.try_divide(F.col("mse"), F.col("__var"))).alias("r2"))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Counts per (label, prediction) pair."""
    return df.groupBy(F.col(label).cast("double").alias("label"),
                      F.col(prediction).cast("double").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: accuracy, weighted precision/recall/F1 (the evaluator default), n."""
    conf = confusion(df, label, prediction)
    by_label = conf.groupBy("label").agg(F.sum("n").alias("n_true"),
                                         F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n"))
                                               .otherwise(0)).alias("tp"))
    by_pred = conf.groupBy(F.col("prediction").alias("label")).agg(F.sum("n").alias("n_pred"))
    per = by_label.join(by_pred, "label", "left").fillna(0, ["n_pred"])
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("n_pred")), F.lit(0.0))
    rec = F.try_divide(F.col("tp"), F.col("n_true"))
    f1 = F.when(prec + rec > 0, F.try_divide(2 * prec * rec, prec + rec)).otherwise(0.0)
    per = per.select("n_true", "tp", prec.alias("p"), rec.alias("r"), f1.alias("f1"))
    tot = F.sum("n_true")
    return per.agg(tot.alias("n"), F.try_divide(F.sum("tp"), tot).alias("accuracy"),
                   F.try_divide(F.sum(F.col("p") * F.col("n_true")), tot).alias("weighted_precision"),
                   F.try_divide(F.sum(F.col("r") * F.col("n_true")), tot).alias("weighted_recall"),
                   F.try_divide(F.sum(F.col("f1") * F.col("n_true")), tot).alias("weighted_f1"))


def ordered_prefix_sums(df: DataFrame, order_col: str, value_cols: list[str],
                        partitions: int | None = None) -> DataFrame:
    """Exclusive running sums of ``value_cols`` in ``order_col`` order, distributed.

    Rows are range-partitioned on ``order_col`` and written once with their
    partition number: range bounds are sampled, so two reads of the plan would
    cut the rows in two ways.  From the written table each partition sums
    locally, and a table of per-partition totals (one row per partition)
    supplies the offsets.  ``order_col`` values must be distinct.
    """
    n = partitions or shuffle_width(df.sparkSession)
    ranged = cut_lineage(df.repartitionByRange(n, order_col)
                         .withColumn("__pid", F.spark_partition_id()), "ranged")
    w = Window.partitionBy("__pid").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumns({f"{c}_before": F.coalesce(F.sum(c).over(w), F.lit(0)) for c in value_cols})
    totals = ranged.groupBy("__pid").agg(*[F.sum(c).alias(f"__t_{c}") for c in value_cols])
    wp = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__pid", *[F.coalesce(F.sum(f"__t_{c}").over(wp), F.lit(0)).alias(f"__o_{c}")
                                       for c in value_cols])
    # ``offsets`` has one row per partition: a bounded broadcast.
    out = local.join(F.broadcast(offsets), "__pid", "inner")
    return out.select(*df.columns, *[(F.col(f"{c}_before") + F.col(f"__o_{c}")).alias(f"{c}_before")
                                     for c in value_cols])


def roc_auc(df: DataFrame, label: str, score: str, by: str | None = None) -> DataFrame:
    """Exact area under the ROC curve of ``score`` for binary ``label``: one row (auc).

    Rows with a null label, or a null or NaN score, are left out: they have no
    place in the ranking.

    With ``by`` (a column without nulls), one row (by, auc) for each of its
    values, all from one prefix sum in (by, score) order.
    """
    group = F.lit(0) if by is None else F.col(by)
    ranked = F.col(score).cast("double")
    df = df.where(F.col(label).isNotNull() & ranked.isNotNull() & ~F.isnan(ranked))
    per_score = df.groupBy(group.alias("__by"), F.col(score).cast("double").alias("score")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("long").alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("long").alias("neg"))
    cum = ordered_prefix_sums(per_score.withColumn("__k", F.struct("__by", "score")), "__k", ["neg"])
    # negatives of earlier groups come first in (by, score) order
    base = cum.groupBy("__by").agg(F.min("neg_before").alias("__base"))
    wins = F.col("pos").cast("double") * ((F.col("neg_before") - F.col("__base")).cast("double") + F.col("neg") * 0.5)
    # null when only one class is present (no pairs to rank)
    area = F.try_divide(F.sum(wins), F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc")
    joined = cum.join(F.broadcast(base), "__by")  # one row per value of ``by`` (models, say)
    if by is None:
        return joined.agg(area)
    return joined.groupBy("__by").agg(area).withColumnRenamed("__by", by)


def positive_score(prob_col: str = "probability") -> Column:
    """Probability of class 1 from an ML probability/rawPrediction vector."""
    return vector_to_array(F.col(prob_col))[1]
