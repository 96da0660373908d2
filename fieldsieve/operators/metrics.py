"""Classifier metrics and training-log summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, 0 where it is undefined."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2 * precision * recall, precision + recall)


def binary_metrics(df: DataFrame, truth: str = "label", pred: str = "pred") -> DataFrame:
    """Precision, recall, F1 and accuracy of class 1, in one aggregation."""
    t, p = F.col(truth), F.col(pred)
    counts = df.agg(
        F.count_if((t == 1) & (p == 1)).alias("tp"),
        F.count_if(p == 1).alias("pp"),
        F.count_if(t == 1).alias("ap"),
        F.count_if(t == p).alias("hits"),
        F.count(F.lit(1)).alias("n"),
    )
    ratios = counts.select(
        _ratio(F.col("tp"), F.col("pp")).alias("precision"),
        _ratio(F.col("tp"), F.col("ap")).alias("recall"),
        _ratio(F.col("hits"), F.col("n")).alias("accuracy"),
    )
    return ratios.withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def confusion_matrix(df: DataFrame, truth: str = "label", pred: str = "pred") -> DataFrame:
    """(true_class, pred_class, n): every pair of classes that occur, 0 where nothing fell.

    Classes come from both columns, so no row is left out; the counts per pair are all that the
    zeros are made from.
    """
    pairs = df.groupBy(F.col(truth).alias("true_class"), F.col(pred).alias("pred_class")).agg(
        F.count(F.lit(1)).alias("n")
    )
    classes = F.array_sort(
        F.array_distinct(F.concat(F.collect_set("true_class"), F.collect_set("pred_class")))
    )
    every = pairs.agg(classes.alias("c")).select(F.explode("c").alias("true_class"), "c")
    zeros = every.select("true_class", F.explode("c").alias("pred_class"), F.lit(0).alias("n"))
    return (
        pairs.unionByName(zeros).groupBy("true_class", "pred_class").agg(F.sum("n").alias("n"))
    )


def classification_report(df: DataFrame, truth: str = "label", pred: str = "pred") -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    Rows are counted per (true, predicted) pair first; all the rest works on those few counts.
    """
    pairs = df.groupBy(F.col(truth).alias("t"), F.col(pred).alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    hits = F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("t").alias("cls"), hits.alias("tp"), F.col("n").alias("support"), none.alias("predicted")),
        F.struct(F.col("p").alias("cls"), none.alias("tp"), none.alias("support"), F.col("n").alias("predicted")),
    )
    per_class = (
        pairs.select(F.inline(sides))
        .groupBy(F.col("cls").cast("string").alias("class"))
        .agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted")])
        .withColumn("precision", _ratio(F.col("tp"), F.col("predicted")))
        .withColumn("recall", _ratio(F.col("tp"), F.col("support")))
        .withColumn("f1", _f1(F.col("precision"), F.col("recall")))
    )
    measures = ["precision", "recall", "f1"]
    total = F.sum("support")
    accuracy = _ratio(F.sum("tp"), total)
    summary = per_class.agg(
        accuracy.alias("accuracy"),
        total.alias("support"),
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[_ratio(F.sum(F.col(m) * F.col("support")), total).alias(f"weighted_{m}") for m in measures],
    ).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(label).alias("class"),
                        *[F.col(source.format(m)).alias(m) for m in measures],
                        F.col("support"),
                    )
                    for label, source in (
                        ("accuracy", "accuracy"),
                        ("macro avg", "macro_{}"),
                        ("weighted avg", "weighted_{}"),
                    )
                ]
            )
        )
    )
    return per_class.select("class", *measures, "support").unionByName(summary)


def metric_log_rollup(
    log: DataFrame, epoch: str = "epoch", loss: str = "loss", step: str = "step", rate: str = "lr"
) -> DataFrame:
    """Per epoch: mean loss, its exponential, and the learning rate of the last step.

    A loss that is not a number makes its epoch's mean one too; null losses are no steps of it.
    """
    return (
        log.groupBy(epoch)
        .agg(
            F.count(loss).alias("n_steps"),
            F.avg(F.col(loss).cast("double")).alias("mean_loss"),
            F.max_by(rate, step).alias("last_rate"),
        )
        .withColumn("exp_loss", F.exp("mean_loss"))
    )
