"""Training the document classifier and reporting how it does on held-out rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import clipped_label
from ..operators import classify, metrics
from ..session import pin


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    metrics: DataFrame
    report: DataFrame
    matrix: DataFrame
    other_labels: DataFrame


def train_classifier(
    annotation: DataFrame, pipeline: Pipeline | None = None, label: str = "label"
) -> Trained:
    """Clip the labels, split 90/10 per label, train on 0/1, and score the held-out rows.

    The head has two classes; rows with other labels are counted in ``other_labels`` and left out.
    The split goes by a key made from a row's content (equal rows are interchangeable), and its
    rows are written once, so training passes and reports read the same table.
    """
    clipped = annotation.withColumn(label, clipped_label(F.col(label)))
    keyed = clipped.withColumn("_row", F.xxhash64(*sorted(clipped.columns)))
    two = keyed.where(F.col(label).isin(0, 1))
    rows = pin(classify.stratified_split(two, "_row", label), "annotation")
    model = (pipeline or classify.text_pipeline(label=label)).fit(rows.where("is_train"))
    scored = pin(classify.score_with_model(rows.where(~F.col("is_train")), model).select(label, "pred"), "scored")
    return Trained(
        model,
        metrics.binary_metrics(scored, label),
        metrics.classification_report(scored, label),
        metrics.confusion_matrix(scored, label),
        clipped.where(~F.col(label).isin(0, 1)).groupBy(label).count(),
    )
