"""Grading model answers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..session import pin
from ..sources.text import read_answers


def grade_answer_files(
    spark: SparkSession, files: dict[str, str], rubrics: dict[str, Callable[[Column], Column]]
) -> tuple[DataFrame, DataFrame]:
    """(scores, rejected) of line-aligned answer files, one per model.

    The judges' raw answers are written once; scores and rejected rows are read from them.
    """
    combined = ev.combine_answers(read_answers(spark, files))
    judged = pin(ev.judge_answers(combined, rubrics), "judged")
    expected = F.size("models")
    return ev.parse_scores(judged, expected), ev.rejected_scores(judged, expected)
