"""Building a labelled training set: candidate groups, judging, and keeping what was accepted."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import keywords as kw
from ..functions.numbers import whole_div
from ..functions.text import sentences
from ..session import pin
from .joins import keep_listed

# The only two answers that count; anything else accepts nothing.
RELATED = "sports-related"
NOT_RELATED = "not-sports-related"

Judge = Callable[[Column], Column]


def groups_of(
    numbered: DataFrame,
    size: int = 10,
    row: str = "row",
    text: str = "text",
    sums: Sequence[str] = ("token_count", "label"),
) -> DataFrame:
    """Runs of ``size`` consecutive rows: texts joined without a separator, numbers summed."""
    totals = [F.sum(c).cast("bigint").alias(c) for c in sums]
    return numbered.groupBy(whole_div(F.col(row), size).alias("grp")).agg(
        F.expr(f"listagg(`{text}`, '') within group (order by `{row}`)").alias(text), *totals
    )


def cap_items(df: DataFrame, cap: int = 20000, row: str = "row") -> DataFrame:
    """The first ``cap`` rows by number; a cap of 0 means no cap."""
    return df.where(F.col(row) < cap) if cap else df


def any_sentence_judge(topic: Iterable[str]) -> Judge:
    """A rule judge: related when any sentence holds a topic word."""
    words = list(topic)

    def judge(text: Column) -> Column:
        hit = F.exists(sentences(F.lower(text)), lambda s: kw.contains_any(s, words))
        return F.when(hit, RELATED).otherwise(NOT_RELATED)

    return judge


def majority_judge(topic: Iterable[str]) -> Judge:
    """A rule judge: related when more than half of the sentences hold a topic word."""
    words = list(topic)

    def judge(text: Column) -> Column:
        parts = sentences(F.lower(text))
        hits = F.size(F.filter(parts, lambda s: kw.contains_any(s, words)))
        return F.when(hits * 2 > F.size(parts), RELATED).otherwise(NOT_RELATED)

    return judge


def python_judge(answer: Callable[[str], str]) -> Judge:
    """A judge from a plain function, such as a call to an outside service.

    Called once per text in Arrow batches; a failing call gives no answer, not a failed job, and
    ``failure`` says why: the exception's class and text. Spark is told that answers may vary, so it
    neither repeats nor moves the call.
    """

    def one(text: str | None) -> tuple[str | None, str | None]:
        if text is None:
            return None, "no text"
        try:
            return answer(text).strip(), None
        except Exception as error:  # noqa: BLE001 - whatever an outside call raises is its reason
            return None, f"{type(error).__name__}: {error}"

    @F.pandas_udf("answer string, failure string")
    def judge(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(list(map(one, texts)), columns=["answer", "failure"], dtype=object)

    return judge.asNondeterministic()


def judge_documents(df: DataFrame, judge: Judge, text: str = "text", keep: bool = True) -> DataFrame:
    """Add ``response``, and ``failure`` where the judge says why it has no answer.

    The answers are written once, without the texts, and read from there by everything that
    follows; ``keep=False`` is for rule judges, which may be asked again.
    """
    judged = df.withColumn("response", judge(F.col(text)))
    if isinstance(judged.schema["response"].dataType, T.StructType):
        said = {"response": F.col("response.answer"), "failure": F.col("response.failure")}
        # A struct is taken apart after it is written: the judge is asked once for both fields.
        judged = pin(judged.drop(text) if keep else judged, "judged").withColumns(said)
        return judged
    return pin(judged.drop(text), "judged") if keep else judged


def accept_by_group(
    numbered: DataFrame, judged_groups: DataFrame, size: int = 10, row: str = "row"
) -> DataFrame:
    """Rows of the groups judged to hold nothing about the topic (label 0)."""
    accepted = judged_groups.where(F.col("response") == NOT_RELATED)
    grouped = numbered.withColumn("grp", whole_div(F.col(row), size))
    return keep_listed(grouped, accepted, "grp").drop("grp")


def accept_by_row(numbered: DataFrame, judged_rows: DataFrame, row: str = "row") -> DataFrame:
    """Rows judged to be mainly about the topic (label 1)."""
    accepted = judged_rows.where(F.col("response") == RELATED)
    return keep_listed(numbered, accepted, row)
