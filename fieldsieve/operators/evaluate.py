"""Joining model answers per prompt, having them graded, and reading the grades."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import whole_div

# Fixed value: the mark in front of every answer in a combined text.
ANSWER_MARK = "[SEP]"


def combine_answers(
    answers: DataFrame,
    key: str = "prompt_id",
    model: str = "model",
    prompt: str = "prompt",
    response: str = "response",
) -> DataFrame:
    """Per prompt one text: every non-empty answer with a mark in front, in model order.

    The prompt is that of the last model; ``prompts_agree`` tells whether all rows had the same.
    ``models`` names the model of each answer, twice if a model answered twice; such answers are
    ordered by their text. A group holds one prompt's answers, as many as there are models.
    """
    given = F.when(F.col(response) != "", F.struct(F.col(model), F.col(response)))
    return (
        answers.groupBy(key)
        .agg(
            F.max_by(prompt, model).alias("prompt"),
            F.min(prompt).eqNullSafe(F.max(prompt)).alias("prompts_agree"),
            F.array_sort(F.collect_list(given)).alias("_given"),
        )
        .select(
            key,
            "prompt",
            "prompts_agree",
            F.array_join(
                F.transform("_given", lambda g: F.concat(F.lit(ANSWER_MARK), g[response])), " "
            ).alias("response"),
            F.transform("_given", lambda g: g[model].cast("string")).alias("models"),
        )
    )


# Fixed value: the form in which a judge is shown a prompt and its answers.
def judge_text(prompt: Column, response: Column) -> Column:
    return F.concat(F.lit("prompt: "), prompt, F.lit(" \nResponse: "), response)


def judge_answers(
    combined: DataFrame, rubrics: dict[str, Callable[[Column], Column]], key: str = "prompt_id"
) -> DataFrame:
    """One row per (prompt, rubric) with the judge's raw answer, a list of scores as text."""
    text = judge_text(F.col("prompt"), F.col("response"))
    graded = F.array(
        *[F.struct(F.lit(r).alias("rubric"), judge(text).alias("raw")) for r, judge in rubrics.items()]
    )
    return combined.select(key, "models", F.inline(graded))


def _prompt_and_answers(text: Column) -> tuple[Column, Column]:
    halves = F.split(text, " \nResponse: ", 2)
    prompt = F.substr(F.get(halves, F.lit(0)), F.lit(len("prompt: ") + 1))
    parts = F.split(F.get(halves, F.lit(1)), "\\[SEP\\]")
    return prompt, F.slice(parts, F.lit(2), F.size(parts) - 1)


def length_judge(step: int = 100) -> Callable[[Column], Column]:
    """A rule judge: one point plus one for every ``step`` characters, at most 5."""

    def judge(text: Column) -> Column:
        _, answers = _prompt_and_answers(text)

        def score(answer: Column) -> Column:
            steps = whole_div(F.length(F.trim(answer)), step).cast("int")
            return F.least(F.lit(5), steps + 1)

        return F.array_join(F.transform(answers, lambda a: score(a).cast("string")), ", ")

    return judge


def overlap_judge() -> Callable[[Column], Column]:
    """A rule judge: 1 to 5 by the share of the prompt's distinct words found in the answer."""

    def judge(text: Column) -> Column:
        prompt, answers = _prompt_and_answers(text)
        words = F.array_distinct(F.split(F.lower(prompt), " "))

        def score(answer: Column) -> Column:
            shared = F.size(F.array_intersect(words, F.split(F.lower(F.trim(answer)), " ")))
            return F.lit(1) + whole_div(F.lit(4) * shared, F.size(words)).cast("int")

        return F.array_join(F.transform(answers, lambda a: score(a).cast("string")), ", ")

    return judge


def _with_scores(judged: DataFrame, expected: Column) -> DataFrame:
    pieces = F.split(F.col("raw"), ",")
    scores = F.transform(pieces, lambda p: F.trim(p).try_cast("int"))
    reason = (
        F.when(F.col("raw").isNull(), "no answer")
        .when(F.size(pieces) != expected, "wrong count")
        .when(F.exists(scores, lambda s: s.isNull()), "not a number")
        .when(F.exists(scores, lambda s: (s < 1) | (s > 5)), "out of range")
    )
    return judged.withColumn("scores", scores).withColumn("reason", reason)


def parse_scores(judged: DataFrame, expected: Column) -> DataFrame:
    """Rows whose answer is exactly ``expected`` scores from 1 to 5, as ``array<int>``."""
    parsed = _with_scores(judged, expected)
    return parsed.where(F.col("reason").isNull()).drop("reason", "raw")


def rejected_scores(judged: DataFrame, expected: Column, key: str = "prompt_id") -> DataFrame:
    """The other rows, as quarantine rows."""
    parsed = _with_scores(judged, expected)
    return parsed.where(F.col("reason").isNotNull()).select(
        F.concat(F.lit("judge:"), F.col("rubric")).alias("stage"),
        F.col(key).cast("string").alias("key"),
        "reason",
    )


def score_summary(scored: DataFrame) -> DataFrame:
    """Per model and rubric: number of scores, mean, and how often each score was given."""
    pairs = F.arrays_zip(F.col("models").alias("model"), F.col("scores").alias("score"))
    return (
        scored.select("rubric", F.inline(pairs))
        .groupBy("model", "rubric")
        .agg(
            F.count(F.lit(1)).alias("n_scores"),
            (F.sum("score") / F.count(F.lit(1))).alias("mean_score"),
            *[F.count_if(F.col("score") == s).alias(f"n_{s}") for s in range(1, 6)],
        )
    )
