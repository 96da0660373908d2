"""Model answers per prompt: conversations stand for answer files, turn numbers for models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..operators import joins
from ..session import scratch_path
from ..sources.text import read_answers
from .registry import query, table

ANSWERS = """first_user AS (SELECT conv_id, arg_min(text, turn) AS prompt FROM conversations WHERE role = 'user' GROUP BY 1),
answers AS (SELECT conv_id AS prompt_id, turn AS model, prompt, text AS response
  FROM conversations JOIN first_user USING (conv_id) WHERE role = 'assistant')"""


def _answers(spark, folder):
    turns = table(spark, folder, "conversations")
    prompts = turns.where("role = 'user'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("prompt"))
    return (
        turns.where("role = 'assistant'")
        .join(prompts, "conv_id")
        .select(
            F.col("conv_id").alias("prompt_id"),
            F.col("turn").alias("model"),
            "prompt",
            F.col("text").alias("response"),
        )
    )


def _combined(spark, folder):
    return ev.combine_answers(_answers(spark, folder))


COMBINED = f"""{ANSWERS},
combined AS (SELECT prompt_id, arg_max(prompt, model) AS prompt, min(prompt) = max(prompt) AS prompts_agree,
  coalesce(string_agg('[SEP]' || response, ' ' ORDER BY model) FILTER (WHERE response <> ''), '') AS response,
  coalesce(list(CAST(model AS VARCHAR) ORDER BY model) FILTER (WHERE response <> ''), []) AS models
  FROM answers GROUP BY prompt_id)"""


def _models(answers) -> list:
    """The models of an answer table: each becomes a file or a column, so a list has them all."""
    return sorted(r["model"] for r in answers.select("model").distinct().collect())


@query("""WITH a AS (SELECT turn AS model, text, row_number() OVER (PARTITION BY turn ORDER BY conv_id) - 1 AS position
  FROM conversations WHERE role = 'assistant')
SELECT position, string_agg(text, chr(31) ORDER BY model) AS answers FROM a GROUP BY 1
HAVING count(*) = (SELECT count(DISTINCT model) FROM a)""")
def align_answers(spark, folder):
    answers = table(spark, folder, "conversations").where("role = 'assistant'").select(
        F.col("turn").alias("model"), "conv_id", F.col("text").alias("response")
    )
    models = _models(answers)
    aligned = joins.align_by_position(answers, models, ["conv_id"])
    columns = [c for c in aligned.columns if c != "position"]
    return aligned.select("position", F.concat_ws("\x1f", *columns).alias("answers"))


@query("""WITH a AS (SELECT conv_id % 50 AS prompt_id, turn AS model, text FROM conversations WHERE role = 'assistant')
SELECT prompt_id, string_agg('[SEP]' || text, ' ' ORDER BY model, text COLLATE "C") AS response, count(*) AS n_answers
FROM a GROUP BY 1""")
def combine_repeated_answers(spark, folder):
    """Conversations folded onto few prompts, so that a model answers a prompt more than once."""
    answers = table(spark, folder, "conversations").where("role = 'assistant'").select(
        (F.col("conv_id") % 50).alias("prompt_id"), F.col("turn").alias("model"),
        F.lit("").alias("prompt"), F.col("text").alias("response"),
    )
    return ev.combine_answers(answers).select(
        "prompt_id", "response", F.size("models").cast("long").alias("n_answers")
    )


@query(f"""WITH {COMBINED} SELECT prompt_id, prompt, prompts_agree, response, array_to_string(models, ' ') AS models FROM combined""")
def combine_answers(spark, folder):
    return _combined(spark, folder).withColumn("models", F.array_join("models", " "))


@query(f"""WITH f AS (SELECT conv_id, arg_min(text, turn) AS prompt FROM conversations WHERE role = 'user' GROUP BY 1),
a AS (SELECT turn AS model, prompt, text, row_number() OVER (PARTITION BY turn ORDER BY conv_id) - 1 AS prompt_id
  FROM conversations JOIN f USING (conv_id) WHERE role = 'assistant')
SELECT prompt_id, arg_max(prompt, model) AS prompt, string_agg('[SEP]' || text, ' ' ORDER BY model) AS response
FROM a GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT model) FROM a)""")
def combine_answer_files(spark, folder):
    """The answers as one folder of JSON lines per model, zipped by line and combined."""
    path = scratch_path(spark, "answers")
    ordered = _answers(spark, folder).repartitionByRange(4, "model", "prompt_id")
    (
        ordered.sortWithinPartitions("model", "prompt_id")
        .select("model", "prompt", "response")
        .write.partitionBy("model").json(path)
    )
    files = {str(m): f"{path}/model={m}" for m in _models(ordered)}
    combined = ev.combine_answers(read_answers(spark, files))
    return combined.select("prompt_id", "prompt", "response")


# The two rule judges, written out for one answer ``a`` of the list ``parts``.
SQL_JUDGED = f"""{COMBINED},
asked AS (SELECT prompt_id, models, 'prompt: ' || prompt || ' ' || chr(10) || 'Response: ' || response AS t,
  prompt, string_split(response, '[SEP]')[2:] AS parts FROM combined),
judged AS (
  SELECT prompt_id, models, 'accuracy' AS rubric, array_to_string(list_transform(parts,
    lambda a: CAST(least(5, 1 + length(trim(a)) // 100) AS VARCHAR)), ', ') AS raw FROM asked
  UNION ALL
  SELECT prompt_id, models, 'relevance', array_to_string(list_transform(parts, lambda a: CAST(1 +
    (4 * len(list_intersect(list_distinct(string_split(lower(prompt), ' ')), string_split(lower(trim(a)), ' '))))
    // len(list_distinct(string_split(lower(prompt), ' '))) AS VARCHAR)), ', ') FROM asked)"""


def _judged(spark, folder):
    rubrics = {"accuracy": ev.length_judge(), "relevance": ev.overlap_judge()}
    return ev.judge_answers(_combined(spark, folder), rubrics)


@query(f"WITH {SQL_JUDGED} SELECT prompt_id, rubric, raw FROM judged")
def judge_answers(spark, folder):
    return _judged(spark, folder).select("prompt_id", "rubric", "raw")


# Fixed number of expected answers: rows with another number of scores are set aside.
EXPECTED = 2


@query(f"""WITH {SQL_JUDGED} SELECT prompt_id, rubric, replace(raw, ' ', '') AS scores FROM judged
WHERE len(string_split(raw, ',')) = {EXPECTED} AND raw <> ''""")
def parse_scores(spark, folder):
    kept = ev.parse_scores(_judged(spark, folder), F.lit(EXPECTED))
    return kept.select("prompt_id", "rubric", F.array_join(F.col("scores").cast("array<string>"), ",").alias("scores"))


@query(f"""WITH {SQL_JUDGED} SELECT 'judge:' || rubric AS stage, CAST(prompt_id AS VARCHAR) AS key,
  'wrong count' AS reason FROM judged WHERE len(string_split(raw, ',')) <> {EXPECTED}""")
def rejected_scores(spark, folder):
    return ev.rejected_scores(_judged(spark, folder), F.lit(EXPECTED))


@query(f"""WITH {SQL_JUDGED}, s AS (SELECT rubric, unnest(models) AS model, CAST(unnest(string_split(raw, ', ')) AS INTEGER) AS score FROM judged)
SELECT model, rubric, count(*) AS n_scores, sum(score) / count(*) AS mean_score,
  count(*) FILTER (WHERE score = 1) AS n_1, count(*) FILTER (WHERE score = 2) AS n_2,
  count(*) FILTER (WHERE score = 3) AS n_3, count(*) FILTER (WHERE score = 4) AS n_4,
  count(*) FILTER (WHERE score = 5) AS n_5 FROM s GROUP BY 1, 2""")
def score_summary(spark, folder):
    scored = ev.parse_scores(_judged(spark, folder), F.size("models"))
    return ev.score_summary(scored)
