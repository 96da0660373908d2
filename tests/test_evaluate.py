import json

from pyspark.sql import functions as F

from fieldsieve.operators import evaluate as ev
from fieldsieve.operators import joins
from fieldsieve.plans.evaluation import grade_answer_files
from fieldsieve.sources.text import read_answers


def write_lines(path, rows):
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    return str(path)


def test_combining(spark):
    rows = [(1, 0, "p", "a"), (1, 1, "p", ""), (1, 2, "q", "c"), (2, 0, "r", None), (2, 1, "r", "x [SEP]"), (2, 2, "r", "z")]
    answers = spark.createDataFrame(rows, "prompt_id long, model int, prompt string, response string")
    got = {r["prompt_id"]: r for r in ev.combine_answers(answers).collect()}
    assert got[1]["response"] == "[SEP]a [SEP]c" and got[1]["prompt"] == "q"
    assert not got[1]["prompts_agree"] and got[1]["models"] == ["0", "2"]
    assert got[2]["response"] == "[SEP]x [SEP] [SEP]z" and got[2]["prompts_agree"]


def test_alignment_stops_at_the_shortest(spark):
    rows = [("a", i, f"a{i}") for i in range(0, 50, 2)] + [("b", i, f"b{i}") for i in range(30)] + [("c", i, "c") for i in range(100)]
    answers = spark.createDataFrame(rows, "model string, k long, response string")
    got = sorted(tuple(r) for r in joins.align_by_position(answers, ["a", "b", "c"], ["k"]).collect())
    assert got == [(p, f"a{2 * p}", f"b{p}", "c") for p in range(25)]


def test_answer_files(spark, tmp_path):
    a = write_lines(tmp_path / "a.jsonl", [{"prompt": f"p{i}", "response": f"a{i}"} for i in range(5)])
    b = write_lines(tmp_path / "b.jsonl", [{"prompt": f"p{i}", "response": "" if i == 1 else f"b{i}"} for i in range(3)])
    files = {"a": a, "b": b}
    got = ev.combine_answers(read_answers(spark, files)).orderBy("prompt_id").collect()
    assert [(r["prompt"], r["response"]) for r in got] == [
        ("p0", "[SEP]a0 [SEP]b0"), ("p1", "[SEP]a1"), ("p2", "[SEP]a2 [SEP]b2"),
    ]
    rubrics = {"accuracy": ev.length_judge(), "broken": lambda text: F.lit("5, x")}
    scores, rejected = grade_answer_files(spark, files, rubrics)
    assert {(r["prompt_id"], tuple(r["scores"])) for r in scores.collect()} == {(0, (1, 1)), (1, (1,)), (2, (1, 1))}
    assert {(r["key"], r["reason"]) for r in rejected.collect()} == {
        ("0", "not a number"), ("1", "wrong count"), ("2", "not a number"),
    }
    empty = {"a": a, "b": write_lines(tmp_path / "c.jsonl", [])}
    assert read_answers(spark, empty).count() == 0


def test_score_parsing(spark):
    raws = ["1, 2, 3", "1,2", "1, x, 3", "9,1,1", None, " 5 ,5,5 "]
    df = spark.createDataFrame(
        [(i, ["m0", "m1", "m2"], "accuracy", r) for i, r in enumerate(raws)],
        "prompt_id int, models array<string>, rubric string, raw string",
    )
    kept = ev.parse_scores(df, F.lit(3))
    assert {r["prompt_id"]: r["scores"] for r in kept.collect()} == {0: [1, 2, 3], 5: [5, 5, 5]}
    bad = {r["key"]: r["reason"] for r in ev.rejected_scores(df, F.lit(3)).collect()}
    assert bad == {"1": "wrong count", "2": "not a number", "3": "out of range", "4": "no answer"}
    summary = {r["model"]: r for r in ev.score_summary(kept).collect()}
    assert summary["m0"]["mean_score"] == 3.0 and summary["m1"]["n_2"] == 1 and summary["m1"]["n_5"] == 1


def test_rule_judges(spark):
    df = spark.createDataFrame([("a b c d", "[SEP]a b x [SEP]" + "y" * 250)], "prompt string, response string")
    text = ev.judge_text(F.col("prompt"), F.col("response"))
    row = df.select(ev.length_judge()(text), ev.overlap_judge()(text)).first()
    assert tuple(row) == ("1, 3", "3, 1")
