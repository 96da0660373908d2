import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from fieldsieve.__main__ import main
from fieldsieve.operators import classify, labels, metrics
from fieldsieve.operators.numbering import number_rows
from fieldsieve.plans.classifier import train_classifier
from fieldsieve.plans.labels import label_set
from fieldsieve.sinks.tables import rejected_answers


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, f"t{i};", i, 0) for i in range(21)]
    df = spark.createDataFrame(data, "id long, text string, token_count long, label int")
    return df.join(number_rows(df.select("id"), ["id"]), "id")


def test_groups_of_ten(rows):
    got = labels.groups_of(rows).orderBy("grp").collect()
    assert [r["text"].count(";") for r in got] == [10, 10, 1]
    assert got[0]["text"] == "".join(f"t{i};" for i in range(10))
    assert [r["token_count"] for r in got] == [45, 145, 20]


@pytest.mark.parametrize(("cap", "kept"), [(0, 21), (1, 1), (20, 20)])
def test_cap(rows, cap, kept):
    assert labels.cap_items(rows, cap).count() == kept


def test_only_exact_answers_accept(spark, rows):
    answers = spark.createDataFrame(
        [(0, "not-sports-related"), (1, "not-sports-related."), (2, None)], "grp long, response string"
    )
    assert sorted(r["id"] for r in labels.accept_by_group(rows, answers).collect()) == list(range(10))
    answers = spark.createDataFrame(
        [(0, "sports-related"), (1, "sports-related."), (2, None), (3, "not-sports-related")],
        "row long, response string",
    )
    assert [r["id"] for r in labels.accept_by_row(rows, answers).collect()] == [0]


def test_rule_judges(spark):
    texts = ["Nothing here. Nor there!", "A Goal. Rest\nrest", "goal. goal! rest", ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    some = [r[0] for r in df.select(labels.any_sentence_judge(["goal"])(F.col("text"))).collect()]
    most = [r[0] for r in df.select(labels.majority_judge(["goal"])(F.col("text"))).collect()]
    yes, no = labels.RELATED, labels.NOT_RELATED
    assert some == [no, yes, yes, no]
    assert most == [no, no, yes, no]


def test_python_judge_turns_errors_into_null(spark):
    def answer(text):
        if "bad" in text:
            raise RuntimeError("service down")
        return " sports-related \n"

    df = spark.createDataFrame([("ok",), ("bad",), (None,)], "text string")
    judged = labels.judge_documents(df.withColumn("id", F.col("text")), labels.python_judge(answer), keep=True)
    assert {r["id"]: r["response"] for r in judged.collect()} == {"ok": "sports-related", "bad": None, None: None}
    reasons = {r["key"]: r["reason"] for r in rejected_answers(judged, "id").collect()}
    assert reasons == {"bad": "RuntimeError: service down", None: "no text"}


def test_label_set(spark):
    pages = [(i, "sport" if i % 2 else "other", f"goal {i}." if i % 3 else "none.", 1, "en") for i in range(60)]
    pages.append((99, "sport", "goal.", 1, "de"))
    crawl = spark.createDataFrame(pages, "id long, url string, text string, token_count long, language string")
    yes = label_set(crawl, "id", 1, labels.majority_judge(["goal"]), keywords=["sport"])
    assert sorted(r["id"] for r in yes.collect()) == [i for i in range(60) if i % 2 and i % 3]
    capped = label_set(crawl, "id", 1, labels.majority_judge(["goal"]), cap=4, keywords=["sport"])
    assert sorted(r["id"] for r in capped.collect()) == [1, 5, 7]
    others = [i for i in range(60) if i % 2 == 0]
    judge = labels.any_sentence_judge(["goal 8"])
    no = label_set(crawl, "id", 0, judge, keywords=["sport"])
    assert sorted(r["id"] for r in no.collect()) == others[10:]
    one_group = label_set(crawl, "id", 0, labels.any_sentence_judge(["zzz"]), cap=1, keywords=["sport"])
    assert sorted(r["id"] for r in one_group.collect()) == others[:10]


def test_split_sizes_and_repeatability(spark):
    data = [(i, 0 if i < 10 else 1) for i in range(30)]
    df = spark.createDataFrame(data, "id long, label int")
    split = classify.stratified_split(df, "id")
    counts = {(r["label"], r["is_train"]): r["count"] for r in split.groupBy("label", "is_train").count().collect()}
    assert counts == {(0, True): 9, (0, False): 1, (1, True): 18, (1, False): 2}
    again = classify.stratified_split(df.repartition(5), "id")
    assert split.exceptAll(again).count() == 0


def test_metrics(spark):
    pairs = [(1, 1)] * 3 + [(1, 0)] + [(0, 1)] * 2 + [(0, 0)] * 4
    df = spark.createDataFrame(pairs, "label int, pred int")
    m = metrics.binary_metrics(df).first()
    assert (m["precision"], m["recall"], m["accuracy"]) == (3 / 5, 3 / 4, 7 / 10)
    assert m["f1"] == pytest.approx(2 / 3)
    matrix = {(r["true_class"], r["pred_class"]): r["n"] for r in metrics.confusion_matrix(df).collect()}
    assert matrix == {(0, 0): 4, (0, 1): 2, (1, 0): 1, (1, 1): 3}
    more = spark.createDataFrame([(0, 0), (1, 3), (3, 0), (5, 1)], "label int, pred int")
    matrix = {(r["true_class"], r["pred_class"]): r["n"] for r in metrics.confusion_matrix(more).collect()}
    assert sum(matrix.values()) == 4 and len(matrix) == 16 and matrix[1, 3] == matrix[5, 1] == 1
    report = {r["class"]: r for r in metrics.classification_report(df).collect()}
    assert report["0"]["precision"] == 4 / 5 and report["0"]["support"] == 6
    assert report["accuracy"]["f1"] == 0.7
    assert report["macro avg"]["recall"] == pytest.approx((4 / 6 + 3 / 4) / 2)
    assert report["weighted avg"]["recall"] == pytest.approx(0.7)


def test_undefined_ratios_are_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, pred int")
    m = metrics.binary_metrics(df).first()
    assert (m["precision"], m["recall"], m["f1"], m["accuracy"]) == (0.0, 0.0, 0.0, 1.0)
    assert {tuple(r) for r in metrics.confusion_matrix(df).collect()} == {(0, 0, 2)}


def test_classifier_learns(spark):
    data = [(i, [float(i % 2), 1.0 - i % 2, 0.1 * (i % 7)], i % 2) for i in range(200)]
    df = spark.createDataFrame(data, "id long, embedding array<float>, label int")
    features = classify.with_features(df)
    model = classify.embedding_pipeline().fit(features)
    scored = classify.score_with_model(features, model)
    assert scored.where("pred <> label").count() == 0
    centers = classify.class_centers(df, "embedding", "label")
    assert [c for c, _ in centers] == [0, 1]
    by_center = classify.score_by_center(df, centers)
    assert by_center.where("pred <> label").count() == 0
    assert classify.keep_positive(by_center).count() == 100


def test_training_and_labelling_jobs(spark, tmp_path):
    words = ["match goal team", "bank loan tax"]
    data = [(f"{words[i % 2]} {i}", 1 - i % 2) for i in range(200)] + [("odd", 7), ("odd", 3)]
    annotation = spark.createDataFrame(data, "text string, label int")
    result = train_classifier(annotation)
    assert result.metrics.first()["accuracy"] == 1.0
    assert {(r["label"], r["count"]) for r in result.other_labels.collect()} == {(5, 1), (3, 1)}
    annotation.write.parquet(str(tmp_path / "a"))
    main(["train", str(tmp_path / "a"), str(tmp_path / "m")])
    model = PipelineModel.load(str(tmp_path / "m"))
    assert classify.score_with_model(annotation.limit(4), model).count() == 4
    pages = [("the team. won.", "http://x/sport", 5, "en")] * 7 + [("team", "http://x/sport", 5, "en")] * 3
    pages += [("other", "http://x/y", 5, "en")] * 12
    schema = "text string, url string, token_count long, language string"
    spark.createDataFrame(pages, schema).write.parquet(str(tmp_path / "c"))
    main(["label", str(tmp_path / "c"), str(tmp_path / "l"), "--label", "1"])
    # Equal rows stay apart; a text is accepted when more than half of its sentences match.
    assert spark.read.parquet(str(tmp_path / "l")).count() == 3
    main(["label", str(tmp_path / "c"), str(tmp_path / "l0"), "--label", "0"])
    zero = spark.read.parquet(str(tmp_path / "l0"))
    assert zero.columns == ["text", "token_count", "label"] and zero.count() == 12


def test_batch_scorer(spark):
    df = spark.createDataFrame([(i, "x" * i) for i in range(30)], "id long, text string")
    scored = classify.score_with_function(df, lambda texts: [(10.0, len(t)) for t in texts])
    assert {r["id"] for r in scored.where("pred = 1").collect()} == set(range(11, 30))
    assert scored.columns == ["id", "text", "pred"]
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_split_keeps_rows_without_a_label(spark):
    df = spark.createDataFrame([(i, None if i < 10 else 1) for i in range(30)], "id long, label int")
    split = classify.stratified_split(df, "id")
    assert split.count() == 30 and split.where("label IS NULL AND is_train").count() == 9


def test_log_rollup(spark):
    log = spark.createDataFrame(
        [(0, 1.0, 1, 0.1), (0, 3.0, 2, 0.05), (1, 0.5, 3, 0.01)], "epoch int, loss double, step int, lr double"
    )
    got = {r["epoch"]: r for r in metrics.metric_log_rollup(log).collect()}
    assert (got[0]["mean_loss"], got[0]["last_rate"], got[0]["n_steps"]) == (2.0, 0.05, 2)
    assert got[1]["exp_loss"] == pytest.approx(1.6487212707)


def test_split_keeps_repeated_rows(spark):
    rows = [("same", 1)] * 20 + [(f"t{i}", 1) for i in range(30)] + [(f"u{i}", 0) for i in range(10)]
    df = spark.createDataFrame(rows, "text string, label int")
    split = classify.stratified_split(df, "text")
    assert split.count() == 60
    assert split.where("is_train and label = 1").count() == 45 and split.where("is_train and label = 0").count() == 9
    assert sum(r["support"] for r in train_classifier(df).report.where("class in ('0', '1')").collect()) == 6


def test_null_losses_are_no_steps(spark):
    log = spark.createDataFrame([(1, 2.0, 1, 0.1), (1, None, 2, 0.2)], "epoch int, loss double, step int, lr double")
    row = metrics.metric_log_rollup(log).first()
    assert (row["n_steps"], row["mean_loss"], row["last_rate"]) == (1, 2.0, 0.2)


def test_a_worker_loads_its_model_once(spark, tmp_path):
    seen = str(tmp_path)

    def load():
        import os
        import uuid

        open(f"{seen}/load-{os.getpid()}-{uuid.uuid4().hex}", "w").close()

        def scores(texts):
            assert [len(t) for t in texts] == sorted(len(t) for t in texts) and len(texts) <= 3
            open(f"{seen}/call-{os.getpid()}-{uuid.uuid4().hex}", "w").close()
            return [(2.0, float(len(t))) for t in texts]

        return scores

    rows = [(i, None if i % 10 == 0 else "x" * (i % 6)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, text string").repartition(16)
    scored = classify.score_with_loaded(df, load, batch=3).collect()
    assert len(scored) == 200
    assert all(r["pred"] == int(len(r["text"]) > 2) for r in scored if r["text"] is not None)
    loads = [f.name.split("-")[1] for f in tmp_path.glob("load-*")]
    assert len(loads) == len(set(loads)) and len(list(tmp_path.glob("call-*"))) >= 60


def test_equal_texts_are_encoded_once(spark):
    df = spark.createDataFrame([("a",), ("bb",), ("a",), (None,)], "text string")
    found = classify.encoded_once(df, lambda: lambda texts: [[float(len(t))] for t in texts]).collect()
    assert sorted(r["embedding"] for r in found) == [[1.0], [2.0]]
