"""Training sets, classifier scores and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import vectors
from ..operators import classify, filters, joins, labels, metrics
from ..operators.numbering import number_rows
from ..session import pin, scratch_path
from ..sinks import tables as tb
from .registry import CRAWL, PAGE_KEYWORDS, TOPIC, crawl, query, sql_any, table

ANY = sql_any("url", PAGE_KEYWORDS)


def _class_pages(spark, folder, positive: bool):
    """Pages of one keyword class, and the dense number of each (narrow rows)."""
    keep = filters.keep_matching if positive else filters.keep_other
    pages = keep(crawl(spark, folder), PAGE_KEYWORDS).withColumn("label", F.lit(int(positive)))
    return pages, number_rows(pages.select("page_id"), ["page_id"])


def _numbered(spark, folder, positive: bool):
    pages, rows = _class_pages(spark, folder, positive)
    return pages.join(rows, "page_id")


def sql_numbered(name: str, condition: str, label: int) -> str:
    return f"""{name} AS (SELECT page_id, url, text, token_count, {label} AS label,
  row_number() OVER (ORDER BY page_id) - 1 AS row FROM crawl WHERE {condition})"""


NEGATIVE = sql_numbered("neg", f"NOT {ANY}", 0)
POSITIVE = sql_numbered("pos", ANY, 1)
SENTENCES = r"list_filter(regexp_split_to_array(lower(text), '[.!?\n]+'), lambda s: length(trim(s)) > 0)"
HIT = sql_any("s", TOPIC)
ANY_JUDGE = (
    f"CASE WHEN len(list_filter({SENTENCES}, lambda s: {HIT})) > 0 "
    "THEN 'sports-related' ELSE 'not-sports-related' END"
)
MAJORITY_JUDGE = (
    f"CASE WHEN len(list_filter({SENTENCES}, lambda s: {sql_any('s', ('th', 'er'))})) * 2 > len({SENTENCES}) "
    "THEN 'sports-related' ELSE 'not-sports-related' END"
)
GROUPS = """grouped AS (SELECT row // 10 AS grp, string_agg(text, '' ORDER BY row) AS text,
  CAST(sum(token_count) AS BIGINT) AS token_count, CAST(sum(label) AS BIGINT) AS label
  FROM neg GROUP BY 1)"""


@query("""SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row FROM documents WHERE lang = 'en'""")
def dense_row_number(spark, folder):
    english = table(spark, folder, "documents").where(F.col("lang") == "en")
    return number_rows(english.select("doc_id"), ["doc_id"])


@query("""SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY n_chars, doc_id) - 1 AS row
FROM documents""")
def dense_row_number_by_source(spark, folder):
    docs = table(spark, folder, "documents").select("source", "n_chars", "doc_id")
    return number_rows(docs, ["n_chars", "doc_id"], by=["source"]).drop("n_chars")


@query(f"WITH {CRAWL}, {NEGATIVE}, {GROUPS} SELECT grp, text, token_count, label FROM grouped")
def group_of_ten(spark, folder):
    return labels.groups_of(_numbered(spark, folder, False))


@query(f"WITH {CRAWL}, {POSITIVE} SELECT page_id, row FROM pos WHERE row < 100")
def judge_cap(spark, folder):
    _, rows = _class_pages(spark, folder, True)
    return labels.cap_items(rows, 100)


@query(f"WITH {CRAWL}, {NEGATIVE}, {GROUPS} SELECT grp, token_count, {ANY_JUDGE} AS response FROM grouped")
def judge_documents(spark, folder):
    grouped = labels.groups_of(_numbered(spark, folder, False))
    judged = labels.judge_documents(grouped, labels.any_sentence_judge(TOPIC), keep=True)
    return judged.select("grp", "token_count", "response")


@query(f"""WITH {CRAWL}, {NEGATIVE}, {GROUPS}, judged AS (SELECT grp, {ANY_JUDGE} AS response FROM grouped)
SELECT page_id, token_count, label FROM neg
WHERE row // 10 IN (SELECT grp FROM judged WHERE response = 'not-sports-related')""")
def accept_label0(spark, folder):
    pages, rows = _class_pages(spark, folder, False)
    groups = labels.groups_of(pages.join(rows, "page_id"))
    judged = labels.judge_documents(groups, labels.any_sentence_judge(TOPIC), keep=True)
    accepted = labels.accept_by_group(rows, judged)
    return joins.keep_listed(pages, accepted, "page_id").select("page_id", "token_count", "label")


@query(f"""WITH {CRAWL}, {POSITIVE}, judged AS (SELECT row, {MAJORITY_JUDGE} AS response FROM pos)
SELECT page_id, token_count, label FROM pos
WHERE row IN (SELECT row FROM judged WHERE response = 'sports-related')""")
def accept_label1(spark, folder):
    pages, rows = _class_pages(spark, folder, True)
    asked = pages.join(labels.cap_items(rows, 0), "page_id").select("row", "text")
    judged = labels.judge_documents(asked, labels.majority_judge(("th", "er")), keep=True)
    accepted = labels.accept_by_row(rows, judged)
    return joins.keep_listed(pages, accepted, "page_id").select("page_id", "token_count", "label")


@query("""SELECT doc_id, n_chars FROM documents
WHERE source IN (SELECT source FROM documents GROUP BY source HAVING avg(n_chars) > 2500)""")
def group_semijoin(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source", "n_chars")
    accepted = docs.groupBy("source").agg(F.avg("n_chars").alias("mean")).where("mean > 2500")
    return joins.keep_listed(docs, accepted, "source").select("doc_id", "n_chars")


@query("""WITH r AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY doc_id) - 1 AS row FROM documents),
wanted AS (SELECT DISTINCT CAST(n_chars AS BIGINT) AS row FROM documents)
SELECT doc_id, n_chars FROM r WHERE row IN (SELECT row FROM wanted)""")
def positional_select(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "n_chars")
    wanted = docs.select(F.col("n_chars").alias("row"))
    return joins.keep_positions(docs, wanted, ["doc_id"])


@query("""WITH r AS (SELECT lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY md5('8:' || n_chars), n_chars) AS rank,
  count(*) OVER (PARTITION BY lang) AS n FROM documents)
SELECT lang, n_chars, count(*) AS n_rows, count(*) FILTER (WHERE rank <= (n * 9 + 9) // 10) AS n_train FROM r GROUP BY 1, 2""")
def stratified_split_repeats(spark, folder):
    """A split whose key, the length of a text, repeats: every row is placed once."""
    docs = table(spark, folder, "documents").select("n_chars", "lang")
    split = classify.stratified_split(docs, "n_chars", "lang")
    return split.groupBy("lang", "n_chars").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("is_train").alias("n_train")
    )


@query("""WITH r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality
  ORDER BY md5('8:' || doc_id), doc_id) AS rank, count(*) OVER (PARTITION BY quality) AS n FROM labels)
SELECT doc_id, quality, rank <= (n * 9 + 9) // 10 AS is_train FROM r""")
def stratified_split(spark, folder):
    labelled = table(spark, folder, "labels").select("doc_id", "quality")
    return classify.stratified_split(labelled, "doc_id", "quality")


SCORED = """scored AS (SELECT d.doc_id, l.quality AS label, CASE WHEN d.n_chars >= 1000 THEN 1 ELSE 0 END AS pred
  FROM labels l JOIN documents d USING (doc_id))"""


def _scored(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "n_chars")
    truth = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    return truth.join(docs, "doc_id").select(
        "doc_id", "label", F.when(F.col("n_chars") >= 1000, 1).otherwise(0).alias("pred")
    )


@query(f"""WITH {SCORED}, c AS (SELECT count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp,
  count(*) FILTER (WHERE pred = 1) AS pp, count(*) FILTER (WHERE label = 1) AS ap,
  count(*) FILTER (WHERE label = pred) AS hits, count(*) AS n FROM scored),
r AS (SELECT tp / pp AS precision, tp / ap AS recall, hits / n AS accuracy FROM c)
SELECT *, 2 * precision * recall / (precision + recall) AS f1 FROM r""")
def binary_metrics(spark, folder):
    return metrics.binary_metrics(_scored(spark, folder))


@query("""WITH s AS (SELECT l.quality + 2 * l.toxic AS t, CAST(least(4, d.n_chars // 1000) AS INTEGER) AS p
  FROM labels l JOIN documents d USING (doc_id)),
c AS (SELECT t AS c FROM s UNION SELECT p FROM s)
SELECT a.c AS true_class, b.c AS pred_class, (SELECT count(*) FROM s WHERE t = a.c AND p = b.c) AS n
FROM c a, c b""")
def confusion_matrix(spark, folder):
    """Both labels as one of four classes, against five classes of length."""
    docs = table(spark, folder, "documents").select("doc_id", "n_chars")
    scored = table(spark, folder, "labels").join(docs, "doc_id").select(
        (F.col("quality") + 2 * F.col("toxic")).alias("label"),
        F.least(F.lit(4), F.floor(F.col("n_chars") / 1000)).cast("int").alias("pred"),
    )
    return metrics.confusion_matrix(scored)


@query(f"""WITH {SCORED}, cls AS (SELECT DISTINCT label AS c FROM scored UNION SELECT DISTINCT pred FROM scored),
n AS (SELECT c, (SELECT count(*) FROM scored WHERE label = c AND pred = c) AS tp,
  (SELECT count(*) FROM scored WHERE label = c) AS support,
  (SELECT count(*) FROM scored WHERE pred = c) AS predicted FROM cls),
m AS (SELECT c, tp, support, tp / predicted AS precision, tp / support AS recall FROM n),
per AS (SELECT *, 2 * precision * recall / (precision + recall) AS f1 FROM m),
allrows AS (
SELECT CAST(c AS VARCHAR) AS class, precision, recall, f1, support FROM per
UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support) FROM per
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM per
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1 * support) / sum(support), sum(support) FROM per)
SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1,
  CAST(support AS BIGINT) AS support FROM allrows""")
def classification_report(spark, folder):
    report = metrics.classification_report(_scored(spark, folder))
    ratios = [F.round(m, 9).alias(m) for m in ("precision", "recall", "f1")]
    return report.select("class", *ratios, "support")


@query("""SELECT CAST(day(ts) AS INTEGER) AS epoch, count(value) AS n_steps,
  round(avg(value), 6) AS mean_loss,
  arg_max(user_id, event_id) AS last_rate,
  round(exp(avg(value) / 100), 6) AS exp_loss
FROM events GROUP BY 1""")
def metric_log_rollup(spark, folder):
    log = table(spark, folder, "events").select(
        F.dayofmonth("ts").alias("epoch"),
        F.col("value").alias("loss"),
        F.col("event_id").alias("step"),
        F.col("user_id").alias("lr"),
    )
    rolled = metrics.metric_log_rollup(log)
    # The values are no losses: their exponential is taken of a hundredth to stay readable.
    return rolled.select(
        "epoch",
        "n_steps",
        F.round("mean_loss", 6).alias("mean_loss"),
        "last_rate",
        F.round(F.exp(F.col("mean_loss") / 100), 6).alias("exp_loss"),
    )


# --- classifier ---------------------------------------------------------------------------


def _vectors(spark, folder):
    return table(spark, folder, "embeddings").select(
        "vec_id", "embedding", (F.col("label") == 2).cast("int").alias("label")
    )


def _sql_split(table_sql: str, key: str, floor: str) -> str:
    """Exact sizes of both parts per label, and that the head is right often enough."""
    return f"""WITH t AS ({table_sql}), r AS (SELECT label, row_number() OVER (PARTITION BY label
  ORDER BY md5('8:' || {key}), {key}) <= (count(*) OVER (PARTITION BY label) * 9 + 9) // 10 AS is_train FROM t)
SELECT label, count(*) FILTER (WHERE is_train) AS n_train, count(*) FILTER (WHERE NOT is_train) AS n_test,
  {floor} AS well_predicted FROM r GROUP BY 1"""


def _split_report(split, key, scored, floor):
    """Per label the rows of both parts, and whether the test rows reach ``floor`` accuracy."""
    sizes = split.groupBy("label").agg(
        F.count_if("is_train").alias("n_train"), F.count_if(~F.col("is_train")).alias("n_test")
    )
    hits = scored.agg((F.count_if(F.col("label") == F.col("pred")) >= floor * F.count(F.lit(1))).alias("well_predicted"))
    return sizes.join(F.broadcast(hits))  # one row


@query(_sql_split("SELECT vec_id, CAST(label = 2 AS INTEGER) AS label FROM embeddings", "vec_id", "true"))
def train_classifier(spark, folder):
    """A trained head: the parts it was trained and tested on, and its accuracy's floor of 0.85."""
    split = classify.stratified_split(_vectors(spark, folder), "vec_id")
    rows = classify.with_features(split)
    model = classify.embedding_pipeline().fit(rows.where("is_train"))
    scored = classify.score_with_model(rows.where(~F.col("is_train")), model)
    return _split_report(split, "vec_id", scored, 0.85)


@query(_sql_split(
    "SELECT doc_id, quality AS label FROM labels WHERE doc_id IN (SELECT doc_id FROM documents)", "doc_id", "true"
))
def train_text_classifier(spark, folder):
    """A head on hashed words, trained on the labelled documents, with a floor of 0.75."""
    truth = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    docs = table(spark, folder, "documents").select("doc_id", "text").join(truth, "doc_id")
    split = classify.stratified_split(docs, "doc_id")
    model = classify.text_pipeline().fit(split.where("is_train"))
    scored = classify.score_with_model(split.where(~F.col("is_train")), model)
    return _split_report(split, "doc_id", scored, 0.75)


@query("SELECT CAST(label = 2 AS INTEGER) AS label, count(*) AS n_rows, true AS well_predicted FROM embeddings GROUP BY 1")
def score_corpus_with_model(spark, folder):
    """The trained head over all vectors, with an accuracy of 0.85 or more."""
    rows = classify.with_features(_vectors(spark, folder))
    model = classify.embedding_pipeline().fit(rows)
    scored = classify.score_with_model(rows, model)
    hits = scored.agg((F.count_if(F.col("label") == F.col("pred")) >= 0.85 * F.count(F.lit(1))).alias("well_predicted"))
    return scored.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows")).join(F.broadcast(hits))


CENTERS = """v AS (SELECT vec_id, CASE WHEN label = 2 THEN 1 ELSE 0 END AS label, unnest(embedding)::DOUBLE AS value,
  generate_subscripts(embedding, 1) AS place FROM embeddings),
c AS (SELECT label, place, avg(value) AS mean FROM v GROUP BY 1, 2),
d AS (SELECT v.vec_id, c.label AS cls, sum((value - mean) * (value - mean)) AS dist FROM v JOIN c USING (place) GROUP BY 1, 2),
p AS (SELECT vec_id, CAST(arg_min(cls, dist) AS INTEGER) AS pred FROM d GROUP BY 1)"""


def _center_scored(spark, folder):
    vectors = _vectors(spark, folder)
    centers = classify.class_centers(vectors, "embedding", "label")
    return classify.score_by_center(vectors, centers)


@query(f"WITH {CENTERS} SELECT vec_id, pred FROM p")
def score_corpus(spark, folder):
    return _center_scored(spark, folder).select("vec_id", "pred")


@query(f"WITH {CENTERS} SELECT vec_id FROM p WHERE pred = 1")
def predicted_positive(spark, folder):
    return classify.keep_positive(_center_scored(spark, folder)).select("vec_id")


# --- hooks ------------------------------------------------------------------------------------


def _service(text: str) -> str:
    """Stands for an outside judge: it fails on long texts and adds white space to its answers."""
    if len(text) > 3000:
        raise TimeoutError("too long")
    return " sports-related\n" if "th" in text else "not-sports-related "


@query("""SELECT doc_id, CASE WHEN n_chars <= 3000 THEN
  CASE WHEN contains(text, 'th') THEN 'sports-related' ELSE 'not-sports-related' END END AS response,
  CASE WHEN n_chars > 3000 THEN 'TimeoutError: too long' END AS failure FROM documents""")
def judge_with_function(spark, folder):
    """Documents judged by a user's function; a call that fails has no answer but a reason."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return labels.judge_documents(docs, labels.python_judge(_service))


@query("""SELECT 'judge' AS stage, CAST(doc_id AS VARCHAR) AS key, 'TimeoutError: too long' AS reason
FROM documents WHERE n_chars > 3000""")
def judge_failures(spark, folder):
    """What goes to quarantine of the judged documents, with the reason of each failed call."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    judged = labels.judge_documents(docs, labels.python_judge(_service))
    path = scratch_path(spark, "judge-quarantine")
    tb.quarantine([tb.rejected_answers(judged, "doc_id")], path)
    return spark.read.parquet(path)


@query("SELECT doc_id, CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END AS pred FROM documents")
def score_with_function(spark, folder):
    """Documents scored by a user's batch function, one list of scores per text."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = classify.score_with_function(docs, lambda texts: [(1000.0, float(len(t))) for t in texts])
    return scored.select("doc_id", "pred")


def _letter_scores():
    """Stands for loading an encoder with a two-class head: scores are shares of letters."""

    def scores(texts):
        return [(2.0 * t.count("e"), float(t.count("a") + t.count("o"))) for t in texts]

    return scores


@query("""SELECT doc_id, CASE WHEN n_a > 2 * n_e THEN 1 ELSE 0 END AS pred FROM (SELECT doc_id,
  length(text) - length(replace(text, 'e', '')) AS n_e,
  length(text) - length(replace(replace(text, 'a', ''), 'o', '')) AS n_a FROM documents)""")
def score_with_loaded_model(spark, folder):
    """Documents scored by a model that each worker loads once, in batches of like lengths."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return classify.score_with_loaded(docs, _letter_scores).select("doc_id", "pred")


@query("""WITH t AS (SELECT CASE WHEN 2 * (length(text) - length(replace(text, 'e', ''))) <
    length(text) - length(replace(replace(text, 'a', ''), 'o', '')) THEN 1 ELSE 0 END AS label FROM documents)
SELECT label, count(*) AS n_rows, (count(*) * 9 + 9) // 10 AS n_train, true AS above_chance FROM t GROUP BY 1""")
def train_on_encoded(spark, folder):
    """From texts to a trained head: each distinct text is encoded once, the split is by the text's
    hash, and the held-out rows of each class are classified better than by chance."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    vectors_of = classify.encoded_once(docs, _letter_scores)
    rows = docs.select("doc_id", F.sha2("text", 256).alias("text_sha256")).join(vectors_of, "text_sha256")
    label = F.when(F.get("embedding", 0) < F.get("embedding", 1), 1).otherwise(0)
    split = pin(classify.stratified_split(rows.withColumn("label", label), "doc_id"), "split")
    featured = classify.with_features(split)
    model = classify.embedding_pipeline().fit(featured.where("is_train"))
    scored = classify.score_with_model(featured, model)
    right = F.avg(F.when(~F.col("is_train"), (F.col("pred") == F.col("label")).cast("int")))
    return scored.groupBy("label").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("is_train").alias("n_train"),
        F.coalesce(right > 0.5, F.lit(True)).alias("above_chance"),
    )


@query("SELECT event_id, CAST(round_even(value, 0) AS INTEGER) AS label FROM events")
def rounded_label(spark, folder):
    events = table(spark, folder, "events")
    return events.select("event_id", vectors.rounded_label(F.col("value")).alias("label"))
