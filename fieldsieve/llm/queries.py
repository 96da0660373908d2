"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (
    align,
    binpack,
    bitplanes,
    collision_ann,
    jaccard_join,
    labelled,
    lexical_search,
    mixing,
    page_text,
    pieces,
    quality,
    simhash,
    toxicity,
    url_templates,
)
from .encoding import public_vocabulary

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(function):
        _QUERIES[function.__name__] = function
        if sql:
            _SQL[function.__name__] = sql
        return function

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def packed_digest(docs: DataFrame, capacity: int = 2048) -> DataFrame:
    """Where every piece of every document lies, with the checksum of its ids."""
    pieces = binpack.token_pieces(docs, public_vocabulary(), end_id=0, capacity=capacity)
    narrow = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return binpack.place_pieces(narrow, capacity).select(
        "doc_id",
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        "sequence_id",
        "offset",
    )


@query()
def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Sequences of at most 2048 ids, each document ended by id 0."""
    return packed_digest(table(spark, folder, "documents"))


@query()
def op7_bit_planes(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of all documents, each ended by id 2, written as byte planes and read back."""
    path = scratch_path(spark, "planes")
    bitplanes.write_ids(table(spark, folder, "documents"), path, public_vocabulary(), end_id=2)
    return bitplanes.read_ids(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


URL_RULES = (
    url_templates.Rule("net/", "block"),
    url_templates.Rule("example.net/en/", "allow"),
    url_templates.Rule("example.com/de/", "block"),
    url_templates.Rule("org/fr/", "allow"),
)


@query()
def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's verdict: its longest rule's, else its path template's."""
    return url_templates.judge_urls(table(spark, folder, "pages"), URL_RULES)


@query()
def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return simhash.edited_fingerprints(table(spark, folder, "documents"))


@query()
def op5_collision_counting(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 nearest of every hundredth vector among all others."""
    vectors = table(spark, folder, "embeddings").select(
        "vec_id", F.col("embedding").alias("vector")
    )
    return collision_ann.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


@query()
def op10_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return page_text.extract_text(table(spark, folder, "pages")).withColumn(
        "n_chars", F.length("text").cast("long")
    )


def toxicity_model(spark: SparkSession, folder: str) -> toxicity.ToxicityModel:
    """Fitted on the labelled documents of ``folder`` that are not held out."""
    return toxicity.fit(
        labelled.labelled_sample(
            table(spark, folder, "documents"), table(spark, folder, "labels"), "toxic",
            {1: toxicity.TOXIC_SAMPLE, 0: toxicity.ORDINARY_SAMPLE},
        )
    )


def quality_model(spark: SparkSession, folder: str) -> quality.QualityModel:
    """Fitted on the labelled documents of ``folder`` that are not held out."""
    return quality.fit(
        labelled.labelled_sample(
            table(spark, folder, "documents"), table(spark, folder, "labels"), "quality",
            {1: quality.GOOD_SAMPLE, 0: quality.BAD_SAMPLE},
        )
    )


TOXIC_FROM = 0.5
GOOD_FROM = 0.3


@query()
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's toxicity."""
    model = toxicity_model(spark, folder)
    return labelled.score_documents(table(spark, folder, "documents"), model.score, TOXIC_FROM)


@query()
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's quality."""
    model = quality_model(spark, folder)
    return labelled.score_documents(table(spark, folder, "documents"), model.score, GOOD_FROM)


@query()
def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have a similarity of 0.9 or more."""
    docs = table(spark, folder, "documents")
    return jaccard_join.similar_components(docs, jaccard_join.Similarity(words=3, percent=90))


#: The mixture: domains, then languages inside a domain; sources of a language count alike.
MIXTURE = {
    ("crawl",): 2, ("curated",): 3,
    ("crawl", "en"): 6, ("crawl", "de"): 2, ("crawl", "fr"): 2, ("crawl", "es"): 1,
    ("curated", "en"): 4, ("curated", "de"): 3, ("curated", "fr"): 2, ("curated", "es"): 2,
}
MIXTURE_SHARE = (1, 1)
MIXTURE_EPOCHS = 2
MIXTURE_SEED = 20


def with_domain(docs: DataFrame) -> DataFrame:
    """The first source is the open crawl, all others are curated."""
    domain = F.when(F.col("source") == "src0", "crawl").otherwise("curated")
    return docs.withColumn("domain", domain)


def _shared_sql(name: str, parent: list[str], path: list[str], above: str) -> str:
    """CTEs that share the budgets of ``above`` out to the nodes of ``path``."""
    columns = ", ".join(path)
    weight = "".join(
        f"WHEN {' AND '.join(f"{c} = '{v}'" for c, v in zip(path, key))} THEN {w} "
        for key, w in MIXTURE.items()
        if len(key) == len(path)
    )
    weight = f"CASE {weight} ELSE 1 END" if weight else "1"
    part = f"PARTITION BY {', '.join(parent)} " if parent else ""
    order = f"({part}ORDER BY lv, {path[-1]}"
    before = f"{order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    up_to = f"{order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    every = f"({part})"
    join = f"JOIN {above} a USING ({', '.join(parent)})" if parent else f"CROSS JOIN {above} a"
    return f"""
{name}_n AS (
  SELECT n.*, a.budget, capacity::DOUBLE / w::DOUBLE AS lv FROM (
    SELECT {columns}, sum(capacity)::HUGEINT AS capacity,
           ({weight})::HUGEINT * 1000000 AS w FROM leaves GROUP BY {columns}) n {join}),
{name}_f AS (
  SELECT *, CASE WHEN greatest(budget - coalesce(sum(capacity) OVER {before}, 0), 0) * w >=
      capacity * (sum(w) OVER {every} - coalesce(sum(w) OVER {before}, 0))
      THEN 0 ELSE 1 END AS nf FROM {name}_n),
{name}_o AS (SELECT *, max(nf) OVER {up_to} AS o FROM {name}_f),
{name}_r AS (
  SELECT *, greatest(budget - sum(CASE WHEN o = 0 THEN capacity ELSE 0 END) OVER {every}, 0) AS rest,
         sum(CASE WHEN o = 1 THEN w ELSE 0 END) OVER {every} AS ow,
         sum(o) OVER {up_to} AS rk FROM {name}_o),
{name}_s AS (
  SELECT *, CASE WHEN o = 1 THEN (rest::HUGEINT * w) // ow::HUGEINT ELSE capacity END AS share
  FROM {name}_r),
{name} AS (
  SELECT {columns}, share + CASE WHEN o = 1 AND rk <= rest -
      sum(CASE WHEN o = 1 THEN share ELSE 0 END) OVER {every} THEN 1 ELSE 0 END AS budget
  FROM {name}_s)"""


_LEVELS = list(mixing.LEVELS)
MIXTURE_SQL = f"""WITH docs AS (
  SELECT doc_id, CASE WHEN source = 'src0' THEN 'crawl' ELSE 'curated' END AS domain, lang, source,
         len(regexp_extract_all(text, '[^ \\t\\n\\r\\f\\x0B]+'))::BIGINT AS n_tokens
  FROM documents),
leaves AS (
  SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens,
         sum(n_tokens)::HUGEINT * {MIXTURE_EPOCHS} AS capacity
  FROM docs GROUP BY ALL),
whole AS (SELECT sum(tokens) * {MIXTURE_SHARE[0]} // {MIXTURE_SHARE[1]} AS budget FROM leaves),
{_shared_sql("b1", [], _LEVELS[:1], "whole")},
{_shared_sql("b2", _LEVELS[:1], _LEVELS[:2], "b1")},
{_shared_sql("b3", _LEVELS[:2], _LEVELS, "b2")},
leaf AS (
  SELECT l.domain, l.lang, l.source,
         CASE WHEN tokens > 0 THEN (budget::HUGEINT // tokens)::BIGINT ELSE 0 END AS whole,
         CASE WHEN tokens > 0 THEN (budget::HUGEINT % tokens)::BIGINT ELSE 0 END AS prefix
  FROM leaves l JOIN b3 USING (domain, lang, source)),
placed AS (
  SELECT doc_id, domain, lang, source, n_tokens, whole, prefix,
         coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source
           ORDER BY md5(concat('{MIXTURE_SEED}:', whole, ':', doc_id)), doc_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM docs JOIN leaf USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens,
       (whole + CASE WHEN place < prefix THEN 1 ELSE 0 END)::BIGINT AS copies
FROM placed WHERE whole > 0 OR place < prefix"""


def mixture(docs: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    return mixing.mix(
        with_domain(docs), MIXTURE, MIXTURE_SHARE, MIXTURE_EPOCHS, MIXTURE_SEED, carried=carried
    )


@query(MIXTURE_SQL)
def op3_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """How often each document is taken to meet the mixture's weights."""
    return mixture(table(spark, folder, "documents"))


@query()
def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's aligned tokens under two vocabularies, and how common their pairs are."""
    docs = table(spark, folder, "documents")
    found = align.align_documents(docs, public_vocabulary(), pieces.public_model(), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


@query()
def op12_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's piece ids and the text they decode to, as checksums."""
    return pieces.encode_documents(table(spark, folder, "documents"), pieces.public_model(), digests=True)


_TERMS_SQL = r"""list_filter(regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda t: t <> '')"""

SEARCH_SQL = f"""WITH docs AS (
  SELECT doc_id, terms, len(terms) AS n FROM (SELECT doc_id, {_TERMS_SQL} AS terms FROM documents)
  WHERE len(terms) > 0),
corpus AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM docs),
held AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM docs)
  GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM held, corpus GROUP BY term),
asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest({_TERMS_SQL}) AS term FROM benchmark) GROUP BY ALL),
scores AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) //
    (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term), corpus GROUP BY item_id, doc_id)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
  FROM scores WHERE score > 0) WHERE rank <= 10"""


@query(SEARCH_SQL)
def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 documents that rank highest for each benchmark item."""
    index = lexical_search.build_index(table(spark, folder, "documents"))
    return lexical_search.search(index, table(spark, folder, "benchmark"), k=10)
