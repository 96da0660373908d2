"""Selecting and labelling pages by URL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keywords as kw
from ..functions.text import clean_lines as clean
from ..functions.text import SPACE_CHARS
from ..functions.vectors import clipped_label
from ..operators import filters, joins
from ..sources import crawl as dumps
from .registry import CRAWL, PAGE_KEYWORDS, crawl, query, sql_any, table

ANY = sql_any("url", PAGE_KEYWORDS)


@query(f"""
SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, count(*) AS n_pages,
       CAST(sum(octet_length(encode(html))) AS BIGINT) AS total_size
FROM pages WHERE {ANY} GROUP BY 1""")
def matches_per_host(spark, folder):
    kept = filters.keep_matching(crawl(spark, folder), PAGE_KEYWORDS)
    host = F.regexp_extract("url", "^https?://([^/?#]+)", 1)
    return kept.groupBy(host.alias("host")).agg(
        F.count(F.lit(1)).alias("n_pages"), F.sum("token_count").alias("total_size")
    )


@query(f"WITH {CRAWL} SELECT page_id, url, text, token_count FROM crawl WHERE {ANY}")
def url_keyword_filter(spark, folder):
    kept = filters.keep_matching(crawl(spark, folder), PAGE_KEYWORDS)
    return kept.select("page_id", "url", "text", "token_count")


@query(f"""SELECT doc_id, source, n_chars FROM documents
WHERE {sql_any('text', kw.needed_keywords(kw.SPORTS_KEYWORDS))}""")
def sports_keyword_filter(spark, folder):
    docs = table(spark, folder, "documents")
    return filters.keep_matching(docs, kw.SPORTS_KEYWORDS, "text").select(
        "doc_id", "source", "n_chars"
    )


@query(f"WITH {CRAWL} SELECT page_id, url, token_count FROM crawl WHERE url IS NOT NULL AND NOT {ANY}")
def url_keyword_negative(spark, folder):
    kept = filters.keep_other(crawl(spark, folder), PAGE_KEYWORDS)
    return kept.select("page_id", "url", "token_count")


@query("""SELECT doc_id FROM documents
WHERE contains(lower(text), 'bundesliga') OR contains(lower(text), 'the a') OR contains(lower(text), 'und die')""")
def keyword_icase(spark, folder):
    docs = table(spark, folder, "documents")
    return filters.keep_matching_icase(docs, ["Bundesliga", "THE A", "Und Die"], "text").select("doc_id")


@query(
    "SELECT k AS keyword, (SELECT count(*) FROM pages WHERE contains(url, k)) AS n_rows FROM (VALUES "
    + ", ".join(f"('{k}')" for k in PAGE_KEYWORDS + ("www.", "m.", "utm_", "nothing"))
    + ") t(k)"
)
def keyword_hits(spark, folder):
    return filters.keyword_report(
        crawl(spark, folder), PAGE_KEYWORDS + ("www.", "m.", "utm_", "nothing")
    )


@query(
    "SELECT page_id, k AS keyword FROM pages JOIN (VALUES "
    + ", ".join(f"('{k}')" for k in PAGE_KEYWORDS)
    + ") t(k) ON contains(url, k)"
)
def keyword_hits_per_row(spark, folder):
    return filters.row_keywords(crawl(spark, folder), "page_id", PAGE_KEYWORDS)


@query(f"""WITH {CRAWL} SELECT text, token_count, CASE WHEN {ANY} THEN 1 ELSE 0 END AS label
FROM crawl WHERE url IS NOT NULL""")
def assign_label(spark, folder):
    return filters.label_by_keyword(crawl(spark, folder), PAGE_KEYWORDS)


@query(f"""WITH {CRAWL}
SELECT page_id, token_count, 0 AS label FROM crawl WHERE contains(url, 'blog')
UNION ALL
SELECT page_id, token_count, 1 AS label FROM crawl WHERE contains(url, '/en/')""")
def single_keyword_sets(spark, folder):
    return filters.two_keyword_sets(
        crawl(spark, folder), "/en/", "blog", keep=("page_id", "token_count")
    )


@query("""SELECT doc_id,
  CAST(least(greatest(trunc(quality * 7.5 - toxic * 9.5), 0), 5) AS INTEGER) AS label FROM labels""")
def clip_label(spark, folder):
    raw = F.col("quality") * F.lit(7.5) - F.col("toxic") * F.lit(9.5)
    return table(spark, folder, "labels").select("doc_id", clipped_label(raw).alias("label"))


@query(
    "SELECT doc_id, chr(10) || array_to_string(list_filter(list_transform(string_split(text, chr(10)), "
    f"lambda l: trim(l, '{SPACE_CHARS}')), lambda l: l <> ''), chr(10)) AS text FROM documents"
)
def clean_lines(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return docs.select("doc_id", clean(F.col("text")).alias("text"))


@query(f"""WITH {CRAWL} SELECT 'kept' AS class, count(*) AS n_rows, CAST(sum(token_count) AS BIGINT) AS total_size
FROM crawl WHERE {ANY}
UNION ALL SELECT 'blog', count(*), CAST(sum(token_count) AS BIGINT) FROM crawl WHERE contains(url, 'blog')
UNION ALL SELECT 'none', count(*), CAST(coalesce(sum(token_count), 0) AS BIGINT) FROM crawl WHERE contains(url, 'zzzz')""")
def token_sum_by_class(spark, folder):
    classes = {"kept": PAGE_KEYWORDS, "blog": ["blog"], "none": ["zzzz"]}
    return filters.sums_by_class(crawl(spark, folder), classes, "token_count")


@query(f"""WITH {CRAWL} SELECT dump, count(*) AS rows_in, CAST(sum(token_count) AS BIGINT) AS size_in,
  count(*) FILTER (WHERE {ANY}) AS rows_url,
  CAST(coalesce(sum(token_count) FILTER (WHERE {ANY}), 0) AS BIGINT) AS size_url,
  count(*) FILTER (WHERE {ANY} AND token_count >= 1500) AS rows_class,
  CAST(coalesce(sum(token_count) FILTER (WHERE {ANY} AND token_count >= 1500), 0) AS BIGINT) AS size_class
FROM crawl GROUP BY dump""")
def funnel_report(spark, folder):
    stages = {
        "url": kw.contains_any(F.col("url"), PAGE_KEYWORDS),
        "class": F.col("token_count") >= 1500,
    }
    return filters.funnel(crawl(spark, folder), stages, "token_count")


@query(f"WITH {CRAWL} SELECT text, url, token_count FROM crawl")
def project_columns(spark, folder):
    return crawl(spark, folder).select(*filters.CRAWL_COLUMNS)


@query(f"WITH {CRAWL} SELECT page_id, url, token_count FROM crawl WHERE language = 'en'")
def filter_language(spark, folder):
    return filters.keep_language(crawl(spark, folder)).select("page_id", "url", "token_count")


@query(f"WITH {CRAWL} SELECT page_id, dump, token_count FROM crawl WHERE dump IN ('de', 'fr')")
def select_patterns(spark, folder):
    wanted = spark.createDataFrame([("de",), ("fr",), ("not-there",)], "dump string")
    return dumps.select_dumps(crawl(spark, folder), wanted).select("page_id", "dump", "token_count")


@query(f"WITH {CRAWL} SELECT page_id, url FROM crawl WHERE url IN (SELECT url FROM pages WHERE {ANY})")
def url_semijoin(spark, folder):
    pages = crawl(spark, folder)
    listed = filters.keep_matching(pages, PAGE_KEYWORDS)
    return joins.keep_listed(pages, listed, "url").select("page_id", "url")


@query("""SELECT source AS name, count(*) AS n_docs FROM documents
WHERE source NOT IN ('src0', 'src3', 'src7') GROUP BY 1""")
def processed_antijoin(spark, folder):
    work = table(spark, folder, "documents").groupBy(F.col("source").alias("name")).agg(
        F.count(F.lit(1)).alias("n_docs")
    )
    done = spark.createDataFrame([("src0",), ("src3",), ("src7",)], "name string")
    return joins.not_yet_done(work, done)


@query(f"""WITH {CRAWL} SELECT page_id, url FROM crawl WHERE dump = 'en' AND {ANY}
UNION ALL SELECT page_id, url FROM crawl WHERE contains(url, 'blog')""")
def union_filtered(spark, folder):
    pages = crawl(spark, folder).select("page_id", "url", "dump")
    english = filters.keep_matching(pages.where(F.col("dump") == "en"), PAGE_KEYWORDS)
    blogs = filters.keep_matching(pages, ["blog"])
    return filters.union_parts(english, blogs).select("page_id", "url")
