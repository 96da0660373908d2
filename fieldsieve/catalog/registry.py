"""Registration of queries and the views of the given tables they share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_QUERIES: dict[str, Query] = {}


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def query(sql: str | None = None):
    """Register a function (spark, folder) → DataFrame under its own name, with its SQL."""

    def add(function):
        _QUERIES[function.__name__] = Query(function, sql)
        return function

    return add


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- pages as a crawl table ---------------------------------------------------------------
# The URL's language part stands for the language and the dump, the size in bytes of the page
# for the token count.

PAGE_KEYWORDS = ("casino", "bets", "blog", "/en/")
TOPIC = ("casino", "pills", "ingtion")


def crawl(spark: SparkSession, folder: str) -> DataFrame:
    language = F.regexp_extract("url", "/([a-z][a-z])/", 1)
    return table(spark, folder, "pages").select(
        "page_id",
        "url",
        F.col("html").alias("text"),
        F.octet_length("html").cast("bigint").alias("token_count"),
        language.alias("language"),
        language.alias("dump"),
    )


CRAWL = """crawl AS (
  SELECT page_id, url, html AS text, CAST(octet_length(encode(html)) AS BIGINT) AS token_count,
         regexp_extract(url, '/([a-z][a-z])/', 1) AS language,
         regexp_extract(url, '/([a-z][a-z])/', 1) AS dump
  FROM pages)"""


def sql_any(column: str, words) -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


def joined(array: Column | str) -> Column:
    """An array of numbers as one text, numbers separated by blanks."""
    column = F.col(array) if isinstance(array, str) else array
    return F.array_join(column.cast("array<string>"), " ")


# --- documents as a token stream under the byte vocabulary --------------------------------

CTX = 512

SQL_TOKENS = """tok AS (
  SELECT doc_id, lang, list_transform(regexp_extract_all(hex(encode(text)), '..'),
                                lambda h: CAST('0x' || h AS INTEGER) + 1) || [0] AS ids
  FROM documents)"""


def sql_flat(name: str, where: str = "true") -> str:
    """CTEs: ``name`` (pos, id, doc_id) is the stream of the documents that satisfy ``where``."""
    return f"""{name}_rows AS (
  SELECT doc_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS place FROM tok WHERE {where}),
{name} AS (
  SELECT doc_id, id, row_number() OVER (ORDER BY doc_id, place) - 1 AS pos FROM {name}_rows)"""
