"""Row selection and labelling by URL keyword."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keywords as kw

CRAWL_COLUMNS = ("text", "url", "token_count")


def keep_language(df: DataFrame, language: str = "en", column: str = "language") -> DataFrame:
    return df.where(F.col(column) == language)


def keep_matching(
    df: DataFrame, keywords: Iterable[str] = kw.SPORTS_KEYWORDS, column: str = "url"
) -> DataFrame:
    """Rows whose ``column`` holds any keyword."""
    return df.where(kw.contains_any(F.col(column), keywords))


def keep_other(
    df: DataFrame, keywords: Iterable[str] = kw.SPORTS_KEYWORDS, column: str = "url"
) -> DataFrame:
    """Rows whose ``column`` is present and holds no keyword."""
    return df.where(kw.contains_none(F.col(column), keywords))


def keep_matching_icase(
    df: DataFrame, keywords: Iterable[str] = kw.SPORTS_KEYWORDS, column: str = "url"
) -> DataFrame:
    return df.where(kw.contains_any_icase(F.col(column), keywords))


def keyword_report(
    df: DataFrame, keywords: Iterable[str] = kw.SPORTS_KEYWORDS, column: str = "url"
) -> DataFrame:
    """Rows matched per keyword, zero included.

    One conditional count per keyword in one aggregation: every task sends a single row, and no
    row is multiplied by its matches.
    """
    listed = kw.distinct_keywords(keywords)
    counts = [F.count_if(F.col(column).contains(k)).alias(f"k{i}") for i, k in enumerate(listed)]
    pairs = F.array(
        *[
            F.struct(F.lit(k).alias("keyword"), F.col(f"k{i}").alias("n_rows"))
            for i, k in enumerate(listed)
        ]
    )
    return df.agg(*counts).select(F.inline(pairs))


def row_keywords(
    df: DataFrame, key: str, keywords: Iterable[str] = kw.SPORTS_KEYWORDS, column: str = "url"
) -> DataFrame:
    """One row per (row, matched keyword)."""
    return df.select(key, F.explode(kw.matched_keywords(F.col(column), keywords)).alias("keyword"))


def label_by_keyword(
    df: DataFrame,
    keywords: Iterable[str] = kw.SPORTS_KEYWORDS,
    column: str = "url",
    keep: Sequence[str] = ("text", "token_count"),
) -> DataFrame:
    """Label 1 for matching rows and 0 for the rest; rows without a URL belong to neither."""
    match = kw.contains_any(F.col(column), keywords)
    return df.where(F.col(column).isNotNull()).select(
        *keep, F.when(match, 1).otherwise(0).alias("label")
    )


def two_keyword_sets(
    df: DataFrame,
    positive: str = "sport",
    negative: str = "business",
    column: str = "url",
    keep: Sequence[str] = ("text", "token_count"),
) -> DataFrame:
    """Rows with the negative keyword as label 0, then rows with the positive one as label 1.

    A row with both appears twice, once per label. Each row is read once: it is turned into the
    labels it earns.
    """
    found = F.filter(
        F.array(
            F.when(F.col(column).contains(negative), F.lit(0)),
            F.when(F.col(column).contains(positive), F.lit(1)),
        ),
        lambda label: label.isNotNull(),
    )
    either = df.where(kw.contains_any(F.col(column), [positive, negative]))
    return either.select(*keep, F.explode(found).alias("label"))


def sums_by_class(
    df: DataFrame, classes: dict[str, Iterable[str]], size: str, column: str = "url"
) -> DataFrame:
    """Rows and total ``size`` per named keyword class; classes may overlap."""
    flags = {name: kw.contains_any(F.col(column), words) for name, words in classes.items()}
    aggregates = []
    for name, flag in flags.items():
        aggregates += [
            F.count_if(flag).alias(f"{name}_rows"),
            F.coalesce(F.sum(F.when(flag, F.col(size))), F.lit(0)).cast("bigint").alias(f"{name}_size"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("class"),
                F.col(f"{name}_rows").alias("n_rows"),
                F.col(f"{name}_size").alias("total_size"),
            )
            for name in flags
        ]
    )
    return df.agg(*aggregates).select(F.inline(rows))


def funnel(
    df: DataFrame,
    stages: dict[str, Column],
    size: str,
    by: str = "dump",
) -> DataFrame:
    """Rows and sizes per dump that pass each stage and all stages before it, in one pass."""
    aggregates = [
        F.count(F.lit(1)).alias("rows_in"),
        F.sum(size).cast("bigint").alias("size_in"),
    ]
    passed = F.lit(True)
    for name, condition in stages.items():
        passed = passed & F.coalesce(condition, F.lit(False))
        aggregates += [
            F.count_if(passed).alias(f"rows_{name}"),
            F.coalesce(F.sum(F.when(passed, F.col(size))), F.lit(0))
            .cast("bigint")
            .alias(f"size_{name}"),
        ]
    return df.groupBy(by).agg(*aggregates)


def union_parts(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, repeats kept, columns matched by name."""
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first
