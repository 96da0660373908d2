"""Keyword predicates over a string column."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The sports keywords that decide whether a crawl URL is kept. Literal,
# case-sensitive substrings.
SPORTS_KEYWORDS = (
    "football", "soccer", "basketball", "baseball", "tennis", "athlete", "running", "marathon",
    "copa", "new", "nike", "adidas", "cricket", "rugby", "golf", "volleyball", "sports", "sport",
    "Sport", "wrestling", "wwe", "hockey", "volleyball", "cycling", "swim", "athletic", "league",
    "team", "champion", "playoff", "olympic", "premierleague", "laliga", "bundesliga", "seriea",
    "ligue1", "epl", "racing", "nascar", "motogp", "cup", "worldcup", "fitness", "workout", "gym",
    "nfl", "nba", "NBA", "NFL", "MLB", "NHL", "FIFA", "UEFA", "NCAA", "MMA", "UFC", "ufc", "mlb",
    "nhl", "fifa", "uefa", "ncaa", "boxing", "espn", "bleacherreport", "mma", "si.com", "formula1",
    "f1", "nytimes/athletic", "apnews.com", "goal",
)


def distinct_keywords(keywords: Iterable[str]) -> list[str]:
    """Keywords without repeats, first occurrence kept."""
    kept = list(dict.fromkeys(keywords))
    if not kept or "" in kept:
        raise ValueError("keywords must be a non-empty list of non-empty strings")
    return kept


def needed_keywords(keywords: Iterable[str]) -> list[str]:
    """The keywords that decide an any-match: one containing another adds nothing."""
    kept = distinct_keywords(keywords)
    return [k for k in kept if not any(other != k and other in k for other in kept)]


def contains_any(column: Column, keywords: Iterable[str]) -> Column:
    """True where ``column`` holds at least one keyword; null where ``column`` is null.

    Plain substring tests joined by OR, so the test reaches the parquet reader as pushed filters
    and a keyword's dot stays a dot.
    """
    return reduce(or_, [column.contains(k) for k in needed_keywords(keywords)])


def contains_none(column: Column, keywords: Iterable[str]) -> Column:
    """True where ``column`` is present and holds no keyword."""
    return column.isNotNull() & ~contains_any(column, keywords)


def contains_any_icase(column: Column, keywords: Iterable[str]) -> Column:
    """Case-blind any-match; a null column does not match."""
    lowered = [k.lower() for k in keywords]
    return F.coalesce(contains_any(F.lower(column), lowered), F.lit(False))


def matched_keywords(column: Column, keywords: Iterable[str]) -> Column:
    """The array of all keywords found in ``column``, in list order."""
    listed = F.array(*[F.lit(k) for k in distinct_keywords(keywords)])
    return F.filter(listed, lambda k: F.contains(column, k))
