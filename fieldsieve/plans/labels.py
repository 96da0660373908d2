"""Building one side of a labelled training set with a judge."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keywords import SPORTS_KEYWORDS
from ..operators import filters, labels
from ..operators.joins import keep_listed
from ..operators.numbering import number_rows


def label_set(
    crawl: DataFrame,
    key: str,
    label: int,
    judge: labels.Judge,
    cap: int = 20000,
    keywords: Iterable[str] = SPORTS_KEYWORDS,
    language: str = "en",
    group: int = 10,
) -> DataFrame:
    """Rows (key, text, token_count, label) of one class that the judge accepted.

    Label 1: pages with a keyword, each judged by itself. Label 0: pages without one, judged in
    groups of ten joined texts and kept by group. ``cap`` limits the judged items; rows that were
    not judged are not kept. Answers are written once before they are used.
    """
    english = filters.keep_language(crawl, language)
    side = filters.keep_matching if label else filters.keep_other
    pages = side(english, keywords).select(key, "text", "token_count", F.lit(label).alias("label"))
    rows = number_rows(pages.select(key), [key])
    # The numbers decide what is kept; the texts join them once, for judging and at the end.
    if label:
        asked = pages.join(labels.cap_items(rows, cap), key).select("row", "text")
        accepted = labels.accept_by_row(rows, labels.judge_documents(asked, judge, keep=True))
    else:
        # Whole groups are judged, so the cap on groups is a cap on their rows.
        asked = pages.join(labels.cap_items(rows, cap * group), key)
        judged = labels.judge_documents(labels.groups_of(asked, group), judge, keep=True)
        accepted = labels.accept_by_group(rows, judged, group)
    return keep_listed(pages, accepted, key)
