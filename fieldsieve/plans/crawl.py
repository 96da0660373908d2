"""From crawl dumps to the kept pages: by URL keyword, then by classifier."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..functions.keywords import SPORTS_KEYWORDS
from ..operators import classify, filters
from ..sinks.tables import process_pending, write_dumps
from ..sources.crawl import CRAWL_SCHEMA, read_dumps

Scorer = Callable[[DataFrame], DataFrame]


def filter_crawl(
    spark: SparkSession,
    root: str,
    output: str,
    dumps: Sequence[str] | None = None,
    keywords: Iterable[str] = SPORTS_KEYWORDS,
) -> None:
    """Keep the pages whose URL holds a keyword, in one folder per dump.

    One scan with pushed predicates and three columns; only kept rows are moved.
    """
    crawl = read_dumps(spark, root, dumps).select(*filters.CRAWL_COLUMNS, "dump")
    write_dumps(filters.keep_matching(crawl, keywords), output)


def model_scorer(model: PipelineModel) -> Scorer:
    return lambda df: classify.score_with_model(df, model)


def clean_crawl(
    spark: SparkSession, filtered: str, output: str, manifest: str, scorer: Scorer
) -> None:
    """Keep the pages a classifier calls positive, dump by dump, skipping finished dumps.

    ``scorer`` adds ``pred``: :func:`model_scorer`, or a function around any batch scorer.
    """
    columns = [*filters.CRAWL_COLUMNS, "dump"]
    process_pending(
        spark,
        filtered,
        CRAWL_SCHEMA,
        lambda df: classify.keep_positive(scorer(df.select(*columns))).select(*columns),
        output,
        manifest,
    )
