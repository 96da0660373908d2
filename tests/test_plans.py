"""Physical plans: what is pushed down, what stays in the JVM, what meets in one task."""

import re

import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()

JVM_ONLY = [
    "matches_per_host", "url_keyword_filter", "url_keyword_negative", "keyword_icase",
    "keyword_hits", "keyword_hits_per_row", "assign_label", "single_keyword_sets", "clip_label",
    "clean_lines", "url_semijoin", "group_semijoin", "positional_select", "align_answers",
    "mixture_route", "window_to_docs", "token_sum_by_class", "group_of_ten", "binary_metrics",
    "confusion_matrix", "classification_report", "char_vocab", "combine_answers", "score_summary",
    "metric_log_rollup", "funnel_report", "dense_row_number", "stream_offsets", "file_groups",
    "epoch_shuffle", "judge_cap", "stratified_split", "cubic_sample_plan", "random_sample_plan",
    "interleave_sources", "char_tokens", "decode_corpus", "score_corpus", "judge_answers",
]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", JVM_ONLY)
def test_stays_in_the_jvm_and_apart(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "EvalPython" not in text and "InPandas" not in text and "InArrow" not in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    # A single partition may only hold what is left of an aggregation.
    lines = text.split("\n")
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            below = next(x for x in lines[i + 1 :] if re.search(r"[A-Z]\w+", x) and "Project" not in x)
            assert "Aggregate" in below, f"{name}: {below}"


def test_keywords_and_columns_reach_the_scan(spark, small):
    text = plan(QUERIES["matches_per_host"](spark, small))
    assert "StringContains(url,casino)" in text
    narrow = plan(QUERIES["token_sum_by_class"](spark, small))
    assert "page_id" not in re.search(r"ReadSchema: (.*)", narrow).group(1)


def test_one_shuffle_for_a_hash_order(spark, small):
    """The totals join and the numbering window use the same distribution of the rows."""
    text = plan(QUERIES["epoch_shuffle"](spark, small)).split("== Initial Plan ==")[-1]
    rows = [x for x in text.split("\n") if "Exchange hashpartitioning(epoch" in x and "_slice" in x]
    assert len(rows) <= 2
