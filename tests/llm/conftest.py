import pytest

EDGE_TEXTS = [
    (1, "The cat sat on the mat and looked at the moon."),
    (2, ""),
    (3, None),
    (4, "one"),
    (5, "The cat sat on the mat and looked at the moon."),
    (5, "The cat sat on the mat and looked at the moon."),
    (None, "no id here"),
    (6, "word " * 30_000),
    (7, "x" * 50_000),
    (8, " \t\n "),
    (9, "Füße über naïve é\u2028 日本語 \U0001f600 <|endoftext|> don't  stop"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Documents with nulls, empty and very long texts, repeats, and columns that operators use."""
    names = "doc_id long, text string, lang string, source string, n_chars long, n long, row long, class long, score double, key string"
    rows = [
        (i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else f"s{k % 2}", None, k, k, k, 0.5, None)
        for k, (i, t) in enumerate(EDGE_TEXTS)
    ]
    return spark.createDataFrame(rows, names).repartition(3)


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.where("false")
