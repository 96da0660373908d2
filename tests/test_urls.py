import pytest
from pyspark.sql import functions as F

from fieldsieve.functions import keywords as kw
from fieldsieve.functions.text import clean_lines, path_part, strip_spaces, without_suffix
from fieldsieve.functions.vectors import argmax, clipped_label, rounded_label
from fieldsieve.operators import filters, joins
from fieldsieve.sources.text import (
    FILE_ENTRY, FOLDER_ENTRY, listing_entries, parse_json_lines, read_corpus_files,
    read_corpus_lines, read_mixture, read_numbered_lines,
)

URLS = ["http://si.com/a", "http://sixcom/a", "x/Sport", "x/SPORT", "x/news", None]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "id int, url string")


def urls(df):
    return [r["url"] for r in df.orderBy("id").collect()]


def test_keyword_list():
    assert len(kw.SPORTS_KEYWORDS) == 72
    assert len(kw.distinct_keywords(kw.SPORTS_KEYWORDS)) == 71
    needed = kw.needed_keywords(kw.SPORTS_KEYWORDS)
    assert len(needed) == 66 and "sports" not in needed and "sport" in needed
    with pytest.raises(ValueError):
        kw.distinct_keywords(["a", ""])


def test_matching_is_literal_and_case_sensitive(pages):
    assert urls(filters.keep_matching(pages)) == ["http://si.com/a", "x/Sport", "x/news"]
    assert urls(filters.keep_other(pages)) == ["http://sixcom/a", "x/SPORT"]
    icase = filters.keep_matching_icase(pages, ["sport"])
    assert urls(icase) == ["x/Sport", "x/SPORT"]


def test_reduced_list_decides_the_same(pages):
    every = F.exists(
        F.array(*[F.lit(k) for k in kw.SPORTS_KEYWORDS]), lambda k: F.contains(F.col("url"), k)
    )
    different = pages.where(F.col("url").isNotNull() & (every != kw.contains_any(F.col("url"), kw.SPORTS_KEYWORDS)))
    assert different.count() == 0


def test_labels_and_reports(spark, pages):
    labelled = filters.label_by_keyword(pages, keep=("id",))
    assert {(r["id"], r["label"]) for r in labelled.collect()} == {(0, 1), (1, 0), (2, 1), (3, 0), (4, 1)}
    both = spark.createDataFrame([(1, "a/sport/business"), (2, "sport"), (3, "x")], "id int, url string")
    sets = filters.two_keyword_sets(both, keep=("id",)).collect()
    assert sorted((r["id"], r["label"]) for r in sets) == [(1, 0), (1, 1), (2, 1)]
    hits = {r["keyword"]: r["n_rows"] for r in filters.keyword_report(both, ["sport", "zz"]).collect()}
    assert hits == {"sport": 2, "zz": 0}


def test_union_keeps_repeats(pages):
    assert filters.union_parts(pages, pages).count() == 2 * len(URLS)


def test_text_helpers(spark):
    rows = spark.createDataFrame([("  a \n\n\u3000b\r",), ("",), (" \n \t\n",), ("x \ny",)], "t string")
    cleaned = [r[0] for r in rows.select(clean_lines(F.col("t"))).collect()]
    assert cleaned == ["\na\nb", "\n", "\n", "\nx\ny"]
    texts = ["  a \n\n\u3000b\r", "\x1c q \x85", "plain", "\xa0"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(strip_spaces(F.col("t"))).collect()] == [t.strip() for t in texts]


def test_paths(spark):
    df = spark.createDataFrame([("d/CC/000_rap.parquet",), ("d/CC/plain",)], "p string")
    got = df.select(path_part(F.col("p"), 2), without_suffix(path_part(F.col("p"), 1))).collect()
    assert [tuple(r) for r in got] == [("CC", "000_rap"), ("CC", "plain")]


def test_label_values(spark):
    df = spark.createDataFrame([(-1.0,), (0.5,), (1.5,), (2.5,), (3.9,), (9.0,)], "v double")
    got = df.select(clipped_label(F.col("v")), rounded_label(F.col("v"))).collect()
    assert [r[0] for r in got] == [0, 0, 1, 2, 3, 5]
    assert [r[1] for r in got] == [-1, 0, 2, 2, 4, 9]
    scores = spark.createDataFrame([([0.1, 0.9, 0.9],), ([2.0, 1.0, 0.0],)], "s array<double>")
    assert [r[0] for r in scores.select(argmax(F.col("s"))).collect()] == [1, 0]


def test_semi_and_anti_joins_do_not_multiply(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "name string, n int")
    listed = spark.createDataFrame([("a",), ("a",)], "name string")
    assert joins.keep_listed(left, listed, "name").count() == 2
    assert [r["n"] for r in joins.not_yet_done(left, listed).collect()] == [3]


def test_listing(spark):
    html = (
        '<span class="truncate">CC-MAIN-2013-20</span><span class="big truncate x">CC-MAIN-2014-10</span>'
        '<span class="truncate">other</span><span class="notruncate">CC-MAIN-1</span>'
        '<span class="truncate group-hover:underline">000.parquet</span>'
    )
    page = spark.createDataFrame([(1, html)], "id int, html string")
    found = listing_entries(page, "id", entry=FOLDER_ENTRY, base=F.lit("http://h/data")).collect()
    assert [(r["entry"], r["child"]) for r in found] == [
        ("CC-MAIN-2013-20", "http://h/data/CC-MAIN-2013-20"),
        ("CC-MAIN-2014-10", "http://h/data/CC-MAIN-2014-10"),
    ]
    files = listing_entries(page, "id", entry=FILE_ENTRY, prefix="", base=F.lit("CC-MAIN-1")).collect()
    assert [r["child"] for r in files] == ["CC-MAIN-1/000.parquet"]


def test_json_lines(spark):
    lines = spark.createDataFrame(
        [('  {"text": "a"} ',), ("   ",), ("{broken",), ('{"other": 1}',)], "value string"
    )
    got = {(r["text"], r["_corrupt_record"] is None) for r in parse_json_lines(lines).collect()}
    assert got == {("a", True), (None, False), (None, True)}


def test_numbered_lines_follow_the_file(spark, tmp_path):
    lines = [f"line {i}" for i in range(500)]
    (tmp_path / "part-0.txt").write_text("\n".join(lines[:300]) + "\n")
    (tmp_path / "part-1.txt").write_text("\n".join(lines[300:]) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    try:
        got = read_numbered_lines(spark, str(tmp_path)).orderBy("line_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r["value"] for r in got] == lines
    assert [r["line_no"] for r in got] == list(range(500))


def test_corpus_encodings(spark, tmp_path):
    text = "première ligne\nζweite\n\U0001f600 third"
    (tmp_path / "a.txt").write_bytes(text.encode("utf-16-le"))
    path = str(tmp_path / "a.txt")
    assert [r[0] for r in read_corpus_lines(spark, path, "utf-16le").collect()] == text.split("\n")
    assert read_corpus_files(spark, path, "utf-16le").first()["value"] == text
    # The bytes 41 0a | 00 01 of two characters hold an encoded newline across their border.
    tricky = "a\u0a41\u0100b\nc"
    (tmp_path / "b.txt").write_bytes(tricky.encode("utf-16-le"))
    path = str(tmp_path / "b.txt")
    assert read_corpus_files(spark, path, "utf-16le").first()["value"] == tricky
    with pytest.raises(Exception, match="inside characters"):
        read_corpus_lines(spark, path, "utf-16le").collect()


def test_mixture_routing(spark, tmp_path):
    (tmp_path / "mix.txt").write_text("a 3 x 5\nb 4 y 9\n\n")
    positions = spark.range(9).withColumnRenamed("id", "i")
    parts = spark.createDataFrame([("a", 3, 5), ("b", 4, 4), ("c", 2, 0)], "p string, n long, w long")
    expected = [(i, "a", i % 3) if i < 5 else (i, "b", (i - 5) % 4) for i in range(9)]
    for mixture in (read_mixture(spark, str(tmp_path / "mix.txt")), joins.mixture_table(parts, "p", "n", "w")):
        routed = joins.route_to_mixture(positions, mixture, "i", "i").collect()
        assert sorted((r["i"], r["part"], r["local_position"]) for r in routed) == expected


def test_mixture_with_many_parts_and_a_large_one(spark):
    parts = spark.range(20_000).select(
        F.format_string("p%06d", "id").alias("p"),
        F.lit(1).cast("long").alias("n"),
        F.when(F.col("id") == 7_000, 10_000).otherwise(1).cast("long").alias("w"),
    )
    mixture = joins.mixture_table(parts, "p", "n", "w")
    positions = spark.range(29_999).select("id", F.col("id").alias("position"))
    routed = joins.route_to_mixture(positions, mixture, "id")
    assert routed.count() == 29_999
    assert routed.where("part = 'p007000'").agg(F.min("id"), F.max("id")).first() == (7_000, 16_999)
