import re

import check
import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldsieve.llm import collision_ann as ann
from fieldsieve.llm import page_text, queries, url_templates
from fieldsieve.llm.url_templates import Rule

RULES = queries.URL_RULES


# --- urls -------------------------------------------------------------------------------------


def by_hand(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fit = [
        r for r in RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fit, key=lambda r: len(r.rule), default=None)
    return host, path, best and best.rule, best and best.verdict


URLS = [
    "http://a.example.net/en/1", "https://EXAMPLE.net/en/x?y://z", "http://net/", "http://notnet.com/", "http://net",
    "ftp://b.example.com/de/9.html#f", "http://example.com/dex", "http://x.org/fr/", "http://x.org/fr", "no host",
    "", None, "http://", "http:///path", "http://h?q=/net/", "://x.net/a\nb", "http://ÄB.net/en/", "a://b://c.net/",
]


def test_parsing_and_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)) + [(None, URLS[0]), (0, URLS[0])], "page_id long, url string")
    clashing = pages.selectExpr("*", "1 AS host", "2 AS path", "3 AS rule", "4 AS n", "5 AS template", "6 AS shape")
    rows = url_templates.judge_urls(clashing, RULES).collect()
    assert len(rows) == len(URLS) + 2
    for r in rows:
        host, path, rule, verdict = by_hand(URLS[r["page_id"] or 0])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
    assert url_templates.judge_urls(clashing.where("false"), RULES).count() == 0


def test_templates_carry_labels_to_unruled_pages(spark):
    rules = [Rule("shop.test/deals/spring", "block"), Rule("shop.test/help/", "allow")]
    urls = [f"http://shop.test/deals/{s}{i}/item{i}" for s in ("spring", "autumn") for i in range(40)]
    urls += [f"http://shop.test/help/{w}" for w in ("pay", "ship", "mail", "size") for _ in range(5)]
    urls += [f"http://other.test/deals/autumn{i}/item{i}" for i in range(40)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = {r["page_id"]: r for r in url_templates.judge_urls(pages, rules).collect()}
    assert all(rows[i]["verdict"] == "block" for i in range(40))
    assert all(rows[i]["verdict"] == "allow" for i in range(80, len(urls)))
    assert len({rows[i]["template"] for i in range(40)}) == 1


def test_many_rare_segments_become_a_wildcard(spark):
    words = [a + b for a in ("red", "blue", "old", "new", "big", "wee") for b in ("cat", "dog", "owl", "fox")]
    urls = [f"http://h.test/user/{w}{x}/posts" for w in words for x in "abc"] + ["http://h.test/about"] * 9
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = url_templates.judge_urls(pages, []).collect()
    assert {r["template"] for r in rows} == {"/user/*/posts", "/about"}
    assert {r["verdict"] for r in rows} == {"allow"}


# --- pages --------------------------------------------------------------------------------------

ARTICLE = """<html><head><title>t</title><style>p{}</style></head><body class="has-sidebar">
<header><h2>Site</h2></header><nav><a href="/">Home</a></nav><div class="cookie-banner">We use cookies</div>
<article><h1>A &amp; B</h1><p>First <b>bold</b> text<br>goes  on.<p>Second &lt;one&gt;&nbsp;x</p>
<div class="ad">Buy</div><form>Name <input></form><script>var a = "<p>no</p>";</script>
<ul><li>one<li>two</ul><!-- <p>gone</p> --><section class="comments"><p>Nice post</p></section></article>
<aside>Related</aside><footer>&copy; x</footer></body>"""


def test_article_of_a_page():
    assert page_text.main_text(ARTICLE) == "A & B\n\nFirst bold text goes on.\n\nSecond <one> x\n\none\n\ntwo"
    assert page_text.main_text("") == "" and page_text.main_text("plain  text") == "plain text"
    assert page_text.main_text("<p>a <b>b<p>c < d") == "a b\n\nc < d"
    assert page_text.main_text("<article><p>" + "<div>" * 3000 + "deep") == "deep"
    assert page_text.main_text("<article><p>cut <scr") == "cut <scr"


def test_article_text_is_not_taken_for_an_aside():
    article = "<article><p>Whole article</p></article>"
    for wrapper in ("class='page has-sidebar'", "id='no-comments'", "class='sidebar'", "class='ad-free'"):
        assert page_text.main_text(f"<div {wrapper}>{article}<div class='cookie-banner'>We use</div></div>") == "Whole article"
    assert page_text.main_text(f"{article}<div class='related'><article>Teaser</article></div>") == "Whole article"
    assert page_text.main_text(f"{article}<div id='comments'><article>Nice</article></div>") == "Whole article"
    shown = "<p title='the hidden door'>a</p><p class='md:block hidden lg'>b</p><p data-x='display:none'>c</p>"
    assert page_text.main_text(f"<article>{shown}<p hidden>x</p><p style='color:red; display : none'>y</p>") == "a\n\nb\n\nc"
    drawn = "<p>one <svg viewBox='0'/>two <math/>three <svg><text>no</text></svg>four</p><p>five <object>six</p>"
    assert page_text.main_text(f"<article>{drawn}") == "one two three four\n\nfive six"
    assert page_text.main_text("<article><p>if <math><mi>x</mi><mo>=</mo><mn>2</mn></math> then") == "if x=2 then"


def test_template_finds_the_content_without_an_article(spark):
    def page(i):
        body = "".join(f"<p>Paragraph {i} {k} has its own words and more of them.</p>" for k in range(1 + i % 3))
        return (
            f"<body><div id='top'>Welcome to the site of many pages</div><div class='post'>{body}</div>"
            f"<div class='links'><a href='/{i}'>see number {i}</a> <a href='/x'>and this</a></div></body>"
        )

    rows = [(i, f"http://h{i % 2}.test/{i}", page(i)) for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in page_text.extract_text(pages).collect()}
    for i in range(20):
        wanted = [f"Paragraph {i} {k} has its own words and more of them." for k in range(1 + i % 3)]
        assert got[i] == "\n\n".join(wanted)


def texts_of(spark, htmls):
    rows = [(i, f"http://h.test/{i}", h) for i, h in enumerate(htmls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in page_text.extract_text(pages).collect()}


def test_template_decides_on_pages_with_an_article(spark):
    def line(i):
        return f"Page {i} tells of its own things in a sentence of some length, as others do."

    inside = [
        f"<body><article><h1>Title {i}</h1><p>{line(i)}</p><p>Follow us here</p><div class='z'>Read on tomorrow</div></article></body>"
        for i in range(12)
    ]
    teaser = [f"<body><article><p>Card {i}</p></article><div class='text'><p>{line(i)}</p></div></body>" for i in range(12)]
    got, cards = texts_of(spark, inside), texts_of(spark, teaser)
    for i in range(12):
        assert got[i] == f"Title {i}\n\n{line(i)}"
        assert cards[i] == line(i)


def test_an_article_copied_over_half_of_a_host_stays(spark):
    copied = "".join(f"<p>Paragraph {k} of the one article that many pages hold.</p>" for k in range(5))
    for note in ("", "<p>Note {i}.</p>"):
        htmls = [
            f"<body><div class='top'>Welcome to you</div><div class='text'>{copied if i % 2 else f'<p>Text {i} has words of its own, and many more of them.</p>'}"
            f"{note.format(i=i)}<p><a href='/'>a list of links {i}</a></p></div></body>"
            for i in range(20)
        ]
        got = texts_of(spark, htmls)
        for i in range(1, 20, 2):
            assert got[i].count("of the one article") == 5 and "Welcome" not in got[i]
            assert f"a list of links {i}" in got[i]


def test_page_edge_cases(spark):
    rows = [(1, None, None), (None, "http://a.test/", "<p>x</p>"), (2, "http://a.test/", ""), (2, "http://a.test/", "")]
    rows += [(3, "http://a.test/l", "<article>" + "<p>word</p>" * 5000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'q' AS host", "1 AS n", "2 AS tags", "3 AS text"
    )
    got = page_text.extract_text(pages)
    assert got.columns == ["page_id", "url", "text"]
    texts = sorted(((r["page_id"] or 0, r["text"]) for r in got.collect()))
    assert texts[:4] == [(0, "x"), (1, ""), (2, ""), (2, "")] and texts[4][1].count("word") == 5000
    assert page_text.extract_text(pages.where("false")).count() == 0


# --- vectors ------------------------------------------------------------------------------------


def test_recall_and_distances(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((3000, 32))
    x[100:200] = x[0]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, vector array<double>")
    s = ann.SearchSettings(block=700, query_block=20)
    rows = ann.nearest(df, df.where("vec_id % 50 = 0"), 10, s).collect()
    truth = ann.exact_nearest(np.arange(3000), x, range(0, 3000, 50), 10)
    hits = 0
    for q, near in truth.items():
        mine = sorted((r for r in rows if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert all(abs(r["score"] - np.linalg.norm(x[q] - x[r["vec_id"]])) < 1e-9 for r in mine)
        assert [(r["score"], r["vec_id"]) for r in mine] == sorted((r["score"], r["vec_id"]) for r in mine)
        hits += len({r["vec_id"] for r in mine} & set(near))
    assert hits >= 0.9 * 10 * len(truth)
    assert [r["vec_id"] for r in sorted(rows, key=lambda r: r["rank"]) if r["query_id"] == 150] == [0, *range(100, 109)]


def test_vector_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]),
            (6, [1.0, 1.0]), (6, [1.0, 1.0]), (None, [1.0, 2.0]), (7, [1.0, 0.0, 0.0]), (8, [])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>").selectExpr("*", "1 AS block", "2 AS score")
    got = ann.nearest(df, df, 10).collect()
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got} == {(0, 1, 6, 1.0), (6, 1, 0, 1.0)}
    assert ann.nearest(df.where("false"), df, 3).count() == 0
    assert ann.nearest(df, df.where("false"), 3).count() == 0


def test_repeated_rows_take_no_place(spark):
    near = [(1, [1.0, 0.01])] * 25
    rows = [(0, [1.0, 0.0])] * 3 + near + [(i, [1.0, 0.1 * i]) for i in range(2, 40)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    got = sorted(ann.nearest(df, df.where("vec_id = 0"), 10).collect(), key=lambda r: r["rank"])
    assert [(r["rank"], r["vec_id"]) for r in got] == [(i, i) for i in range(1, 11)]


# --- queries and pipeline -------------------------------------------------------------------------


def test_registered_queries():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.queries())
    assert numbers == list(range(1, 11))


def test_mixture_against_sql(spark, small):
    df = queries.op3_mixture(spark, small)
    assert check.compare(df, check.connect(small), queries.MIXTURE_SQL) is None


@pytest.mark.parametrize("name", sorted(n for n in queries.queries() if not n.startswith("op3_")))
def test_queries_run(spark, small, name):
    df = queries.queries()[name](spark, small)
    table = {"op1_url_filter": "pages", "op10_main_text": "pages"}.get(name, "documents")
    rows = df.count()
    if name == "op2_best_fit_packing":
        assert df.select("doc_id").distinct().count() == queries.table(spark, small, table).count()
    elif name == "op5_collision_counting":
        assert rows == 10 * df.select("query_id").distinct().count()
    else:
        assert rows == queries.table(spark, small, table).count()


def test_pipeline_stages(spark, small, tmp_path):
    docs = queries.table(spark, small, "documents")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small)
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        kept.append(docs.count())
        if name != "best_fit_packing":
            assert docs.columns == columns
        if name == "toxicity":
            scores = labels_of(queries.op6_toxicity(spark, small), "predicted = 0")
            assert scores == {r["doc_id"] for r in docs.collect()}
        if name == "quality":
            scores = labels_of(queries.op9_quality(spark, small), "predicted = 1")
            assert {r["doc_id"] for r in docs.collect()} <= scores
        if name == "jaccard_join":
            assert docs.select("doc_id").distinct().count() == docs.count()
    assert kept[0] >= kept[1] >= kept[2] and kept[-1] > 0


def labels_of(scored, where):
    return {r["doc_id"] for r in scored.where(where).select("doc_id").collect()}


def test_pipeline_on_edge_cases(spark, edge, nothing, small, tmp_path):
    for source in (edge, nothing):
        docs = source
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{name}-{source is edge}")
            stage(spark, docs, small).write.parquet(path)
            docs = spark.read.parquet(path)
        assert "sequence_id" in docs.columns

