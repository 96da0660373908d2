import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import check
from fieldsieve.llm import align, lexical_search, pieces, queries
from fieldsieve.llm.encoding import byte_alphabet, public_vocabulary
from fieldsieve.llm.perfect_hash import PerfectHash

MODEL, VOCABULARY = pieces.public_model(), public_vocabulary()
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
OWN = pieces.MergeVocabulary(MODEL)
PLAIN = Tokenizer.from_file(VOCABULARY)
PLAIN.encode_special_tokens = True

ODD = st.text(
    alphabet=st.sampled_from(list("abthein  ▁\n\té日本語の\U0001f600<s>0xA\0ß.,'́\x1c\xa0")), max_size=40
)


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- pieces ------------------------------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(ODD)
def test_pieces_are_the_librarys(text):
    ids = OWN.encode(text)
    assert ids.tolist() == LIBRARY.encode(text)
    assert OWN.decode(ids.tolist()) == LIBRARY.decode(ids.tolist())


@pytest.mark.parametrize("text", ["thein" * 30_000, " " * 5_001, "日本語" * 20_000, "", " ", "<s></s><unk>"])
def test_long_and_empty_texts(text):
    assert OWN.encode(text).tolist() == LIBRARY.encode(text)


def test_bytes_that_are_no_character_are_replaced():
    ids = [LIBRARY.piece_to_id("▁a"), LIBRARY.piece_to_id("<0xE6>"), LIBRARY.piece_to_id("b")]
    assert OWN.decode(ids) == LIBRARY.decode(ids) == "a�b"


def test_words_are_held_against_the_library():
    own = pieces.MergeVocabulary(MODEL)
    own.encode("some words, and  some more")
    own.confirm()
    assert own.unlike == set()
    own._pairs.order.clear()
    own.encode("others")
    own.confirm()
    assert own.unlike == {"▁others"}


def test_joins_take_the_best_score_then_the_left():
    scores = {"a": 0.0, "b": 0.0, "c": 0.0, "ab": 1.0, "bc": 2.0, "aa": 0.0}
    numbers = {piece: i for i, piece in enumerate(scores)}
    pairs = pieces.Pairs(scores, numbers, len(numbers))

    def merged(text):
        return [list(scores)[i] for i in pairs.merge([numbers[c] for c in text])]

    assert merged("abc") == ["a", "bc"] and merged("aaa") == ["aa", "a"] and merged("") == []


def test_forgotten_words_change_nothing(monkeypatch):
    monkeypatch.setattr(pieces, "CACHED_WORDS", 2)
    text = "more words than are kept, more words than are kept"
    assert pieces.MergeVocabulary(MODEL).encode(text).tolist() == LIBRARY.encode(text)


def test_encoded_documents(edge, nothing):
    rows = pieces.encode_documents(edge, MODEL).collect()
    texts = edge.select("doc_id", "text").collect()
    expected = sorted((str(r.doc_id), LIBRARY.encode(r.text or "")) for r in texts)
    assert sorted((str(r.doc_id), r.ids) for r in rows) == expected
    assert all(r.agrees for r in rows)
    assert pieces.encode_documents(nothing, MODEL).collect() == []


def test_sentencepiece_query(spark, small):
    rows = queries.op12_sentencepiece(spark, small).collect()
    texts = {r.doc_id: r.text for r in queries.table(spark, small, "documents").collect()}
    assert len(rows) == len(texts)
    for row in rows:
        ids = LIBRARY.encode(texts[row.doc_id])
        assert (row.n_tokens, row.ids_sha256) == (len(ids), sha256(",".join(map(str, ids))))
        assert row.decoded_sha256 == sha256(LIBRARY.decode(ids))


# --- perfect hash ------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5_000])
def test_slots_are_a_permutation(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**40, n))
    made = PerfectHash.from_bytes(PerfectHash.build(keys).to_bytes())
    assert np.array_equal(np.sort(made.slots(keys)), np.arange(len(keys)))
    assert (made.slots(np.arange(2**41, 2**41 + 100)) < max(1, made.size)).all()


# --- alignment ---------------------------------------------------------------------------------

BYTE_OF = {c: b for b, c in byte_alphabet().items()}


def spelt(text):
    """Ids and bytes of both vocabularies over the whole text, by the libraries."""
    a = PLAIN.encode(" " + text, add_special_tokens=False).ids
    bytes_a = [bytes(BYTE_OF[c] for c in PLAIN.id_to_token(i)) for i in a]
    b = LIBRARY.encode(text)
    bytes_b = [
        bytes([int(LIBRARY.id_to_piece(i)[3:5], 16)]) if LIBRARY.is_byte(i)
        else LIBRARY.id_to_piece(i).replace("▁", " ").encode()
        for i in b
    ]
    return a, bytes_a, b, bytes_b


def brute_groups(text):
    if not text:
        return []
    a, bytes_a, b, bytes_b = spelt(text)
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return []
    groups, at_a, at_b, i, j = [([], [])], 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if at_a <= at_b:
            groups[-1][0].append(a[i])
            at_a, i = at_a + len(bytes_a[i]), i + 1
        else:
            groups[-1][1].append(b[j])
            at_b, j = at_b + len(bytes_b[j]), j + 1
        if at_a == at_b:
            groups.append(([], []))
    return groups[:-1]


def brute_alignment(docs):
    """Result rows for (doc_id, text) pairs."""
    every = [(i, brute_groups(text)) for i, text in docs]
    held = Counter()
    for _, groups in every:
        held.update({(x, y) for a, b in groups for x in a for y in b})
    highest = defaultdict(int)
    for (x, _), n in held.items():
        highest[x] = max(highest[x], n)
    rows = []
    for i, groups in every:
        links = [(x, y) for a, b in groups for x in a for y in b]
        shown = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        rows.append(
            (
                i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                sum(held[link] == highest[link[0]] for link in links), sum(held[link] for link in links),
                sha256(shown) if groups else "",
            )
        )
    return rows


def alignment_rows(df):
    return [tuple(r) for r in df.collect()]


def in_order(rows):
    return sorted(rows, key=str)


@settings(max_examples=200, deadline=None)
@given(ODD)
def test_groups_of_a_text(text):
    own = align.vocabularies(VOCABULARY, MODEL)
    found = align.Alignment(own, *own.encode([text])[0])
    groups = brute_groups(text)
    assert found.groups() == ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
    links = Counter(x * own.size_b + y for a, b in groups for x in a for y in b)
    assert dict(zip(*(c.tolist() for c in found.links()), strict=True)) == links


def test_large_groups_are_multiplied(monkeypatch):
    own = align.vocabularies(VOCABULARY, MODEL)
    whole = align.Alignment(own, *own.encode(["strange worrrds thththeinein, " * 3])[0])
    expected = [c.tolist() for c in whole.links()]
    monkeypatch.setattr(align, "PAIRED_OUT", 1)
    assert [c.tolist() for c in whole.links()] == expected


def test_aligned_edge_cases(edge, nothing):
    found = align.align_documents(edge, VOCABULARY, MODEL, digest=True)
    docs = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    assert in_order(alignment_rows(found)) == in_order(brute_alignment(docs))
    assert align.align_documents(nothing, VOCABULARY, MODEL).collect() == []


def test_texts_that_are_not_spelt_have_no_tokens(spark):
    docs = spark.createDataFrame([(1, "a ▁ b"), (2, "a b"), (3, "<|endoftext|> a")], "doc_id long, text string")
    rows = {r.doc_id: r for r in align.align_documents(docs, VOCABULARY, MODEL).collect()}
    assert (rows[1].n_a, rows[1].n_links, rows[1].groups) == (0, 0, "")
    assert rows[2].n_a == 2 and rows[3].n_a == len(spelt("<|endoftext|> a")[0])


def test_small_shards_and_trees_change_nothing(spark, small, monkeypatch):
    for name, size in {"SHARD_PAIRS": 500, "LEAF_COUNTS": 300, "FAN": 2, "GROUP_LINKS": 700, "GATHERED": 900}.items():
        monkeypatch.setattr(align, name, size)
    docs = queries.table(spark, small, "documents").repartition(5)
    found = align.align_documents(docs, VOCABULARY, MODEL, digest=True)
    pairs = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert in_order(alignment_rows(found)) == in_order(brute_alignment(pairs))


def test_alignment_query(spark, small):
    found = queries.op11_token_alignment(spark, small)
    docs = [(r.doc_id, r.text) for r in queries.table(spark, small, "documents").collect()]
    assert found.columns[-1] == "groups_sha256"
    assert in_order(alignment_rows(found)) == in_order(brute_alignment(docs))


# --- search ------------------------------------------------------------------------------------


def brute_terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[0-9a-zA-Z\x80-\U0010ffff]+", lower)


def brute_search(docs, items, k):
    lists = [(i, brute_terms(t)) for i, t in docs if brute_terms(t)]
    n_docs, n_terms = len(lists), sum(len(t) for _, t in lists)
    df = Counter(w for _, t in lists for w in set(t))
    rows = []
    for item_id, text in items:
        scored = []
        for doc_id, terms in lists:
            tf, n, score = Counter(terms), len(terms), 0
            m = 25 + (75 * n * n_docs) // n_terms
            for word in brute_terms(text):
                if tf[word]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[word] + 1)))
                    score += w * ((1_000_000_000 * tf[word]) // (1000 * tf[word] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        rows += [
            (item_id, rank, None if null else i, -score)
            for rank, (score, null, i) in enumerate(sorted(scored)[:k], 1)
        ]
    return rows


def random_docs(n, seed):
    r = random.Random(seed)
    words = [f"w{int(r.paretovariate(0.7))}" for _ in range(400)]
    return [(i * 7 % n, " ".join(r.choice(words) for _ in range(r.choice((1, 3, 30, 200))))) for i in range(n)]


def test_search_against_all_scores(spark, monkeypatch):
    for name, size in {"SHARD_DOCS": 150, "BLOCK": 8, "STRETCH": 32, "ITEMS": 3}.items():
        monkeypatch.setattr(lexical_search, name, size)
    docs = random_docs(600, 1) + [(10_000 + i, "w1 w2 w3") for i in range(40)]
    items = [(i, t) for i, t in random_docs(12, 2)] + [(50, "w1 w1 w3"), (51, None), (52, "absent"), (53, "")]
    index = lexical_search.build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    found = lexical_search.search(index, spark.createDataFrame(items, "item_id long, text string"), k=10)
    assert in_order(map(tuple, found.collect())) == in_order(brute_search(docs, items, 10))


def test_blocks_are_rejected_unread():
    """A frequent term's blocks stay packed where its maximum cannot help."""
    docs = [(i, "often " * (1 + i % 2) + ("rare " * 5 if i < 20 else "") + "x " * 30) for i in range(4096)]
    shard = lexical_search._Shard()
    for i, text in docs:
        shard.add(i, lexical_search.terms_of(text))
    names = lexical_search._INDEX.names
    rows = [dict(zip(names, r, strict=True)) for r in shard.rows(0)]
    corpus = lexical_search.Corpus(rows[0], 4096, sum(shard.lengths))
    lists = {r["term"]: lexical_search.PostingList(r | {"total_df": r["df"]}, corpus) for r in rows[1:]}
    asked = [(lists["often"], 1), (lists["rare"], 1)]
    top, scores = lexical_search.best_documents(asked, 4096, corpus.rank, 10)
    expected = brute_search(docs, [(0, "often rare")], 10)
    assert list(zip(top.tolist(), scores.tolist(), strict=True)) == [(r[2], r[3]) for r in expected]
    assert lists["often"].unpacked < len(lists["often"].peaks)


def test_outline_gives_the_blocks_best():
    r = np.random.default_rng(3)
    tf, n = r.integers(1, 9, 500), r.integers(9, 90, 500)
    shares = lexical_search._shares(n, 500, int(n.sum()))
    kept = lexical_search._outline(tf, n)
    assert len(kept) < 30
    assert lexical_search._impacts(tf, shares).max() == lexical_search._impacts(tf, shares)[kept].max()


def test_search_edge_cases(edge, nothing, spark):
    items = spark.createDataFrame(
        [(1, "the cat and the moon"), (1, "the cat and the moon"), (2, None), (3, "WORD x"), (None, "no stop")],
        "item_id long, text string",
    )
    docs = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    expected = brute_search(docs, [(1, "the cat and the moon"), (3, "WORD x"), (None, "no stop")], 10)
    found = lexical_search.search(lexical_search.build_index(edge), items)
    assert in_order(map(tuple, found.collect())) == in_order(expected)
    assert lexical_search.search(lexical_search.build_index(nothing), items).collect() == []
    assert lexical_search.search(lexical_search.build_index(edge), items.where("false")).collect() == []


def test_search_query_against_sql(spark, small):
    found = queries.op13_lexical_search(spark, small)
    assert check.compare(found, check.connect(small), queries.SEARCH_SQL) is None
