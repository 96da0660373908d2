import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldsieve.functions.hashing import uniform_below
from fieldsieve.operators import tokens as tk
from fieldsieve.operators import windows as wn
from fieldsieve.operators.trie import Trie
from fieldsieve.sources.token_files import read_token_rows

TEXTS = ["", "a", "héllo wörld\n", "\U0001f600 x\U0001f600", "abcabcab" * 40, "\x00z"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")


def column(df, name="tokens"):
    return [r[name] for r in df.orderBy("doc_id").collect()]


def test_byte_tokens(spark, docs):
    expected = [[b + 1 for b in t.encode()] + [0] for t in TEXTS]
    assert column(docs.select("doc_id", tk.byte_tokens("text").alias("tokens"))) == expected
    encode = tk.tokenizer(tk.byte_vocabulary())
    assert column(docs.select("doc_id", encode("text").alias("tokens"))) == expected
    sizes = column(docs.select("doc_id", tk.byte_token_count(F.col("text")).alias("tokens")))
    assert sizes == [len(e) for e in expected]
    nulls = spark.createDataFrame([(0, None), (1, "b")], "doc_id long, text string")
    assert column(nulls.select("doc_id", tk.byte_tokens("text").alias("tokens"))) == [None, [99, 0]]


def greedy(data, vocabulary):
    ids, at = [], 0
    while at < len(data):
        size = max(n for n in range(1, len(data) - at + 1) if data[at : at + n] in vocabulary)
        ids.append(vocabulary[data[at : at + size]])
        at += size
    return ids


def test_greedy_longest_match(docs, spark):
    rng = random.Random(4)
    vocabulary = tk.byte_vocabulary()
    for token in [b"ab", b"abcabc", b"bcab", b"lo w", "ö".encode(), "\U0001f600 ".encode(), b".", b"(?", b"\n"]:
        vocabulary.setdefault(token, len(vocabulary) + 1)
    texts = TEXTS + ["".join(rng.choice("abc.(?\n") for _ in range(300)) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    encode, decode = tk.tokenizer(vocabulary), tk.decoder(vocabulary)
    ids = df.select("doc_id", "text", encode("text").alias("tokens"))
    assert column(ids) == [greedy(t.encode(), vocabulary) + [0] for t in texts]
    report = tk.round_trip_report(ids.withColumn("back", decode("tokens")), "text", "back").first()
    assert (report["n_texts"], report["n_mismatches"]) == (len(texts), 0)


def test_uncovered_text_fails(docs):
    with pytest.raises(Exception, match="does not cover"):
        docs.select(tk.tokenizer({b"a": 1})("text")).collect()


def test_bad_utf8_decodes_to_the_replacement(spark):
    df = spark.createDataFrame([(0, [196, 0])], "doc_id long, tokens array<int>")
    assert df.select(tk.decoder(tk.byte_vocabulary())("tokens")).first()[0] == "�"


def test_vocabulary_lines(spark):
    assert tk.parse_vocabulary_line("257 ' the' 4") == (b" the", 257)
    assert tk.parse_vocabulary_line("5 b'\\xe2\\x80' 2") == (b"\xe2\x80", 5)
    assert tk.parse_vocabulary_line("33 ' ' 1\n") == (b" ", 33)
    with pytest.raises(ValueError):
        tk.parse_vocabulary_line("1 'ab' 3")
    lines = spark.createDataFrame([("1 'a' 1",), ("2 'ab' 2",), ("",)], "value string")
    assert tk.read_vocabulary(lines) == {b"a": 1, b"ab": 2}


def test_characters(docs):
    vocab = tk.vocab_list(tk.char_vocab(docs))
    assert vocab == sorted(set("".join(TEXTS)))
    ids = docs.select("doc_id", "text", tk.char_tokens(F.col("text"), vocab).alias("tokens"))
    assert column(ids) == [[vocab.index(c) for c in t] for t in TEXTS]
    assert column(ids.select("doc_id", tk.char_decode(F.col("tokens"), vocab).alias("tokens"))) == TEXTS
    unknown = docs.select("doc_id", tk.char_tokens(F.col("text"), ["a"]).alias("tokens"))
    with pytest.raises(Exception, match="not in the vocabulary"):
        column(unknown)


def test_offsets_totals_and_spans(docs):
    sizes = docs.select("doc_id", tk.byte_token_count(F.col("text")).alias("n_tokens"))
    placed = tk.stream_offsets(sizes, ["doc_id"]).orderBy("doc_id").collect()
    assert placed[-1]["start"] + placed[-1]["n_tokens"] == sum(len(t.encode()) + 1 for t in TEXTS)
    assert [r["pointer"] for r in placed] == [2 * r["start"] for r in placed]
    ids = docs.select("doc_id", tk.byte_tokens("text").alias("tokens"))
    totals = tk.stream_totals(ids).first()
    assert totals["all_ended"] and totals["n_items"] == len(TEXTS)
    span = ids.where("doc_id = 2").select(tk.item_span(F.col("tokens"), F.lit(1), F.lit(2))).first()[0]
    assert span == [b + 1 for b in "é".encode()]
    assert tk.item_range(ids, 1, 3, "doc_id").count() == 3


def flat_stream(spark, seed, n_docs=40):
    rng = random.Random(seed)
    docs, start = [], 0
    for i in range(n_docs):
        size = rng.choice([0, 1, 2, 3, 7, 8, 9, 16, 100])
        ids = [rng.choice([0, 1, 2, 3, 4]) for _ in range(size)]
        docs.append((i, start, ids))
        start += size
    flat = [t for _, _, ids in docs for t in ids]
    return flat, spark.createDataFrame(docs, "doc_id long, start long, tokens array<int>")


@pytest.mark.parametrize("ctx", [1, 4, 8, 50])
def test_windows_are_slices_of_the_stream(spark, ctx):
    flat, stream = flat_stream(spark, ctx)
    packed = {r["window"]: r["tokens"] for r in wn.pack_windows(stream, ctx).collect()}
    n = (len(flat) - 1) // ctx
    assert packed == {k: flat[k * ctx : k * ctx + ctx + 1] for k in range(n)}
    rows = wn.fixed_rows(stream, ctx + 1).collect()
    assert {r["window"]: (r["x"], r["y"]) for r in rows} == {
        k: (flat[k * (ctx + 1) : (k + 1) * (ctx + 1) - 1], flat[k * (ctx + 1) + 1 : (k + 1) * (ctx + 1)])
        for k in range(len(flat) // (ctx + 1))
    }
    shares = wn.documents_in_windows(stream.withColumn("n", F.size("tokens")), ctx, size="n")
    by_doc = {r["doc_id"]: r["tokens"] for r in stream.collect()}
    found = {}
    for r in sorted(shares.collect(), key=lambda r: (r["window"], r["doc_id"])):
        found.setdefault(r["window"], []).extend(by_doc[r["doc_id"]][r["first"] : r["first"] + r["n"]])
    assert {k: found[k] for k in range(n)} == packed


def test_flat_token_files(spark, tmp_path):
    ids = (np.arange(1003) * 77 % 65536).astype(np.uint16)
    ids.tofile(tmp_path / "raw.bin")
    np.save(tmp_path / "flat.npy", ids)
    for name in ("raw.bin", "flat.npy"):
        rows = read_token_rows(spark, str(tmp_path / name), 10, tokens_per_read=95)
        assert rows.rdd.getNumPartitions() == 12
        got = {r["row"]: r["tokens"] for r in rows.collect()}
        assert got == {k: ids[10 * k : 10 * k + 10].tolist() for k in range(100)}
    packed = wn.pack_windows(rows.withColumn("start", F.col("row") * 10), 7)
    assert {r["window"]: r["tokens"] for r in packed.collect()} == {
        k: ids[7 * k : 7 * k + 8].tolist() for k in range(142)
    }


def test_spans_anywhere(spark):
    flat, stream = flat_stream(spark, 9)
    ctx = 7
    last = len(flat) - ctx - 1
    plan = spark.range(last).select(F.col("id").alias("s"), F.col("id").alias("start"), F.lit("k").alias("tag"))
    twice = plan.unionByName(plan.where("s % 5 = 2"))
    rows = wn.read_spans(twice, stream, ctx).collect()
    assert len(rows) == twice.count() and {r["tag"] for r in rows} == {"k"}
    assert {r["s"]: r["tokens"] for r in rows} == {s: flat[s : s + ctx + 1] for s in range(last)}
    for start in (last + 1, len(flat) + 100, None):
        beyond = spark.range(1).select(F.lit(start).cast("long").alias("start"))
        with pytest.raises(Exception, match="beyond the stream"):
            wn.read_spans(beyond, stream, ctx).collect()
    assert wn.read_spans(plan.where("false"), stream, ctx).count() == 0
    blocks = wn.pack_windows(stream, ctx)
    with pytest.raises(Exception, match="block border"):
        wn.read_blocks(spark.range(1).select(F.lit(3).alias("start")), blocks, ctx).collect()


def state_machine(ids, ctx, pattern):
    mask, on = [0] * ctx, False
    for i in range(len(pattern) - 1, ctx):
        if ids[i - len(pattern) + 1 : i + 1] == pattern:
            on = True
        if ids[i] == 0:
            on = False
        mask[i] = int(on)
    return mask


def test_answer_mask(spark):
    rng = random.Random(2)
    ctx, pattern = 30, [3, 3, 1, 2]
    rows = []
    for k in range(300):
        ids = [rng.choice([0, 1, 2, 3, 3]) for _ in range(ctx + 1)]
        if k % 2:
            at = rng.randrange(ctx - 4)
            ids[at : at + 4] = pattern
        rows.append((k, ids))
    samples = spark.createDataFrame(rows, "window long, tokens array<int>")
    flat, back = flat_stream(spark, 5)
    got = {r["window"]: r for r in wn.masked_samples(samples, back, len(flat), ctx, pattern, seed=1).collect()}
    assert len(got) == 300
    starts = samples.select("window", uniform_below(F.lit(len(flat) - ctx - 1), 1, F.col("window")).alias("s"))
    starts = {r["window"]: r["s"] for r in starts.collect()}
    replaced = 0
    for k, ids in rows:
        mask = state_machine(ids, ctx, pattern)
        if any(mask):
            assert (got[k]["tokens"], got[k]["z"], got[k]["replaced"]) == (ids, mask, False)
        else:
            replaced += 1
            drawn = flat[starts[k] : starts[k] + ctx + 1]
            assert (got[k]["tokens"], got[k]["z"], got[k]["replaced"]) == (drawn, [1] * ctx, True)
    assert 0 < replaced < 300


@settings(max_examples=200, deadline=None)
@given(
    st.dictionaries(st.binary(min_size=1, max_size=4), st.integers(1, 500), max_size=30),
    st.lists(st.binary(max_size=30), min_size=1, max_size=4),
)
def test_trie_matches_the_longest_token(more, texts):
    vocabulary = tk.byte_vocabulary() | {t: i + 1000 for t, i in more.items() if len(t) > 1}
    longest = max(map(len, vocabulary))
    expected = []
    for text in texts:
        at = 0
        while at < len(text):
            size = next(n for n in range(longest, 0, -1) if text[at : at + n] in vocabulary and at + n <= len(text))
            expected.append(vocabulary[text[at : at + size]])
            at += size
        expected.append(0)
    ids, sizes = Trie(vocabulary).encode(texts, [0])
    assert ids.tolist() == expected and sizes.sum() == len(expected)
    without, fewer = Trie(vocabulary).encode(texts, [])
    assert without.tolist() == [i for i in expected if i] and (fewer == sizes - 1).all()


def test_a_large_vocabulary_and_nulls(spark):
    rng = random.Random(5)
    words = {bytes(rng.choices(b"abcdefgh ", k=rng.randint(2, 9))) for _ in range(60_000)}
    vocabulary = tk.byte_vocabulary() | {w: 300 + i for i, w in enumerate(sorted(words))}
    texts = [None, "", "abc" * 40_000, *("".join(rng.choices("abcdefgh é", k=300)) for _ in range(50))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    rows = docs.select("text", tk.tokenizer(vocabulary)("text").alias("ids")).collect()
    token_of = {i: t for t, i in vocabulary.items()}
    for text, ids in rows:
        assert ids is None if text is None else b"".join(token_of[i] for i in ids[:-1]) == text.encode()
        for first, second in zip(ids[:-1] if ids else [], ids[1:-1] if ids else []):
            # A greedy token cannot be lengthened by what follows.
            assert token_of[first] + token_of[second][:1] not in vocabulary


def test_texts_are_walked_and_given_out_in_runs(spark, monkeypatch):
    """A worker's arrays hold one run of texts, however many texts an Arrow batch has."""
    held = []
    monkeypatch.setattr(tk, "WALKED", 64)
    trie = Trie(tk.byte_vocabulary())
    walked = trie.encode
    monkeypatch.setattr(trie, "encode", lambda t, tail: held.append(sum(map(len, t))) or walked(t, tail))
    monkeypatch.setattr(tk, "_trie", lambda entries: trie)
    texts = [None, "", *("é" * (k % 9) for k in range(200)), "z" * 500, None]
    encode, decode = tk.tokenizer(tk.byte_vocabulary()).func, tk.decoder(tk.byte_vocabulary()).func
    ids = list(encode(iter([pa.array(texts, pa.string()), pa.array([], pa.string())])))
    assert len(held) > 10 and sorted(held)[-2] <= 64 and max(held) == 500
    lists = [row for part in ids for row in part.to_pylist()]
    assert lists == [None if t is None else [b + 1 for b in t.encode()] + [0] for t in texts]
    back = list(decode(iter([pa.chunked_array(ids).combine_chunks()[1:]])))
    assert len(back) > 10 and [t for part in back for t in part.to_pylist()] == texts[1:]
    with pytest.raises(ValueError, match="not in the vocabulary"):
        list(decode(iter([pa.array([[1, 999]], pa.list_(pa.int32()))])))


def test_narrow_tokens_are_the_same_in_16_bits(docs):
    both = docs.select("doc_id", tk.byte_tokens("text").alias("tokens"), tk.narrow_byte_tokens("text").alias("narrow"))
    assert both.schema["narrow"].dataType.elementType.simpleString() == "smallint"
    assert column(both) == column(both, "narrow")


def test_streams_shuffle_narrow_tokens(spark, small):
    from fieldsieve.catalog import streams

    assert dict(streams.stream(spark, small).dtypes)["tokens"] == "array<smallint>"
