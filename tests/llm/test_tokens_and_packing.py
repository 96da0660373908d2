import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fieldsieve.llm import binpack, bitplanes
from fieldsieve.llm.encoding import TextEncoder, public_vocabulary

VOCABULARY = public_vocabulary()
PLAIN = Tokenizer.from_file(VOCABULARY)
ENCODER = TextEncoder(VOCABULARY)


def ids_of(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


def numbers(raw):
    return np.frombuffer(raw, "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab Z\n\t'.,1é ß\u2028\xa0日\x1c_")), max_size=40))
def test_pieces_give_the_ids_of_the_whole_text(text):
    assert numbers(ENCODER(text)) == ids_of(text)


@pytest.mark.parametrize("text", ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|> \n", "<|endoftext"])
def test_added_tokens_are_the_librarys(text):
    assert numbers(ENCODER(text)) == ids_of(text)
    plain = Tokenizer.from_file(VOCABULARY)
    plain.encode_special_tokens = True
    assert numbers(TextEncoder(VOCABULARY, plain=True)(text)) == plain.encode(text, add_special_tokens=False).ids


def test_a_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr("fieldsieve.llm.encoding.CACHED_PIECES", 3)
    small = TextEncoder(VOCABULARY)
    text = "many different words, more than the cache holds; many different words"
    assert numbers(small(text)) == numbers(small(text)) == ids_of(text)


@pytest.mark.parametrize("mode", ["byte", "bit"])
def test_planes_are_inverted(mode):
    rng = np.random.default_rng(1)
    for n in (1, 7, 8, 1000):
        ids = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype("<u4")
        assert (bitplanes.from_planes(bitplanes.to_planes(ids, mode), n, mode) == ids).all()


@pytest.mark.parametrize("mode,block", [("byte", 65_536), ("bit", 64)])
def test_store_round_trip(spark, edge, tmp_path, mode, block):
    path = str(tmp_path / "store")
    bitplanes.write_ids(edge, path, VOCABULARY, 2, block, mode)
    rows = bitplanes.read_ids(spark, path).orderBy("start").collect()
    wanted = Counter((r["doc_id"], tuple(ids_of(r["text"]) + [2])) for r in edge.collect())
    assert Counter((r["doc_id"], tuple(numbers(r["ids"]))) for r in rows) == wanted
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    start = 0
    for r in rows:
        assert r["start"] == start and r["n_tokens"] == len(r["ids"]) // 4
        start += r["n_tokens"]


def test_index_is_read_without_planes(spark, edge, tmp_path):
    path = str(tmp_path / "store")
    bitplanes.write_ids(edge, path, VOCABULARY, 2)
    blocks = spark.read.parquet(path)
    plan = bitplanes.shard_starts(blocks)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<shard:int,n_ids:int>" in plan


def test_empty_store(spark, nothing, tmp_path):
    bitplanes.write_ids(nothing, str(tmp_path / "store"), VOCABULARY, 2)
    assert bitplanes.read_ids(spark, str(tmp_path / "store")).count() == 0
    with pytest.raises(ValueError):
        bitplanes.write_ids(nothing, "x", VOCABULARY, 2, mode="word")


def test_cutting():
    assert binpack.cut_lengths(5000, 2048) == [904, 2048, 2048]
    assert binpack.cut_lengths(4096, 2048) == [2048, 2048] and binpack.cut_lengths(1, 2048) == [1]


def spread(fills):
    """Every piece's (length, number) with its sequence and offset."""
    for f in fills:
        for k in range(f.per * f.count):
            yield (f.length, f.first + k), f.sequence + k // f.per, f.offset + k % f.per * f.length


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(0, 40), max_size=12))
def test_fills_are_a_packing(counts):
    capacity = 30
    placed = list(spread(binpack.plan_fills(counts, capacity)))
    assert Counter(p for p, _, _ in placed) == Counter((n, k) for n, c in counts.items() for k in range(c))
    held = {}
    for (length, _), sequence, offset in placed:
        held.setdefault(sequence, []).append((offset, length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


def best_fit(sizes, capacity):
    gaps = []
    for size in sorted(sizes, reverse=True):
        fitting = [i for i, g in enumerate(gaps) if g >= size]
        if fitting:
            gaps[min(fitting, key=lambda i: gaps[i])] -= size
        else:
            gaps.append(capacity - size)
    return len(gaps)


def test_as_few_sequences_as_piecewise_best_fit():
    rng = random.Random(4)
    for _ in range(40):
        sizes = [rng.choice([rng.randint(1, 100), rng.randint(30, 60), 34, 33]) for _ in range(300)]
        n = 1 + max(s for _, s, _ in spread(binpack.plan_fills(Counter(sizes), 100)))
        assert n <= best_fit(sizes, 100) + 1
        assert n >= -(-sum(sizes) // 100)


def test_plan_stays_short_whatever_the_counts():
    rng = random.Random(5)
    few = {n: rng.randint(1, 9) for n in range(1, 2049)}
    many = {n: c * 10**9 + rng.randint(0, 9) for n, c in few.items()}
    assert len(binpack.plan_fills(many, 2048)) < 40_000


def test_packing_edge_cases(spark, edge, nothing):
    pieces = binpack.token_pieces(edge, VOCABULARY, end_id=0, capacity=64)
    placed = binpack.place_pieces(pieces.drop("ids"), 64)
    whole = {}
    for r in pieces.orderBy("part", "row", "piece").collect():
        assert r["start"] == len(whole.setdefault((r["part"], r["row"], r["doc_id"]), [])) and r["length"] <= 64
        whole[r["part"], r["row"], r["doc_id"]] += numbers(r["ids"])
    wanted = Counter((r["doc_id"], tuple(ids_of(r["text"]) + [0])) for r in edge.collect())
    assert Counter((k[2], tuple(v)) for k, v in whole.items()) == wanted
    filled = binpack.sequences(pieces, placed)
    assert filled.agg(F.sum(F.octet_length("ids"))).first()[0] == 4 * sum(map(len, whole.values()))
    assert filled.agg(F.max(F.octet_length("ids"))).first()[0] <= 4 * 64
    one = placed.orderBy("sequence_id", "offset").collect()
    ends = {}
    for r in one:
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    empty = binpack.token_pieces(nothing, VOCABULARY, 0, 64)
    assert binpack.place_pieces(empty.drop("ids"), 64).count() == 0


def test_checksum_is_that_of_the_ids(spark, edge):
    pieces = binpack.token_pieces(edge, VOCABULARY, end_id=0, capacity=2048)
    for r in pieces.withColumn("crc", F.crc32("ids")).collect():
        assert r["crc"] == zlib.crc32(r["ids"])
