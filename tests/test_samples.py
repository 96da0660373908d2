import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldsieve.functions.numbers import product_mod, sampler_prime, whole_div
from fieldsieve.operators import joins, sampling
from fieldsieve.plans import tokens as token_plans


def test_epochs_are_permutations(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["aa", "bb", "cc", "dd"])], "doc_id long, text string")
    order = sampling.epoch_shuffle(docs, "doc_id", 3).collect()
    assert len(order) == 12
    for epoch in range(3):
        rows = [r for r in order if r["epoch"] == epoch]
        assert sorted(r["doc_id"] for r in rows) == [0, 1, 2, 3]
        assert sorted(r["position"] for r in rows) == [0, 1, 2, 3]
    windows = token_plans.epoch_windows(docs, "doc_id", 3, 3).orderBy("window").collect()
    flat = [t for w in windows for t in w["x"]]
    texts = {i: [b + 1 for b in t.encode()] + [0] for i, t in enumerate(["aa", "bb", "cc", "dd"])}
    expected = [t for r in sorted(order, key=lambda r: (r["epoch"], r["position"])) for t in texts[r["doc_id"]]]
    assert flat == expected[: len(flat)] and len(flat) == (len(expected) - 1) // 3 * 3


def test_seeds_give_other_orders(spark):
    docs = spark.range(200).withColumnRenamed("id", "doc_id")

    def order(seed, digits=3):
        rows = sampling.epoch_shuffle(docs, "doc_id", 1, seed, digits).orderBy("position").collect()
        return [r["doc_id"] for r in rows]

    assert order(1) == order(1, digits=1) != order(2)


@pytest.mark.parametrize(("prime", "ctx"), [(101, 4), (11, 7)])
def test_cubic_plan_visits_every_block(spark, prime, ctx):
    sampling.check_plan(prime, prime * ctx + 8, ctx)
    numbers = sampling.sample_numbers(spark, prime - 1)
    starts = [r["start"] for r in sampling.sample_starts(numbers, prime, prime * ctx + 8, ctx).collect()]
    assert sorted(starts) == [b * ctx for b in range(1, prime)]


@pytest.mark.parametrize("prime", [613559327, 3037000493, 97_656_250_001, 4_000_000_007_000_001_011])
def test_cubic_arithmetic_is_exact(spark, prime):
    numbers = [1, 2, 40320, 10**9 + 7, prime - 1, prime + 5]
    df = spark.createDataFrame([(n,) for n in numbers], "ii long")
    got = [r[0] for r in df.select(sampling.cubic_start(F.col("ii"), prime, 1)).collect()]
    factor = int(prime * ((math.sqrt(5) - 1) / 2))
    assert got == [factor * n**3 % prime for n in numbers]


def test_whole_numbers(spark):
    df = spark.createDataFrame([(2**62 + 1, 3)], "a long, b long")
    row = df.select(whole_div(F.col("a"), 3), product_mod(F.col("b"), F.col("b"), 5)).first()
    assert (row[0], row[1]) == ((2**62 + 1) // 3, 4)


def test_plan_checks():
    with pytest.raises(ValueError):
        sampling.check_plan(7, 28, 4)
    with pytest.raises(ValueError):
        sampling.check_plan(101, 4 * 200, 4)
    with pytest.raises(ValueError):
        sampling.check_plan(101, 412, 4, batch=11)
    with pytest.raises(ValueError, match="prime"):
        sampling.check_plan(95, 4 * 100, 4)
    assert sampler_prime(412, 4) == 101
    assert sampler_prime(628284834758, 1024) == 613559333


def test_numbers_of_ranks(spark):
    rows = sampling.sample_numbers(spark, 40320 * 2, world=8).collect()
    assert all(r["ii"] == 1 + r["epoch"] * 40320 + r["idx"] * 8 + r["rank"] for r in rows)
    assert Counter(r["rank"] for r in rows) == {k: 10080 for k in range(8)}
    with pytest.raises(ValueError):
        sampling.sample_numbers(spark, 10, world=11)


def test_random_and_interleaved_starts(spark):
    numbers = sampling.sample_numbers(spark, 500)
    drawn = sampling.sample_starts(numbers, 101, 412, 4, always_random=True).collect()
    assert all(0 <= r["start"] < 412 - 5 for r in drawn) and len({r["start"] for r in drawn}) > 100
    early = sampling.sample_starts(numbers, 101, 412, 4, random_steps=50, shift=-3).collect()
    cubic = {r["ii"]: r["start"] for r in sampling.sample_starts(numbers, 101, 412, 4).collect()}
    random_starts = {r["ii"]: r["start"] for r in drawn}
    for r in early:
        assert r["start"] == (random_starts[r["ii"]] if r["ii"] < 50 else cubic.get(r["ii"] - 50, 0))
    whole = sampling.sample_starts(numbers, 101, 6, 4, always_random=True, mixture=True).collect()
    assert {r["start"] for r in whole} == set(range(6))
    both = sampling.interleaved_starts(numbers, 101, 4, 300, total_tokens=412, random_steps=20).collect()
    for r in both:
        if r["ii"] % 2:
            n = r["ii"] // 2
            assert r["start"] == (random_starts[r["ii"]] if n < 20 else cubic.get(n - 20, 0))
    with pytest.raises(ValueError):
        sampling.interleaved_starts(numbers, 101, 4, 300, random_steps=20)
    mixed = sampling.interleaved_starts(numbers, 101, 4, 300).collect()
    assert all((r["corpus"] == "background") == (r["ii"] % 2 == 0) for r in mixed)
    assert all(r["start"] == cubic.get(r["ii"] // 2, 0) for r in mixed if r["ii"] % 2)


def test_routing_keeps_repeated_keys(spark):
    parts = spark.createDataFrame([("a", 4, 8), ("b", 2, 2)], "source string, n long, width long")
    mixture = joins.mixture_table(parts, "source", "n", "width")
    positions = spark.createDataFrame([(1, 0), (1, 9), (1, 9), (2, 5), (None, 3)], "k long, position long")
    found = [tuple(r) for r in joins.route_to_mixture(positions, mixture, "k").collect()]
    assert sorted(found, key=str) == sorted(
        [(1, 0, "a", 0), (1, 9, "b", 1), (1, 9, "b", 1), (2, 5, "a", 1), (None, 3, "a", 3)], key=str
    )
