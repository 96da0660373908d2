import os
import random
from collections import defaultdict

from pyspark.sql import functions as F

from fieldsieve.operators.numbering import number_by_hash, number_rows, running_offsets
from fieldsieve.session import owned, pin, shared_dir


def skewed(spark, n=3000, seed=1):
    """Unique ids with huge gaps; one group holds more than a third of the rows."""
    rng = random.Random(seed)
    ids = rng.sample(range(10**6), n - 5) + [2**62 + i for i in range(5)]
    rows = [(i, "hot" if rng.random() < 0.4 else f"g{rng.randrange(20)}", rng.randrange(9)) for i in ids]
    return rows, spark.createDataFrame(rows, "id long, grp string, size long").repartition(7)


def test_dense_numbers(spark):
    rows, df = skewed(spark)
    got = {r["id"]: r["row"] for r in number_rows(df.select("id"), ["id"]).collect()}
    assert got == {i: n for n, i in enumerate(sorted(r[0] for r in rows))}


def test_dense_numbers_per_group(spark):
    rows, df = skewed(spark)
    expected, seen = {}, defaultdict(int)
    for i, g, _ in sorted(rows):
        expected[i] = seen[g]
        seen[g] += 1
    for n_slices in (1, 3, 16):
        got = number_rows(df, ["id"], by=["grp"], n_slices=n_slices).collect()
        assert {r["id"]: r["row"] for r in got} == expected


def test_offsets_are_prefix_sums(spark):
    rows, df = skewed(spark)
    placed = running_offsets(df, ["id"], "size").orderBy("id").collect()
    total = 0
    for n, (row, r) in enumerate(zip(sorted(rows), placed, strict=True)):
        assert (r["id"], r["item"], r["start"]) == (row[0], n, total)
        total += row[2]


def test_hash_order_is_a_permutation_per_group(spark):
    rows, df = skewed(spark)
    got = number_by_hash(df, 3, ["id"], by=["grp"], digits=1).collect()
    again = number_by_hash(df.repartition(3), 3, ["id"], by=["grp"], digits=2).collect()
    by_group = defaultdict(list)
    for r in got:
        by_group[r["grp"]].append(r["row"])
    assert all(sorted(v) == list(range(len(v))) for v in by_group.values())
    assert {(r["id"], r["row"]) for r in got} == {(r["id"], r["row"]) for r in again}


def test_hot_group_is_cut_over_slices(spark):
    """Every slice of the hot group stays near the size of any other slice."""
    from fieldsieve.operators.numbering import SLICE, ordered_slices

    _, df = skewed(spark)
    sizes = [r["count"] for r in ordered_slices(df, ["id"], ["grp"], 8).groupBy(SLICE).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 3000 / 8


def test_rows_without_a_group_are_a_group(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, None), (4, "a")], "id long, grp string")
    expected = {1: 0, 2: 0, 3: 1, 4: 1}
    assert {r["id"]: r["row"] for r in number_rows(df, ["id"], by=["grp"]).collect()} == expected
    hashed = number_by_hash(df, 0, ["id"], by=["grp"]).collect()
    assert sorted((r["grp"] or "", r["row"]) for r in hashed) == [("", 0), ("", 1), ("a", 0), ("a", 1)]


def test_owned_tables_are_removed(spark):
    with owned(spark):
        outer = pin(spark.range(5), "outer")
        with owned(spark):
            inner = pin(spark.range(3), "inner")
            files = inner.inputFiles() + outer.inputFiles()
            assert all(os.path.exists(f.removeprefix("file://")) for f in files)
        assert outer.count() == 5
        assert not os.path.exists(inner.inputFiles()[0].removeprefix("file://"))
    assert not any(os.path.exists(f.removeprefix("file://")) for f in files)


def test_offsets_shuffle_the_rows_once(spark):
    rows = [(i, None if i % 9 == 0 else i % 13) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, size int").repartition(5)
    placed = running_offsets(df, ["id"], "size", n_slices=16)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_slice" not in plan.split("BroadcastExchange")[0] and "Window" not in plan.split("BroadcastExchange")[0]
    start = 0
    for i, r in enumerate(placed.orderBy("id").collect()):
        assert (r["id"], r["item"], r["start"]) == (i, i, start)
        start += r["size"] or 0
    assert running_offsets(df.where("false"), ["id"], "size").count() == 0
