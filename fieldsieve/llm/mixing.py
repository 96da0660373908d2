"""Mixing sources to target weights by hierarchical budgets.

Documents are leaves of a tree, by default domain, language, source. The corpus-wide token budget is
handed down level by level in proportion to the weights. No node gets more than it can give, its
tokens times the allowed epochs; what one cannot take goes to its siblings, in proportion to their
weights, and only a parent whose children are all exhausted passes the rest on to its own siblings.

A leaf's budget is read from its epochs: whole epochs first, then the prefix, in the seeded order
of the next epoch, of documents whose tokens still start inside the budget. The order is the md5 of
seed, epoch and id, so its first digits are slices of even size: only the slice in which a budget
ends has to be ordered, and a leaf that holds a third of all documents is many slices.

All sums are whole numbers, so any engine gets the same budgets.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import order_key
from ..session import pin
from .labelled import unused_name

LEVELS = ("domain", "lang", "source")
#: Weight of a child that has no weight of its own.
DEFAULT_WEIGHT = 1
_WHOLE = "decimal(38,0)"


def token_count(text: Column) -> Column:
    """Runs of characters other than white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\r\f\x0B]+")), F.lit(0)).cast("long")


def _weight(path: Sequence[str], weights: Mapping[tuple[str, ...], int]) -> Column:
    """The weight of a node by its path; ``weights`` is a setting kept by people."""
    known = [(k, w) for k, w in weights.items() if len(k) == len(path)]
    weight = F.lit(DEFAULT_WEIGHT)
    for key, w in sorted(known, reverse=True):
        same = [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(path, key, strict=True)]
        hit = same[0]
        for also in same[1:]:
            hit = hit & also
        weight = F.when(hit, F.lit(int(w))).otherwise(weight)
    return weight.cast(_WHOLE)


def share_out(nodes: DataFrame, parent: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Replace ``budget`` (the parent's) of each row by its own share.

    ``nodes`` has the columns of ``key``, which begins with those of ``parent``, ``weight``,
    ``capacity`` and the parent's ``budget``. Siblings stand in the order of capacity per weight.
    A node whose share by weight of what those before it leave covers its capacity is full, and so
    are all before it; the others share the rest by weight, rounded down, and the tokens lost by
    rounding go one each to the first of them. A weight of 0 counts as a millionth.
    """
    zero, one = F.lit(0).cast(_WHOLE), F.lit(1).cast(_WHOLE)
    by = [F.col(c) for c in parent] or [F.lit(0)]
    names = [F.col(c).asc_nulls_first() for c in key[len(parent) :]]
    order = Window.partitionBy(*by).orderBy("_level", *names)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    up_to = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = lambda c: F.coalesce(F.sum(c).over(before), zero)

    weight = F.greatest(F.col("weight") * F.lit(10**6).cast(_WHOLE), one).cast(_WHOLE)
    rows = nodes.withColumn("_w", weight).withColumn(
        "_level", F.col("capacity").cast("double") / F.col("_w").cast("double")
    )
    left = F.greatest(F.col("budget") - so_far("capacity"), zero)
    full = left * F.col("_w") >= F.col("capacity") * (F.sum("_w").over(every) - so_far("_w"))
    rows = rows.withColumn("_not_full", F.when(full, 0).otherwise(1))
    rows = rows.withColumn("_open", F.max("_not_full").over(up_to))
    of_open = lambda c: F.when(F.col("_open") == 1, F.col(c)).otherwise(zero)
    of_full = F.when(F.col("_open") == 0, F.col("capacity")).otherwise(zero)
    rows = rows.withColumns(
        {
            "_rest": F.greatest(F.col("budget") - F.sum(of_full).over(every), zero),
            "_open_w": F.sum(of_open("_w")).over(every),
            "_rank": F.sum("_open").over(up_to),
        }
    )
    product = (F.col("_rest") * F.col("_w")).cast(_WHOLE)
    share = ((product - product % F.col("_open_w")) / F.col("_open_w")).cast(_WHOLE)
    rows = rows.withColumn("_share", F.when(F.col("_open") == 1, share).otherwise(F.col("capacity")))
    lost = F.col("_rest") - F.sum(of_open("_share")).over(every)
    extra = F.when((F.col("_open") == 1) & (F.col("_rank") <= lost), one).otherwise(zero)
    return rows.withColumn("_lost", extra).withColumn(
        "budget", (F.col("_share") + F.col("_lost")).cast(_WHOLE)
    ).select(*nodes.columns)


def leaf_budgets(
    leaves: DataFrame,
    budget: int | Column,
    weights: Mapping[tuple[str, ...], int],
    levels: Sequence[str] = LEVELS,
) -> DataFrame:
    """``budget`` of every leaf of ``leaves`` (the levels, ``tokens``, ``capacity``).

    ``budget`` is the whole corpus's; ``weights`` maps a path of values, from the root down, to a
    whole number.
    """
    level_tables = []
    for depth in range(1, len(levels) + 1):
        path = list(levels[:depth])
        level_tables.append(
            leaves.groupBy(*path)
            .agg(F.sum("capacity").cast(_WHOLE).alias("capacity"))
            .withColumn("weight", _weight(path, weights))
        )
    total = budget if isinstance(budget, Column) else F.lit(budget)
    given = share_out(
        level_tables[0].withColumn("budget", total.cast(_WHOLE)), [], levels[:1]
    )
    for depth in range(2, len(levels) + 1):
        parent, path = list(levels[: depth - 1]), list(levels[:depth])
        above = given.select(*[F.col(c).alias(f"_{c}") for c in parent], "budget")
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in parent]
        below = level_tables[depth - 1].join(above, same).drop(*[f"_{c}" for c in parent])
        given = share_out(below, parent, path)
    return given.select(*levels, F.col("budget").cast("long").alias("budget"))


def mix(
    docs: DataFrame,
    weights: Mapping[tuple[str, ...], int],
    share: tuple[int, int],
    epochs: int,
    seed: int,
    levels: Sequence[str] = LEVELS,
    key: str = "doc_id",
    text: str = "text",
    digits: int = 3,
    carried: Sequence[str] = (),
) -> DataFrame:
    """``key``, the levels, the columns named in ``carried``, ``n_tokens`` and ``copies`` of every
    row that is taken at least once.

    The corpus's budget is ``share[0] / share[1]`` of its tokens, and no document is taken more
    than ``epochs`` times. ``docs`` has the level columns; null levels are values of their own.
    Rows without tokens cost nothing: they go with every epoch their place in the order reaches.
    Ties of the order are broken by key and text, equal rows are taken or left together only if
    their tokens fit. Other columns are not read; no rows give no rows.
    """
    same = [F.col(f"_{c}").eqNullSafe(F.col(c)) for c in levels]
    rows = pin(
        docs.select(
            key, *levels, *carried, token_count(F.col(text)).alias("n_tokens"), F.xxhash64(text).alias("tie")
        ),
        "mix-rows",
    )
    leaves = rows.groupBy(*levels).agg(F.sum("n_tokens").cast(_WHOLE).alias("tokens")).withColumn(
        "capacity", (F.col("tokens") * epochs).cast(_WHOLE)
    )
    all_tokens = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).cast("long")).first()[0]
    given = leaf_budgets(leaves, all_tokens * share[0] // share[1], weights, levels)
    leaf = given.join(
        leaves.select(*[F.col(c).alias(f"_{c}") for c in levels], "tokens"), same
    ).select(
        *[F.col(c).alias(f"_{c}") for c in levels],
        F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(F.lit(0))
        .cast("long").alias("whole"),
        (F.when(F.col("tokens") > 0, F.col("budget") % F.col("tokens")).otherwise(F.lit(0)))
        .cast("long").alias("prefix"),
    )
    placed = rows.join(leaf, same).withColumn(
        "order", order_key(seed, F.col("whole"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    ).withColumn("slice", F.substring("order", 1, digits))

    slices = placed.groupBy(*levels, "slice").agg(F.sum("n_tokens").alias("in_slice"))
    by_leaf = Window.partitionBy(*levels).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.select(
        *[F.col(c).alias(f"s_{c}") for c in levels],
        F.col("slice").alias("s_slice"),
        F.coalesce(F.sum("in_slice").over(by_leaf), F.lit(0)).alias("start"),
    )
    on = [F.col(f"s_{c}").eqNullSafe(F.col(c)) for c in levels] + [F.col("s_slice") == F.col("slice")]
    inside = (
        Window.partitionBy(*levels, "slice").orderBy("order", key, "tie")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    at = F.col("start") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    return (
        placed.join(starts, on)
        .withColumn("at", at)
        .withColumn("copies", F.col("whole") + F.when(F.col("at") < F.col("prefix"), 1).otherwise(0))
        .where(F.col("copies") > 0)
        .select(key, *levels, *carried, "n_tokens", "copies")
    )


def mixed_documents(docs: DataFrame, mixed: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The rows of ``docs``, each as often as it is taken, with all their columns.

    ``mixed`` is called with ``docs`` and the name of a key added to them; it gives that key and
    ``copies`` of the rows that are taken. Rows equal in id, language, source and text are given out
    as one of them, as often as all are taken, so repeated or null ids cost no more than the
    budget allows.
    """
    key = unused_name(docs, "row_key")
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in ("doc_id", "lang", "source", "text")]
    keyed = docs.withColumn(key, F.md5(F.concat_ws("\x1f", *parts)))
    copies = mixed(keyed, key).groupBy(key).agg(F.sum("copies").cast("long").alias("copies"))
    each = copies.select(key, F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(key)
    return keyed.dropDuplicates([key]).join(each, key).select(*docs.columns)
