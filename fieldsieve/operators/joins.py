"""Semi, anti, positional and range joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import whole_div
from .numbering import PLACE, SLICE, number_rows, ordered_slices, running_offsets


def not_yet_done(work: DataFrame, manifest: DataFrame, key: str = "name") -> DataFrame:
    """Work-list rows whose ``key`` is not in the manifest of finished names."""
    return work.join(manifest.select(key), key, "left_anti")


def keep_listed(df: DataFrame, listed: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key is in ``listed``; repeats on either side never multiply."""
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(listed.select(*keys), keys, "left_semi")


def keep_positions(
    df: DataFrame, positions: DataFrame, order_by: Sequence[str], position: str = "row"
) -> DataFrame:
    """Rows of ``df`` whose dense position in ``order_by`` order is listed in ``positions``."""
    numbered = number_rows(df.select(*order_by), order_by, position)
    chosen = keep_listed(numbered, positions, position)
    return df.join(chosen.drop(position), list(order_by), "left_semi")


def align_by_position(
    answers: DataFrame,
    models: Sequence,
    order_by: Sequence[str],
    model: str = "model",
    value: str = "response",
) -> DataFrame:
    """Zip the answer lists of ``models`` by position, stopping at the shortest list.

    Every list is numbered by itself; position p survives when each model has one. The result has
    one column per model, named ``m0, m1, …`` in the order of ``models``, so a group holds a fixed
    number of values and is combined on the map side.
    """
    numbered = number_rows(answers.where(F.col(model).isin(list(models))), order_by, "position", by=[model])
    columns = [
        F.max(F.when(F.col(model) == m, F.col(value))).alias(f"m{i}") for i, m in enumerate(models)
    ]
    return (
        numbered.groupBy("position")
        .agg(F.count(F.lit(1)).alias("_n"), *columns)
        .where(F.col("_n") == len(models))
        .drop("_n")
    )


def mixture_table(parts: DataFrame, name: str, count: str, width: str) -> DataFrame:
    """(part, count, prev, cutoff): each sub-dataset covers ``width`` positions, in name order."""
    sized = parts.select(
        F.col(name).alias("part"),
        F.col(count).cast("bigint").alias("count"),
        F.col(width).cast("bigint").alias("_width"),
    )
    placed = running_offsets(sized, ["part"], "_width", "prev", "_item")
    return placed.select(
        "part", "count", "prev", (F.col("prev") + F.col("_width")).alias("cutoff")
    )


def route_to_mixture(
    positions: DataFrame, mixture: DataFrame, key: str, position: str = "position"
) -> DataFrame:
    """Send each global position to the sub-dataset that covers it, with its local position.

    A sub-dataset covers ``prev <= position < cutoff`` and the local position is
    ``(position - prev) % count``; ``key`` orders equal positions, and rows that repeat it stay as many
    as they are, because the whole row goes with its position. Positions and beginnings of
    sub-datasets are merged in one order, cut into even slices: inside a slice the last beginning
    is carried forward, and a slice's first rows take the last beginning of the slices before it,
    one row per slice. No position meets more than one sub-dataset, however many there are and
    however many positions one of them covers. Positions that none covers are left out.
    """
    part = F.struct("part", "count", "prev", "cutoff")
    begins = mixture.where(F.col("cutoff") > F.col("prev")).select(
        F.col("prev").cast("bigint").alias("_at"),
        F.lit(0).alias("_kind"),
        F.lit(None).cast(positions.schema[key].dataType).alias("_key"),
        F.lit(None).cast(positions.schema).alias("_row"),
        part.alias("_part"),
    )
    asked = positions.select(
        F.col(position).cast("bigint").alias("_at"),
        F.lit(1).alias("_kind"),
        F.col(key).alias("_key"),
        F.struct(*positions.columns).alias("_row"),
        F.lit(None).cast(begins.schema["_part"].dataType).alias("_part"),
    )
    merged = ordered_slices(begins.unionByName(asked), ["_at", "_kind", "_key"])
    inside = Window.partitionBy(SLICE).orderBy(PLACE)
    carried = merged.withColumn("_own", F.last("_part", ignorenulls=True).over(inside))
    # One row per slice.
    lasts = merged.groupBy(SLICE).agg(
        F.max_by("_part", F.when(F.col("_part").isNotNull(), F.col(PLACE))).alias("_last")
    )
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    before = lasts.select(SLICE, F.last("_last", ignorenulls=True).over(earlier).alias("_before"))
    routed = (
        carried.where("_kind = 1")
        .join(F.broadcast(before), SLICE)
        .withColumn("_found", F.coalesce("_own", "_before"))
        .where(F.col("_at") < F.col("_found.cutoff"))
        .select(
            "_row.*",
            F.col("_found.part").alias("part"),
            ((F.col("_at") - F.col("_found.prev")) % F.col("_found.count")).alias("local_position"),
        )
    )
    return routed
