"""Global row numbers and running totals without a single-partition sort.

Rows are first cut into ordered slices; each slice is numbered by itself and shifted by the totals
of the slices before it. Only the per-slice totals ever meet in one task, and their number is a
parameter, not a property of the data.

Two ways to cut the slices:

* by value (:func:`ordered_slices`): Spark's sampled range partitioning over the full sort key.
  The slices are even for any distribution of a unique key. Sampled borders differ from run to
  run, so the sliced rows are written out once and all later steps read that table.
* by hash (:func:`hash_slices`): the order key is already uniform, so its first digits are the
  slice and nothing has to be sampled or written.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import order_key
from ..session import pin

SLICE = "_slice"
PLACE = "_place"
SUM = "_sum"
GROUP = "_group"


def _grouped(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add the group as one struct: never null itself, and equal to itself with null fields."""
    return df.withColumn(GROUP, F.struct(*by) if by else F.lit(0))


def _slice_count(df: DataFrame, n_slices: int | None) -> int:
    return n_slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ordered_slices(
    df: DataFrame,
    order_by: Sequence[str],
    by: Sequence[str] = (),
    n_slices: int | None = None,
    size: str | None = None,
) -> DataFrame:
    """``df`` written in slices ordered by ``by`` + ``order_by``, which must identify a row.

    Adds the slice number and the row's place in its slice and, with ``size``, the sum of that
    column over the slice's rows up to and with this one. Because the sort key includes the unique
    ``order_by``, a group that holds a third of the rows is spread over a third of the slices.
    """
    keys = [*by, *order_by]
    laid_out = (
        df.repartitionByRange(_slice_count(df, n_slices), *keys)
        .sortWithinPartitions(*keys)
        .withColumn(SLICE, F.spark_partition_id())
        .withColumn(PLACE, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    return pin(_with_sums(laid_out, size) if size else laid_out, "slices")


def _with_sums(slices: DataFrame, size: str) -> DataFrame:
    """Add the running sum of ``size`` in each task's rows as they pass; a null counts as 0."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            sizes = pc.fill_null(batch.column(size).cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
            sums = np.cumsum(sizes) + total
            total = int(sums[-1]) if len(sums) else total
            yield batch.append_column(SUM, pa.array(sums, pa.int64()))

    return slices.mapInArrow(add, T.StructType([*slices.schema.fields, T.StructField(SUM, T.LongType())]))


def hash_slices(df: DataFrame, key: str, digits: int | None = None) -> DataFrame:
    """Slices from the first hex ``digits`` of a uniform hex ``key``: 16**digits of them.

    By default as many digits as give every shuffle partition of the session several slices, so
    slices shrink as the cluster and its settings grow.
    """
    if digits is None:
        digits = 1
        while 16**digits < 8 * _slice_count(df, None):
            digits += 1
    return df.withColumn(SLICE, F.substring(F.col(key), 1, digits))


def _shifted(sliced: DataFrame, by: Sequence[str], **amounts: Column) -> DataFrame:
    """Add each of ``amounts``, an aggregate, taken over the earlier slices of the row's group.

    The totals hold one row per (group, slice). Without groups that is at most the fixed number of
    slices and they are broadcast; with groups the join is left to Spark. It has the same keys as
    the numbering window, so both use one shuffle of the rows, and a hot group is many keys.
    """
    totals = sliced.groupBy(GROUP, SLICE).agg(
        *[total.cast("bigint").alias(name) for name, total in amounts.items()]
    )
    earlier = (
        Window.partitionBy(*([GROUP] if by else []))
        .orderBy(SLICE)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = totals.select(
        GROUP, SLICE, *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in amounts]
    )
    if not by:
        return sliced.join(F.broadcast(before.drop(GROUP)), SLICE)
    return sliced.join(before, [GROUP, SLICE])


def _row_count() -> Column:
    return F.count(F.lit(1))


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    name: str = "row",
    by: Sequence[str] = (),
    n_slices: int | None = None,
) -> DataFrame:
    """Add ``name``: the 0-based dense position of each row in ``order_by`` order, per ``by`` group.

    Pass narrow rows (keys) and join the wide columns back: the rows are written out once.
    """
    sliced = _grouped(ordered_slices(df, order_by, by, n_slices), by)
    shifted = _shifted(sliced, by, _before=_row_count())
    if by:
        within = Window.partitionBy(GROUP, SLICE).orderBy(PLACE)
        local = F.row_number().over(within) - 1
    else:
        local = F.col(PLACE)
    return shifted.withColumn(name, (F.col("_before") + local).cast("bigint")).select(
        *df.columns, name
    )


def running_offsets(
    df: DataFrame,
    order_by: Sequence[str],
    size: str,
    name: str = "start",
    row: str = "item",
    n_slices: int | None = None,
) -> DataFrame:
    """Add ``row`` (dense position) and ``name`` (sum of ``size`` over all earlier rows).

    The rows are shuffled and written once: sums inside a slice are taken while it is written, and
    what lies before a slice comes from one row per slice. Sizes are whole numbers.
    """
    sliced = _grouped(ordered_slices(df, order_by, (), n_slices, size), ())
    inside = F.col(SUM) - F.coalesce(F.col(size), F.lit(0))
    return (
        _shifted(sliced, (), _before=_row_count(), _sizes=F.max(SUM))
        .withColumn(row, F.col("_before") + F.col(PLACE))
        .withColumn(name, (F.col("_sizes") + inside).cast("bigint"))
        .select(*df.columns, row, name)
    )


def number_by_hash(
    df: DataFrame,
    seed: int,
    parts: Sequence[str],
    name: str = "row",
    by: Sequence[str] = (),
    digits: int | None = None,
) -> DataFrame:
    """Add ``name``: the 0-based position of each row in a seeded random order, per ``by`` group.

    The key is md5 of ``seed:part:…``; equal keys (never met in practice) fall back to ``parts``.
    Groups of any size are spread over all slices.
    """
    keyed = df.withColumn("_key", order_key(seed, *[F.col(p) for p in parts]))
    sliced = _grouped(hash_slices(keyed, "_key", digits), by)
    within = Window.partitionBy(GROUP, SLICE).orderBy("_key", *parts)
    return (
        _shifted(sliced, by, _before=_row_count())
        .withColumn(name, (F.col("_before") + F.row_number().over(within) - 1).cast("bigint"))
        .select(*df.columns, name)
    )
