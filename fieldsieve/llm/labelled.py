"""Bounded samples of labelled documents, and calibrated scores for all documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow import arrow_schema, batch_of, small, spark_schema

#: Longest text a sampled document may have, in code points: with the numbers of sampled rows it
#: bounds the memory of a fit.
SAMPLED_LENGTH = 20_000


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text is a multiple of 5; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, sizes: dict[int, int], seed: int = 11
) -> list[tuple[str, int]]:
    """At most ``sizes[y]`` texts with label ``y``, as (text, y), from rows that are not held out.

    Ids are drawn by a seeded hash before any text is read; repeated ids count once, as do equal
    texts with the same label. Null and too long texts (``SAMPLED_LENGTH``) are passed over. The
    result has a fixed bound, so it may come to the driver.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("y"))
    known = known.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).distinct()
    order = F.xxhash64(F.lit(seed), "doc_id")
    drawn = [known.where(F.col("y") == y).orderBy(order, "doc_id").limit(n) for y, n in sizes.items()]
    ids = reduce(DataFrame.unionByName, drawn)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(
        F.length("text") <= SAMPLED_LENGTH
    )
    # The ids are at most the sum of ``sizes``.
    rows = texts.join(F.broadcast(ids), "doc_id").select("text", "y").distinct().collect()
    return sorted((r["text"], int(r["y"])) for r in rows)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


_SCORES = arrow_schema(doc_id="int64", held_out="bool", score="float64")


def score_documents(
    docs: DataFrame, score_texts: Callable[[list[str]], np.ndarray], threshold: float
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row, from its whole text alone.

    A null text is scored as an empty one. ``predicted`` is 1 where the score is at least
    ``threshold``. Other columns are not read; repeated rows are scored each.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            ids, out = batch["doc_id"].to_pylist(), batch["held_out"].to_pylist()
            scores = score_texts([t or "" for t in batch["text"].to_pylist()])
            yield batch_of(list(zip(ids, out, scores.tolist(), strict=True)), _SCORES)

    doc_id = F.col("doc_id").cast("long")
    narrow = docs.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), "text")
    return narrow.mapInArrow(score, spark_schema(_SCORES)).withColumn(
        "predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)
    )


def kept_documents(
    docs: DataFrame, score_texts: Callable[[list[str]], np.ndarray], keep: Callable[[np.ndarray], np.ndarray]
) -> DataFrame:
    """The rows of ``docs`` whose scores ``keep`` accepts, with all their columns, unshuffled."""
    position = docs.columns.index("text")

    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = [t or "" for t in batch.column(position).to_pylist()]
            yield batch.filter(pa.array(keep(score_texts(texts)), type=pa.bool_()))

    return docs.mapInArrow(filtered, docs.schema)


def unused_name(docs: DataFrame, name: str) -> str:
    """``name``, with as many lines before it as make it no column of ``docs`` in any case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
