"""Best-fit packing of documents into token sequences of one length.

A document longer than a sequence is cut from its end into full sequences, so only its first piece
may be shorter. The plan depends on nothing but how many pieces there are of each length, a table
of at most ``capacity`` rows, so the driver plans any corpus from the same bounded input:

* large pieces, above a third of the capacity, fit at most twice into a sequence: each, from the
  longest on, is matched with the longest large piece that still fits beside it;
* smaller pieces, longest first, go where the gap they fit is smallest; what fits nowhere opens new
  sequences.

All sequences with the same gap are filled at once, so the plan is a short list of fillings, each
for many sequences. The pieces of one length are interchangeable: Spark numbers them, by slices,
so that a length shared by a third of all pieces is no hot group, and a piece's number says its
place.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import pin
from .arrow import arrow_schema, batch_of, small, spark_schema
from .encoding import encoder

_PIECES = arrow_schema(
    part="int32", row="int64", doc_id="int64", piece="int32", start="int64", length="int32",
    ids="binary",
)


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids: all full but, perhaps, the first."""
    full, rest = divmod(n, capacity)
    return ([rest] if rest else []) + [capacity] * full


def _cutter(vocabulary: str, end_id: int, capacity: int) -> Callable:
    end = np.uint32(end_id).astype("<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        part, row = TaskContext.get().partitionId(), 0
        for batch in small(batches):
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = encode(text.as_py()) + end
                start = 0
                for piece, length in enumerate(cut_lengths(len(ids) // 4, capacity)):
                    rows.append(
                        (part, row, doc_id.as_py(), piece, start, length,
                         ids[4 * start : 4 * (start + length)])
                    )
                    start += length
                row += 1
            yield batch_of(rows, _PIECES)

    return cut


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int) -> DataFrame:
    """The pieces of every document with their ids, written once to the shared folder.

    A null text is empty and has its end id only; a null ``doc_id`` stays null. (part, row) names
    the document's row, so repeated rows and repeated ids stay apart. Other columns are not read.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return pin(narrow.mapInArrow(_cutter(vocabulary, end_id, capacity), spark_schema(_PIECES)), "pieces")


@dataclass(frozen=True)
class Fill:
    """Pieces ``first``… of one length: ``per`` each in ``count`` sequences from ``sequence`` on."""

    length: int
    first: int
    per: int
    count: int
    sequence: int
    offset: int


def plan_fills(counts: dict[int, int], capacity: int) -> list[Fill]:
    """Where the pieces of each length go, given how many there are.

    Lengths are 1 to ``capacity``. The plan has at most a few tens of thousands of fills, whatever
    the counts: every length splits at most one run of equal sequences, and every fill of a
    sequence at least halves the gap it is counted by.
    """
    left = {n: c for n, c in counts.items() if c}
    if any(not 1 <= n <= capacity for n in left):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    used: dict[int, int] = defaultdict(int)
    fills: list[Fill] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: runs (sequence, count)
    opened = 0

    def fill(length: int, per: int, count: int, sequence: int, offset: int) -> None:
        fills.append(Fill(length, used[length], per, count, sequence, offset))
        used[length] += per * count
        left[length] -= per * count

    def open_run(count: int) -> int:
        nonlocal opened
        opened += count
        return opened - count

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for a in large:
        for b in (b for b in large if b <= min(a, capacity - a)):
            pairs = left[a] // 2 if a == b else min(left[a], left[b])
            if pairs:
                at = open_run(pairs)
                fill(a, 1, pairs, at, 0)
                fill(b, 1, pairs, at, a)
                gaps[capacity - a - b].append((at, pairs))
        if left[a]:
            count = left[a]
            at = open_run(count)
            fill(a, 1, count, at, 0)
            gaps[capacity - a].append((at, count))

    def place(length: int, gap: int, run: tuple[int, int]) -> None:
        """Fill a run's gaps as far as the pieces go; what the run has left over goes back."""
        at, count = run
        per = gap // length
        full = min(count, left[length] // per)
        if full:
            fill(length, per, full, at, capacity - gap)
            gaps[gap - per * length].append((at, full))
        rest = left[length] if full < count else 0
        if rest:
            fill(length, rest, 1, at + full, capacity - gap)
            gaps[gap - rest * length].append((at + full, 1))
            full += 1
        if full < count:
            gaps[gap].append((at + full, count - full))

    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        for gap in sorted(g for g in gaps if g >= length):
            runs = gaps.pop(gap)
            for i, run in enumerate(runs):
                if not left[length]:
                    gaps[gap].extend(runs[i:])
                    break
                place(length, gap, run)
            if not left[length]:
                break
        if left[length]:
            count = -(-left[length] // (capacity // length))
            place(length, capacity, (open_run(count), count))
    return fills


def _place(fills: list[Fill]) -> Callable[[pd.Series, pd.Series], pd.DataFrame]:
    """Sequence and offset of the pieces of given lengths and numbers."""
    fills = sorted(fills, key=lambda f: (f.length, f.first))
    columns = ("length", "first", "per", "sequence", "offset")
    length, first, per, sequence, offset = (
        np.array([getattr(f, c) for f in fills], dtype=np.int64) for c in columns
    )
    begins = {n: i for i, n in reversed(list(enumerate(length.tolist())))}

    def place(lengths: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        n = numbers.to_numpy(np.int64)
        at = np.empty(len(n), dtype=np.int64)
        for value, rows in pd.Series(range(len(n))).groupby(lengths.to_numpy()):
            lo = begins[int(value)]
            hi = lo + int(np.searchsorted(length[lo:], value, side="right"))
            i = rows.to_numpy()
            at[i] = lo + np.searchsorted(first[lo:hi], n[i], side="right") - 1
        inside = n - first[at]
        return pd.DataFrame(
            {
                "sequence_id": sequence[at] + inside // per[at],
                "offset": offset[at] + inside % per[at] * lengths.to_numpy(np.int64),
            }
        )

    return place


def place_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a written table with ``part``, ``row``, ``piece``, ``length``.

    Give it narrow rows: they are shuffled twice to be numbered. An empty table stays empty.
    """
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    by_part = Window.partitionBy("length").orderBy("part")
    before = (
        pieces.groupBy("length", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "length",
            "part",
            F.coalesce(F.sum("n").over(by_part.rowsBetween(Window.unboundedPreceding, -1)),
                       F.lit(0)).alias("before"),
        )
    )
    inside = F.row_number().over(Window.partitionBy("length", "part").orderBy("row", "piece"))
    numbered = (
        pieces.withColumn("inside", inside)
        .join(before, ["length", "part"])
        .withColumn("number", F.col("before") + F.col("inside") - 1)
    )
    if not counts:
        return pieces.withColumns({c: F.lit(0).cast("long") for c in ("sequence_id", "offset")})
    place = F.pandas_udf(_place(plan_fills(counts, capacity)), "sequence_id long, offset long")
    return (
        numbered.withColumn("at", place("length", "number"))
        .select(*pieces.columns, "at.sequence_id", "at.offset")
    )


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences: ``sequence_id``, ``ids``; a group is one sequence, never longer."""
    keys = ["part", "row", "piece"]
    return (
        pieces.select(*keys, "ids")
        .join(placed.select(*keys, "sequence_id", "offset"), keys)
        .groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
        .select(
            "sequence_id",
            F.aggregate("parts.ids", F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"),
        )
    )
