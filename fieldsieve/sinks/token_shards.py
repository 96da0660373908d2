"""Binary token shards: a data source that writes and reads indexed token streams.

Every task writes one pair of files: ``.bin`` with the little-endian ids of its items and ``.idx``
with the items' sizes, their byte pointers, and the borders of documents, which hold one item or
several. Items and documents are numbered over all shards, so pairs that are appended go on where
the store ended. Readers may choose items, and a span inside them, as byte ranges: other ranges are not
opened. These are options of a read and no pushed filters, since the scans of one DataFrame share the
reader that filters would be pushed to, and with it the last filters. A ``_shards.json`` listing, written
when the job commits, names the pairs that count; files of failed or duplicate attempts are not in
it. Shards are numbered in the order of the tasks, so a table sorted by range keeps its order.
"""

from __future__ import annotations

import bisect
import json
import struct
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from ..sources.token_files import open_fs

# The index format.
MAGIC = b"MMIDIDX\x00\x00"
VERSION = 1
DTYPE_CODES = {
    "uint8": 1, "int8": 2, "int16": 3, "int32": 4, "int64": 5, "float64": 7, "uint16": 8,
}
CODE_DTYPES = {code: name for name, code in DTYPE_CODES.items()} | {6: "float64"}

LISTING = "_shards.json"
FORMAT = "token_shards"
TOKENS_PER_READ = 1 << 24
_HEADER = struct.Struct("<9sQBQQ")


@dataclass
class ShardMessage(WriterCommitMessage):
    task: int
    name: str
    n_docs: int
    n_items: int
    n_tokens: int


class ShardWriter(DataSourceArrowWriter):
    def __init__(self, path: str, dtype: str, overwrite: bool):
        self.path, self.dtype, self.overwrite = path, dtype, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> ShardMessage:
        fs, root = open_fs(self.path)
        fs.create_dir(root, recursive=True)
        task = TaskContext.get().partitionId()
        name = f"shard-{task:06d}-{uuid.uuid4().hex}"
        kind = np.dtype(self.dtype)
        low, high = (np.iinfo(kind).min, np.iinfo(kind).max) if kind.kind in "iu" else (None, None)
        sizes: list[np.ndarray] = []
        held: list[np.ndarray] = []
        with fs.open_output_stream(f"{root}/{name}.bin") as data:
            for batch in iterator:
                tokens = batch.column(0)
                if tokens.null_count:
                    raise ValueError("a document without tokens cannot be written to a shard")
                if pa.types.is_list(tokens.type.value_type):
                    held.append(pc.list_value_length(tokens).to_numpy(zero_copy_only=False))
                    tokens = tokens.flatten()
                    if tokens.null_count:
                        raise ValueError("an item without tokens cannot be written to a shard")
                else:
                    held.append(np.ones(len(tokens), dtype=np.int64))
                ids = tokens.flatten().to_numpy(zero_copy_only=False)
                if low is not None and len(ids) and (ids.min() < low or ids.max() > high):
                    raise ValueError(f"a token id does not fit {self.dtype}")
                data.write(ids.astype(kind.newbyteorder("<")).tobytes())
                sizes.append(pc.list_value_length(tokens).to_numpy(zero_copy_only=False))
        lengths = np.concatenate(sizes).astype("<i4") if sizes else np.zeros(0, "<i4")
        ends = np.cumsum(lengths, dtype=np.int64) * kind.itemsize
        pointers = np.concatenate([np.zeros(min(1, len(ends)), np.int64), ends[:-1]])
        borders = np.concatenate([[0], *held]).cumsum(dtype="<i8")
        with fs.open_output_stream(f"{root}/{name}.idx") as index:
            index.write(
                _HEADER.pack(MAGIC, VERSION, DTYPE_CODES[self.dtype], len(lengths), len(borders))
            )
            for part in (lengths, pointers.astype("<i8"), borders):
                index.write(part.tobytes())
        n_tokens = int(lengths.sum(dtype=np.int64))
        return ShardMessage(task, name, len(borders) - 1, len(lengths), n_tokens)

    def commit(self, messages: list[ShardMessage | None]) -> None:
        fs, root = open_fs(self.path)
        written = sorted((m for m in messages if m and m.n_docs), key=lambda m: m.task)
        new = [
            {"name": m.name, "n_docs": m.n_docs, "n_items": m.n_items, "n_tokens": m.n_tokens}
            for m in written
        ]
        old = [] if self.overwrite else read_listing(self.path)
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/{LISTING}") as out:
            out.write(json.dumps(old + new).encode())

    def abort(self, messages: list[ShardMessage | None]) -> None:
        """Nothing to undo: files that no listing names are never read."""


@dataclass
class ItemRange(InputPartition):
    """Items ``first`` up to ``last`` of a shard, which has so many items and documents before it."""

    name: str
    shard: int
    items_before: int
    docs_before: int
    first: int
    last: int


def read_listing(path: str) -> list[dict]:
    fs, root = open_fs(path)
    if fs.get_file_info(f"{root}/{LISTING}").type == pafs.FileType.NotFound:
        return []
    with fs.open_input_stream(f"{root}/{LISTING}") as listing:
        return json.loads(listing.read())


class _Borders:
    """The document borders of an index file, read one by one as a search asks for them."""

    def __init__(self, index: pa.NativeFile, at: int, count: int):
        self._index, self._at, self._count = index, at, count

    def __len__(self) -> int:
        return self._count

    def __getitem__(self, i: int) -> int:
        return int(self.between(i, i + 1)[0])

    def between(self, first: int, last: int) -> np.ndarray:
        self._index.seek(self._at + 8 * first)
        return np.frombuffer(self._index.read(8 * (last - first)), "<i8")


class ShardReader(DataSourceReader):
    """Reads the items in ``runs`` (first, last), all without them, and of each a span."""

    def __init__(
        self,
        path: str,
        tokens_per_read: int,
        runs: list[tuple[int, int]] | None = None,
        offset: int = 0,
        length: int | None = None,
    ):
        self.path, self.tokens_per_read, self.runs = path, tokens_per_read, runs
        self.offset, self.length = offset, length

    def partitions(self) -> list[ItemRange]:
        ranges, items, docs = [], 0, 0
        for number, shard in enumerate(read_listing(self.path)):
            step = max(1, shard["n_items"] * self.tokens_per_read // max(1, shard["n_tokens"]))
            for first, last in self._runs(items, items + shard["n_items"]):
                ranges += [
                    ItemRange(shard["name"], number, items, docs, at, min(at + step, last))
                    for at in range(first, last, step)
                ]
            items, docs = items + shard["n_items"], docs + shard["n_docs"]
        return ranges

    def _runs(self, begin: int, end: int) -> Iterator[tuple[int, int]]:
        """The parts of the runs within a shard that has the items ``begin`` up to ``end``."""
        for first, last in [(begin, end)] if self.runs is None else self.runs:
            low, high = max(begin, first), min(end, last)
            if low < high:
                yield low - begin, high - begin

    def read(self, part: ItemRange) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(self.path)
        count = part.last - part.first
        with fs.open_input_file(f"{root}/{part.name}.idx") as index:
            magic, version, code, n_items, n_borders = _HEADER.unpack(index.read(_HEADER.size))
            if magic != MAGIC or version != VERSION:
                raise ValueError(f"{part.name}.idx is not a token index")
            kind = np.dtype(CODE_DTYPES[code]).newbyteorder("<")
            index.seek(_HEADER.size + 4 * part.first)
            lengths = np.frombuffer(index.read(4 * count), "<i4").astype(np.int64)
            index.seek(_HEADER.size + 4 * n_items + 8 * part.first)
            begin = int(np.frombuffer(index.read(8), "<i8")[0])
            borders = _Borders(index, _HEADER.size + 12 * n_items, n_borders)
            doc = bisect.bisect_right(borders, part.first) - 1
            later = borders.between(doc + 1, bisect.bisect_left(borders, part.last) + 1)
        items = np.arange(part.first, part.last, dtype=np.int64)
        docs = part.docs_before + doc + np.searchsorted(later, items, side="right")
        begins = begin + (np.cumsum(lengths) - lengths) * kind.itemsize
        skipped = np.minimum(self.offset, lengths)
        begins, sizes = begins + skipped * kind.itemsize, lengths - skipped
        if self.length is not None:
            sizes = np.minimum(sizes, self.length)
        if sizes.max(initial=0) >= 1 << 31:
            raise ValueError("an item is too long for a list of tokens")
        ends = np.cumsum(sizes)
        with fs.open_input_file(f"{root}/{part.name}.bin") as data:
            first = done = 0
            while first < count:
                # As many items as the read size holds, one at least: long items come alone.
                last = max(first + 1, int(np.searchsorted(ends, done + self.tokens_per_read, "right")))
                ids = self._ids(data, begins[first:last], sizes[first:last], kind)
                offsets = np.concatenate([[0], ends[first:last] - done]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(last - first, part.shard, dtype=np.int32)),
                        pa.array(docs[first:last]),
                        pa.array(items[first:last] + part.items_before),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32))),
                    ],
                    ["shard", "document", "item", "tokens"],
                )
                done, first = int(ends[last - 1]), last

    def _ids(self, data: pa.NativeFile, begins: np.ndarray, sizes: np.ndarray, kind: np.dtype) -> np.ndarray:
        """Whole items lie side by side; spans are read one by one."""
        if not self.offset and self.length is None:
            begins, sizes = begins[:1], [int(sizes.sum())]
        parts = []
        for begin, size in zip(begins, sizes, strict=True):
            data.seek(int(begin))
            parts.append(np.frombuffer(data.read(int(size) * kind.itemsize), kind))
        return np.concatenate(parts)


class TokenShards(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "shard int, document bigint, item bigint, tokens array<int>"

    def reader(self, schema) -> ShardReader:
        given = {n: int(self.options[n]) for n in ("offset", "length") if n in self.options}
        runs = json.loads(self.options["runs"]) if "runs" in self.options else None
        per_read = int(self.options.get("tokens_per_read", TOKENS_PER_READ))
        return ShardReader(self.options["path"], per_read, runs, **given)

    def writer(self, schema, overwrite: bool) -> ShardWriter:
        return ShardWriter(self.options["path"], self.options.get("dtype", "uint16"), overwrite)


def write_token_shards(
    df: DataFrame,
    path: str,
    order_by: str,
    tokens: Column,
    shards: int | None = None,
    dtype: str = "uint16",
    shard: Column | None = None,
    append: bool = False,
) -> None:
    """Write the ``tokens`` of every row in ``order_by`` order, one shard per range of it.

    A row is a document: an array of ids is its only item, an array of arrays its items. With
    ``append`` the documents follow those of the store; without it they replace them.

    Rows are ranged before the ids are made, so the range sampling does not make them as well.
    Where the rows' places are known, ``shard`` says the shard of each, rising with ``order_by``,
    and nothing is sampled at all.
    """
    spark = df.sparkSession
    spark.dataSource.register(TokenShards)
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, order_by) if shard is None else df.repartitionById(n, shard)
    (
        ranged.sortWithinPartitions(order_by).select(tokens.alias("tokens"))
        .write.format(FORMAT).option("dtype", dtype).mode("append" if append else "overwrite").save(path)
    )


def read_token_shards(
    spark: SparkSession,
    path: str,
    tokens_per_read: int = TOKENS_PER_READ,
    items: Iterable[int] | None = None,
    offset: int = 0,
    length: int | None = None,
) -> DataFrame:
    """(shard, document, item, tokens): every task reads a range of one shard's items.

    ``items`` chooses items by number, all without it, and ``offset`` and ``length`` a span inside each,
    cut at its end. Both become byte ranges, found through the index; other ranges are not opened.
    """
    spark.dataSource.register(TokenShards)
    reader = spark.read.format(FORMAT).option("tokens_per_read", tokens_per_read).option("offset", offset)
    if items is not None:
        reader = reader.option("runs", json.dumps(item_runs(items)))
    return (reader if length is None else reader.option("length", length)).load(path)


def item_runs(items: Iterable[int]) -> list[tuple[int, int]]:
    """The runs (first, behind last) of item numbers, in order."""
    if isinstance(items, range) and items.step == 1:
        return [(items.start, items.stop)] if items else []
    runs: list[tuple[int, int]] = []
    for item in sorted(set(items)):
        if runs and runs[-1][1] == item:
            runs[-1] = runs[-1][0], item + 1
        else:
            runs.append((item, item + 1))
    return runs
