"""Flat token files, raw or ``.npy``, read as rows of a fixed number of tokens."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "token_rows"
TOKENS_PER_READ = 1 << 24


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path on it, for local paths and URIs."""
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _layout(path: str, dtype: str) -> tuple[np.dtype, int, int]:
    """Element type, first data byte and number of elements of a flat file."""
    fs, local = open_fs(path)
    size = fs.get_file_info(local).size
    if not path.endswith(".npy"):
        kind = np.dtype(dtype).newbyteorder("<")
        return kind, 0, size // kind.itemsize
    with fs.open_input_file(local) as data:
        version = np.lib.format.read_magic(data)
        read = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
        shape, _, kind = read(data)
        return kind, data.tell(), int(np.prod(shape))


@dataclass
class RowRange(InputPartition):
    first: int
    last: int


class TokenRowsReader(DataSourceReader):
    def __init__(self, path: str, row_len: int, dtype: str, tokens_per_read: int):
        self.path, self.row_len = path, row_len
        self.rows_per_read = max(1, tokens_per_read // row_len)
        self.kind, self.begin, self.n_tokens = _layout(path, dtype)

    def partitions(self) -> list[RowRange]:
        rows = self.n_tokens // self.row_len
        step = self.rows_per_read
        return [RowRange(first, min(first + step, rows)) for first in range(0, rows, step)]

    def read(self, part: RowRange) -> Iterator[pa.RecordBatch]:
        fs, local = open_fs(self.path)
        count = (part.last - part.first) * self.row_len
        with fs.open_input_file(local) as data:
            data.seek(self.begin + part.first * self.row_len * self.kind.itemsize)
            ids = np.frombuffer(data.read(count * self.kind.itemsize), self.kind)
        borders = np.arange(0, count + 1, self.row_len, dtype=np.int32)
        tokens = pa.ListArray.from_arrays(pa.array(borders), pa.array(ids.astype(np.int32)))
        rows = pa.array(np.arange(part.first, part.last, dtype=np.int64))
        yield pa.RecordBatch.from_arrays([rows, tokens], ["row", "tokens"])


class TokenRows(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "row bigint, tokens array<int>"

    def reader(self, schema) -> TokenRowsReader:
        tokens_per_read = int(self.options.get("tokens_per_read", TOKENS_PER_READ))
        return TokenRowsReader(
            self.options["path"], int(self.options["row_len"]), self.options["dtype"], tokens_per_read
        )


def read_token_rows(
    spark: SparkSession,
    path: str,
    row_len: int,
    dtype: str = "uint16",
    tokens_per_read: int = TOKENS_PER_READ,
) -> DataFrame:
    """(row, tokens): the full rows of a flat token file, each task reading a range of them.

    With ``start = row * row_len`` the rows are a token stream for the window operators.
    """
    spark.dataSource.register(TokenRows)
    options = {"row_len": row_len, "dtype": dtype, "tokens_per_read": tokens_per_read}
    return spark.read.format(FORMAT).options(**options).load(path)
