"""Arrow schemas and batches of the functions that run inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType


def arrow_schema(**columns: str | pa.DataType) -> pa.Schema:
    """A schema from column names and Arrow types, given as types or by name."""
    return pa.schema(
        [(n, pa.type_for_alias(t) if isinstance(t, str) else t) for n, t in columns.items()]
    )


def spark_schema(schema: pa.Schema) -> StructType:
    return from_arrow_schema(schema)


def batch_of(rows: Sequence[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """A batch from rows given as tuples in the order of the schema; there may be none."""
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def small(batches: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows: what a worker builds from texts at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
