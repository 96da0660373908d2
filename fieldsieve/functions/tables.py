"""Lookup tables carried in the plan as one folded literal."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CODE_POINTS = 0x110000


def literal_array(values: Sequence, element: str) -> Column:
    """An ``array<element>`` literal, built from one JSON string that the optimizer folds."""
    return F.from_json(F.lit(json.dumps(list(values))), f"array<{element}>")


def bounded_rows(df: DataFrame, bound: int, what: str) -> list:
    """Rows of a table whose size has a known bound; more rows than that is an error."""
    rows = df.limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"{what} has more than {bound} rows")
    return rows
