"""Repeatable pseudo-random order and numbers, from md5 so that any engine can check them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_key(seed: int, *parts: Column) -> Column:
    """32 hex digits that order rows at random but repeatably: md5 of ``seed:part:part…``."""
    pieces = [F.lit(str(seed))] + [p.cast("string") for p in parts]
    return F.md5(F.concat_ws(":", *pieces))


def uniform_below(limit: Column, seed: int, *parts: Column) -> Column:
    """A repeatable whole number in ``[0, limit)`` from the first 15 hex digits of the key."""
    digits = F.conv(F.substring(order_key(seed, *parts), 1, 15), 16, 10)
    return digits.cast("bigint") % limit.cast("bigint")
