"""Small whole-number helpers for the sampling plan."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_LONG_PRODUCT_LIMIT = math.isqrt(2**63 - 1)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, math.isqrt(n) + 1))


def sampler_prime(total_tokens: int, ctx_len: int) -> int:
    """Largest prime below the number of blocks that leaves 2 when divided by 3."""
    top = total_tokens // ctx_len - 1
    for candidate in range(top, 1, -1):
        if candidate % 3 == 2 and is_prime(candidate):
            return candidate
    raise ValueError("too few tokens for a sampling plan")


def whole_div(left: Column, right: Column | int) -> Column:
    """Whole-number quotient of two integer columns, exact for all 64-bit values."""
    return F.call_function("div", left, F.lit(right) if isinstance(right, int) else right)


def product_mod(left: Column, right: Column, modulus: int) -> Column:
    """``left * right mod modulus`` for operands already below ``modulus``, without overflow."""
    if modulus <= _LONG_PRODUCT_LIMIT:
        return left * right % F.lit(modulus).cast("bigint")
    wide = left.cast("decimal(19,0)") * right.cast("decimal(19,0)")
    return (wide % F.lit(modulus).cast("decimal(19,0)")).cast("bigint")
