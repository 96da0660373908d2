"""Epoch shuffles and the order in which training samples are drawn."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import uniform_below
from ..functions.numbers import is_prime, product_mod, whole_div
from .numbering import number_by_hash

# Fixed value: the number of samples in one mini-epoch; batch sizes must divide it.
SAMPLES_PER_EPOCH = 40320


def epoch_shuffle(
    df: DataFrame, key: str, n_epochs: int, seed: int = 0, digits: int | None = None
) -> DataFrame:
    """(epoch, position, key): every epoch holds every key once, in its own seeded order."""
    copies = df.select(
        F.explode(F.sequence(F.lit(0), F.lit(n_epochs - 1))).alias("epoch"), key
    )
    return number_by_hash(copies, seed, ["epoch", key], "position", by=["epoch"], digits=digits)


def sample_numbers(
    spark: SparkSession,
    n_samples: int,
    world: int = 1,
    samples_per_epoch: int = SAMPLES_PER_EPOCH,
) -> DataFrame:
    """(epoch, idx, rank, ii): the running sample number ii, from 1, of every loader rank."""
    if samples_per_epoch % world:
        raise ValueError("the number of ranks must divide the samples of an epoch")
    place = F.col("id") % samples_per_epoch
    return spark.range(n_samples).select(
        whole_div(F.col("id"), samples_per_epoch).alias("epoch"),
        whole_div(place, world).alias("idx"),
        (place % world).alias("rank"),
        (F.col("id") + 1).alias("ii"),
    )


def check_plan(prime: int, total_tokens: int, ctx_len: int, batch: int = 1) -> None:
    """The conditions under which the cubic plan reads every block once per pass."""
    slots = total_tokens // ctx_len
    if not is_prime(prime):
        raise ValueError("the modulus must be a prime number")
    if prime % 3 != 2:
        raise ValueError("the modulus must leave 2 when divided by 3")
    if not 0.9 < prime / slots <= 1:
        raise ValueError("the modulus must be at most the number of blocks and above 0.9 of it")
    if SAMPLES_PER_EPOCH % batch:
        raise ValueError(f"the batch size must divide {SAMPLES_PER_EPOCH}")


def cubic_factor(prime: int) -> int:
    """The whole part of the modulus times the golden ratio's fraction, in double arithmetic."""
    return int(prime * ((math.sqrt(5) - 1) / 2))


def cubic_start(ii: Column, prime: int, ctx_len: int, shift: int = 0) -> Column:
    """Where sample ``ii`` begins: ``(factor * ii³ mod prime) * ctx_len + shift``.

    Reduced after every product, so nothing overflows. A negative shift counts as none.
    """
    modulus = F.lit(prime).cast("bigint")
    step = ii.cast("bigint") % modulus
    slot = F.lit(cubic_factor(prime)).cast("bigint")
    for _ in range(3):
        slot = product_mod(slot, step, prime)
    return slot * F.lit(ctx_len).cast("bigint") + F.lit(max(shift, 0)).cast("bigint")


def random_start(
    ii: Column, total_tokens: int, ctx_len: int, seed: int = 0, mixture: bool = False
) -> Column:
    """A seeded uniform position from which ``ctx_len + 1`` tokens can be read.

    With ``mixture`` any position of the stream: it is routed to a sub-dataset, and read there.
    """
    room = total_tokens if mixture else total_tokens - ctx_len - 1
    return uniform_below(F.lit(room), seed, ii)


def main_start(
    number: Column,
    draw: Column,
    prime: int,
    ctx_len: int,
    shift: int = 0,
    random_steps: int = 0,
    always_random: bool = False,
) -> Column:
    """Where sample ``number`` begins: at ``draw`` for the first ``random_steps`` numbers (or all),
    then by the cubic plan."""
    if always_random:
        return draw
    cubic = cubic_start(number - random_steps, prime, ctx_len, shift)
    return F.when(number < random_steps, draw).otherwise(cubic) if random_steps else cubic


def sample_starts(
    numbers: DataFrame,
    prime: int,
    total_tokens: int,
    ctx_len: int,
    shift: int = 0,
    random_steps: int = 0,
    always_random: bool = False,
    seed: int = 0,
    mixture: bool = False,
) -> DataFrame:
    """Add ``start``: random for the first ``random_steps`` samples (or all), then cubic."""
    draw = random_start(F.col("ii"), total_tokens, ctx_len, seed, mixture)
    start = main_start(F.col("ii"), draw, prime, ctx_len, shift, random_steps, always_random)
    return numbers.withColumn("start", start)


def interleaved_starts(
    numbers: DataFrame,
    prime: int,
    ctx_len: int,
    background_tokens: int,
    shift: int = 0,
    seed: int = 0,
    total_tokens: int | None = None,
    random_steps: int = 0,
    always_random: bool = False,
    mixture: bool = False,
) -> DataFrame:
    """Add ``corpus`` and ``start``: even samples come from a random place of the background,
    odd ones from the main corpus at half their number.

    Random places of the main corpus, for the first ``random_steps`` of these numbers or all, need
    its size, ``total_tokens``.
    """
    if (random_steps or always_random) and total_tokens is None:
        raise ValueError("random places of the main corpus need its number of tokens")
    from_background = F.col("ii") % 2 == 0
    draw = random_start(F.col("ii"), total_tokens or background_tokens, ctx_len, seed, mixture)
    number = whole_div(F.col("ii"), 2)
    main = main_start(number, draw, prime, ctx_len, shift, random_steps, always_random)
    return numbers.select(
        *numbers.columns,
        F.when(from_background, "background").otherwise("main").alias("corpus"),
        F.when(from_background, random_start(F.col("ii"), background_tokens, ctx_len, seed))
        .otherwise(main)
        .alias("start"),
    )
