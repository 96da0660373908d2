"""From documents to shuffled token shards and training windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import whole_div
from ..operators import sampling
from ..operators import tokens as tk
from ..operators import windows as wn
from ..operators.numbering import running_offsets
from ..session import pin
from ..sinks.token_shards import write_token_shards


def ordered_epochs(docs: DataFrame, key: str, n_epochs: int, seed: int = 0) -> DataFrame:
    """``docs`` once per epoch with (epoch, position): each epoch in its own seeded order."""
    order = sampling.epoch_shuffle(docs.select(key), key, n_epochs, seed)
    return docs.join(order, key)


def write_epochs(
    docs: DataFrame,
    key: str,
    path: str,
    n_epochs: int,
    tokens: Column | None = None,
    text: str = "text",
    seed: int = 0,
    shards: int | None = None,
) -> None:
    """Shuffle, tokenize and write ``n_epochs`` copies as token shards in training order.

    Positions are dense, so each row's shard follows from its place and the texts move once.
    """
    epochs = ordered_epochs(docs.select(key, text), key, n_epochs, seed)
    n_docs = docs.select(key).count()
    n = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.col("epoch").cast("bigint") * n_docs + F.col("position")
    shard = whole_div(F.col("_place") * n, max(1, n_docs * n_epochs)).cast("int")
    ids = tk.byte_tokens(text) if tokens is None else tokens
    rows = epochs.select(place.alias("_place"), text)
    write_token_shards(rows, path, "_place", ids, n, shard=shard)


def epoch_windows(
    docs: DataFrame, key: str, n_epochs: int, ctx_len: int, text: str = "text", seed: int = 0
) -> DataFrame:
    """(window, x, y): training windows over all epochs, byte vocabulary.

    Sizes are numbered without their texts; the texts join the offsets once and are cut into
    windows.
    """
    sizes = pin(docs.select(key, tk.byte_token_count(F.col(text)).alias("n_tokens")), "sizes")
    order = sampling.epoch_shuffle(docs.select(key), key, n_epochs, seed).join(sizes, key)
    offsets = running_offsets(order, ["epoch", "position"], "n_tokens")
    stream = docs.select(key, text).join(offsets.select(key, "start"), key)
    stream = stream.select("start", tk.byte_tokens(text).alias("tokens"))
    return wn.inputs_and_targets(wn.pack_windows(stream, ctx_len))
