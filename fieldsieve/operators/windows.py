"""Training windows over a token stream that runs across document borders.

A stream is a table of documents with their ``start`` offset and ``tokens``. Block k covers the
positions ``[k * ctx_len, (k + 1) * ctx_len)``; window k is block k plus the next token. Documents
are cut at block borders first, so the pieces meet by an equi-join key (the block number) and no
row or group ever holds more than one window.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import uniform_below
from ..functions.numbers import whole_div


def _touched(start: Column, end: Column, ctx_len: int, extra: int) -> Column:
    """Numbers of the windows that hold any position of ``[start, end)``."""
    first = F.greatest(F.lit(0).cast("bigint"), whole_div(start - extra, ctx_len))
    last = whole_div(end - 1, ctx_len)
    none = F.array().cast("array<bigint>")
    return F.when(end > start, F.sequence(first, last)).otherwise(none)


def documents_in_windows(
    offsets: DataFrame,
    ctx_len: int,
    key: str = "doc_id",
    start: str = "start",
    size: str = "n_tokens",
    extra: int = 1,
) -> DataFrame:
    """(window, key, first, n): which tokens of which documents each window reads.

    ``first`` is the place in the document where the window's share begins. Includes the shares of
    a last, unfilled window.
    """
    begin, end = F.col(start), F.col(start) + F.col(size)
    rows = offsets.select(
        key, begin.alias("_s"), end.alias("_e"), F.explode(_touched(begin, end, ctx_len, extra)).alias("window")
    )
    low = F.greatest(F.col("_s"), F.col("window") * ctx_len)
    high = F.least(F.col("_e"), F.col("window") * ctx_len + ctx_len + extra)
    return rows.select(
        "window", key, (low - F.col("_s")).alias("first"), (high - low).alias("n")
    )


def _pieces(
    stream: DataFrame, ctx_len: int, start: str = "start", tokens: str = "tokens", extra: int = 0
) -> DataFrame:
    """(window, at, part): the documents cut at block borders, before any row is multiplied."""
    begin = F.col(start)
    end = begin + F.size(tokens)

    def piece(window: Column) -> Column:
        low = F.greatest(begin, window * ctx_len)
        high = F.least(end, window * ctx_len + ctx_len + extra)
        part = F.slice(F.col(tokens), (low - begin + 1).cast("int"), (high - low).cast("int"))
        return F.struct(window.alias("window"), low.alias("at"), part.alias("part"))

    return stream.select(F.inline(F.transform(_touched(begin, end, ctx_len, extra), piece)))


def _in_order(at: Column, part: Column) -> Column:
    """Aggregate: the parts of one window joined in the order of their places."""
    parts = F.array_sort(F.collect_list(F.when(F.size(part) > 0, F.struct(at.alias("at"), part.alias("part")))))
    return F.flatten(F.transform(parts, lambda p: p["part"]))


def pack_windows(
    stream: DataFrame,
    ctx_len: int,
    start: str = "start",
    tokens: str = "tokens",
    extra: int = 1,
    keep_tail: bool = False,
) -> DataFrame:
    """(window, tokens): all windows of ``ctx_len + extra`` tokens.

    ``keep_tail`` also returns the last, shorter ones.
    """
    pieces = _pieces(stream, ctx_len, start, tokens, extra)
    packed = pieces.groupBy("window").agg(_in_order(F.col("at"), F.col("part")).alias("tokens"))
    return packed if keep_tail else packed.where(F.size("tokens") == ctx_len + extra)


def inputs_and_targets(windows: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Replace ``tokens`` by ``x`` (all but the last) and ``y`` (all but the first)."""
    n = F.size(tokens) - 1
    rest = [c for c in windows.columns if c != tokens]
    return windows.select(
        *rest, F.slice(F.col(tokens), F.lit(1), n).alias("x"), F.slice(F.col(tokens), F.lit(2), n).alias("y")
    )


def fixed_rows(stream: DataFrame, row_len: int, start: str = "start", tokens: str = "tokens") -> DataFrame:
    """The stream as rows of ``row_len`` tokens (full rows only), split into ``x`` and ``y``."""
    return inputs_and_targets(pack_windows(stream, row_len, start, tokens, extra=0))


def _found(rows: DataFrame, size: Column, needed: Column | int, what: str) -> DataFrame:
    """``rows``, failing the job where a planned sample has not all its tokens."""
    short = F.raise_error(F.lit(f"{what} reaches beyond the stream")).cast("boolean")
    return rows.where(F.when(F.coalesce(size, F.lit(0)) >= needed, True).otherwise(short))


def read_spans(
    plan: DataFrame, stream: DataFrame, ctx_len: int, start: str = "start", at: str = "start", tokens: str = "tokens"
) -> DataFrame:
    """Windows that begin anywhere: ``plan`` rows with their ``ctx_len + 1`` ``tokens``.

    A span touches at most two blocks. The documents of ``stream`` (places in ``at``) are cut at
    block borders, each piece meets the spans of its block by an equi-join and leaves them only the
    tokens they ask for, and these meet in their span. So no token of the stream travels twice,
    and where Spark finds the plan small enough to send around, only asked tokens travel. Equal
    plan rows are read once and given out as often as they came. A span beyond the end of the
    stream, or at no place, fails the job.
    """
    begin = F.col("_start")
    asked = (
        plan.groupBy(*plan.columns)
        .agg(F.count(F.lit(1)).cast("int").alias("_times"))
        .withColumn("_start", F.col(start).cast("bigint"))
        .withColumn("_end", begin + ctx_len + 1)
        .withColumn("_block", F.explode_outer(_touched(begin, F.col("_end"), ctx_len, 0)))
    )
    pieces = _pieces(stream, ctx_len, at, tokens).toDF("_block", "_at", "_part")
    low = F.greatest("_at", "_start")
    high = F.least(F.col("_at") + F.size("_part"), F.col("_end"))
    share = F.slice("_part", (low - F.col("_at") + 1).cast("int"), F.greatest(high - low, F.lit(0)).cast("int"))
    shares = asked.join(pieces, "_block", "left").select(
        *plan.columns, "_times", low.alias("_low"), share.alias("_share")
    )
    spans = shares.groupBy(*plan.columns, "_times").agg(_in_order(F.col("_low"), F.col("_share")).alias("_tokens"))
    sound = _found(spans, F.size("_tokens"), ctx_len + 1, "a span")
    again = F.explode(F.array_repeat("_tokens", F.col("_times")))
    return sound.select(*plan.columns, again.alias("tokens"))


def read_blocks(plan: DataFrame, windows: DataFrame, ctx_len: int, start: str = "start") -> DataFrame:
    """Windows that begin on a block border: one equi-join of the plan with the windows.

    A start off the border, or without a full window, fails the job; the first kind needs
    :func:`read_spans`.
    """
    off = F.raise_error(F.lit("a start lies off the block border")).cast("bigint")
    block = F.when(F.col(start) % ctx_len == 0, whole_div(F.col(start), ctx_len)).otherwise(off)
    rows = plan.withColumn("window", block).join(windows, "window", "left")
    present = F.when(F.col(windows.columns[-1]).isNotNull(), 1).otherwise(0)
    return _found(rows, present, 1, "a block")


def span_mask(tokens: Column | str, ctx_len: int, pattern: Sequence[int], stop: int = 0) -> Column:
    """0/1 per position: 1 from the last token of ``pattern`` until the next ``stop`` token.

    One pass over a batch of windows: marks and stops are found for all places at once, and each
    place takes the last of them before it. Places before the pattern could have ended are 0.
    """
    first = len(pattern) - 1
    wanted = np.array(pattern)

    @F.pandas_udf("array<int>")
    def mask(windows: pd.Series) -> pd.Series:
        if windows.empty:
            return pd.Series([], dtype=object)
        ids = np.stack([np.asarray(w)[:ctx_len] for w in windows])
        ends = np.ones((len(ids), ctx_len - first), dtype=bool)
        for back, token in enumerate(wanted):
            ends &= ids[:, back : ctx_len - first + back] == token
        last = np.zeros(ids.shape, dtype=np.int64)
        event = ends | (ids[:, first:] == stop)
        places = np.arange(first, ctx_len)
        last[:, first:] = np.maximum.accumulate(np.where(event, places, 0), axis=1)
        ones = np.zeros(ids.shape, dtype=np.int32)
        ones[:, first:] = ends & (ids[:, first:] != stop)
        return pd.Series(list(np.take_along_axis(ones, last, axis=1)), index=windows.index)

    return mask(tokens)


def masked_samples(
    samples: DataFrame,
    background: DataFrame,
    background_tokens: int,
    ctx_len: int,
    pattern: Sequence[int],
    key: str = "window",
    seed: int = 0,
) -> DataFrame:
    """Samples with their answer mask ``z``; (key, replaced, tokens, z).

    A sample without any answer span is replaced as a whole by a window at a seeded random
    position of the ``background`` stream (see :func:`read_spans`), all of it counted. A background
    that holds no window fails the job once a sample needs it.
    """
    marked = samples.select(key, "tokens", span_mask("tokens", ctx_len, pattern).alias("z"))
    has_span = F.array_contains("z", 1)
    kept = marked.where(has_span).select(key, F.lit(False).alias("replaced"), "tokens", "z")
    room = background_tokens - ctx_len - 1
    too_short = F.raise_error(F.lit("the background is shorter than a window")).cast("bigint")
    drawn = uniform_below(F.lit(room), seed, F.col(key)) if room > 0 else too_short
    plan = marked.where(~has_span).select(F.col(key), drawn.alias("start"))
    filled = read_spans(plan, background, ctx_len).select(
        key,
        F.lit(True).alias("replaced"),
        "tokens",
        F.array_repeat(F.lit(1), ctx_len).alias("z"),
    )
    return kept.unionByName(filled)


def interleaved_samples(
    plan: DataFrame, main: DataFrame, background: DataFrame, ctx_len: int, pattern: Sequence[int]
) -> DataFrame:
    """Read the samples of a plan with ``corpus`` and ``start``: its rows with ``x``, ``y``, ``z``.

    Main samples are blocks of ``main`` and carry their answer mask; background samples begin
    anywhere in ``background`` (see :func:`read_spans`) and count in full. Every planned row gives
    one sample, or the job fails.
    """
    is_main = F.col("corpus") == "main"
    answers = read_blocks(plan.where(is_main), main, ctx_len).select(
        *plan.columns, "tokens", span_mask("tokens", ctx_len, pattern).alias("z")
    )
    ones = F.array_repeat(F.lit(1), ctx_len)
    texts = read_spans(plan.where(~is_main), background, ctx_len).withColumn("z", ones)
    return inputs_and_targets(answers.unionByName(texts))
