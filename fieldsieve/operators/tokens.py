"""Token ids: vocabularies, encoding, decoding, offsets and spans."""

from __future__ import annotations

import ast
from collections.abc import Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.tables import CODE_POINTS, bounded_rows, literal_array
from ..functions.text import characters
from ..session import pin
from .numbering import running_offsets
from .trie import Trie

END_OF_DOCUMENT = 0
MAX_VOCABULARY = 65536
TOKENS = T.ArrayType(T.IntegerType())


# --- vocabularies -------------------------------------------------------------------------


def char_vocab(df: DataFrame, text: str = "text") -> DataFrame:
    """(id, ch): all distinct characters in code point order, numbered from 0.

    Repeats are removed inside each text first, so one text contributes at most its distinct
    characters to the shuffle. The final numbering sees at most one row per code point.
    """
    found = df.select(F.explode(F.array_distinct(characters(F.col(text)))).alias("ch")).distinct()
    return found.select(
        (F.row_number().over(Window.orderBy("ch")) - 1).cast("int").alias("id"), "ch"
    )


def vocab_list(vocab: DataFrame) -> list[str]:
    """The characters of a :func:`char_vocab` in id order; bounded by the number of code points."""
    rows = bounded_rows(vocab, CODE_POINTS, "a character vocabulary")
    return [r["ch"] for r in sorted(rows, key=lambda r: r["id"])]


def byte_vocabulary() -> dict[bytes, int]:
    """One id per byte, starting at 1; 0 ends a document."""
    return {bytes([b]): b + 1 for b in range(256)}


def parse_vocabulary_line(line: str) -> tuple[bytes, int]:
    """(token, id) from a line ``id literal length``; a wrong length is an error."""
    number, rest = line.strip().split(" ", 1)
    literal, length = rest.rsplit(" ", 1)
    token = ast.literal_eval(literal)
    token = token.encode("utf-8") if isinstance(token, str) else token
    if len(token) != int(length):
        raise ValueError(f"vocabulary entry {number}: {len(token)} bytes, {length} declared")
    return token, int(number)


def read_vocabulary(lines: DataFrame) -> dict[bytes, int]:
    """A vocabulary from a text table; ids are 16-bit, which bounds its size."""
    rows = bounded_rows(lines, MAX_VOCABULARY, "a vocabulary")
    return dict(parse_vocabulary_line(r["value"]) for r in rows if r["value"].strip())


# --- encoding -----------------------------------------------------------------------------


#: Bytes of text, or ids, that a worker holds at once beside its Arrow batch: they bound its
#: memory, not a text's length.
WALKED = 1 << 18


def _runs(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Borders of runs of rows that hold at most ``WALKED`` together, or are one row."""
    total, at = np.cumsum(sizes), 0
    while at < len(sizes):
        before = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, before + WALKED, "right")))
        yield at, end
        at = end


@lru_cache(maxsize=4)
def _trie(entries: tuple[tuple[bytes, int], ...]) -> Trie:
    return Trie(dict(entries))


def tokenizer(vocabulary: Mapping[bytes, int], end: int | None = END_OF_DOCUMENT):
    """A vectorized function text → ids: greedy longest match over the UTF-8 bytes.

    Runs of texts of an Arrow batch are walked together through a trie that a worker builds once,
    and given out run by run. ``end`` is appended to every text; a null text has no ids. Bytes that
    no token covers fail the task.
    """
    entries = tuple(sorted(vocabulary.items()))
    tail = [] if end is None else [end]

    def walk(texts: pa.Array) -> pa.Array:
        data = [t.encode() if t is not None else None for t in texts.to_pylist()]
        sizes, ids = np.zeros(len(data), dtype=np.int64), np.zeros(0, dtype=np.int32)
        known = [i for i, t in enumerate(data) if t is not None]
        if known:
            ids, sizes[known] = _trie(entries).encode([data[i] for i in known], tail)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        if offsets[-1] >= 1 << 31:
            raise ValueError("a text holds more tokens than a list can")
        missing = np.array([t is None for t in data], dtype=bool)
        borders = pa.array(offsets.astype(np.int32), mask=np.append(missing, False))
        return pa.ListArray.from_arrays(borders, pa.array(ids, pa.int32()))

    @F.arrow_udf(TOKENS)
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            for a, b in _runs(sizes.astype(np.int64)):
                yield walk(texts[a:b])

    return encode


def decoder(vocabulary: Mapping[bytes, int]):
    """A vectorized function ids → text without the end mark; bad UTF-8 becomes U+FFFD.

    An id that the vocabulary lacks fails the task."""
    texts = {i: t for t, i in vocabulary.items()} | {END_OF_DOCUMENT: b""}
    known = np.array(sorted(texts), dtype=np.int64)

    def joined(data: bytes) -> str:
        try:
            return data.decode("utf-8")
        except UnicodeDecodeError:
            return "\ufffd"

    def texts_of(lists: pa.Array, parts: pa.Array) -> pa.Array:
        borders = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        ids = lists.values[borders[0] : borders[-1]]
        if ids.null_count:
            raise ValueError("an id is null")
        numbers = ids.to_numpy(zero_copy_only=False)
        places = np.minimum(np.searchsorted(known, numbers), len(known) - 1)
        if (known[places] != numbers).any():
            raise ValueError("an id is not in the vocabulary")
        _, ends, blob = parts.take(pa.array(places)).buffers()
        ends = np.frombuffer(ends, np.int64)[borders - borders[0]].tolist()
        data = blob.to_pybytes() if blob else b""
        missing = lists.is_null().to_pylist()
        rows = zip(missing, ends, ends[1:], strict=False)
        return pa.array([None if m else joined(data[a:b]) for m, a, b in rows], pa.string())

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        parts = pa.array([texts[i] for i in known.tolist()], pa.large_binary())
        for lists in batches:
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            for a, b in _runs(sizes.astype(np.int64)):
                yield texts_of(lists[a:b], parts)

    return decode


def _byte_ids(texts: pa.Array, dtype: type) -> pa.Array:
    """Ids under the byte vocabulary, each text ended by 0; one numpy pass per Arrow batch."""
    blob = pc.fill_null(texts, "").cast(pa.large_binary())
    _, places, content = blob.buffers()
    borders = np.frombuffer(places, np.int64)[blob.offset : blob.offset + len(blob) + 1]
    data = np.frombuffer(content or b"", np.uint8)[borders[0] : borders[-1]]
    ends = borders[1:] - borders[0] + np.arange(1, len(blob) + 1)
    if len(data) + len(blob) >= 1 << 31:
        raise ValueError("a batch holds more tokens than a list can; lower its number of records")
    ids = np.zeros(len(data) + len(blob), dtype=dtype)
    inside = np.ones(len(ids), dtype=bool)
    inside[ends - 1] = False
    ids[inside] = data.astype(dtype) + dtype(1)
    starts = np.concatenate([[0], ends]).astype(np.int32)
    out = pa.ListArray.from_arrays(pa.array(starts), pa.array(ids))
    return pc.if_else(texts.is_null(), pa.scalar(None, out.type), out) if texts.null_count else out


@F.arrow_udf(TOKENS)
def byte_tokens(texts: pa.Array) -> pa.Array:
    """Ids under the byte vocabulary, each text ended by 0."""
    return _byte_ids(texts, np.int32)


@F.arrow_udf(T.ArrayType(T.ShortType()))
def narrow_byte_tokens(texts: pa.Array) -> pa.Array:
    """:func:`byte_tokens` in 16 bits each, for streams whose tokens are shuffled."""
    return _byte_ids(texts, np.int16)


def byte_token_count(text: Column) -> Column:
    """Number of byte tokens of ``text`` with its end mark, without making them."""
    return (F.octet_length(text) + 1).cast("bigint")


def char_tokens(text: Column, vocab: list[str]) -> Column:
    """Character ids by one table lookup per character; one not in ``vocab`` fails the job."""
    table = [None] * (max(map(ord, vocab)) + 1)
    for number, ch in enumerate(vocab):
        table[ord(ch)] = number
    lookup = literal_array(table, "int")
    unknown = F.raise_error(F.lit("a character is not in the vocabulary")).cast("int")
    return F.transform(characters(text), lambda c: F.coalesce(F.get(lookup, F.ascii(c)), unknown))


def char_decode(tokens: Column, vocab: list[str]) -> Column:
    """Text of character ids, again by one table lookup per id."""
    lookup = literal_array(vocab, "string")
    return F.array_join(F.transform(tokens, lambda t: F.get(lookup, t)), "")


def round_trip_report(df: DataFrame, text: str, decoded: str) -> DataFrame:
    """Texts and how many of them do not come back equal after encoding and decoding."""
    return df.agg(
        F.count(F.lit(1)).alias("n_texts"),
        F.count_if(~F.col(text).eqNullSafe(F.col(decoded))).alias("n_mismatches"),
    )


# --- streams ------------------------------------------------------------------------------


def stream_offsets(
    sizes: DataFrame, order_by: list[str], size: str = "n_tokens", token_bytes: int = 2
) -> DataFrame:
    """Add ``item``, ``start`` (tokens before the document) and ``pointer`` (bytes before it).

    The sizes are written out before they are ordered: ordering reads its input twice, and the
    texts behind the sizes should be read once.
    """
    placed = running_offsets(pin(sizes, "sizes"), order_by, size, "start", "item")
    return placed.withColumn("pointer", F.col("start") * token_bytes)


def stream_totals(stream: DataFrame, tokens: str = "tokens", token_bytes: int = 2) -> DataFrame:
    """Totals of a token stream and whether every document ends with the end mark."""
    size = F.size(tokens)
    return stream.agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum(size).cast("bigint").alias("n_tokens"),
        (F.sum(size) * token_bytes).cast("bigint").alias("n_bytes"),
        F.min(size).cast("bigint").alias("min_size"),
        F.max(size).cast("bigint").alias("max_size"),
        F.bool_and(F.element_at(tokens, -1) == END_OF_DOCUMENT).alias("all_ended"),
    )


def stream_preview(stream: DataFrame, item: str = "item", text: str = "text", limit: int = 100) -> DataFrame:
    """The head and tail of the first and last document of a stream, ``limit`` characters each."""
    ends = stream.agg(F.min_by(text, item).alias("first"), F.max_by(text, item).alias("last"))
    pair = F.array(
        F.struct(F.lit("first").alias("document"), F.col("first").alias("text")),
        F.struct(F.lit("last").alias("document"), F.col("last").alias("text")),
    )
    return ends.select(F.inline(pair)).select(
        "document",
        F.left(F.col("text"), F.lit(limit)).alias("head"),
        F.right(F.col("text"), F.lit(limit)).alias("tail"),
    )


def item_span(tokens: Column, offset: Column, length: Column | None = None) -> Column:
    """``length`` tokens of an item from a 0-based ``offset``; to its end when no length is given."""
    wanted = F.size(tokens) - offset if length is None else length
    return F.slice(tokens, (offset + 1).cast("int"), wanted.cast("int"))


def item_range(stream: DataFrame, first: int, last: int, item: str = "item") -> DataFrame:
    """The items ``first`` to ``last`` of a stream, both included."""
    return stream.where(F.col(item).between(first, last))
