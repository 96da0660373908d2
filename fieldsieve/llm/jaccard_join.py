"""Jaccard join of word n-gram sets by token-combination prefixes.

Tokens are hashed n-grams. A first pass counts them, over all documents, in a table of fixed size;
tokens in cells that stand out of the table are the frequent class. Any such split is right, as
long as it is the same for all documents; the counts only make it useful.

All tokens are ordered, rare ones first. A prefix of a set is indexed: rare tokens by themselves,
frequent ones in pairs inside one of ``CLASSES`` fixed classes. A class with x frequent tokens in
the prefix can hide at most one common token without a common pair, so it counts for x - 1, and the
prefix is extended until rare tokens and classes together count for one more than the number of
tokens a similar set may lack. Two similar sets then share a key. Sets too small for that are
indexed by single tokens, in a key space of their own with the sets similar to them in size.

Sets with enough rare tokens extend their prefix by ``EXTRA - 1`` more of them. When the holders of
each key have been counted, such a set gives up its ``EXTRA - 1`` most widely held keys again. So a
passage that many long documents share is no key of theirs as long as they have words of their own.
No link is lost: two extended prefixes share ``EXTRA`` tokens, and of the keys of one prefix that
come before the least held of these, none is in the other set, so at most as many as a similar
set may lack. A set that cannot extend its prefix keeps all its rare tokens, for which the same holds.

Equal sets are one class from the start. Classes that share a key are first compared with the
key's smallest class only, which joins a group of near copies through a few of its members; the
rest are compared pairwise, inside a join that refuses classes already joined, sizes too different,
and parity sketches too different (a sketch differs in at most as many bits as the sets do in
tokens), first narrow ones, then wide ones. Of keys that the same classes keep, as those of a shared
passage often are, one stands for all in both. What then remains is verified on the whole sets.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import pin
from .arrow import arrow_schema, batch_of, small, spark_schema
from .components import components
from .labelled import unused_name

CLASSES = 8
#: Rare tokens two extended prefixes of similar sets share.
EXTRA = 64
CELL_BITS = 22
RANGES = 16
SKETCH = 256
#: Bits of the second sketch, of sets too large for the first to tell apart.
WIDE_SKETCH = 4096
WIDE_FROM = 64
_CHUNK = 1 << 20
_U = np.uint64


def _mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (the usual xor-shift and multiply finish)."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U(33))
    h = h * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def _word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words in UTF-8 bytes, A–Z lower-cased; blanks are 9–13 and 32."""
    upper = (raw >= 65) & (raw <= 90)
    raw = raw + upper.astype(np.uint8) * np.uint8(32)
    inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return starts, np.zeros(0, dtype=np.uint64)
    lengths = np.diff(np.append(starts, len(raw)))
    place = np.arange(starts[0], len(raw)) - np.repeat(starts, lengths)
    powers = np.ones(int(lengths.max()), dtype=np.uint64)
    powers[1:] = _U(0x9E3779B97F4A7C15)
    powers = np.multiply.accumulate(powers)
    value = np.where(inside[starts[0] :], raw[starts[0] :].astype(np.uint64) + _U(1), _U(0))
    return starts, _mix(np.add.reduceat(value * powers[place], starts - starts[0]))


def token_sets(texts: list[str | None], words: int) -> Iterator[np.ndarray]:
    """The sorted distinct hashed n-grams of each text.

    A text with fewer words than ``words`` has one token, its whole sequence; one without words
    has none.
    """
    encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    at = 0
    while at < len(encoded):
        end, size = at, 0
        while end < len(encoded) and (end == at or size + len(encoded[end]) < _CHUNK):
            size += len(encoded[end]) + 1
            end += 1
        part = encoded[at:end]
        at = end
        starts, hashes = _word_hashes(np.frombuffer(b"\n".join(part) + b"\n", dtype=np.uint8))
        borders = np.cumsum([len(p) + 1 for p in part])
        cuts = np.concatenate([[0], np.searchsorted(starts, borders)])
        n = max(0, len(hashes) - words + 1)
        grams = np.zeros(n, dtype=np.uint64)
        for i in range(words):
            grams = _mix(grams * _U(0x100000001B3) + hashes[i : i + n])
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b - a >= words:
                yield np.unique(grams[a : b - words + 1])
            elif b > a:
                whole = np.array([b - a], dtype=np.uint64)
                for h in hashes[a:b]:
                    whole = _mix(whole * _U(0x100000001B3) + h)
                yield whole
            else:
                yield np.zeros(0, dtype=np.uint64)


# --- the frequent class ------------------------------------------------------------------------

_COUNTS = arrow_schema(part="int64", range="int32", counts="binary")
_CELLS = (1 << CELL_BITS) // RANGES


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> _U(64 - CELL_BITS)).astype(np.int64)


def _count_cells(words: int) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << CELL_BITS, dtype=np.int64)
        for batch in small(batches):
            cells = [_cells(tokens) for tokens in token_sets(batch["text"].to_pylist(), words)]
            table += np.bincount(np.concatenate(cells), minlength=len(table))
        part = TaskContext.get().partitionId()
        yield batch_of(
            [
                (part, r, zlib.compress(table[r * _CELLS : (r + 1) * _CELLS].tobytes(), 1))
                for r in range(RANGES)
                if table[r * _CELLS : (r + 1) * _CELLS].any()
            ],
            _COUNTS,
        )

    return count


def _added(counts: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(_CELLS, dtype=np.int64)
    for packed in counts["counts"]:
        total += np.frombuffer(zlib.decompress(packed), dtype=np.int64)
    return pd.DataFrame(
        {
            "part": [int(counts["part"].iloc[0]) // 32],
            "range": [int(counts["range"].iloc[0])],
            "counts": [zlib.compress(total.tobytes(), 1)],
        }
    )


def frequent_cells(docs: DataFrame, words: int) -> bytes:
    """One bit per cell of the count table, set where the cell stands out: above the mean by five
    times its square root and 32.

    The tasks' tables are added in a tree, 32 at a time, so no task holds more than that; only the
    bits, of fixed size, come to the driver.
    """
    schema = spark_schema(_COUNTS)
    level = pin(docs.select("text").mapInArrow(_count_cells(words), schema), "cells")
    while (level.agg(F.max("part")).first()[0] or 0) > 0:
        summed = level.groupBy("range", F.expr("part div 32")).applyInPandas(_added, schema)
        level = pin(summed, "cells")
    table = np.zeros(1 << CELL_BITS, dtype=np.int64)
    for row in level.collect():  # 16 rows
        table[row["range"] * _CELLS :][:_CELLS] = np.frombuffer(
            zlib.decompress(row["counts"]), dtype=np.int64
        )
    mean = table.mean()
    return np.packbits(table > mean + 5 * np.sqrt(mean) + 32).tobytes()


# --- keys ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Similarity:
    """Sets are linked when 100 * intersection >= ``percent`` * union; tokens are ``words`` words."""

    words: int = 3
    percent: int = 90

    def lacking(self, n: int) -> int:
        """How many of its ``n`` tokens a set may lack in a set linked with it."""
        return n - -(-self.percent * n // 100)

    @property
    def combining(self) -> int:
        """The size from which extended prefixes always find room in the set."""
        n = 1
        while n - CLASSES < self.lacking(n) + 1:
            n += 1
        return n

    def may_link(self, n: Column, m: Column, difference: Column) -> Column:
        """False only for sets of sizes n, m that cannot be linked if they differ in at least
        ``difference`` tokens."""
        p = self.percent
        sizes = 100 * F.least(n, m) >= p * F.greatest(n, m)
        return sizes & ((100 + p) * difference <= (100 - p) * (n + m))


def set_keys(tokens: np.ndarray, frequent: np.ndarray, s: Similarity) -> tuple[np.ndarray, int]:
    """The index keys of one set, given which cells are frequent, and how many of them, those with
    the most holders, it gives up once holders are counted."""
    n = len(tokens)
    often = frequent[_cells(tokens)]
    ordered = np.concatenate([tokens[~often], tokens[often]])
    rare = int(n - often.sum())
    need = s.lacking(n) + 1
    keys = []
    spare = 0
    if n <= 100 * (s.combining - 1) // s.percent:
        keys.append(_mix(ordered[:need] ^ _U(0x5BD1E995)))
    if n >= s.combining:
        keys.append(ordered[: min(rare, need + EXTRA - 1)])
        if rare >= need + EXTRA - 1:
            spare = EXTRA - 1
        if rare < need:
            classes: list[list[int]] = [[] for _ in range(CLASSES)]
            counted = rare
            for token in ordered[rare:].tolist():
                if counted >= need:
                    break
                own = classes[(token >> 7) % CLASSES]
                counted += bool(own)
                own.append(token)
            for own in classes:
                if len(own) > 1:
                    i, j = np.triu_indices(len(own), 1)
                    t = np.array(own, dtype=np.uint64)
                    keys.append(_mix(t[i] * _U(0x9E3779B97F4A7C15) + _mix(t[j])))
    return (np.unique(np.concatenate(keys)) if keys else tokens[:0]), spare


def sketch(tokens: np.ndarray, bits: int = SKETCH) -> np.ndarray:
    """Parity of the tokens in each of ``bits`` cells, as 64-bit words."""
    odd = np.bincount((tokens & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def set_name(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    if not len(tokens):
        return 0, 0
    a = np.bitwise_xor.reduce(_mix(tokens + _U(0x1234567)))
    b = np.add.reduce(_mix(tokens ^ _U(0xA5A5A5A5A5A5A5A5)))
    return int(a.view(np.int64)), int(b.view(np.int64))


_SETS = arrow_schema(
    row="int64", doc_id="int64", text_key="string", n="int64", name0="int64", name1="int64",
    s0="int64", s1="int64", s2="int64", s3="int64", keys=pa.list_(pa.int64()),
    spare="int32", wide=pa.list_(pa.int64()),
)
_SKETCH = ["s0", "s1", "s2", "s3"]


def _keyed_sets(cells: bytes, s: Similarity) -> Callable:
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = np.unpackbits(np.frombuffer(cells, dtype=np.uint8)).astype(bool)
        row = TaskContext.get().partitionId() << 33
        for batch in small(batches):
            rows = []
            sets = token_sets(batch["text"].to_pylist(), s.words)
            ids, text_keys = batch["doc_id"].to_pylist(), batch["text_key"].to_pylist()
            for doc_id, text_key, tokens in zip(ids, text_keys, sets, strict=True):
                keys, spare = set_keys(tokens, frequent, s)
                wide = sketch(tokens, WIDE_SKETCH) if len(tokens) >= WIDE_FROM else None
                rows.append(
                    (row, doc_id, text_key, len(tokens), *set_name(tokens), *sketch(tokens).tolist(),
                     keys.view(np.int64), spare, wide)
                )
                row += 1
            yield batch_of(rows, _SETS)

    return keyed


_TOKENS = arrow_schema(name0="int64", name1="int64", tokens=pa.list_(pa.int64()))


def _whole_sets(words: int) -> Callable:
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            sets = token_sets(batch["text"].to_pylist(), words)
            yield batch_of([(*set_name(t), t.view(np.int64)) for t in sets], _TOKENS)

    return whole


# --- join ------------------------------------------------------------------------------------


def _different(a: str, b: str) -> Column:
    return sum((F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in _SKETCH), F.lit(0))


def _ends(pairs: DataFrame) -> DataFrame:
    """The classes in pairs (a, b), written: Spark then knows how few they are, and a short list
    goes to the rows it selects instead of moving them."""
    return pin(pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct(), "ends")


def _may_link_wide(s: Similarity) -> Column:
    """False only where the wide sketches of x and y rule a link out; small sets have none."""
    differing = F.aggregate(
        F.zip_with("x.wide", "y.wide", lambda p, q: F.bit_count(p.bitwiseXOR(q))),
        F.lit(0),
        lambda total, bits: total + bits,
    )
    return s.may_link(F.col("x.n"), F.col("y.n"), F.coalesce(differing, F.lit(0)))


def _close(pairs: DataFrame, rows: DataFrame, s: Similarity) -> DataFrame:
    """The pairs (a, b) of classes whose wide sketches do not rule a link out."""
    pairs = pin(pairs, "pairs")
    wide = rows.select(F.col("row").alias("class"), "n", "wide").join(_ends(pairs), "class")
    wide = pin(wide, "wide")
    left = pairs.join(wide.alias("x"), F.col("a") == F.col("x.class"))
    both = left.join(wide.alias("y"), F.col("b") == F.col("y.class"))
    return both.where(_may_link_wide(s)).select("a", "b")


def _verified(close: DataFrame, docs: DataFrame, classes: DataFrame, s: Similarity) -> DataFrame:
    """The pairs (a, b) of classes whose whole sets are similar enough.

    The texts are read again, but only those of one document of each class in a pair go on.
    """
    close = pin(close, "close-pairs")
    wanted = pin(
        classes.join(_ends(close), "class").select("class", "least", "name0", "name1"), "wanted"
    )
    ids = wanted.select("least")
    again = docs.join(ids, docs["doc_id"].eqNullSafe(ids["least"]), "left_semi")
    read = again.select("text").mapInArrow(_whole_sets(s.words), spark_schema(_TOKENS))
    sets = pin(
        read.join(wanted, ["name0", "name1"]).dropDuplicates(["class"]).select("class", "tokens"),
        "whole-sets",
    )
    left = sets.select(F.col("class").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("class").alias("b"), F.col("tokens").alias("tb"))
    common = F.size(F.array_intersect("ta", "tb"))
    union = F.size("ta") + F.size("tb") - common
    similar = 100 * common >= s.percent * union
    return pin(close.join(left, "a").join(right, "b").where(similar).select("a", "b"), "links")


def _place() -> Column:
    """What orders rows: id, those without one last, then the text's checksum."""
    return F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_key")


def _indexed(docs: DataFrame, s: Similarity) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The documents' ids and texts, their sets, the classes of equal sets, and the keys that
    several classes keep, with each of the classes, their number (``held``) and the smallest of
    them (``hub``).

    Of keys with the same classes, told by number, smallest and two 64-bit sums, only the smallest is
    given: the others lead to the same pairs."""
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.md5("text").alias("text_key")
    )
    cells = frequent_cells(narrow, s.words)
    rows = pin(narrow.mapInArrow(_keyed_sets(cells, s), spark_schema(_SETS)), "sets")
    name = ["name0", "name1", "n"]
    classes = pin(
        rows.where(F.col("n") > 0)
        .groupBy(*name)
        .agg(
            F.min("row").alias("class"),
            F.min(_place()).alias("first"),
            *[F.first(c).alias(c) for c in _SKETCH],
        )
        .withColumn("least", F.col("first.doc_id")),
        "classes",
    )
    first_rows = rows.withColumnRenamed("row", "class").join(classes.select("class"), "class", "left_semi")
    keyed = first_rows.select(F.explode("keys").alias("key"), "class", "spare")
    counted = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("holders"))
    most_held = Window.partitionBy("class").orderBy(F.desc("holders"), F.desc("key"))
    kept = pin(
        keyed.join(counted.where("holders > 1"), "key")
        .withColumn("place", F.row_number().over(most_held))
        .where("place > spare")
        .select("key", "class"),
        "kept-keys",
    )
    sums = [F.bit_xor(F.xxhash64("class", F.lit(i))).alias(f"sum{i}") for i in range(2)]
    held = kept.groupBy("key").agg(F.count(F.lit(1)).alias("held"), F.min("class").alias("hub"), *sums)
    same = held.where("held > 1").groupBy("held", "hub", "sum0", "sum1").agg(F.min("key").alias("key"))
    return narrow, rows, classes, pin(kept.join(same.select("key", "held", "hub"), "key"), "shared")


#: Classes of one key that a task holds against as many others.
KEY_PART = 512
FIRST_KEYS = 16


def _key_pairs(
    shared: DataFrame, described: DataFrame, rows: DataFrame, allowed: Column, s: Similarity
) -> DataFrame:
    """The pairs (a, b) of classes that share a key, where ``allowed`` holds for their columns of
    ``described``, as x and y, and their wide sketches do not rule a link out. The pairs of a key with
    many classes are dealt over cells of ``KEY_PART`` by ``KEY_PART`` classes. Two classes that share
    one of their ``FIRST_KEYS`` smallest keys meet under the smallest such key only.

    The wide sketches travel with the keys, so a group of near copies, each of which shares many keys
    with the others, leaves the join only the pairs that may be links."""
    first = F.slice(F.sort_array(F.collect_list("key")), 1, FIRST_KEYS).alias("first")
    firsts = pin(shared.groupBy("class").agg(first), "first-keys")
    wide = rows.select(F.col("row").alias("class"), "wide").join(firsts, "class")
    described = pin(described.join(wide, "class"), "described")
    common = F.array_intersect("x.first", "y.first")
    once = (F.size(common) == 0) | (F.col("x.key") == F.array_min(common))
    parts = F.ceil(F.col("held") / KEY_PART).cast("int")
    dealt = (
        shared.withColumn("part", F.pmod(F.xxhash64("class"), parts).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .select(
            "key", "class", "part", F.least("part", "other").alias("low"),
            F.greatest("part", "other").alias("high"),
        )
        .join(described, "class")
    )
    x, y = dealt.alias("x"), dealt.alias("y")
    return (
        x.join(
            y,
            (F.col("x.key") == F.col("y.key"))
            & (F.col("x.low") == F.col("y.low"))
            & (F.col("x.high") == F.col("y.high"))
            & (F.col("x.class") < F.col("y.class"))
            & ((F.col("x.low") == F.col("x.high")) | (F.col("x.part") != F.col("y.part")))
            & allowed
            & once
            & _may_link_wide(s),
        )
        .select(F.col("x.class").alias("a"), F.col("y.class").alias("b"))
        .distinct()
    )


def similar_components(docs: DataFrame, s: Similarity = Similarity()) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``found_links`` and ``component_id`` of every row.

    Words are the runs of characters other than blank, tab, line feed, vertical tab, form feed and
    return, with A–Z lower-cased. ``found_links`` counts the verified links of the row's class of equal
    sets to others; links inside a component that is already joined are not looked for. ``component_id`` is the smallest doc_id reachable by links; a text that
    is null or has no words has no tokens and is linked with nothing, not even its copies. Null ids
    stay null and never name a component that has other ids; rows that repeat an id are each
    judged by their own text. Other columns are not read; no rows give no rows.
    """
    return _joined(docs, s).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("found_links"),
        F.coalesce("first.doc_id", "doc_id").alias("component_id"),
    )


def without_copies(docs: DataFrame, s: Similarity = Similarity()) -> DataFrame:
    """The rows of ``docs`` of which one stays of each component, with all their columns.

    The row with the smallest id stays, rows without an id coming last, then the smallest checksum
    of the text; of rows equal in id and text one stays. Rows are told apart by id and text, so a
    copy takes no other text of its id with it. Texts that are null or have no words are nobody's copies.
    """
    joined = _joined(docs, s).where(F.col("first").isNotNull() & ~F.col("first").eqNullSafe(_place()))
    gone = joined.select("doc_id", "text_key").distinct()
    key = unused_name(docs, "text_key")
    keyed = docs.withColumn(key, F.md5("text"))
    copy = keyed["doc_id"].eqNullSafe(gone["doc_id"]) & (keyed[key] == gone["text_key"])
    left = keyed.join(gone, copy, "left_anti")
    return left.dropDuplicates(["doc_id", key]).select(*docs.columns)


def _joined(docs: DataFrame, s: Similarity) -> DataFrame:
    """Every row's id, text checksum, number of tokens, links and ``first``, the place of the first
    row of its component (null for a row without tokens)."""
    narrow, rows, classes, shared = _indexed(docs, s)
    name = ["name0", "name1", "n"]

    described = classes.select("class", "n", *_SKETCH)
    a, b = described.alias("x"), described.alias("y")
    may = s.may_link(F.col("x.n"), F.col("y.n"), _different("x", "y"))
    stars = shared.where("class != hub").select(F.col("hub").alias("a"), F.col("class").alias("b"))
    starred = (
        stars.distinct()
        .join(a, F.col("a") == F.col("x.class"))
        .join(b, (F.col("b") == F.col("y.class")) & may)
        .select("a", "b")
    )
    first_links = _verified(_close(starred, rows, s), narrow, classes, s)
    joined = components(first_links).select(F.col("node").alias("class"), "label")
    known = described.join(joined, "class", "left").withColumn("label", F.coalesce("label", "class"))
    apart = F.col("x.label") != F.col("y.label")
    pairs = _key_pairs(shared, known, rows, apart & may, s)
    links = first_links.unionByName(_verified(pairs, narrow, classes, s))
    found = components(links).select(F.col("node").alias("class"), F.col("label").alias("component"))
    ends = links.select(F.explode(F.array("a", "b")).alias("class"))
    n_links = ends.groupBy("class").agg(F.count(F.lit(1)).alias("n_links"))

    # Of a component every class's smallest id, of which the smallest is the component's.
    placed = classes.join(found, "class", "left").withColumn("component", F.coalesce("component", "class"))
    ids = placed.groupBy("component").agg(F.min("first").alias("first"))
    named = (
        placed.drop("first").join(ids, "component")
        .join(n_links, "class", "left")
        .select(*name, "n_links", "first")
    )
    return rows.select("doc_id", "text_key", *name).join(named, name, "left")


def similar_links(docs: DataFrame, s: Similarity = Similarity()) -> DataFrame:
    """The whole join: ``doc_id``, ``n_shingles`` and, per row, its links.

    ``linked_sets`` counts the classes of equal sets similar to the row's own and not equal to it,
    ``linked_rows`` the rows in them, ``copies`` the further rows of its own class. Every pair of
    classes that shares a key is held against sketches and, if these allow a link, verified, also
    inside a component; copies are counted by the sizes of classes, never paired. The pairs of a key
    with many classes are dealt over cells of ``KEY_PART`` by ``KEY_PART`` classes. The output is one
    row per document, but the work grows with the links, the square of a group of near copies. Nulls,
    empty texts and repeated ids are treated as by ``similar_components``.
    """
    narrow, rows, classes, shared = _indexed(docs, s)
    name = ["name0", "name1", "n"]
    described = classes.select("class", "n", *_SKETCH)
    may = s.may_link(F.col("x.n"), F.col("y.n"), _different("x", "y"))
    pairs = _key_pairs(shared, described, rows, may, s)
    links = _verified(pairs, narrow, classes, s)
    sizes = rows.where(F.col("n") > 0).groupBy(*name).agg(F.count(F.lit(1)).alias("size"))
    sized = classes.select(*name, "class").join(sizes, name)
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = (
        both.join(sized.select(F.col("class").alias("b"), "size"), "b")
        .groupBy(F.col("a").alias("class"))
        .agg(F.count(F.lit(1)).alias("linked_sets"), F.sum("size").alias("linked_rows"))
    )
    counted = sized.join(linked, "class", "left").select(
        *name, "linked_sets", "linked_rows", (F.col("size") - 1).alias("copies")
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.select("doc_id", *name).join(counted, name, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), zero("linked_sets"), zero("linked_rows"), zero("copies")
    )
