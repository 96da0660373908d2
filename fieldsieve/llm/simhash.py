"""SimHash fingerprints of whole texts, and the search for fingerprints in a Hamming radius.

A term is a word with the word after it; every occurrence votes with the term's length, so long
terms count for more than the short words of any language. A fingerprint has 128 bits: a bit is
set where the votes for it outweigh those against. All of it is DataFrame code: terms are exploded
and their votes summed by Spark's aggregation, 32 bits of room for each bit's sum, two sums to a
long.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 128
_LANES = 0x0000000100000001
_LOW = 0xFFFFFFFF


def _votes() -> list[Column]:
    """Sums of ``weight`` by set bit: column v{w}_{j} holds bit j low and bit j + 32 high."""
    weighted = [
        (f"v{w}_{j}", F.shiftright(f"h{w}", j).bitwiseAND(F.lit(_LANES)) * F.col("weight"))
        for w in range(2)
        for j in range(32)
    ]
    return [F.sum(votes).alias(name) for name, votes in weighted]


def _word(w: int) -> Column:
    """64 bits of the fingerprint from their votes."""

    def bit(j: int) -> Column:
        both = F.col(f"v{w}_{j % 32}")
        votes = F.shiftrightunsigned(both, 32) if j >= 32 else both.bitwiseAND(F.lit(_LOW))
        value = 1 << j if j < 63 else -(1 << 63)
        return F.when(2 * votes > F.col("total"), F.lit(value).cast("long")).otherwise(F.lit(0))

    return reduce(Column.bitwiseOR, [bit(j) for j in range(64)])


def fingerprints(rows: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """``keys`` and the two halves ``f0``, ``f1`` of the fingerprint of ``text``.

    ``keys`` must name each row; rows of a key already lie together if the table is partitioned by
    some of the keys, and then nothing is shuffled. A null, empty or blank text has no terms and
    the fingerprint 0; equal texts have equal fingerprints.
    """
    words = F.filter(F.split(F.translate(text, "\t\n\r\f\x0b", " " * 5), " "), lambda w: w != "")
    terms = rows.select(*keys, words.alias("word")).select(
        *keys,
        F.explode_outer(
            F.arrays_zip(
                F.col("word").alias("a"), F.slice("word", F.lit(2), F.size("word")).alias("b")
            )
        ).alias("term"),
    )
    first = F.xxhash64("term.a", "term.b")
    length = F.coalesce(F.length("term.a"), F.lit(0)) + F.coalesce(F.length("term.b"), F.lit(0))
    return (
        terms.select(*keys, first.alias("h0"), length.cast("long").alias("weight"))
        .withColumn("h1", F.xxhash64("h0"))
        .groupBy(*keys)
        .agg(*_votes(), F.sum("weight").alias("total"))
        .select(*keys, _word(0).alias("f0"), _word(1).alias("f1"))
    )


def as_text(f0: Column | str, f1: Column | str) -> Column:
    """The fingerprint as 32 hexadecimal digits."""
    return F.lower(F.concat(*[F.lpad(F.hex(f), 16, "0") for f in (f0, f1)]))


def hamming(a: tuple[str, str], b: tuple[str, str]) -> Column:
    return sum(
        (F.bit_count(F.col(x).bitwiseXOR(F.col(y))) for x, y in zip(a, b, strict=True)), F.lit(0)
    )


def likeness(a: tuple[str, str], b: tuple[str, str]) -> Column:
    """The cosine that the share of equal bits stands for, not below 0: 1 for equal fingerprints,
    about 0 for unrelated texts."""
    return F.greatest(F.lit(0.0), F.cos(hamming(a, b) * F.lit(math.pi / BITS)))


# --- the text after each text ---------------------------------------------------------------


def _borders(docs: DataFrame, n: int) -> list[int]:
    """At most ``n`` - 1 ids that cut the ids into about equal ranges; only ids are read."""
    shares = [i / n for i in range(1, n)]
    found = docs.agg(F.percentile_approx("doc_id", shares or [0.5], 20 * n)).first()[0]
    return sorted(set(found or []))


def _range_of(value: Column, borders: Sequence[int]) -> Column:
    """How many of the sorted borders are at most ``value``, looked up in two steps."""
    step = max(1, math.isqrt(len(borders)))
    parts = [list(borders[i : i + step]) for i in range(0, len(borders), step)]
    if not parts:
        return F.lit(0)
    firsts = F.array(*[F.lit(p[0]).cast("long") for p in parts])
    lists = F.array(*[F.array(*[F.lit(x).cast("long") for x in p]) for p in parts])
    part = F.size(F.filter(firsts, lambda x: x <= value))
    inside = F.size(F.filter(F.get(lists, part - 1), lambda x: x <= value))
    return F.coalesce(F.when(part > 0, (part - 1) * step + inside), F.lit(0))


def with_next(docs: DataFrame, n_ranges: int | None = None) -> DataFrame:
    """Rows (range, place, own, doc_id, text, next): each text and the one after it by ``doc_id``.

    The last row is followed by the first. The texts move once, to ranges of ids; the first row
    of each range is also given to the range before it (``own`` false), so no range has to look
    into another. Null ids come first; rows of one id are ordered by a hash of their text. A null
    text is empty. A table of one row is followed by itself.
    """
    spark = docs.sparkSession
    n = n_ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    edges = narrow.agg(
        F.min("doc_id").alias("first"), F.count_if(F.col("doc_id").isNull()).alias("nulls")
    ).first()
    first = None if edges["nulls"] else edges["first"]
    borders = _borders(narrow.select("doc_id"), n)
    last = len(borders)
    home = _range_of(F.col("doc_id"), borders)
    places = narrow.withColumn("home", home)
    if borders:
        border_of = F.array(*[F.lit(b).cast("long") for b in borders])
        opens = (F.col("home") > 0) & (F.get(border_of, F.col("home") - 1) == F.col("doc_id"))
    else:
        opens = F.lit(False)

    def copy(where: Column, to: Column, wrap: int, own: bool) -> Column:
        made = F.struct(to.alias("range"), F.lit(wrap).alias("wrap"), F.lit(own).alias("own"))
        return F.when(where, F.array(made)).otherwise(F.array().cast(_COPIES))

    copies = F.concat(
        copy(F.lit(True), F.col("home"), 0, True),
        copy(opens, F.col("home") - 1, 0, False),
        copy(F.col("doc_id").eqNullSafe(F.lit(first)), F.lit(last), 1, False),
    )
    order = Window.partitionBy("range").orderBy(
        "wrap", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "own"
    )
    return (
        places.select("doc_id", "text", F.inline(copies))
        .withColumns({"place": F.row_number().over(order), "next": F.lead("text").over(order)})
        .select("range", "place", "own", "doc_id", "text", "next")
    )


_COPIES = "array<struct<range:int,wrap:int,own:boolean>>"


def edited_fingerprints(docs: DataFrame, n_ranges: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many of
    the next document. Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. Nulls, ties and single rows are as in :func:`with_next`.
    """
    pairs = with_next(docs, n_ranges)
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n - half),
        F.substring(F.coalesce("next", F.lit("")), F.lit(1), half),
    )
    rows = pairs.select(
        "range", "place", "own", "doc_id",
        F.length("text").cast("long").alias("n_chars"), "text", edited.alias("edited"),
    ).select(
        "range", "place", "own", "doc_id", "n_chars",
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("kind"), F.col("text").alias("body")),
                F.struct(F.lit(1).alias("kind"), F.col("edited").alias("body")),
            )
        ),
    )
    keys = ["range", "place", "own", "doc_id", "n_chars", "edited_sha256"]
    voted = fingerprints(rows, [*keys, "kind"], "body")
    of = lambda kind, f: F.max(F.when(F.col("kind") == kind, F.col(f)))
    both = voted.groupBy(*keys).agg(
        of(0, "f0").alias("f0"), of(0, "f1").alias("f1"),
        of(1, "f0").alias("e0"), of(1, "f1").alias("e1"),
    )
    order = Window.partitionBy("range").orderBy("place")
    following = both.withColumns({f"n{i}": F.lead(f"f{i}").over(order) for i in range(2)})
    own = ("f0", "f1")
    return following.where("own").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(*own).alias("fingerprint"),
        as_text("e0", "e1").alias("edited_fingerprint"),
        likeness(own, ("e0", "e1")).alias("near_edited"),
        likeness(own, ("n0", "n1")).alias("near_next"),
    )


# --- search -----------------------------------------------------------------------------------


def within_radius(
    queries: DataFrame, table: DataFrame, radius: int, blocks: int | None = None
) -> DataFrame:
    """Pairs of different (f0, f1) in ``queries`` and ``table`` that differ in 1 to ``radius`` bits.

    The bits are cut into ``blocks`` (radius + 1 or more); fingerprints in the radius agree in all
    but ``radius`` of them, so each choice of the other blocks is the key of one permuted table.
    More blocks give longer keys and more tables. A pair is kept only in the first table that
    finds it. Both sides are made distinct first, so copies cost nothing. Rows with null halves
    take no part. Returns q0, q1, f0, f1, distance.
    """
    blocks = blocks or radius + 1
    if blocks <= radius or blocks > BITS:
        raise ValueError("blocks must lie above radius and be at most 128")
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    bit_string = F.concat(*[F.lpad(F.conv(F.hex(f), 16, 2), 64, "0") for f in ("f0", "f1")])
    choices = list(combinations(range(blocks), blocks - radius))

    def keyed(df: DataFrame) -> DataFrame:
        rows = df.select("f0", "f1").dropna().distinct().withColumn("bits", bit_string)
        part = [F.substring("bits", a + 1, b - a) for a, b in zip(cuts, cuts[1:])]
        keys = [
            F.struct(F.lit(i).alias("choice"), F.concat(*[part[b] for b in c]).alias("value"))
            for i, c in enumerate(choices)
        ]
        return rows.select("f0", "f1", "bits", F.inline(F.array(*keys)))

    asked = keyed(queries).select(
        F.col("f0").alias("q0"), F.col("f1").alias("q1"), F.col("bits").alias("q_bits"),
        "choice", "value",
    )
    found = asked.join(keyed(table), ["choice", "value"])

    def agrees(b: int) -> Column:
        a, z = cuts[b], cuts[b + 1]
        return F.substring("bits", a + 1, z - a) == F.substring("q_bits", a + 1, z - a)

    agreed = F.array(*[agrees(b) for b in range(blocks)])
    first = F.lit(len(choices))
    for i, c in reversed(list(enumerate(choices))):
        first = F.when(F.forall(F.array(*[agreed[b] for b in c]), lambda x: x), F.lit(i)).otherwise(first)
    distance = hamming(("q0", "q1"), ("f0", "f1"))
    return (
        found.where(first == F.col("choice"))
        .withColumn("distance", distance)
        .where(F.col("distance").between(1, radius))
        .select("q0", "q1", "f0", "f1", "distance")
    )
