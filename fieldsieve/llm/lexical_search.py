"""Ranked lexical search by Block-Max MaxScore over shards of an inverted index.

A shard holds the postings of a bounded stretch of documents; it is made where its documents are
read, without a shuffle. A term's postings are cut into blocks of ``BLOCK``, packed as gaps and
counts of few bytes. A block keeps, unpacked, its first and last document and its outline: the
(occurrences, document length) pairs that no other of its postings beats in both. The outline gives
the block's exact best score whatever the corpus statistics, so the index is independent of them.

For each item and shard, the terms are ordered by their best possible score. Terms whose bounds
together cannot reach the k-th score so far are non-essential: documents are found through the other
terms only, stretch by stretch. A found document is then held against the block maxima of the
non-essential terms, highest first; those that cannot reach the k-th score are rejected before a
block is unpacked for them. Each shard gives its k best; these heaps are merged by rank.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import pin
from .arrow import arrow_schema, batch_of, small, spark_schema

BLOCK = 128
#: Documents and postings at which a shard is closed, documents of a stretch, and items that are
#: searched together.
SHARD_DOCS = 1 << 13
SHARD_POSTINGS = 1 << 22
STRETCH = 1 << 11
ITEMS = 64

#: Weight of document length, in hundredths, and the saturation, in eighths of a hundredth.
LENGTH_SHARE = 75
SCALE = 1_000_000_000

_UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text: str | None) -> list[str]:
    """The terms of a whole text: runs of ASCII letters, digits and all further characters."""
    return _TERM.findall((text or "").translate(_UPPER))


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


# --- index -------------------------------------------------------------------------------------

_INDEX = arrow_schema(
    shard="int64", term="string", df="int64", n_terms="int64", first="binary", last="binary", at="binary",
    outline_at="binary", outline_tf="binary", outline_n="binary", postings="binary",
)
_WIDTHS = (np.dtype("u1"), np.dtype("<u2"), np.dtype("<u4"), np.dtype("<u8"))


def _narrow(numbers: np.ndarray) -> bytes:
    """Non-negative numbers in the fewest bytes that hold the largest, after the choice made."""
    largest = int(numbers.max(initial=0))
    kind = next(i for i, t in enumerate(_WIDTHS) if largest < 1 << 8 * t.itemsize)
    return bytes([kind]) + numbers.astype(_WIDTHS[kind]).tobytes()


def _wide(raw: bytes, at: int = 0, count: int = -1) -> np.ndarray:
    return np.frombuffer(raw, dtype=_WIDTHS[raw[at]], offset=at + 1, count=count).astype(np.int64)


def _outline(tf: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Places of the postings that none beats with more occurrences in a document no longer."""
    order = np.lexsort((n, -tf))
    shortest = np.minimum.accumulate(n[order])
    best = np.ones(len(order), dtype=bool)
    best[1:] = n[order][1:] < shortest[:-1]
    return order[best]


class _Shard:
    """Documents gathered for one shard."""

    def __init__(self):
        self.numbers: dict[str, int] = {}
        self.doc_ids: list[int | None] = []
        self.lengths = array("q")
        self.term, self.ordinal, self.tf = array("I"), array("I"), array("Q")

    def add(self, doc_id: int | None, terms: list[str]) -> None:
        numbers = self.numbers
        for term, times in Counter(terms).items():
            self.term.append(numbers.setdefault(term, len(numbers)))
            self.ordinal.append(len(self.lengths))
            self.tf.append(times)
        self.doc_ids.append(doc_id)
        self.lengths.append(len(terms))

    @property
    def full(self) -> bool:
        return len(self.lengths) >= SHARD_DOCS or len(self.term) >= SHARD_POSTINGS

    def rows(self, shard: int) -> Iterator[tuple]:
        """The shard's documents (a row without term), then its terms."""
        lengths = np.array(self.lengths, dtype=np.int64)
        ids = np.array([0 if i is None else i for i in self.doc_ids], dtype="<i8")
        known = np.array([i is not None for i in self.doc_ids], dtype="u1")
        yield (
            shard, None, len(lengths), int(lengths.sum()), known.tobytes(), ids.tobytes(),
            None, None, None, None, _narrow(lengths),
        )
        term = np.array(self.term, dtype=np.int64)
        order = np.argsort(term, kind="stable")
        ordinal = np.array(self.ordinal, dtype=np.int64)[order]
        tf = np.array(self.tf, dtype=np.int64)[order]
        cuts = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(self.numbers)))]).tolist()
        # Most terms have one block, which is kept as it is: a slice of these pairs.
        pairs = np.column_stack([ordinal, tf]).astype("<u4").tobytes()
        for word, (start, end) in zip(self.numbers, pairwise(cuts), strict=True):
            if end - start <= BLOCK:
                yield (shard, word, end - start, 0, *_NO_BLOCKS, pairs[8 * start : 8 * end])
            else:
                yield (shard, word, end - start, 0, *_blocks(ordinal[start:end], tf[start:end], lengths))


_NO_BLOCKS = (None,) * 6


def _blocks(ordinal: np.ndarray, tf: np.ndarray, lengths: np.ndarray) -> tuple[bytes, ...]:
    n = lengths[ordinal]
    packed, at, outline_at, outline = [], [], [], []
    size = 0
    for start in range(0, len(ordinal), BLOCK):
        end = min(start + BLOCK, len(ordinal))
        gaps = np.diff(ordinal[start:end], prepend=ordinal[start])
        block = _narrow(gaps) + _narrow(tf[start:end])
        at.append(size)
        size += len(block)
        packed.append(block)
        outline_at.append(sum(map(len, outline)))
        outline.append(start + _outline(tf[start:end], n[start:end]) if end - start > 1 else [start])
    outlined = np.concatenate(outline).astype(np.int64)
    starts = np.arange(0, len(ordinal), BLOCK)
    ends = np.minimum(starts + BLOCK, len(ordinal)) - 1
    return (
        _narrow(ordinal[starts]), _narrow(ordinal[ends]), _narrow(np.array(at)),
        _narrow(np.array(outline_at)), _narrow(tf[outlined]), _narrow(n[outlined]), b"".join(packed),
    )


def build_index(docs: DataFrame) -> DataFrame:
    """The index of the whole texts of all rows, written once to the shared folder.

    Rows without a term are not in it. Every row is a document of its own, also if its id or text is
    repeated; a null ``doc_id`` stays null. Other columns are not read.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, shard = TaskContext.get().partitionId() << 24, _Shard()

        def packed() -> Iterator[pa.RecordBatch]:
            rows = list(shard.rows(name)) if shard.lengths else []
            for start in range(0, len(rows), 5000):
                yield batch_of(rows[start : start + 5000], _INDEX)

        for batch in small(batches):
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                terms = terms_of(text)
                if terms:
                    shard.add(doc_id, terms)
                if shard.full:
                    yield from packed()
                    name, shard = name + 1, _Shard()
        yield from packed()

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return pin(narrow.mapInArrow(build, spark_schema(_INDEX)), "search-index")


# --- search ------------------------------------------------------------------------------------


class Corpus:
    """What a shard's lists share: the statistics of the corpus and the shard's documents."""

    def __init__(self, documents: dict, n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, n_terms
        self.shares = _shares(_wide(documents["postings"]), n_docs, n_terms)
        self.known = np.frombuffer(documents["first"], dtype=bool)
        self.ids = np.frombuffer(documents["last"], dtype="<i8")
        # By id, documents without one last.
        self.rank = np.empty(len(self.ids), dtype=np.int64)
        self.rank[np.lexsort((self.ids, ~self.known))] = np.arange(len(self.ids))


def _shares(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Eight times a document's length factor, in hundredths."""
    return 8 * (100 - LENGTH_SHARE + (LENGTH_SHARE * lengths * n_docs) // n_terms)


def _impacts(tf: np.ndarray, shares: np.ndarray) -> np.ndarray:
    return (SCALE * tf) // (1000 * tf + shares)


class PostingList:
    """A term's blocks in one shard; blocks are unpacked when first needed."""

    def __init__(self, row: dict, corpus: Corpus):
        self._raw, self._df, self._shares = row["postings"], row["df"], corpus.shares
        self._unpacked: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        if row["at"] is None:  # a single block, not packed
            found, tf = np.frombuffer(self._raw, dtype="<u4").astype(np.int64).reshape(-1, 2).T
            self._unpacked[0] = found, _impacts(tf, self._shares[found])
            self.first, self.last = found[:1], found[-1:]
            self.peaks = self._unpacked[0][1].max(keepdims=True)
        else:
            self.first, self.last, self._at = _wide(row["first"]), _wide(row["last"]), _wide(row["at"])
            shares = _shares(_wide(row["outline_n"]), corpus.n_docs, corpus.n_terms)
            outlined = _impacts(_wide(row["outline_tf"]), shares)
            self.peaks = np.maximum.reduceat(outlined, _wide(row["outline_at"]))
        self.peak = int(self.peaks.max())
        self.weight = term_weight(corpus.n_docs, row["total_df"])

    @property
    def unpacked(self) -> int:
        return len(self._unpacked)

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of one block."""
        if i not in self._unpacked:
            count = min(BLOCK, self._df - i * BLOCK)
            at = int(self._at[i])
            gaps = _wide(self._raw, at, count)
            tf = _wide(self._raw, at + 1 + count * _WIDTHS[self._raw[at]].itemsize, count)
            found = self.first[i] + np.cumsum(gaps)
            self._unpacked[i] = found, _impacts(tf, self._shares[found])
        return self._unpacked[i]

    def between(self, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The postings of documents ``low`` up to ``high``, block by block."""
        begin = int(np.searchsorted(self.last, low))
        end = int(np.searchsorted(self.first, high))
        for i in range(begin, end):
            found, impact = self.block(i)
            if found[0] < low or found[-1] >= high:
                inside = slice(*np.searchsorted(found, (low, high)))
                found, impact = found[inside], impact[inside]
            yield found, impact

    def limits(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Block of each document and the most the term can give it."""
        block = np.searchsorted(self.last, found)
        held = np.minimum(block, len(self.last) - 1)
        inside = (block < len(self.last)) & (self.first[held] <= found)
        return held, np.where(inside, self.peaks[held], 0)

    def look_up(self, found: np.ndarray, block: np.ndarray) -> np.ndarray:
        """Impacts of single documents that lie within the given blocks; 0 where it has none."""
        given = np.zeros(len(found), dtype=np.int64)
        for i in np.unique(block).tolist():
            held, impact = self.block(i)
            mine = np.flatnonzero(block == i)
            place = np.minimum(np.searchsorted(held, found[mine]), len(held) - 1)
            given[mine] = np.where(held[place] == found[mine], impact[place], 0)
        return given


def best_documents(
    terms: list[tuple[PostingList, int]], n_docs: int, rank: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """The k best documents (places in the shard) of weighted lists, and their scores.

    Equal scores go by ``rank``, so a document that can only equal the k-th score stays in the race.
    """
    lists = sorted(
        ((p, p.weight * times) for p, times in terms if p.weight > 0), key=lambda x: x[1] * x[0].peak
    )
    bounds = np.cumsum([w * p.peak for p, w in lists])
    top, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    needed, split = 1, 0
    for low in range(0, n_docs if lists else 0, STRETCH):
        high = min(low + STRETCH, n_docs)
        gathered = np.zeros(high - low, dtype=np.int64)
        for postings, weight in lists[split:]:
            for found, impact in postings.between(low, high):
                gathered[found - low] += weight * impact
        found = np.flatnonzero(gathered) + low
        score = gathered[found - low]
        limits = [p.limits(found) for p, _ in lists[:split]]
        may = sum((w * limit for (_, w), (_, limit) in zip(lists, limits)), np.zeros(len(found), np.int64))
        left = np.flatnonzero(score + may >= needed)
        for j in range(split - 1, -1, -1):
            (postings, weight), (block, limit) = lists[j], limits[j]
            asked = left[limit[left] > 0]
            score[asked] += weight * postings.look_up(found[asked], block[asked])
            may[left] -= weight * limit[left]
            left = left[score[left] + may[left] >= needed]
        top, scores = np.concatenate([top, found[left]]), np.concatenate([scores, score[left]])
        if len(top) > k:
            order = np.lexsort((rank[top], -scores))[:k]
            top, scores = top[order], scores[order]
        if len(top) >= k:
            needed = max(1, int(scores.min()))
            # Terms that together stay below the k-th score find no document by themselves.
            split = int(np.searchsorted(bounds, needed))
            if split == len(lists):
                break
    return top, scores


_TERMS = arrow_schema(item="string", item_id="int64", term="string", times="int64")
_FOUND = arrow_schema(item="string", item_id="int64", doc_id="int64", score="int64")


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        rows = []
        for item, item_id, text in zip(*(batch[c].to_pylist() for c in ("item", "item_id", "text")), strict=True):
            rows += [(item, item_id, term, times) for term, times in Counter(terms_of(text)).items()]
        yield batch_of(rows, _TERMS)


def _search_shard(n_docs: int, n_terms: int, k: int):
    def search(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        documents = [r for r in rows if r["term"] is None]
        corpus = Corpus(documents[0], n_docs, n_terms)
        items: dict[tuple, list] = {}
        for row in rows:
            if row["term"] is not None:
                postings = PostingList(row, corpus)
                for item in row["items"]:
                    items.setdefault((item["item"], item["item_id"]), []).append((postings, item["times"]))
        found = []
        for (item, item_id), terms in items.items():
            top, scores = best_documents(terms, len(corpus.ids), corpus.rank, k)
            for at, score in zip(top.tolist(), scores.tolist(), strict=True):
                doc_id = int(corpus.ids[at]) if corpus.known[at] else None
                found.append((item, item_id, doc_id, score))
        return pa.Table.from_batches([batch_of(found, _FOUND)])

    return search


def search(index: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the ``k`` best documents of each item.

    ``items`` have ``item_id`` and ``text``; rows equal in both are one item, a null text has no terms
    and finds nothing, null ids stay null. Scores above 0 count; equal scores go by ascending
    ``doc_id``, null ids last. Items are searched in blocks of ``ITEMS``, a shard and a block at a time;
    a posting list moves once for each block that asks for its term. Empty tables give no rows.
    """
    documents = index.where(F.col("term").isNull())
    corpus = documents.agg(F.sum("df").alias("n"), F.sum("n_terms").alias("l")).first()
    n_docs, n_terms = corpus["n"] or 0, corpus["l"] or 1

    text = F.coalesce("text", F.lit(""))
    narrow = items.select(
        F.concat_ws(":", "item_id", F.sha2(text, 256)).alias("item"),
        F.col("item_id").cast("long").alias("item_id"),
        text.alias("text"),
    ).distinct()
    asked = pin(narrow.mapInArrow(_item_terms, spark_schema(_TERMS)), "item-terms")
    blocks = max(1, -(-asked.select("item").distinct().count() // ITEMS))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int").alias("block")
    wanted = asked.groupBy("term", block).agg(F.collect_list(F.struct("item", "item_id", "times")).alias("items"))
    held = index.where(F.col("term").isNotNull())
    total = held.join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("df").alias("total_df"))
    lists = held.join(wanted.join(total, "term"), "term")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    whole = lists.unionByName(documents.withColumn("block", every), allowMissingColumns=True)
    found = whole.groupBy("shard", "block").applyInArrow(
        _search_shard(n_docs, n_terms, k), spark_schema(_FOUND)
    )
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("item_id", "rank", "doc_id", "score")
    )
