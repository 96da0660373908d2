"""Alignment of two tokenizers' tokens, and how common each linked pair of ids is in the corpus.

A byte-level vocabulary (A) and a merge-type piece vocabulary (B) encode the same bytes. Offsets
where tokens of both end cut a text into groups; the tokens of a group are linked. Every text is
encoded once, and its ids are written. A first pass over the documents aligns them and counts, task by task, in how many documents each linked id pair occurs. The distinct
pairs are dealt to shards by their A id, and each shard gets a minimal perfect hash of its pairs: a
count is then a place in a dense vector. Partial counts become such vectors, which are added in a
tree. The second pass aligns the documents again, sends each document's pairs to their shards, and
looks the counts up there, comparing every pair with the one stored for its slot.

Shards and the groups dealt to tasks have fixed sizes; only their number grows with the corpus.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin
from .arrow import arrow_schema, batch_of, small, spark_schema
from .encoding import byte_alphabet, encoder
from .perfect_hash import PerfectHash
from .pieces import vocabulary

#: Pairs of a shard, partial counts of a leaf of the tree, vectors added at once, and links of
#: documents that one group looks up. They bound a task's memory.
SHARD_PAIRS = 1 << 18
LEAF_COUNTS = 1 << 18
FAN = 16
GROUP_LINKS = 1 << 21
#: Pairs that a task gathers before it counts them.
GATHERED = 1 << 20
#: Links up to which the tokens of a group are paired one by one.
PAIRED_OUT = 1024

_NONE = np.zeros(0, dtype=np.int64)


class Vocabularies:
    """The two vocabularies in a worker: encoding of whole texts, and the bytes of their tokens."""

    def __init__(self, byte_vocabulary: str, piece_model: str):
        from tokenizers import Tokenizer

        self._encode_a = encoder(byte_vocabulary, plain=True)
        self._encode_b = vocabulary(piece_model).library.encode
        byte_of = {shown: b for b, shown in byte_alphabet().items()}
        tokens = Tokenizer.from_file(byte_vocabulary).get_vocab(with_added_tokens=True)
        self._bytes_a = [b""] * (1 + max(tokens.values()))
        for token, i in tokens.items():
            if set(token) <= byte_of.keys():
                self._bytes_a[i] = bytes(byte_of[c] for c in token)
        self._bytes_b = vocabulary(piece_model).bytes
        self.sizes_a = np.array(list(map(len, self._bytes_a)), dtype=np.int64)
        self.sizes_b = np.array(list(map(len, self._bytes_b)), dtype=np.int64)
        self.size_b = len(self._bytes_b)
        # Ids as text with the mark that follows inside and at the end of a group's half.
        self.shown_a = [np.array([f"{i}{m}" for i in range(len(self._bytes_a))], dtype=object) for m in ",|"]
        self.shown_b = [np.array([f"{i}{m}" for i in range(self.size_b)], dtype=object) for m in ",;"]

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both vocabularies; none for texts that are null, empty or not spelt by the tokens."""
        found = []
        for text, b in zip(texts, self._encode_b([t or "" for t in texts], num_threads=1), strict=True):
            a = np.frombuffer(self._encode_a(" " + text), dtype="<u4") if text else _NONE
            raw = (" " + text).encode() if text else b""
            spelt = b"".join([self._bytes_a[i] for i in a.tolist()]), b"".join([self._bytes_b[i] for i in b])
            found.append((a, np.array(b, dtype=np.int64)) if text and spelt == (raw, raw) else (_NONE, _NONE))
        return found


_LOADED: dict[tuple[str, str], Vocabularies] = {}


def vocabularies(byte_vocabulary: str, piece_model: str) -> Vocabularies:
    """The worker's pair of vocabularies; it lives as long as the worker."""
    key = byte_vocabulary, piece_model
    if key not in _LOADED:
        _LOADED[key] = Vocabularies(*key)
    return _LOADED[key]


class Alignment:
    """The ids of both vocabularies, and how many of each lie before the end of each group."""

    def __init__(self, own: Vocabularies, a: np.ndarray, b: np.ndarray):
        self._own = own
        self.a, self.b = a.astype(np.int64), b.astype(np.int64)
        ends_a, ends_b = np.cumsum(own.sizes_a[self.a]), np.cumsum(own.sizes_b[self.b])
        borders = np.intersect1d(ends_a, ends_b, assume_unique=True)
        self._cuts_a = np.searchsorted(ends_a, borders, side="right")
        self._cuts_b = np.searchsorted(ends_b, borders, side="right")

    @property
    def n_groups(self) -> int:
        return len(self._cuts_a)

    def groups(self) -> str:
        """Ids of A and B by group: ``a1,a2|b1;a3|b2``."""
        n_a, n_b = np.diff(self._cuts_a, prepend=0), np.diff(self._cuts_b, prepend=0)
        place_a = np.arange(len(self.a)) + np.repeat(self._cuts_b - n_b, n_a)
        place_b = np.arange(len(self.b)) + np.repeat(self._cuts_a, n_b)
        last_a, last_b = self._cuts_a - 1, self._cuts_b - 1
        parts = np.empty(len(self.a) + len(self.b), dtype=object)
        parts[place_a], parts[place_b] = self._own.shown_a[0][self.a], self._own.shown_b[0][self.b]
        parts[place_a[last_a]] = self._own.shown_a[1][self.a[last_a]]
        parts[place_b[last_b]] = self._own.shown_b[1][self.b[last_b]]
        return "".join(parts.tolist())[:-1]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct linked id pairs as numbers, in order, and how often each is linked.

        Small groups are paired out; equal ids of a large group are multiplied, not paired one by one.
        """
        size_b = self._own.size_b
        n_a, n_b = np.diff(self._cuts_a, prepend=0), np.diff(self._cuts_b, prepend=0)
        start_a, start_b = self._cuts_a - n_a, self._cuts_b - n_b
        large = np.flatnonzero(n_a * n_b > PAIRED_OUT)
        partners = n_b.copy()
        partners[large] = 0
        each = np.repeat(partners, n_a)
        before = np.cumsum(each) - each
        place = np.arange(int(each.sum())) + np.repeat(np.repeat(start_b, n_a) - before, each)
        pairs = [np.repeat(self.a, each) * size_b + self.b[place]]
        times = [np.ones(len(place), dtype=np.int64)]
        for g in large.tolist():
            x, times_x = np.unique(self.a[start_a[g] : self._cuts_a[g]], return_counts=True)
            y, times_y = np.unique(self.b[start_b[g] : self._cuts_b[g]], return_counts=True)
            pairs.append((x[:, None] * size_b + y).ravel())
            times.append((times_x[:, None] * times_y).ravel())
        every, times = np.concatenate(pairs), np.concatenate(times)
        order = np.argsort(every, kind="stable")
        every = every[order]
        starts = np.flatnonzero(np.diff(every, prepend=-1))
        return every[starts], np.add.reduceat(times[order], starts) if len(starts) else times


# --- first pass: counts ------------------------------------------------------------------------

_ENCODED = arrow_schema(doc_id="int64", text_md5="binary", a="binary", b="binary")
_PARTIAL = arrow_schema(pair="int64", n="int64", task="int64")
_INDEX = arrow_schema(shard="int64", hash="binary", pairs="binary")
_VECTOR = arrow_schema(shard="int64", branch="int64", counts="binary")
_TABLE = arrow_schema(shard="int64", hash="binary", pairs="binary", counts="binary")


_WIDTHS = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}


def _raw(numbers: np.ndarray) -> bytes:
    """Non-negative numbers in the fewest bytes each that hold the largest, after that width."""
    largest = int(numbers.max(initial=0))
    width = next(w for w in _WIDTHS if largest < 1 << 8 * w)
    return bytes([width]) + numbers.astype(_WIDTHS[width]).tobytes()


def _numbers(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=_WIDTHS[raw[0]], offset=1).astype(np.int64)


def encoded(docs: DataFrame, byte_vocabulary: str, piece_model: str) -> DataFrame:
    """``doc_id``, ``text_md5`` and the ids ``a`` and ``b`` of every row, written once."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabularies(byte_vocabulary, piece_model)
        for batch in small(batches):
            ids, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
            names = [hashlib.md5((text or "").encode()).digest() for text in texts]
            yield batch_of(
                [(i, name, _raw(a), _raw(b)) for i, name, (a, b) in zip(ids, names, own.encode(texts), strict=True)],
                _ENCODED,
            )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return pin(narrow.mapInArrow(encode, spark_schema(_ENCODED)), "two-encodings")


def partial_counts(ids: DataFrame, byte_vocabulary: str, piece_model: str) -> DataFrame:
    """``pair``, ``n``, ``task``: in how many documents of a stretch of rows a pair is linked."""

    def counted(gathered: list[np.ndarray]) -> pa.RecordBatch:
        pairs, n = np.unique(np.concatenate([_NONE, *gathered]), return_counts=True)
        task = np.full(len(pairs), TaskContext.get().partitionId(), dtype=np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n), pa.array(task)], schema=_PARTIAL)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabularies(byte_vocabulary, piece_model)
        gathered, size = [], 0
        for batch in batches:
            for a, b in zip(batch["a"], batch["b"], strict=True):
                gathered.append(Alignment(own, _numbers(a.as_py()), _numbers(b.as_py())).links()[0])
                size += len(gathered[-1])
                if size >= GATHERED:
                    yield counted(gathered)
                    gathered, size = [], 0
        yield counted(gathered)

    return ids.select("a", "b").mapInArrow(count, spark_schema(_PARTIAL))


def _indexed_shard(rows: pa.Table) -> pa.Table:
    pairs = rows["pair"].to_numpy()
    own = PerfectHash.build(pairs)
    stored = np.empty(own.size, dtype=np.int64)
    stored[own.slots(pairs)] = pairs
    shard = rows["shard"][0].as_py()
    return pa.Table.from_pylist(
        [{"shard": shard, "hash": own.to_bytes(), "pairs": _raw(stored)}], schema=_INDEX
    )


def _leaf(index: pa.Table, counts: pa.Table) -> pa.Table:
    """The dense vector of one leaf's partial counts."""
    if not index.num_rows or not counts.num_rows:
        return _VECTOR.empty_table()
    own = PerfectHash.from_bytes(index["hash"][0].as_py())
    vector = np.zeros(own.size, dtype=np.int64)
    np.add.at(vector, own.slots(counts["pair"].to_numpy()), counts["n"].to_numpy())
    key = {c: index[c][0].as_py() for c in ("shard", "branch")}
    return pa.Table.from_pylist([key | {"counts": _raw(vector)}], schema=_VECTOR)


def _added(vectors: pa.Table) -> pa.Table:
    total = sum(_numbers(raw.as_py()) for raw in vectors["counts"])
    key = {"shard": vectors["shard"][0].as_py(), "branch": vectors["branch"][0].as_py() // FAN}
    return pa.Table.from_pylist([key | {"counts": _raw(total)}], schema=_VECTOR)


def _spread(index: DataFrame, branches: int) -> DataFrame:
    """Every shard once for each of its branches."""
    return index.withColumn("branch", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(branches - 1).cast("long"))))


def pair_table(partial: DataFrame, size_b: int) -> tuple[DataFrame, int, int]:
    """Shards of hashed pairs with their total counts (``shard``, ``hash``, ``pairs``, ``counts``), the
    number of shards, and the sum of the counts."""
    partial = pin(partial, "partial-counts")
    pairs = pin(partial.select("pair").distinct(), "pairs")
    shards = max(1, -(-pairs.count() // SHARD_PAIRS))
    shard = F.pmod(F.expr(f"pair div {size_b}"), F.lit(shards)).alias("shard")
    index = pairs.select("pair", shard).groupBy("shard").applyInArrow(_indexed_shard, spark_schema(_INDEX))
    index = pin(index, "pair-index")

    branches = max(1, -(-partial.count() // (shards * LEAF_COUNTS)))
    branch = F.pmod(F.xxhash64("task", "pair"), F.lit(branches)).alias("branch")
    leaves = partial.select("pair", "n", shard, branch).groupBy("shard", "branch")
    hashes = _spread(index, branches).select("shard", "branch", "hash").groupBy("shard", "branch")
    vectors = hashes.cogroup(leaves).applyInArrow(_leaf, spark_schema(_VECTOR))
    while branches > 1:
        above = F.expr(f"branch div {FAN}").alias("above")
        level = vectors.select("shard", "branch", "counts", above).groupBy("shard", "above")
        vectors = level.applyInArrow(_added, spark_schema(_VECTOR))
        branches = -(-branches // FAN)
    table = pin(index.join(vectors.drop("branch"), "shard"), "pair-counts")
    return table, shards, partial.agg(F.sum("n")).first()[0] or 0


# --- second pass: look-ups -----------------------------------------------------------------------

_FIGURES = {"n_a": "int64", "n_b": "int64", "n_groups": "int64", "n_links": "int64"}
_LINKS = arrow_schema(
    doc_id="int64", text_md5="binary", shard="int64", first="int64", **_FIGURES,
    groups="string", pairs="binary", times="binary",
)
_LOOKED_UP = arrow_schema(
    doc_id="int64", text_md5="binary", first="int64", **_FIGURES, groups="string",
    n_best="int64", count_sum="int64",
)


def _links(ids: DataFrame, byte_vocabulary: str, piece_model: str, shards: int, digest: bool) -> DataFrame:
    """One row per document and shard with its links, or one without links in the first shard."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabularies(byte_vocabulary, piece_model)
        for batch in small(batches):
            rows = []
            for doc_id, name, a, b in zip(*(batch[c].to_pylist() for c in _ENCODED.names), strict=True):
                found = Alignment(own, _numbers(a), _numbers(b))
                pairs, times = found.links()
                groups = found.groups()
                if digest and groups:
                    groups = hashlib.sha256(groups.encode()).hexdigest()
                whole = (1, len(found.a), len(found.b), found.n_groups, int(times.sum()), groups)
                of = pairs // own.size_b % shards
                for k, shard in enumerate(np.unique(of).tolist() or [0]):
                    here = of == shard
                    figures = whole if k == 0 else (0, *[None] * 5)
                    rows.append((doc_id, name, shard, *figures, _raw(pairs[here]), _raw(times[here])))
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(_LINKS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, _LINKS, strict=True)], schema=_LINKS
            )

    return ids.mapInArrow(align, spark_schema(_LINKS))


def _looked_up(size_b: int):
    def look_up(table: pa.Table, links: pa.Table) -> pa.Table:
        if not links.num_rows:
            return _LOOKED_UP.empty_table()
        pairs_of = [_numbers(raw) for raw in links["pairs"].to_pylist()]
        pairs, row = np.concatenate(pairs_of), np.repeat(np.arange(links.num_rows), list(map(len, pairs_of)))
        times = np.concatenate([_numbers(raw) for raw in links["times"].to_pylist()])
        count, best = np.zeros(len(pairs), dtype=np.int64), np.zeros(len(pairs), dtype=bool)
        if table.num_rows and len(pairs):
            stored, counts = _numbers(table["pairs"][0].as_py()), _numbers(table["counts"][0].as_py())
            ids = stored // size_b
            highest = np.zeros(int(ids.max()) + 1, dtype=np.int64)
            np.maximum.at(highest, ids, counts)
            slot = PerfectHash.from_bytes(table["hash"][0].as_py()).slots(pairs)
            known = (slot >= 0) & (stored[slot] == pairs)
            count = np.where(known, counts[slot], 0)
            best = known & (count == highest[ids[slot]])
        sums = {"n_best": times * best, "count_sum": times * count}
        for name, values in sums.items():
            total = np.zeros(links.num_rows, dtype=np.int64)
            np.add.at(total, row, values)
            links = links.append_column(name, pa.array(total))
        return links.select(_LOOKED_UP.names).cast(_LOOKED_UP)

    return look_up


def align_documents(
    docs: DataFrame, byte_vocabulary: str, piece_model: str, digest: bool = False
) -> DataFrame:
    """``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups`` of
    every row.

    A blank is put before each text; strings of special tokens are ordinary text. ``groups`` lists the
    ids of both vocabularies by group, or with ``digest`` their lowercase hex SHA-256. The count of an
    id pair is the number of rows that hold it linked; ``count_sum`` adds the counts over all links,
    ``n_best`` counts the links whose count is the highest of their A id. A text that is null, empty or
    not spelt by the tokens (one with U+2581, say) has no tokens: zeros and empty ``groups``. Each of
    several rows equal in id and text counts and is returned; null ids stay null. Other columns are
    not read; no rows give no rows.
    """
    size_b = len(vocabulary(piece_model).bytes)
    ids = encoded(docs, byte_vocabulary, piece_model)
    partial = partial_counts(ids, byte_vocabulary, piece_model)
    # A pair's count is also the number of documents that will ask for it.
    table, shards, asked = pair_table(partial, size_b)
    branches = max(1, -(-asked // (shards * GROUP_LINKS)))
    links = _links(ids, byte_vocabulary, piece_model, shards, digest)
    links = links.withColumn("branch", F.pmod(F.xxhash64("doc_id", "text_md5"), F.lit(branches)))
    found = (
        _spread(table, branches)
        .groupBy("shard", "branch")
        .cogroup(links.groupBy("shard", "branch"))
        .applyInArrow(_looked_up(size_b), spark_schema(_LOOKED_UP))
    )
    # Rows equal in id and text meet here: their figures are equal, their sums are shared out.
    whole = found.groupBy("doc_id", "text_md5").agg(
        F.sum("first").alias("rows"),
        *[F.max(c).alias(c) for c in (*_FIGURES, "groups")],
        *[F.expr(f"sum({c}) div sum(first)").alias(c) for c in ("n_best", "count_sum")],
    )
    each = F.explode(F.sequence(F.lit(1).cast("long"), "rows")).alias("row")
    return whole.select(
        "doc_id", *_FIGURES, "n_best", "count_sum", "groups", each
    ).drop("row")
