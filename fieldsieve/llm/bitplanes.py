"""Token ids in files of bit or byte planes.

Documents are laid out in ascending ``doc_id`` order over shards (one per range of ids); a shard is
one stream of ids, cut into blocks of a fixed number of ids. A block is transposed: plane 0 holds
the lowest byte (or bit) of every id, plane 1 the next, and so on. Neighbouring values of one plane
are alike, high planes are nearly constant, and each plane is compressed by itself with zstandard.

A store is a Parquet folder with one row per block, written by Spark's commit protocol, so a lost
executor's work is done again and never seen twice:

    shard, block, start (ids of the shard before the block), n_ids, mode, planes (their compressed
    bytes), docs: the documents with ids in the block, as (doc_no, doc_id, doc_ids, at, place, n):
    place in the shard, id, ids of the whole document, ids of it before this block, place of its
    first id in the block, ids in the block.

Every column but ``planes`` is the chunk index; Parquet reads it without the planes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .arrow import arrow_schema, spark_schema
from .encoding import encoder

BLOCK_IDS = 65_536
LEVEL = 3

_STORE = arrow_schema(
    shard="int32", block="int32", start="int64", n_ids="int32", mode="string",
    planes=pa.list_(pa.binary()),
    docs=pa.list_(
        pa.struct(
            [
                *[(n, pa.int64()) for n in ("doc_no", "doc_id", "doc_ids", "at")],
                ("place", pa.int32()),
                ("n", pa.int32()),
            ]
        )
    ),
)
_PIECES = arrow_schema(
    shard="int32", doc_no="int64", doc_id="int64", doc_ids="int64", at="int64",
    shard_start="int64", ids="binary",
)


def to_planes(ids: np.ndarray, mode: str) -> list[bytes]:
    """The planes of a block of 32-bit ids, lowest first: 4 byte planes or 32 bit planes."""
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if mode == "byte":
        return [raw[:, i].tobytes() for i in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, i], bitorder="little").tobytes() for i in range(32)]


def from_planes(planes: list[bytes], n_ids: int, mode: str) -> np.ndarray:
    """The ids that :func:`to_planes` took apart."""
    if mode == "byte":
        raw = np.stack([np.frombuffer(p, dtype=np.uint8) for p in planes], axis=1)
    else:
        bits = [
            np.unpackbits(np.frombuffer(p, dtype=np.uint8), bitorder="little", count=n_ids)
            for p in planes
        ]
        raw = np.packbits(np.stack(bits, axis=1), axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)


def _block_writer(vocabulary: str, end_id: int, block_ids: int, mode: str) -> Callable:
    end = np.uint32(end_id).astype("<u4").tobytes()
    size = 4 * block_ids

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encode = encoder(vocabulary)
        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        shard = TaskContext.get().partitionId()
        pending, docs, block, doc_no = bytearray(), [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal block
            ids = np.frombuffer(bytes(pending[:size]), dtype="<u4")
            row = {
                "shard": shard, "block": block, "start": block * block_ids, "n_ids": len(ids),
                "mode": mode, "planes": [compress(p) for p in to_planes(ids, mode)],
                "docs": list(docs),
            }
            del pending[:size]
            docs.clear()
            block += 1
            return pa.RecordBatch.from_pylist([row], schema=_STORE)

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = encode(text.as_py()) + end
                doc = {"doc_no": doc_no, "doc_id": doc_id.as_py(), "doc_ids": len(ids) // 4}
                doc_no += 1
                at = 0
                while at < len(ids):
                    n = min(len(ids) - at, size - len(pending))
                    docs.append(doc | {"at": at // 4, "place": len(pending) // 4, "n": n // 4})
                    pending += ids[at : at + n]
                    at += n
                    if len(pending) == size:
                        yield flush()
        if pending:
            yield flush()

    return write


def write_ids(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    end_id: int,
    block_ids: int = BLOCK_IDS,
    mode: str = "byte",
) -> None:
    """Encode ``text`` of every row, end it with ``end_id`` and write the ids to ``path``.

    Rows are ordered by ``doc_id``; null ids come first and rows with the same id are ordered by a
    hash of their text, rows that are also equal in text in any order. A null text is empty, and an
    empty text is its end id alone. Other columns are not read. An empty table gives an empty store.
    """
    if mode not in ("byte", "bit"):
        raise ValueError(f"mode is byte or bit, not {mode!r}")
    placed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn(
        "tie", F.xxhash64("text")
    )
    ordered = placed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered.select("doc_id", "text").mapInArrow(
        _block_writer(vocabulary, end_id, block_ids, mode), spark_schema(_STORE)
    ).write.parquet(path)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    for batch in batches:
        expand = zstandard.ZstdDecompressor().decompress
        for row in batch.to_pylist():
            planes = [expand(p) for p in row["planes"]]
            raw = from_planes(planes, row["n_ids"], row["mode"]).astype("<u4").tobytes()
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "shard": row["shard"], "doc_no": d["doc_no"], "doc_id": d["doc_id"],
                        "doc_ids": d["doc_ids"], "at": d["at"],
                        "shard_start": row["start"] + d["place"] - d["at"],
                        "ids": raw[4 * d["place"] : 4 * (d["place"] + d["n"])],
                    }
                    for d in row["docs"]
                ],
                schema=_PIECES,
            )


def shard_starts(blocks: DataFrame) -> DataFrame:
    """Ids in all shards before each shard; one row per shard, from the index alone."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocks.groupBy("shard").agg(F.sum(F.col("n_ids").cast("long")).alias("n"))
    return totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Read a store back: one row per document with ``doc_id``, ``start``, ``n_tokens``, ``ids``.

    ``start`` counts the ids of all documents before it in the store, ``ids`` is binary,
    little-endian unsigned 32-bit. Documents inside one block need no shuffle; only those that
    cross a block border are put together by their number.
    """
    blocks = spark.read.schema(spark_schema(_STORE)).parquet(path)
    pieces = blocks.mapInArrow(_decode, spark_schema(_PIECES))
    whole = F.octet_length("ids") == 4 * F.col("doc_ids")
    inside = pieces.where(whole).select("shard", "doc_id", "doc_ids", "shard_start", "ids")
    across = (
        pieces.where(~whole)
        .groupBy("shard", "doc_no", "doc_id", "doc_ids", "shard_start")
        .agg(F.array_sort(F.collect_list(F.struct("at", "ids"))).alias("parts"))
        .withColumn("ids", F.aggregate("parts.ids", F.lit(b""), lambda a, b: F.concat(a, b)))
        .select(*inside.columns)
    )
    # One row per shard: the shards are the shuffle partitions of the writing session.
    return (
        inside.unionByName(across)
        .join(F.broadcast(shard_starts(blocks)), "shard")
        .select(
            "doc_id",
            (F.col("before") + F.col("shard_start")).alias("start"),
            F.col("doc_ids").alias("n_tokens"),
            "ids",
        )
    )
