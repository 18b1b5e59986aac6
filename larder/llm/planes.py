"""Token ids on disk as compressed byte or bit planes.

A *block* is a fixed number of ids. Its 32-bit ids are transposed into planes (four of bytes or 32 of bits), so that the
high planes, which hardly change, shrink to almost nothing; each plane is a zstandard frame. A *stripe* is one row of
the file: whole documents of a quarter of a million ids or more, the blocks' planes behind one another, and the chunk index that says
where each block and plane lies, with the block's crc32. Documents ascend by doc_id within a shard and from shard to shard. The files are
Parquet, which any store that Spark writes to can hold and which a failed task leaves no half-written part of; columns
of the index are read without the planes.

A null text is an empty document (end id only). Null ids come first; rows that repeat are all written.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.llm import arrays as A
from larder.llm.encoding import encoder, located

BLOCK_IDS = 1 << 14
STRIPE_IDS = 1 << 18

_BLOCK = pa.struct([("first", pa.int64()), ("n_ids", pa.int32()), ("offset", pa.int64()), ("planes", pa.list_(pa.int32())), ("crc32", pa.int64())])
STRIPES = pa.schema(
    [
        ("shard", pa.int32()), ("stripe", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("kind", pa.string()),
        ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), ("index", pa.list_(_BLOCK)), ("payload", pa.binary()),
    ]
)
_DDL = (
    "shard int, stripe int, first long, n_ids long, kind string, doc_ids array<long>, doc_tokens array<long>, "
    "index array<struct<first:long,n_ids:int,offset:long,planes:array<int>,crc32:long>>, payload binary"
)


# --- planes --------------------------------------------------------------------------------


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    ids = np.ascontiguousarray(ids, "<u4")
    if kind == "byte":
        return [np.ascontiguousarray(p).tobytes() for p in ids.view(np.uint8).reshape(-1, 4).T]
    bits = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return [np.packbits(p, bitorder="little").tobytes() for p in bits.T]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    rows = [np.frombuffer(p, np.uint8) for p in planes]
    if kind == "byte":
        return np.ascontiguousarray(np.stack(rows, axis=1)).view("<u4").ravel()
    bits = np.stack([np.unpackbits(r, count=n, bitorder="little") for r in rows], axis=1)
    return np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel()


def pack(ids: np.ndarray, kind: str = "byte", block_ids: int = BLOCK_IDS) -> tuple[list[dict], bytes]:
    """Chunk index and payload of a run of ids."""
    squeeze = zstandard.ZstdCompressor(level=3)
    index, parts, offset = [], [], 0
    for first in range(0, len(ids), block_ids):
        block = ids[first : first + block_ids]
        planes = [squeeze.compress(p) for p in to_planes(block, kind)]
        sizes = [len(p) for p in planes]
        crc = zlib.crc32(block.astype("<u4").tobytes())
        index.append({"first": first, "n_ids": len(block), "offset": offset, "planes": sizes, "crc32": crc})
        parts += planes
        offset += sum(sizes)
    return index, b"".join(parts)


def unpack(index: list[dict], payload: bytes, kind: str) -> np.ndarray:
    """All ids of a stripe; a block whose crc32 is not as the index has it raises an error."""
    expand, out = zstandard.ZstdDecompressor(), []
    for entry in index:
        at, planes = entry["offset"], []
        for size in entry["planes"]:
            planes.append(expand.decompress(payload[at : at + size]))
            at += size
        ids = from_planes(planes, entry["n_ids"], kind)
        if zlib.crc32(ids.tobytes()) != entry["crc32"]:
            raise ValueError(f"block at {entry['first']} does not have the crc32 of the index")
        out.append(ids)
    return np.concatenate(out) if out else np.zeros(0, "<u4")


# --- files ---------------------------------------------------------------------------------


def _stripe(shard: int, number: int, first: int, docs: list, lengths: list[int], ids: np.ndarray, kind: str) -> pa.RecordBatch:
    index, payload = pack(ids, kind)
    row = {
        "shard": shard, "stripe": number, "first": first, "n_ids": len(ids), "kind": kind,
        "doc_ids": docs, "doc_tokens": lengths, "index": index, "payload": payload,
    }
    return pa.RecordBatch.from_pylist([row], schema=STRIPES)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, kind: str = "byte") -> None:
    """Encode ``docs`` (doc_id, text) and write stripes under ``path``. One shuffle: the range partitioning by doc_id."""

    def stripes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = encoder(located(tokenizer)), TaskContext.get().partitionId()
        number = first = held = 0
        names: list = []
        lengths: list[int] = []
        parts: list[np.ndarray] = []

        def stripe() -> pa.RecordBatch:
            nonlocal number, first, held, names, lengths, parts
            made = _stripe(shard, number, first, names, lengths, np.concatenate(parts), kind)
            number, first, held, names, lengths, parts = number + 1, first + held, 0, [], [], []
            return made

        for batch in batches:
            doc_ids = batch.column("doc_id")
            for row, ids, sizes in encode(batch.column("text"), end_id):
                ends = np.cumsum(sizes)
                at = 0
                while at < len(sizes):
                    begin = int(ends[at] - sizes[at])
                    stop = min(int(np.searchsorted(ends, begin + STRIPE_IDS - held)) + 1, len(sizes))
                    names += doc_ids.slice(row + at, stop - at).to_pylist()
                    lengths += sizes[at:stop].tolist()
                    parts.append(ids[begin : ends[stop - 1]])
                    held += int(ends[stop - 1]) - begin
                    at = stop
                    if held >= STRIPE_IDS:
                        yield stripe()
        if names:
            yield stripe()
        A.tidy()

    # The hash of the text parts rows that share an id, or have none, into ranges as well.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("tie"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered.select("doc_id", "text").mapInArrow(stripes, _DDL).write.option("compression", "none").parquet(path)


def _open(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_DDL).parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(row["index"], row["payload"], row["kind"])
            ends = np.cumsum(row["doc_tokens"])
            starts = ends - row["doc_tokens"]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["shard"]] * len(ends), pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts + row["first"], pa.int64()),
                    pa.array([ids[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
                ],
                names=["shard", "doc_id", "at", "ids"],
            )


def read(spark: SparkSession, path: str) -> DataFrame:
    """shard, doc_id, place within the shard, and the ids of each document as little-endian 32-bit integers."""
    return _open(spark, path).mapInArrow(_documents, "shard int, doc_id long, at long, ids binary")


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """Ids in all shards before a shard: one row per shard, from the index columns alone."""
    totals = _open(spark, path).groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def report(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, kind: str = "byte") -> DataFrame:
    """Write ``docs``, read the files back, and give doc_id, start, n_tokens and ids_crc32 of each document."""
    spark = docs.sparkSession
    write(docs, path, tokenizer, end_id, kind)
    rows = read(spark, path).select(
        "shard", "doc_id", "at", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
    rows = rows.join(shard_starts(spark, path), "shard")
    return rows.select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
