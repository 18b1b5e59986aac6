"""Packing tokenised documents into sequences of a fixed length by the sum-of-squares rule.

A document of more tokens than a sequence holds is cut into whole sequences, the first piece being what is left over; pieces that fill a sequence
need no packing. Each other piece goes, in the order of a hash, where the sum over all gaps of the squared number of open sequences with that
gap becomes smallest: into an open one, or into a new one. Gaps thus stay evenly represented, and later pieces find one that they fill.

Pieces are dealt to groups of about ``GROUP_PIECES``, each packed in one task. A sequence that is still open at the group's end is taken
apart again, and its pieces go on to the next level, where ``FAN_IN`` groups meet, until one group is left; a group hands on a ``FAN_IN``-th of its
pieces at most, those of the emptiest sequences first (more are left only where sizes do not go together, which no level would mend). In the last group
the pieces of open sequences are packed once more, the longest first, each into the fullest sequence that holds it. So what a corpus wastes does
not grow with its number of groups. Only lengths are shuffled, never ids.

A null text is an empty document: its end id alone. Rows that repeat are packed each; rows without doc_id too. An empty table gives no rows.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm import arrays as A
from larder.llm.encoding import encoder, located
from larder.llm.shared import stored

LENGTH = 1024
GROUP_PIECES = 1 << 16
FAN_IN = 16
_FAR = np.int64(1) << 40


def sum_of_squares(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Bins as lists of places in ``sizes``, all below ``length``."""
    open_at: list[list[int]] = [[] for _ in range(length)]  # bins by gap
    count = np.zeros(length, np.int64)
    bins: list[list[int]] = []
    for i, size in enumerate(sizes.tolist()):
        # What the sum grows by if a bin of gap size, size + 1, ... is taken; a filled bin is open no more.
        grows = 2 * (count[: length - size] - count[size:] + 1)
        grows[0] = 1 - 2 * count[size]
        grows[count[size:] == 0] = _FAR
        left = int(grows.argmin())
        if grows[left] <= 2 * count[length - size] + 1:
            at = open_at[size + left].pop()
            count[size + left] -= 1
        else:
            left, at = length - size, len(bins)
            bins.append([])
        bins[at].append(i)
        if left:
            open_at[left].append(at)
            count[left] += 1
    return bins


def best_fit(sizes: np.ndarray, length: int) -> list[list[int]]:
    """The longest first, each into the fullest bin that holds it."""
    open_at: list[list[int]] = [[] for _ in range(length)]
    count = np.zeros(length, np.int64)
    bins: list[list[int]] = []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fit = np.flatnonzero(count[size:])
        if len(fit):
            gap = size + int(fit[0])
            at = open_at[gap].pop()
            count[gap] -= 1
        else:
            gap, at = length, len(bins)
            bins.append([])
        bins[at].append(i)
        if gap > size:
            open_at[gap - size].append(at)
            count[gap - size] += 1
    return bins


def pack_group(sizes: np.ndarray, length: int, most_on: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset and whether the next level packs it, for each piece. ``most_on``: pieces handed on at most; None in the last group."""
    bins = sum_of_squares(sizes, length)
    gap = np.array([length - int(sizes[b].sum()) for b in bins])
    handed = np.zeros(len(sizes), bool)
    left = 0
    for at in np.argsort(-gap, kind="stable").tolist():
        left += len(bins[at])
        if not gap[at] or most_on is not None and left > most_on:
            break
        handed[bins[at]] = True
    again = np.flatnonzero(handed)
    bins = [b for b in bins if not handed[b[0]]]
    if most_on is None:
        bins += [again[b].tolist() for b in best_fit(sizes[again], length)]
        handed[:] = False
    number, offset = np.full(len(sizes), -1), np.zeros(len(sizes), np.int64)
    for k, b in enumerate(bins):
        number[b] = k
        offset[b] = np.cumsum(sizes[b]) - sizes[b]
    return number, offset, handed


_PIECES = "key long, doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


def cut(docs: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH, keep_ids: bool = False) -> DataFrame:
    """Pieces of every document: key (of its own), doc_id, piece, start, length, ids_crc32, ids (little-endian 32-bit, if kept)."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, key = encoder(located(tokenizer)), TaskContext.get().partitionId() << 33
        for batch in batches:
            for row, ids, sizes in encode(batch.column("text"), end_id):
                n = -(-sizes // length)
                doc = np.repeat(np.arange(len(sizes)), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                # Places from the end: all pieces but the first are whole.
                start = np.where(piece > 0, sizes[doc] - (n[doc] - piece) * length, 0)
                stop = sizes[doc] - (n[doc] - piece - 1) * length
                base = (np.cumsum(sizes) - sizes)[doc]
                raw = [ids[a:b].tobytes() for a, b in zip((base + start).tolist(), (base + stop).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(key, key + len(doc))), batch.column("doc_id").slice(row, len(sizes)).take(pa.array(doc)), pa.array(piece, pa.int32()),
                        pa.array(start), pa.array(stop - start), pa.array([zlib.crc32(x) for x in raw], pa.int64()), pa.array(raw if keep_ids else [None] * len(raw), pa.binary()),
                    ],
                    names=["key", "doc_id", "piece", "start", "length", "ids_crc32", "ids"],
                )
                key += len(doc)
        A.tidy()

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(docs.mapInArrow(pieces, _PIECES), "pieces")


_PLACED = "key long, length long, group long, bin long, offset long, handed boolean"


def _packer(length: int, most_on: int | None):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("tie", "ascending"), ("key", "ascending")])
        number, offset, handed = pack_group(table["length"].to_numpy(), length, most_on)
        return pa.table({"key": table["key"], "length": table["length"], "group": table["group"], "bin": number, "offset": offset, "handed": handed})

    return run


def place(pieces: DataFrame, length: int = LENGTH, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """(key, sequence_id, offset) of every piece (key, length)."""
    whole = pieces.where(F.col("length") == length).select("key", (-1 - F.col("key")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rows = pieces.where(F.col("length") < length).select("key", "length")
    groups = max(1, -(-rows.count() // group_pieces))
    rows, out, level = rows.withColumn("group", F.pmod(F.xxhash64(F.lit(7), "key"), F.lit(groups))), whole, 0
    while True:
        last = groups == 1
        tied = rows.withColumn("tie", F.xxhash64(F.lit(level), "key"))
        placed = tied.groupBy("group").applyInArrow(_packer(length, None if last else group_pieces // FAN_IN), _PLACED)
        placed = stored(placed, f"packed{level}")
        # Level, group and bin in one number.
        number = F.lit(level << 56) + F.col("group") * (1 << 20) + F.col("bin")
        out = out.unionByName(placed.where("NOT handed").select("key", number.alias("sequence_id"), "offset"))
        if last:
            return out
        rows = placed.where("handed").select("key", "length", F.floor(F.col("group") / FAN_IN).cast("long").alias("group"))
        groups, level = -(-groups // FAN_IN), level + 1


def pack(docs: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH, keep_ids: bool = False, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pieces of all documents with the sequence that each is in and its offset there."""
    pieces = cut(docs, tokenizer, end_id, length, keep_ids)
    return pieces.join(place(pieces, length, group_pieces), "key").drop("key")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids (little-endian 32-bit), and the documents in it, of pieces whose ids were kept."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))  # at most as many as a sequence has tokens
    listed = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    ids = F.aggregate("parts", F.lit(b""), lambda all_ids, x: F.concat(all_ids, x["ids"]))
    return listed.select("sequence_id", ids.alias("ids"), F.col("parts.doc_id").alias("doc_ids"))


def report(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    return pack(docs, tokenizer, end_id).drop("ids")
