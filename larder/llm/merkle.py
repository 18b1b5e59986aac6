"""Merkle manifest of a data set: digests of all rows in trees of eight, one tree per language, and a tree of their roots.

* **Blocks.** A tree is cut into aligned subtrees of four levels of edges (4,096 leaves); a block is one row of the manifest. The blocks' roots
  are the leaves of the next round of blocks, and so on until one block is left to a tree. A hot language is thus spread over
  many tasks, and a round is 1/4096 of the one before.
* **Layout.** Within a block nodes lie in van Emde Boas order: the subtree is split at half its height; the top part is stored first,
  then the bottom parts from left to right, each in the same way. ``address`` gives a node's place by that recursion alone; it serves to build a block
  and to fetch siblings, and a path from leaf to root touches few pages, whatever their size.
* **Proofs** go down the rounds: a block's path to the root is worked out with the round above and handed to the blocks below.

A run is eight consecutive nodes of a level (the last run: fewer, even one), and its digest the parent's, as long as a level has several nodes.
Rows of one language ascend by doc_id, null first; rows that share it ascend by digest, and full repeats are leaves each. A null language is a tree of its own,
the first one; languages are ordered by bytes. Null fields have a digest of their own, long texts are hashed whole where Spark reads them, an
empty table gives no rows. Columns beside doc_id, source, lang, n_chars and text do not matter.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.shared import fresh, stored

FAN = 8
HEIGHT = 4  # levels of edges in a block
BLOCK = FAN**HEIGHT
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# --- layout ------------------------------------------------------------------------------------


def size(levels: int) -> int:
    """Nodes of a full subtree with so many levels of nodes."""
    return (FAN**levels - 1) // (FAN - 1)


def address(depth: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Places of the nodes ``index`` of a level in a subtree of ``levels`` levels: the top half, then the bottom halves, recursively."""
    if levels == 1:
        return np.zeros_like(index)
    top = (levels + 1) // 2
    if depth < top:
        return address(depth, index, top)
    wide = FAN ** (depth - top)
    return size(top) + index // wide * size(levels - top) + address(depth - top, index % wide, levels - top)


@lru_cache(maxsize=None)
def _addresses(depth: int, levels: int) -> np.ndarray:
    return address(depth, np.arange(FAN**depth), levels)


def _widths(n: int, height: int) -> list[int]:
    """Nodes of each level, root first, above ``n`` leaves."""
    out = [n]
    for _ in range(height):
        out.append(-(-out[-1] // FAN))
    return out[::-1]


def height_of(n: int) -> int:
    """Levels of edges of a whole tree of ``n`` leaves that fits a block; HEIGHT for a block of a larger one."""
    height = 0
    while FAN**height < min(n, BLOCK):
        height += 1
    return height


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lay_out(leaves: list[str], height: int) -> tuple[str, bytes]:
    """Root and nodes, in the layout's order, of a subtree over ``leaves``; places without a node are zero."""
    nodes = np.zeros((size(height + 1), 32), np.uint8)
    for depth in range(height, -1, -1):
        at = _addresses(depth, height + 1)[: len(leaves)]
        nodes[at] = np.frombuffer(bytes.fromhex("".join(leaves)), np.uint8).reshape(-1, 32)
        if depth:
            leaves = [digest("".join(leaves[i : i + FAN])) for i in range(0, len(leaves), FAN)]
    return leaves[0], nodes.tobytes()


def siblings(payload: bytes, n: int, height: int, leaf: int) -> list[tuple[int, str]]:
    """For each level from a leaf up to below the root: the node's place in its run, and the digests of the run's others."""
    nodes, out = np.frombuffer(payload, np.uint8).reshape(-1, 32), []
    for depth, width in zip(range(height, 0, -1), _widths(n, height)[:0:-1], strict=True):
        first = leaf // FAN * FAN
        run = np.arange(first, min(first + FAN, width))
        others = address(depth, run[run != leaf], height + 1)
        out.append((leaf - first, nodes[others].tobytes().hex()))
        leaf //= FAN
    return out


def _paths(payload: bytes, n: int, height: int) -> Iterator[list[tuple[int, str]]]:
    """``siblings`` of all leaves in order, each level fetched once."""
    nodes, levels = np.frombuffer(payload, np.uint8).reshape(-1, 32), []
    for depth, width in zip(range(height, 0, -1), _widths(n, height)[:0:-1], strict=True):
        flat = nodes[_addresses(depth, height + 1)[:width]].tobytes().hex()
        row = []
        for i in range(width):
            a, b = i // FAN * FAN * 64, min((i // FAN + 1) * FAN, width) * 64
            row.append((i % FAN, flat[a : i * 64] + flat[i * 64 + 64 : b]))
        levels.append(row)
    for leaf in range(n):
        yield [row[leaf // FAN**k] for k, row in enumerate(levels)]


def fold(start: str, path: list[tuple[int, str]]) -> str:
    """The root that a digest leads to with the siblings of a path."""
    for place, others in path:
        start = digest(others[: place * 64] + start + others[place * 64 :])
    return start


def _pack(path: list[tuple[int, str]]) -> str:
    return "".join(f"{place}{others};" for place, others in path)


def _unpack(text: str) -> list[tuple[int, str]]:
    return [(int(x[0]), x[1:]) for x in text.split(";")[:-1]]


# --- blocks ------------------------------------------------------------------------------------

_BLOCKS = pa.schema(
    [
        ("tree", pa.string()), ("block", pa.int64()), ("size", pa.int64()), ("n", pa.int32()), ("height", pa.int32()), ("root", pa.string()),
        ("payload", pa.binary()), ("keys", pa.list_(pa.string())), ("claims", pa.list_(pa.string())),
    ]
)
_BLOCKS_DDL = "tree string, block long, size long, n int, height int, root string, payload binary, keys array<string>, claims array<string>"


def _ranked(nodes: DataFrame, *order: str) -> DataFrame:
    """Adds to (tree, digest, key, claim) a node's rank in its tree and the tree's size.

    One range shuffle; a task counts along its range, and what lies before it comes from the counts of (tree, range).
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            tree = batch.column("tree").to_pylist()
            nth = []
            for t in tree:
                nth.append(seen.get(t, 0))
                seen[t] = nth[-1] + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([shard] * len(nth), pa.int32()), pa.array(nth, pa.int64())], names=[*batch.schema.names, "shard", "nth"])

    # Full repeats are told apart by where they were read, so that no range must hold them all.
    rows = nodes.withColumn("tie", F.monotonically_increasing_id())
    order = (*order, "tie")
    placed = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).select("tree", "digest", "key", "claim")
    placed = stored(placed.mapInArrow(count, "tree string, digest string, key string, claim string, shard int, nth long"), "placed")
    per = placed.groupBy("tree", "shard").agg(F.count(F.lit(1)).alias("n"))
    within = Window.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(within.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per = per.select("tree", "shard", before.alias("base"), F.sum("n").over(within).alias("size"))
    return placed.join(per, ["tree", "shard"]).select("tree", (F.col("base") + F.col("nth")).alias("rank"), "size", "digest", "key", "claim")


def _build(table: pa.Table) -> pa.Table:
    table = table.sort_by("rank")
    first = {c: table[c][0].as_py() for c in ("tree", "block", "size")}
    height = height_of(first["size"])
    root, payload = lay_out(table["digest"].to_pylist(), height)
    keyed = table["claim"].null_count < len(table)
    row = {
        **first, "n": len(table), "height": height, "root": root, "payload": payload,
        "keys": table["key"].to_pylist() if keyed else None, "claims": table["claim"].to_pylist() if keyed else None,
    }
    return pa.Table.from_pylist([row], schema=_BLOCKS)


def _forest(nodes: DataFrame, path: str) -> list[DataFrame]:
    """Rounds of blocks over (tree, rank, size, digest, key, claim), each a table under ``path``."""
    rounds, spark = [], nodes.sparkSession
    while True:
        cut = nodes.withColumn("block", F.floor(F.col("rank") / BLOCK).cast("long"))
        cut.groupBy("tree", "block").applyInArrow(_build, _BLOCKS_DDL).write.option("compression", "none").parquet(to := f"{path}-{len(rounds)}")
        rounds.append(spark.read.schema(_BLOCKS_DDL).parquet(to))
        most = rounds[-1].agg(F.max("size")).first()[0]
        if most is None or most <= BLOCK:
            return rounds
        up = rounds[-1].where(F.col("size") > BLOCK)
        none = F.lit(None).cast("string")
        nodes = up.select("tree", F.col("block").alias("rank"), F.ceil(F.col("size") / BLOCK).alias("size"), F.col("root").alias("digest"), none.alias("key"), none.alias("claim"))


def _roots(rounds: list[DataFrame]) -> DataFrame:
    """(tree, root) of all trees."""
    out = None
    for r in rounds:
        done = r.where(F.col("size") <= BLOCK).select("tree", "root")
        out = done if out is None else out.unionByName(done)
    return out


def _nodes_above(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            paths = [_pack(p) + row["path"] for p in _paths(row["payload"], row["n"], row["height"])]
            first = row["block"] * BLOCK
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["tree"]] * row["n"]), pa.array(range(first, first + row["n"]), pa.int64()), pa.array(paths),
                    pa.array([row["subroot"]] * row["n"]), pa.array([row["top"]] * row["n"]), pa.array(row["keys"] or [None] * row["n"], pa.string()),
                ],
                names=["tree", "block", "path", "subroot", "top", "key"],
            )


_ABOVE = "tree string, block long, path string, subroot string, top string, key string"


def _with_paths(rounds: list[DataFrame], trees: DataFrame) -> DataFrame:
    """The lowest round's blocks with what leads from each to the top; ``trees``: (tree, path, subroot, top)."""
    below = None
    for r in reversed(rounds):
        above = r.where(F.col("size") <= BLOCK).select("tree", "block").join(trees, "tree")
        if below is not None:
            above = above.unionByName(below.mapInArrow(_nodes_above, _ABOVE).drop("key"))
        below = r.join(stored(above, "above"), ["tree", "block"])
    return below


# --- manifest ----------------------------------------------------------------------------------


def _field(value: Column) -> Column:
    value = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf(text: Column, *fields: Column) -> Column:
    return F.sha2(F.concat(*[_field(f) for f in fields], _field(text)), 256)


@dataclass
class Manifest:
    """Rounds of blocks of the languages' trees, and of the tree over their roots."""

    rows: list[DataFrame]
    roots: list[DataFrame]


def build(docs: DataFrame, path: str | None = None, claim: Column | None = None) -> Manifest:
    """Write the manifest of ``docs`` under ``path``. ``claim``: another digest of each row, kept beside its leaf to be checked against the tree."""
    path = path or fresh(docs.sparkSession, "manifest")
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    own = leaf(F.col("text"), F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"))
    # The digests are stored first: only they are shuffled, and no text is hashed twice.
    rows = stored(docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("id"), own.alias("digest"), F.coalesce(claim, own).alias("claim") if claim is not None else own.alias("claim")), "leaves")
    rows = rows.withColumn("key", F.col("id").cast("string"))
    by_lang = _forest(_ranked(rows, "id", "digest"), f"{path}/rows")
    tops = _roots(by_lang).select(F.lit("").alias("tree"), F.col("root").alias("digest"), F.col("tree").alias("key"), F.col("root").alias("claim"))
    return Manifest(by_lang, _forest(_ranked(stored(tops, "tops"), "key"), f"{path}/roots"))


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            above, out = _unpack(row["path"]), []
            rest = "".join(others for _, others in above).encode()
            nodes = np.frombuffer(row["payload"], np.uint8).reshape(-1, 32)
            flat = nodes[_addresses(row["height"], row["height"] + 1)[: row["n"]]].tobytes().hex()
            for i, (key, claim, path) in enumerate(zip(row["keys"], row["claims"], _paths(row["payload"], row["n"], row["height"]), strict=True)):
                proof = hashlib.sha256("".join(others for _, others in path).encode() + rest).hexdigest()
                out.append((key, flat[64 * i : 64 * i + 64], row["subroot"], row["top"], proof, fold(fold(claim, path), above)))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out, strict=True)], names=["key", "leaf", "subroot", "root", "proof_sha256", "folded_root"])


def check(manifest: Manifest) -> DataFrame:
    """Every row's proof, and the root that its claim leads to: key, leaf, subroot, root, proof_sha256, folded_root."""
    top = _roots(manifest.roots).select("tree", F.lit("").alias("path"), F.lit("").alias("subroot"), F.col("root").alias("top"))
    tops = _with_paths(manifest.roots, top).mapInArrow(_nodes_above, _ABOVE).drop("tree", "block", "subroot").withColumnRenamed("key", "tree")
    trees = stored(tops.join(_roots(manifest.rows).withColumnRenamed("root", "subroot"), "tree"), "trees")
    found = _with_paths(manifest.rows, trees)
    return found.mapInArrow(_checked, "key string, leaf string, subroot string, root string, proof_sha256 string, folded_root string")


def report(docs: DataFrame) -> DataFrame:
    """Build the manifest and check it against rows of which a third, by the crc32 of the id, has its letters A-Z lower-cased.

    doc_id, leaf, subroot, root, proof_sha256, folded_root, verified. Rows without doc_id are never tampered with.
    """
    docs = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), "n_chars", F.col("text").cast("string").alias("text"))
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.translate("text", _UPPER, _LOWER))
    claim = F.when(tampered.isNotNull(), leaf(tampered, F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars")))
    rows = check(build(docs, claim=claim))
    return rows.select(F.col("key").cast("long").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
