"""Near-duplicate join on word shingles by parity sketches.

Two sets of sizes a and b with a Jaccard similarity of 0.75 or more differ in at most ``d = (a + b) / 7`` shingles.

* **Sketches.** A shingle's hash flips one bit of its document's sketch. Shared shingles cancel out, so the
  Hamming distance of two sketches is at most the number of shingles in which the sets differ.
* **Pigeonholes.** For documents of a size band (a factor of two; those that can match the next band take part there too)
  shingles are dealt to k blocks, and the XOR of a block's hashes is its sketch. A difference spoils one block. A document
  with more than d blocks that are not empty thus shares one of them, with all it holds, with each partner not larger than itself. k is chosen for each
  band so that this holds for *every* document in it; the coarsest of a few block sizes that does is used.
* **Blocks that many documents share** (a passage copied into them) are *hot*. Where a document has more than d blocks that are not hot,
  its pairs meet in one of those, and its hot blocks are not needed. The others need so many of their hot blocks that the sum is more
  than d, and their partners bring as few, by the same order (prefixes on both sides). These few documents (a large group of near copies,
  mostly) are compared with a leader of each hot block; what is still unconnected with its nearest members, and the rest with all that may link.
* **Counting.** A link spoils at most d of the larger document's blocks, so the pair shares the others. Pairs that share fewer
  (a passage, mostly) go before any sketch is sent.
* **Verification.** Candidates whose sketches are too far apart are dropped; of the rest the whole sets are compared.

Documents with equal sets are one node from the start; a task drops repeats of a node before it sends anything.
Block keys travel sorted, as differences, in compressed runs, one run for a task and bucket; a task also keeps back what is hot in itself, so
that no bucket gets more than a few keys of a hot block from a task. Sets are known by 64-bit hashes.

No pair is lost: any link between different texts is found or lies inside a component that verified links already connect.
A document without words has no set, and is a component of its own. Rows without doc_id take part; they get the smallest
doc_id of their component, or null. Repeated rows are copies.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from larder.llm import arrays as A
from larder.llm.components import components
from larder.llm.shared import small, stored

WORDS = 5
HOT = 32  # a block sketch shared by more documents is hot
TILE = 4096
NEAREST = 3  # partners of a straggler in the first of two rounds
EARLY = 4  # blocks of a member that this round looks at
#: Shingles per block for a document at the top of its band, coarsest first; 0 gives every shingle its own.
PER_BLOCK = (2.0, 1.5, 1.0, 0.5, 0.25, 0.1, 0.0)
ALL_LEVELS = (1 << len(PER_BLOCK)) - 1
BUCKET_KEYS = 1_000_000
FLUSH_KEYS = 600_000
BROADCAST_ROWS = 500_000


# --- sets and sketches of a batch ------------------------------------------------------------


class Sets:
    """Distinct shingles of the texts of a slice: hashes in order within a text, and the text of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = A.LOWER[data]
        rows = len(offsets) - 1
        starts, ends, text = A.words(data, offsets, A.NOT_SPACE)
        hashes = A.span_hashes(data, starts, ends)
        n_words = A.counts(text, rows)
        value, at = A.windows(hashes, text, WORDS)
        owner = text[at]
        few = np.flatnonzero((n_words > 0) & (n_words < WORDS))
        if len(few):
            first = np.cumsum(n_words) - n_words
            whole = np.array([_run(hashes[first[i] : first[i] + n_words[i]]) for i in few], np.uint64)
            value, owner = np.concatenate([value, whole]), np.concatenate([owner, few])
        order = np.lexsort((value, owner))
        value, owner = value[order], owner[order]
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        self.rows, self.value, self.owner = rows, value[new], owner[new]
        self.n = A.counts(self.owner, rows)
        self.first = np.cumsum(self.n) - self.n
        full = self.n > 0
        node = np.zeros(rows, np.uint64)
        if full.any():
            at = self.first[full]
            xor = np.bitwise_xor.reduceat(A.mix(self.value, 1), at)
            total = np.add.reduceat(A.mix(self.value, 2), at)
            node[full] = A.mix(xor ^ A.mix(total, 4) ^ self.n[full].astype(np.uint64))
        self.node = node.view(np.int64)

    def bands(self) -> np.ndarray:
        return np.frexp(np.maximum(self.n, 1))[1] - 1

    def sketches(self) -> list[bytes]:
        """Two to four bits per shingle, a power of two, 64 at least."""
        bits = np.maximum(1 << (self.bands() + 2), 64)
        first = np.cumsum(bits) - bits
        place = first[self.owner] + (A.mix(self.value, 5) & (bits[self.owner] - 1).astype(np.uint64)).astype(np.int64)
        flips = np.bincount(place, minlength=int(bits.sum())) & 1
        packed = np.packbits(flips.astype(np.uint8), bitorder="little").tobytes()
        return [packed[a // 8 : (a + b) // 8] for a, b in zip(first, bits, strict=True)]

    def blocks(self, band: np.ndarray, level: np.ndarray) -> np.ndarray:
        """Block of each shingle, for a band and level given per text."""
        mixed = A.mix(self.value ^ A.mix(band[self.owner].astype(np.uint64), 11), 13)
        k = n_blocks(band, level)[self.owner]
        return np.where(k > 0, (mixed >> np.uint64(1)) % np.maximum(k, 1).astype(np.uint64), mixed >> np.uint64(1)).astype(np.int64)


def _run(hashes: np.ndarray) -> int:
    value = np.uint64(len(hashes))
    with np.errstate(over="ignore"):
        for h in hashes:
            value = (value ^ (value >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) + h
    return value


def n_blocks(band: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Blocks at a band and level; 0 for one block to each shingle."""
    per = np.array(PER_BLOCK)[level]
    return np.where(per > 0, np.maximum(8, np.ldexp(1.0, band + 1) / np.where(per > 0, per, 1)), 0).astype(np.int64)


def needed(n: np.ndarray) -> np.ndarray:
    """Blocks a document must have so that one is shared with any partner not larger than itself."""
    return 2 * n // 7 + 1


def levels(sets: Sets) -> np.ndarray:
    """The levels of its band at which each document has enough blocks, a bit for each. The last one, a block to each shingle, always has."""
    out = np.full(sets.rows, 1 << (len(PER_BLOCK) - 1))
    todo = sets.n > 0
    band = sets.bands()
    if not todo.any():
        return np.full(sets.rows, ALL_LEVELS)
    for level in range(len(PER_BLOCK) - 1):
        at = np.full(sets.rows, level)
        k = np.where(todo, n_blocks(band, at), 0)
        first = np.cumsum(k) - k
        taken = np.zeros(int(k.sum()) + 1, bool)
        taken[first[sets.owner] + sets.blocks(band, at)] = True
        filled = np.concatenate([[0], np.cumsum(taken)])
        out[todo & (filled[first + k] - filled[first] >= needed(sets.n))] |= 1 << level
    out[~todo] = ALL_LEVELS
    return out


def coarsest(bits: int) -> int:
    return (bits & -bits).bit_length() - 1


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, data, offsets in A.slices(batch.column("text")):
            s = Sets(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(row, s.rows), pa.array(s.n), pa.array(s.node), pa.array(s.bands(), pa.int32()),
                    pa.array(levels(s), pa.int32()), pa.array(s.sketches(), pa.binary()),
                ],
                names=["doc_id", "n", "node", "band", "levels", "sketch"],
            )


# --- block keys -------------------------------------------------------------------------------


def _squeeze(x: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _expand(raw: bytes, kind: str) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(flat.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


_PARCEL = pa.schema([("bucket", pa.int32()), ("hot", pa.bool_()), *((x, pa.binary()) for x in ("key", "doc", "own", "node", "n", "slack"))])
_PARCEL_DDL = "bucket int, hot boolean, key binary, doc binary, own binary, node binary, n binary, slack binary"


class _Parcels:
    """Keys of a task, until they are sent."""

    def __init__(self, levels_of: dict[int, int], buckets: int):
        top = max(levels_of, default=0) + 2
        self.level = np.array([levels_of.get(b, 0) for b in range(top + 1)])
        self.buckets = buckets
        self.clear()

    def clear(self) -> None:
        self.seen: set[int] = set()
        self.key, self.doc, self.own, self.node, self.n, self.slack = [], [], [], [], [], []
        self.held = 0

    def add(self, s: Sets) -> None:
        fresh = np.zeros(s.rows, bool)
        for i, (node, n) in enumerate(zip(s.node.tolist(), s.n.tolist(), strict=True)):
            if n and node not in self.seen:
                self.seen.add(node)
                fresh[i] = True
        number = np.cumsum(fresh) - 1 + sum(map(len, self.node))
        band, slack = s.bands(), np.zeros(s.rows, np.int64)
        for own in (True, False):
            take = fresh if own else fresh & (4 * s.n >= 3 * (1 << (band + 1)))
            at = band + (not own)
            pick = np.flatnonzero(take[s.owner])
            if not len(pick):
                continue
            owner, block = s.owner[pick], s.blocks(at, self.level[np.minimum(at, len(self.level) - 1)])[pick]
            order = np.lexsort((block, owner))
            owner, block = owner[order], block[order]
            new = np.ones(len(order), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (block[1:] != block[:-1])
            start = np.flatnonzero(new)
            xor = np.bitwise_xor.reduceat(A.mix(s.value[pick][order], 6), start)
            owner, block = owner[start], block[start]
            where = A.mix(block.astype(np.uint64) ^ A.mix(at[owner].astype(np.uint64), 7), 8)
            self.key.append(A.mix(xor ^ where, 9))
            self.doc.append(number[owner].astype(np.uint32))
            self.own.append(np.full(len(owner), own, np.uint8))
            self.held += len(owner)
            if own:
                slack = A.counts(owner, s.rows) - needed(s.n)
        self.node.append(s.node[fresh])
        self.n.append(s.n[fresh].astype(np.int32))
        self.slack.append(slack[fresh].astype(np.int32))

    def send(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        key, doc, own = np.concatenate(self.key), np.concatenate(self.doc), np.concatenate(self.own)
        node, n, slack = np.concatenate(self.node), np.concatenate(self.n), np.concatenate(self.slack)
        self.clear()
        bucket = ((key >> np.uint64(32)) * np.uint64(self.buckets)) >> np.uint64(32)
        key = (bucket << np.uint64(32)) | (key & np.uint64(0x3FFFFFFF))  # 30 bits in a bucket; what is equal by chance is sorted out by verification
        order = np.argsort(key, kind="stable")
        key, doc, own = key[order], doc[order], own[order]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        run = np.diff(np.append(start, len(key)))
        # Of a block that is hot in this task alone, so many keys go on that the bucket sees it is hot; the rest is told apart here.
        nth = np.arange(len(key)) - np.repeat(start, run)
        spare = nth > HOT
        for part, (at, more) in enumerate(((np.flatnonzero(~spare), False), (np.flatnonzero(spare), True))):
            if not len(at):
                continue
            # Spare keys are whole numbers without a bucket of their own, dealt out evenly.
            dealt = (np.arange(len(at)) // TILE + int(key[0] % 997)) % self.buckets if more else (key[at] >> np.uint64(32)).astype(np.int64)
            o = np.argsort(dealt, kind="stable")
            at, dealt = at[o], dealt[o]
            cuts = np.flatnonzero(np.concatenate([[True], dealt[1:] != dealt[:-1]]))
            for a, b in zip(cuts, np.append(cuts[1:], len(at)), strict=True):
                rows = at[a:b]
                # Nodes in order, as differences: a run then names each in fewer bits.
                nodes, docs, local = np.unique(node[doc[rows]].view(np.uint64), return_index=True, return_inverse=True)
                docs = doc[rows[docs]]
                step = np.diff(key[rows] if more else key[rows] & np.uint64(0xFFFFFFFF), prepend=np.uint64(0))
                yield pa.RecordBatch.from_pylist(
                    [{
                        "bucket": int(dealt[a]), "hot": more, "key": _squeeze(step if more else step.astype(np.uint32)), "doc": _squeeze(local.astype(np.uint32)),
                        "own": _squeeze(own[rows]), "node": _squeeze(np.diff(nodes, prepend=np.uint64(0))), "n": _squeeze(n[docs]), "slack": _squeeze(slack[docs]),
                    }], schema=_PARCEL,
                )


def _keys(levels_of: dict[int, int], buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parcels = _Parcels(levels_of, buckets)
        for batch in batches:
            for _, data, offsets in A.slices(batch.column("text")):
                parcels.add(Sets(data, offsets))
                if parcels.held > FLUSH_KEYS:
                    yield from parcels.send()
        yield from parcels.send()
        A.tidy()

    return run


_MET = pa.schema([("kind", pa.int8()), ("a", pa.int64()), ("b", pa.int64()), ("c", pa.int64()), ("spare", pa.int64()), ("keys", pa.binary()), ("nodes", pa.binary()), ("own", pa.binary())])
_MET_DDL = "kind byte, a long, b long, c long, spare long, keys binary, nodes binary, own binary"


def _met(columns: dict) -> pa.Table:
    rows = len(next(iter(columns.values())))
    return pa.table([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in _MET], schema=_MET)


def _hot_rows(key, node, own, slack) -> list[pa.Table]:
    """Counts of the hot blocks of documents in their own band, and the blocks' members."""
    mine = own > 0
    nodes, place = np.unique(node[mine], return_inverse=True)
    spare = np.zeros(len(nodes), np.int64)
    spare[place] = slack[mine]
    out = [_met({"kind": np.full(len(nodes), 1, np.int8), "a": nodes, "c": np.bincount(place, minlength=len(nodes)), "spare": spare})]
    for at in range(0, len(key), 65_536):
        part = slice(at, at + 65_536)
        out.append(_met({"kind": [2], "keys": [key[part].astype(np.int64).tobytes()], "nodes": [node[part].tobytes()], "own": [own[part].tobytes()]}))
    return out


def _meet(table: pa.Table) -> pa.Table:
    """All keys of a bucket: pairs from blocks that are not hot, and what hot blocks hold."""
    keys, nodes, owns, sizes, slacks, out = [], [], [], [], [], []
    for row in table.to_pylist():
        doc, own, node, n, slack = (_expand(row[c], t) for c, t in (("doc", "<u4"), ("own", "<u1"), ("node", "<u8"), ("n", "<i4"), ("slack", "<i4")))
        node = np.cumsum(node, dtype=np.uint64).view(np.int64)
        key = np.cumsum(_expand(row["key"], "<u8" if row["hot"] else "<u4"), dtype=np.uint64)
        if row["hot"]:
            out += _hot_rows(key, node[doc], own, slack[doc])
            continue
        keys.append(key | np.uint64(row["bucket"] << 32))
        nodes.append(node[doc])
        owns.append(own)
        sizes.append(n[doc])
        slacks.append(slack[doc])
    if keys:
        key, node, own, n, slack = (np.concatenate(x) for x in (keys, nodes, owns, sizes, slacks))
        order = np.argsort(key)
        lone = np.ones(len(key) + 1, bool)
        lone[1:-1] = key[order[1:]] != key[order[:-1]]
        order = order[~(lone[1:] & lone[:-1])]  # a key met once pairs nothing
        order = order[np.lexsort((node[order], key[order]))]
        key, node, own, n, slack = key[order], node[order], own[order], n[order], slack[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        key, node, own, n, slack = key[new], node[new], own[new], n[new], slack[new]
        if len(key):
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            run = np.diff(np.append(start, len(key)))
            hot = np.repeat(run > HOT, run)
            if hot.any():
                out += _hot_rows(key[hot], node[hot], own[hot], slack[hot])
            key, node, own, n, slack = key[~hot], node[~hot], own[~hot], n[~hot], slack[~hot]
            a, b, spare = [], [], []
            for step in range(1, min(HOT, len(key))):
                low = np.flatnonzero(key[step:] == key[:-step])
                if not len(low):
                    break
                high = low + step
                close = (4 * np.minimum(n[low], n[high]) >= 3 * np.maximum(n[low], n[high])) & ((own[low] | own[high]) > 0)
                low, high = low[close], high[close]
                # The larger one first; of two of one size, that with the smaller number.
                x = np.where((n[low] > n[high]) | ((n[low] == n[high]) & (node[low] < node[high])), low, high)
                a.append(node[x])
                b.append(node[low + high - x])
                spare.append(slack[x])
            if a:
                a, b, spare = np.concatenate(a), np.concatenate(b), np.concatenate(spare)
                order = np.lexsort((b, a))
                a, b, spare = a[order], b[order], spare[order]
                first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.zeros(0, np.int64)
                out.append(_met({"kind": np.zeros(len(first), np.int8), "a": a[first], "b": b[first], "c": np.diff(np.append(first, len(a))), "spare": spare[first]}))
    A.tidy()
    return pa.concat_tables(out) if out else _MET.empty_table()


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(row["keys"], np.int64)), pa.array(np.frombuffer(row["nodes"], np.int64)), pa.array(np.frombuffer(row["own"], np.uint8) > 0)],
                names=["key", "node", "own"],
            )


# --- verification -----------------------------------------------------------------------------


def _folded(sketch: np.ndarray, size: int) -> np.ndarray:
    while len(sketch) > size:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


def distance(a: bytes, b: bytes) -> int:
    """Hamming distance of two sketches; the longer one is folded to the shorter one's length."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    size = min(len(x), len(y))
    return int(np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum())


@F.arrow_udf(BooleanType())
def _may_link(x: pa.Array, y: pa.Array, n: pa.Array, m: pa.Array) -> pa.Array:
    limit = (n.to_numpy() + m.to_numpy()) // 7
    return pa.array([distance(a, b) <= d for a, b, d in zip(x.to_pylist(), y.to_pylist(), limit, strict=True)], pa.bool_())


@F.arrow_udf(BooleanType())
def _linked(x: pa.Array, y: pa.Array) -> pa.Array:
    out = []
    for a, b in zip(x, y, strict=True):
        a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
        both = len(np.intersect1d(a, b, assume_unique=True))
        out.append(100 * both >= 75 * (len(a) + len(b) - both))
    return pa.array(out, pa.bool_())


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, data, offsets in A.slices(batch.column("text")):
            s = Sets(data, offsets)
            parts = np.split(s.value, (s.first + s.n)[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(s.node), pa.array([p.tobytes() for p in parts], pa.binary())], names=["node", "shingles"])


class _Verifier:
    def __init__(self, docs: DataFrame, reps: DataFrame):
        self.docs, self.reps = docs, reps

    def near(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) whose sketches are not too far apart."""
        near = pairs.distinct()
        for end in ("a", "b"):
            near = near.join(self.reps.select(F.col("node").alias(end), F.col("sketch").alias(f"sketch_{end}"), F.col("n").alias(f"n_{end}")), end)
        return stored(near.where(_may_link("sketch_a", "sketch_b", "n_a", "n_b")).select("a", "b"), "near")

    def judged(self, near: DataFrame) -> DataFrame:
        """(a, b, linked) of pairs (a, b), by their whole sets."""
        nodes = near.select(F.col("a").alias("node")).unionByName(near.select(F.col("b").alias("node"))).distinct()
        ids = self.reps.join(nodes, "node", "left_semi").select(F.col("rep").alias("rep_id"), F.col("node").alias("want"))
        # Bounded by the check; beyond it Spark joins by shuffling.
        wanted = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
        texts = self.docs.join(wanted.select("rep_id"), F.col("doc_id").eqNullSafe(F.col("rep_id")), "left_semi").select("text")
        sets = texts.mapInArrow(_sets, "node long, shingles binary").join(ids.select(F.col("want").alias("node")), "node", "left_semi")
        sets = stored(sets.dropDuplicates(["node"]), "sets")
        both = near.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
        both = both.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
        return stored(both.select("a", "b", _linked("x", "y").alias("linked")), "judged")

    def links(self, pairs: DataFrame) -> DataFrame:
        """(u, v) of the pairs (a, b) that link."""
        return self.judged(self.near(pairs)).where("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))


def _nearest(most: int | None):
    """For each straggler of a tile its ``most`` nearest members, or all, that may link and are not connected with it yet."""

    def run(table: pa.Table) -> pa.Table:
        side, asks = (table[c].to_numpy(zero_copy_only=False) for c in ("straggler", "asks"))
        node, root, n = (table[c].to_numpy() for c in ("node", "root", "n"))
        sketches = [np.frombuffer(x, np.uint64) for x in table["sketch"].to_pylist()]
        width = np.array([len(x) for x in sketches])
        # Members by the width of their sketches, folded to each width that is met.
        kinds = [x for x in (np.flatnonzero(~side & (width == w)) for w in np.unique(width)) if len(x)]
        flat = {(k, w): np.stack([_folded(sketches[j], w) for j in at]) for k, at in enumerate(kinds) for w in np.unique(width) if w <= width[at[0]]}
        out = []
        for i in np.flatnonzero(side):
            found, distance = [], []
            for k, members in enumerate(kinds):
                size = min(width[i], width[members[0]])
                may = (asks[members] | asks[i]) & (root[members] != root[i]) & (4 * np.minimum(n[members], n[i]) >= 3 * np.maximum(n[members], n[i]))
                may = np.flatnonzero(may)
                far = np.bitwise_count(flat[k, size][may] ^ _folded(sketches[i], size)).sum(axis=1)
                fit = far <= (n[members[may]] + n[i]) // 7
                found.append(node[members[may[fit]]])
                distance.append(far[fit])
            found, distance = np.concatenate(found), np.concatenate(distance)
            found = found[np.lexsort((found, distance))[:most]]
            out.append(np.stack([np.minimum(found, node[i]), np.maximum(found, node[i])], axis=1))
        both = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), np.int64)
        return pa.table([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    return run


def _hot_counts(met: DataFrame) -> DataFrame:
    """Hot blocks of each document that has any (repeats of a document may count twice), and how many blocks it can do without."""
    counts = met.where("kind = 1").groupBy("a").agg(F.sum("c").alias("hot"), F.max("spare").alias("slack"))
    return stored(counts.select(F.col("a").alias("node"), "hot", "slack"), "hot")


def _cold_pairs(met: DataFrame, hot: DataFrame) -> DataFrame:
    """Pairs (a, b) that share as many blocks that are not hot as a link asks of the larger one, a.

    A link leaves more than ``slack`` of its blocks whole, of which the hot ones are not counted here. Two blocks of a document whose keys
    are equal by chance count once, so a tenth and two blocks may be missing.
    """
    pairs = met.where("kind = 0").groupBy("a", "b").agg(F.sum("c").alias("shared"), F.max("spare").alias("slack"))
    pairs = pairs.join(hot.select(F.col("node").alias("a"), "hot"), "a", "left")
    return pairs.where(10 * (F.col("shared") + 2) > 9 * (F.col("slack") - F.coalesce("hot", F.lit(0)))).select("a", "b")


def _hot_members(met: DataFrame, hot: DataFrame, reps: DataFrame) -> DataFrame:
    """(key, node, asks, early) of the hot blocks in which pairs must meet that share no other block.

    Such a pair shares more than ``slack`` hot blocks, by the larger one's count, and by the smaller one's all of its blocks but a third of its
    size. Taken in one order for all, that of the keys, the first shared block is thus among the first ``ask`` of the larger one and among the
    first ``give`` of the smaller one, if that is in its own band; no others are kept. Documents with no block to give are in no such pair.
    """
    n = F.col("n")
    ask, give = F.col("hot") - F.col("slack"), F.col("hot") - F.col("slack") - F.floor(2 * n / 7) + F.floor(n / 3)
    roles = hot.join(reps.select("node", "n"), "node").select("node", "n", ask.alias("ask"), give.alias("give")).where("give > 0")
    members = met.where("kind = 2").select("keys", "nodes", "own").mapInArrow(_members, "key long, node long, own boolean").distinct()
    members = stored(members, "members")
    # A document's list is as long as its own text at most.
    lists = members.where("own").groupBy("node").agg(F.array_sort(F.collect_list("key")).alias("keys")).join(roles, "node")
    lists = lists.withColumn("keys", F.slice("keys", 1, F.col("give").cast("int")))
    first = lists.select("node", "n", "ask", F.posexplode("keys").alias("nth", "key"))
    first = stored(first.select("key", "node", "n", (F.col("nth") < F.col("ask")).alias("asks"), (F.col("nth") < EARLY).alias("early")), "first")
    # Sizes of the documents that ask for a block: partners are not larger, nor less than three quarters.
    asked = stored(first.where("asks").groupBy("key").agg(F.min("n").alias("low"), F.max("n").alias("high")), "asked")
    below = members.where("NOT own").join(asked.select("key"), "key", "left_semi").join(reps.select("node", "n"), "node")
    every = first.unionByName(below.select("key", "node", "n", F.lit(False).alias("asks"), F.lit(False).alias("early")))
    return stored(every.join(asked, "key").where("n <= high AND 4 * n >= 3 * low").select("key", "node", "asks", "early"), "members")


def _straggling(members: DataFrame, roots: DataFrame) -> DataFrame:
    """The members of blocks of several roots, with the block's most frequent root and in how many tiles its members, and those of other roots, go."""
    rooted = stored(members.join(roots, "node", "left").select("key", "node", "asks", F.coalesce("root", "node").alias("root")), "rooted")
    per = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("m"))
    main = per.groupBy("key").agg(F.max_by("root", F.struct("m", "root")).alias("main"), F.sum("m").alias("all"), F.count(F.lit(1)).alias("roots"), F.max("m").alias("m"))
    parts = main.where("roots > 1").select("key", "main", F.ceil(F.col("all") / TILE).alias("tiles"), F.ceil((F.col("all") - F.col("m")) / TILE).alias("loose_tiles"))
    return rooted.join(small(parts), "key")


def _candidates(rows: DataFrame, reps: DataFrame, most: int | None) -> DataFrame:
    """(a, b): partners of every member that is not of its block's most frequent root, from tiles against tiles of the block."""
    rows = rows.join(reps.select("node", "n", "sketch"), "node")
    spread = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    tile = rows.withColumn("t", F.pmod(F.xxhash64("node"), "tiles")).withColumn("s", F.explode(spread(F.col("loose_tiles")))).withColumn("straggler", F.lit(False))
    single = rows.where("root <> main").withColumn("s", F.pmod(F.xxhash64("node"), "loose_tiles")).withColumn("t", F.explode(spread(F.col("tiles")))).withColumn("straggler", F.lit(True))
    tiles = tile.unionByName(single).select("key", "t", "s", "straggler", "asks", "node", "root", "n", "sketch")
    return stored(tiles.groupBy("key", "t", "s").applyInArrow(_nearest(most), "a long, b long").distinct(), "candidates")


def _hot_links(met: DataFrame, hot: DataFrame, reps: DataFrame, verifier: _Verifier, links: DataFrame) -> DataFrame:
    """Links that only hot blocks can show, added to what ``links`` connects.

    All members are compared with a leader of their block. Of what is then not connected with most of a block, each member
    is compared with its few nearest ones, which connects nearly all that are connected at all, however large the group is; what links is contracted.
    Those that are still apart are compared with every member that their sketches leave possible.
    """
    if hot.where("hot > slack").isEmpty():
        return links
    members = _hot_members(met, hot, reps)
    rank = F.struct(F.xxhash64("node").alias("h"), "node")
    leaders = members.groupBy("key").agg(F.min_by("node", rank).alias("leader"))
    pairs = members.join(small(leaders), "key").where("node <> leader")
    pairs = pairs.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"))
    found = verifier.links(pairs)
    # The nearest ones are looked for in the first few blocks of each member, where those of its group are found as well; all of them in all blocks.
    for most, where in ((NEAREST, members.where("early")), (None, members)):
        roots = stored(components(links.unionByName(found)), "roots")
        links = roots.where("node <> root").select(F.col("root").alias("u"), F.col("node").alias("v"))
        pairs = _candidates(_straggling(where, roots), reps, most)
        found = verifier.judged(pairs).where("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))
    return links.unionByName(found)


# --- the join ---------------------------------------------------------------------------------


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text); any other columns do not matter."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    nodes = stored(docs.mapInArrow(_nodes, "doc_id long, n long, node long, band int, levels int, sketch binary"), "nodes")
    reps = nodes.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    reps = stored(reps, "reps")
    # One row per band, of which there are as many as a number has bits.
    bands = nodes.where("n > 0").groupBy("band").agg(F.bit_and("levels").alias("levels"), F.sum("n").alias("n")).collect()
    level = {r["band"]: coarsest(r["levels"]) for r in bands}
    buckets = max(1, round(sum(r["n"] for r in bands) * 0.8 / BUCKET_KEYS), min(24, sum(r["n"] for r in bands) // 100_000))
    keys = docs.select("text").mapInArrow(_keys(level, buckets), _PARCEL_DDL)
    met = stored(keys.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_meet, _MET_DDL), "met")
    verifier = _Verifier(docs, reps)
    hot = _hot_counts(met)
    links = verifier.links(_cold_pairs(met, hot))
    links = _hot_links(met, hot, reps, verifier, links)
    named = reps.select("node", "rep").join(components(links), "node", "left").select("node", "rep", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    found = stored(named.join(least, "root").select("node", "component_id"), "classes")
    rows = nodes.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("node")).alias("node"))
    rows = rows.join(found, "node", "left")
    return rows.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
