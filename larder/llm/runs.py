"""Periodic runs of words: stretches that repeat a period three times or more.

With period q, word i equals word i + q all along a run, so a run of length L is a *stretch* of L - q such places i.

* **Octaves and tiles.** Periods are taken by octaves, [16, 32), [32, 64) and so on; the lowest holds 1 to 15. For each octave a document is cut into
  tiles of 16 times the octave's *step* m (its least period; 8 in the lowest) or 1,024 words, if that is more, which overlap by 5 m. A tile is solved
  by itself, from its own words: a run may begin before it and end behind it.
* **Boundaries.** Places that m divides are boundaries. A run has at least 2 m places in its stretch, so it holds a boundary b whose next m words come
  again q later. Fingerprints of m words sift all boundaries and periods of an octave in a few numpy steps (equal words have equal fingerprints, so nothing is
  missed); only what they leave is looked at.
* **Z-functions.** There the Z-function of the words from b on says how far the text agrees with itself q later, for all q at once, and whether its first q
  words are themselves repeats of something shorter; the Z-function of the reversed words before b says how far it agrees backwards.
  What the tile's ends cut off is a *fragment*.
* **Stitching.** Fragments are shuffled by document and period; those that touch or overlap are one stretch. The length is tested on the whole.

A text is not shuffled to its tiles: a task makes them from the texts that it reads, tile by tile. Only documents with a fragment send their words on.
A document without words, a null text included, has no run. Rows that share a doc_id, or have none, are documents each. Equal words are known by 64-bit hashes.
"""

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm import arrays as A
from larder.llm.shared import stored

LEAST = 24  # words of a run
TIMES = 3  # periods of a run
LOWEST = 8  # step of the lowest octave
TILE_WORDS = 1024


# --- one document -------------------------------------------------------------------------------


def z_function(s: list[int]) -> list[int]:
    """For each place the length of the longest common prefix of ``s`` and what starts there."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def octaves(n: int) -> Iterator[tuple[int, int, int]]:
    """Step, least and greatest period of the octaves that a document of ``n`` words can have runs of."""
    step, low = LOWEST, 1
    while TIMES * low <= n and n >= LEAST:
        yield step, low, 2 * step - 1
        step, low = 2 * step, 2 * step


class _Boundary:
    """Z-functions at a boundary of a tile: agreement forwards up to the tile's end, and backwards over one step."""

    def __init__(self, words: np.ndarray, b: int, begin: int, end: int, step: int):
        self.ahead = z_function(words[b:end].tolist())
        back = words[max(begin, b - step) : b][::-1].tolist()
        # Reversed: the words before b, a sign that is no word, and all words up to the greatest period behind b.
        upto = min(b + 2 * step, end)
        self.back = z_function([*back, None, *words[max(begin, b - step) : upto][::-1].tolist()])
        self.at = len(back) + 1 + upto - b

    def agrees(self, q: int) -> tuple[int, int]:
        """So many places before, and from, the boundary have an equal word q later."""
        return self.back[self.at - q], self.ahead[q] if q < len(self.ahead) else 0

    def shorter(self, q: int) -> bool:
        """Are the q words from the boundary on, in a run of period q, repeats of something shorter?"""
        return any(q % d == 0 and self.ahead[d] >= q - d for d in range(1, q // 2 + 1))


def solve_tile(words: np.ndarray, begin: int, end: int, step: int, pairs: np.ndarray) -> list[tuple[int, int, int]]:
    """Fragments (period, first place, end) of the stretches of a tile at ``pairs``, (period, boundary) in order."""
    out, known = [], {}
    cuts = np.flatnonzero(np.diff(pairs[:, 0], prepend=-1))
    for a, z in zip(cuts, np.append(cuts[1:], len(pairs)), strict=True):
        q, at = int(pairs[a, 0]), pairs[a:z, 1]
        i = 0
        while i < len(at):
            b = int(at[i])
            if b not in known:
                known[b] = _Boundary(words, b, begin, end, step)
            before, ahead = known[b].agrees(q)
            if ahead >= step and not known[b].shorter(q):
                out.append((q, b - before, b + ahead))
            # Boundaries inside the same stretch say nothing new.
            i = max(i + 1, int(np.searchsorted(at, b + ahead)))
    return out


def fragments(words: np.ndarray, pairs: dict[int, np.ndarray]) -> Iterator[tuple[int, int, int]]:
    """Fragments of a document, octave by octave and tile by tile; ``pairs``: for a step its (period, boundary) rows."""
    for step, found in pairs.items():
        core = max(TILE_WORDS, 16 * step)
        tile = found[:, 1] // core
        order = np.lexsort((found[:, 1], found[:, 0], tile))
        found, tile = found[order], tile[order]
        cuts = np.flatnonzero(np.diff(tile, prepend=-1))
        for a, z in zip(cuts, np.append(cuts[1:], len(tile)), strict=True):
            first = int(tile[a]) * core
            yield from solve_tile(words, max(0, first - step), min(len(words), first + core + 4 * step), step, found[a:z])


# --- texts --------------------------------------------------------------------------------------


def sift(hashes: np.ndarray, first: np.ndarray, n: np.ndarray) -> dict[int, dict[int, np.ndarray]]:
    """For each document and step the (period, boundary) pairs whose next ``step`` words agree.

    ``first`` and ``n``: where a document's words begin among ``hashes``, and how many it has.
    """
    out: dict[int, dict[int, np.ndarray]] = {}
    width, prints = 1, A.mix(hashes)
    most = int(n.max(initial=0))
    for step, low, high in octaves(most):
        while width < step:  # the print of 2 w words from two of w
            prints = A.mix(prints[:-width] * np.uint64(0x9E3779B97F4A7C15) ^ prints[width:]) if len(prints) > width else prints[:0]
            width *= 2
        docs = np.flatnonzero(n >= max(LEAST, TIMES * low))
        # Boundaries of all documents, those only that leave room for the least period.
        count = np.maximum(0, (n[docs] - low - step) // step + 1)
        before = np.cumsum(count) - count
        place = (np.arange(int(count.sum())) - np.repeat(before, count)) * step
        doc = np.repeat(docs, count)
        # In parts, so that boundaries times periods stay within a bounded number of cells.
        rows = max(1, (1 << 21) // (high - low + 1))
        for a in range(0, len(place), rows):
            b, d = place[a : a + rows, None], doc[a : a + rows, None]
            q = np.arange(low, high + 1)[None, :]
            at = first[d] + b
            fits = b + q + step <= n[d]
            hit = fits & (prints[np.minimum(at + q, len(prints) - 1)] == prints[at])
            i, j = np.nonzero(hit)
            if len(i):
                owner, pair = d[i, 0], np.stack([q[0, j], b[i, 0]], axis=1)
                cuts = np.flatnonzero(np.diff(owner, prepend=-1))
                for x, y in zip(cuts, np.append(cuts[1:], len(owner)), strict=True):
                    held = out.setdefault(int(owner[x]), {})
                    held[step] = np.concatenate([held[step], pair[x:y]]) if step in held else pair[x:y]
    return out


def repeating(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """Where the document is made to repeat, and its period: word i >= a becomes word a + (i - a) % p."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    a = h // 10 % n
    return a, 1 + (n - a) // (3 + h // 10 % 8)


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words with a space behind each, and where each ends, its space included."""
    size = ends - starts + 1
    stop = np.cumsum(size)
    out = data[np.minimum(np.repeat(starts - (stop - size), size) + np.arange(int(size.sum())), max(len(data) - 1, 0))]
    out[stop - 1] = 0x20
    return out, stop


_FOUND = pa.schema(
    [
        ("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("collapsed_sha256", pa.string()), ("words", pa.binary()),
        ("fragments", pa.list_(pa.struct([("period", pa.int64()), ("first", pa.int64()), ("stop", pa.int64())]))),
    ]
)
_FOUND_DDL = "row long, doc_id long, n_words long, collapsed_sha256 string, words binary, fragments array<struct<period:long,first:long,stop:long>>"


def _explore(own_repeats: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for row, data, offsets in A.slices(batch.column("text")):
                rows = len(offsets) - 1
                names = batch.column("doc_id").slice(row, rows).to_pylist()
                starts, ends, text = A.words(data, offsets, A.NOT_SPACE)
                n = A.counts(text, rows)
                first = np.cumsum(n) - n
                if own_repeats:
                    source = np.arange(len(starts))
                    for i, name in enumerate(names):
                        if made := repeating(name, int(n[i])):
                            a, p = made
                            source[first[i] + a : first[i] + n[i]] = first[i] + a + np.arange(n[i] - a) % p
                    starts, ends = starts[source], ends[source]
                hashes = A.span_hashes(data, starts, ends)
                found = sift(hashes, first, n)
                line, stop = _joined(data, starts, ends)
                stop = np.concatenate([[0], stop])
                out = []
                for i, name in enumerate(names):
                    at = first[i]
                    words = line[stop[at] : max(stop[at], stop[at + n[i]] - 1)].tobytes()
                    parts = list(fragments(hashes[at : at + n[i]], found[i])) if i in found else []
                    out.append(
                        {
                            "row": row_number, "doc_id": name, "n_words": int(n[i]), "collapsed_sha256": hashlib.sha256(words).hexdigest(),
                            "words": words if parts else None, "fragments": [dict(zip(("period", "first", "stop"), x, strict=True)) for x in parts] or None,
                        }
                    )
                    row_number += 1
                yield pa.RecordBatch.from_pylist(out, schema=_FOUND)

    return run


def stitched(parts: DataFrame) -> DataFrame:
    """(row, start, length, period) of the runs that fragments (row, period, first, stop) make up."""
    order = Window.partitionBy("row", "period").orderBy("first", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = parts.withColumn("new", F.coalesce((F.col("first") > reach).cast("int"), F.lit(1)))
    numbered = marked.withColumn("stretch", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = numbered.groupBy("row", "period", "stretch").agg(F.min("first").alias("start"), F.max("stop").alias("stop"))
    length = F.col("stop") - F.col("start") + F.col("period")
    runs = whole.select("row", "start", length.alias("length"), "period")
    return runs.where((F.col("length") >= LEAST) & (F.col("length") >= TIMES * F.col("period")))


_DONE = "row long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, sha256 string, collapsed string"


def _summary(row: dict, keep_text: bool) -> dict:
    runs = sorted((r["start"], r["period"], r["length"]) for r in row["runs"])
    best = runs[0]
    for r in runs[1:]:  # the first of equal ones has the least start, then period
        if r[2] * best[1] > best[2] * r[1]:
            best = r
    words = row["words"].split(b" ")
    gone = np.zeros(len(words) + 1, np.int64)
    for start, period, length in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    kept = b" ".join([w for w, g in zip(words, np.cumsum(gone[:-1]).tolist(), strict=True) if not g])
    lines = "".join(f"{start},{length},{period}\n" for start, period, length in runs)
    return {
        "row": row["row"], "n_runs": len(runs), "start": best[0], "length": best[2], "period": best[1], "exponent_milli": 1000 * best[2] // best[1],
        "runs_sha256": hashlib.sha256(lines.encode()).hexdigest(), "sha256": hashlib.sha256(kept).hexdigest(), "collapsed": kept.decode() if keep_text else None,
    }


def _summaries(keep_text: bool):
    schema = pa.schema([(x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in _DONE.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 200) for at in range(0, len(batch), 200)):
                yield pa.RecordBatch.from_pylist([_summary(r, keep_text) for r in part.to_pylist()], schema=schema)
        A.tidy()

    return run


def detect(docs: DataFrame, own_repeats: bool = False, keep_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_runs, the run of greatest exponent, digests of all runs and of the text without repeats.

    ``own_repeats`` lets a tenth of the documents, by the crc32 of the id, repeat a part of theirs first. ``keep_text`` adds the text without
    repeats of the documents that have a run (null for others, whose words all stay).
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = stored(docs.mapInArrow(_explore(own_repeats), _FOUND_DDL), "fragments")
    parts = found.where("fragments IS NOT NULL").select("row", F.inline("fragments"))
    runs = stitched(parts)
    # A document's runs are fewer than its words.
    listed = runs.groupBy("row").agg(F.collect_list(F.struct("start", "length", "period")).alias("runs"))
    done = found.where("words IS NOT NULL").select("row", "words").join(listed, "row").mapInArrow(_summaries(keep_text), _DONE)
    rows = found.select("row", "doc_id", "n_words", "collapsed_sha256").join(stored(done, "runs"), "row", "left")
    none = hashlib.sha256(b"").hexdigest()
    columns = [
        "doc_id", "n_words", F.coalesce("n_runs", F.lit(0)).cast("long").alias("n_runs"), "start", "length", "period", "exponent_milli",
        F.coalesce("runs_sha256", F.lit(none)).alias("runs_sha256"), F.coalesce("sha256", "collapsed_sha256").alias("collapsed_sha256"),
    ]
    return rows.select(*columns, *(["collapsed"] if keep_text else []))


def report(docs: DataFrame) -> DataFrame:
    return detect(docs, own_repeats=True)
