"""Words of whole Arrow batches as numpy arrays, without a Python object per word.

An Arrow string column already holds its texts as one run of UTF-8 bytes. All word classes used here
treat bytes of 0x80 and above alike, so words can be found and hashed on bytes. Hashes have 64 bits.
"""

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BYTE = np.arange(256)
#: Word bytes when words are parted by white space (0x20, 0x09-0x0D).
NOT_SPACE = ~((BYTE == 0x20) | ((BYTE >= 0x09) & (BYTE <= 0x0D)))
#: Word bytes when words are letters, digits and everything beyond ASCII.
ALNUM = ((BYTE >= 0x30) & (BYTE <= 0x39)) | ((BYTE >= 0x41) & (BYTE <= 0x5A)) | ((BYTE >= 0x61) & (BYTE <= 0x7A)) | (BYTE >= 0x80)
LOWER = BYTE.astype(np.uint8)
LOWER[0x41:0x5B] += 0x20

_random = np.random.default_rng(20250101)
_VALUE = _random.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _random.integers(1, 2**63, 4096, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
SLICE_BYTES = 1 << 20


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A well mixed one-to-one image of 64-bit numbers."""
    x = x ^ np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def tidy() -> None:
    """Give freed memory back to the system: Python workers live on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``limit`` bytes (one longer text alone): first row, bytes, offsets. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    rows = len(column)
    if not rows:
        return
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + rows + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < rows:
        stop = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        stop = min(max(stop, at + 1), rows)
        yield at, whole[offsets[at] : offsets[stop]], offsets[at : stop + 1] - offsets[at]
        at = stop
    tidy()


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word, in order."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = kind[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span; spans may be empty."""
    out = np.zeros(len(starts), np.uint64)
    lengths = ends - starts
    full = np.flatnonzero(lengths)
    if len(full):
        n = lengths[full]
        first = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(first, n)
        value = _VALUE[data[np.repeat(starts[full], n) + place]]
        value *= _PLACE[place & 4095]
        # A word longer than the table is told apart by the block a byte lies in.
        if n.max() > 4096:
            value += (place >> 12).astype(np.uint64) * _STEP * value
        out[full] = np.add.reduceat(value, first)
    return mix(out ^ lengths.astype(np.uint64) * _STEP)


def windows(hashes: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every run of ``size`` words within one text."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    last = len(hashes) - size + 1
    out = hashes[:last].copy()
    for k in range(1, size):
        out = (out ^ (out >> np.uint64(29))) * _STEP + hashes[k : last + k]
    at = np.flatnonzero(text[:last] == text[size - 1 :])
    return mix(out[at]), at


def in_text(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes that differ between texts: equal values in two texts no longer meet."""
    return mix(hashes ^ mix(text.astype(np.uint64) + np.uint64(1), 3))


def counts(text: np.ndarray, rows: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(text, weights, rows).astype(np.int64)


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: does it occur twice or more, and is it a later occurrence?"""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    many, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    many[order] = same[1:] | same[:-1]
    later[order] = same[:-1]
    return many, later
