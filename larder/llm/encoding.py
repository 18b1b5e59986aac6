"""Token ids of whole Arrow batches, by a table of units that were met before.

Two kinds of public tokenizers cut a text at places that depend on a few bytes only, so that a text's ids are those of
its *units* in a row: a tokenizer that drops white space never joins what a space or line feed parts; a byte-level one
never joins white space to the characters before it. Units are found and looked up in numpy: an open-addressed table of
64-bit hashes leads to an entry, whose bytes are compared with the unit's. Units that are not in the table go to the tokenizers
library once. Other tokenizers get whole texts. The table is emptied when it holds more than ``budget`` bytes.
"""

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from larder.llm import arrays as A

# A pre-tokenizer that lower-cases, drops white space, and cuts letters, digits and symbols apart.
_STEPS = ["NFC", "Replace", "Lowercase"]
_CUT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_PLAIN = re.compile(r"(\n?)( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?%$#*&]*)")

TABLE_BYTES = 64 << 20
#: Texts that are worked on at once.
SLICE_BYTES = 1 << 18
NOT_BREAK = (A.BYTE != 0x20) & (A.BYTE != 0x0A)
_SPACE = ~A.NOT_SPACE
#: Bytes that may end a white-space character beyond ASCII, or are white space to some libraries only.
_DOUBTFUL = np.isin(A.BYTE, [0x1C, 0x1D, 0x1E, 0x1F, *range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF])
#: The bytes before those, in UTF-8: C2 85, C2 A0, E1 9A 80, E2 80 80 and on, E2 81 9F, E3 80 80.
_DOUBTFUL_BEFORE = np.isin(A.BYTE, [0xC2, 0x9A, 0x80, 0x81])


#: The first bytes of eight.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _heads(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first 16 bytes of each unit as two numbers, zero beyond its end."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    eight = np.ndarray(len(data) + 9, "<u8", padded.data, strides=(1,))
    return eight[starts] & _FIRST[np.minimum(sizes, 8)], eight[starts + np.minimum(sizes, 8)] & _FIRST[np.clip(sizes - 8, 0, 8)]


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after another."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


class _Pool:
    """An array that grows at its end."""

    def __init__(self, kind: str):
        self.data, self.used = np.zeros(1024, kind), 0

    def add(self, more: np.ndarray) -> None:
        need = self.used + len(more)
        if need > len(self.data):
            grown = np.zeros(max(need, len(self.data) * 3 // 2), self.data.dtype)
            grown[: self.used] = self.data[: self.used]
            self.data = grown
        self.data[self.used : need] = more
        self.used = need


class Table:
    """Entries (bytes of a unit, its ids), found by hash."""

    def __init__(self, budget: int = TABLE_BYTES):
        self.budget = budget
        self.clear()

    def clear(self) -> None:
        self.slots = np.zeros(1 << 12, np.int32)
        self.hash, self.low, self.high = _Pool("<u8"), _Pool("<u8"), _Pool("<u8")
        self.at, self.size = _Pool("<i4"), _Pool("<i4")
        self.id_at, self.n_ids = _Pool("<i4"), _Pool("<i4")
        self.bytes, self.ids = _Pool("<u1"), _Pool("<u4")

    def full(self) -> bool:
        return self.bytes.used + 4 * self.ids.used + 40 * self.hash.used + 4 * len(self.slots) > self.budget

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Entry of each hash, -1 where there is none."""
        mask = len(self.slots) - 1
        out = np.full(len(hashes), -1, np.int64)
        todo, place = np.arange(len(hashes)), (hashes & np.uint64(mask)).astype(np.int64)
        while len(todo):
            entry = self.slots[place].astype(np.int64) - 1
            used = entry >= 0
            hit = used & (self.hash.data[entry] == hashes[todo])
            out[todo[hit]] = entry[hit]
            on = used & ~hit
            todo, place = todo[on], (place[on] + 1) & mask
        return out

    def _place(self, first: int) -> None:
        mask = len(self.slots) - 1
        entry = np.arange(first, self.hash.used)
        place = (self.hash.data[first : self.hash.used] & np.uint64(mask)).astype(np.int64)
        while len(entry):
            free = self.slots[place] == 0
            self.slots[place[free]] = entry[free] + 1
            on = self.slots[place] != entry + 1
            entry, place = entry[on], (place[on] + 1) & mask

    def add(self, hashes: np.ndarray | None, units: list[bytes], ids: list[np.ndarray]) -> int:
        """Append entries; without hashes they are not found again. The first one's number."""
        first = self.hash.used
        heads = np.frombuffer(b"".join(u[:16].ljust(16, b"\0") for u in units), "<u8").reshape(-1, 2)
        self.low.add(heads[:, 0])
        self.high.add(heads[:, 1])
        for pool, count, values, start, length in (
            # Up to 16 bytes of a unit are in its two numbers already.
            (self.bytes, len(units), [np.frombuffer(u if len(u) > 16 else b"", np.uint8) for u in units], self.at, None),
            (self.ids, len(ids), ids, self.id_at, self.n_ids),
        ):
            n = np.fromiter(map(len, values), np.int64, count)
            start.add(pool.used + np.cumsum(n) - n)
            if length:
                length.add(n)
            pool.add(np.concatenate(values))
        self.size.add(np.fromiter(map(len, units), np.int64, len(units)))
        self.hash.add(np.zeros(len(units), np.uint64) if hashes is None else hashes)
        if hashes is not None:
            if 2 * self.hash.used > len(self.slots):
                self.slots = np.zeros(1 << int(np.ceil(np.log2(4 * self.hash.used))), np.int32)
                self._place(0)
            else:
                self._place(first)
        return first

    def same(self, entry: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Does each entry hold the bytes of its unit? Up to 16 of them are in two numbers."""
        out = (self.size.data[entry] == sizes) & (self.low.data[entry] == low) & (self.high.data[entry] == high)
        long = np.flatnonzero(out & (sizes > 16))
        n = sizes[long]
        if len(long):
            equal = self.bytes.data[_ranges(self.at.data[entry[long]].astype(np.int64), n)] == data[_ranges(starts[long], n)]
            out[long] = np.logical_and.reduceat(equal, np.cumsum(n) - n)
        return out


class Encoder:
    """Ids of whole texts, as the tokenizers library gives them without special tokens added."""

    def __init__(self, path: str, budget: int = TABLE_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        steps = [x.get("type") for x in (made.get("normalizer") or {}).get("normalizers", [])]
        before = made.get("pre_tokenizer") or {}
        cut = before.get("pretokenizers", [{}])
        self.by_word = steps == _STEPS and cut[0].get("pattern") == {"Regex": _CUT} and [x.get("type") for x in cut] == ["Split", "ByteLevel"]
        self.by_space = made.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        self.table = Table(budget)
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.model = self.tokenizer.model
        self.marks: dict[str, list[int]] = {}
        self.spelled = str.maketrans({c: level.pre_tokenize_str(c)[0][0] for c in [" ", *map(chr, range(0xC0, 0x100))]})

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _mark(self, text: str) -> list[int]:
        if text not in self.marks:
            if len(self.marks) > 10_000:
                self.marks.clear()
            self.marks[text] = self._whole([text])[0]
        return self.marks[text]

    def _unit(self, unit: str) -> list[int]:
        """A word of Latin letters, perhaps with a line feed before and punctuation behind, needs the model alone for its letters."""
        m = _PLAIN.fullmatch(unit)
        if not m:
            return self._whole([unit])[0]
        word = m[2].lower() if self.by_word else m[2]
        ids = [x.id for x in self.model.tokenize(word if word.isascii() and word[0] != " " else word.translate(self.spelled))]
        return (self._mark(m[1]) if m[1] else []) + ids + (self._mark(m[3]) if m[3] else [])

    def _encode(self, units: list[bytes]) -> list[np.ndarray]:
        texts = [u.decode() for u in units]
        found = map(self._unit, texts) if self.by_word or self.by_space else self._whole(texts)
        return [np.array(x, np.uint32) for x in found]

    def _units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.by_word:
            return A.words(data, offsets, NOT_BREAK)
        rows = np.flatnonzero(np.diff(offsets))
        if not self.by_space or not len(rows):
            return offsets[rows], offsets[rows + 1], rows
        space = _SPACE[data]
        start = np.zeros(len(data), bool)
        start[1:] = space[1:] & ~space[:-1]
        doubtful = _DOUBTFUL[data[:-1]]
        doubtful[1:] &= _DOUBTFUL_BEFORE[data[:-2]] | (data[1:-1] < 0x80)
        start[1:] &= ~doubtful
        start[offsets[rows]] = True
        starts = np.flatnonzero(start)
        return starts, np.append(starts[1:], len(data)), np.searchsorted(offsets, starts, "right") - 1

    def _entries(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if self.table.full():
            self.table.clear()
        cut = lambda at: [data[a:b].tobytes() for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
        if not (self.by_word or self.by_space):
            units = cut(np.arange(len(starts)))
            return np.arange(len(starts)) + (self.table.add(None, units, self._encode(units)) if units else 0)
        sizes = ends - starts
        low, high = _heads(data, starts, sizes)
        hashes = A.mix(A.mix(low, 21) + A.mix(high, 22) + sizes.astype(np.uint64))
        long = np.flatnonzero(sizes > 16)
        hashes[long] = A.span_hashes(data, starts[long], ends[long])
        entry = self.table.find(hashes)
        new = np.flatnonzero(entry < 0)
        if len(new):
            fresh, at, back = np.unique(hashes[new], return_index=True, return_inverse=True)
            units = cut(new[at])
            entry[new] = self.table.add(fresh, units, self._encode(units)) + back
        odd = np.flatnonzero(~self.table.same(entry, data, starts, sizes, low, high))
        if len(odd):  # two units of one hash
            units = cut(odd)
            entry[odd] = self.table.add(None, units, self._encode(units)) + np.arange(len(odd))
        return entry

    def __call__(self, column: pa.Array, end_id: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For slices of the texts: the first row, the ids of its texts one after another, each with ``end_id`` behind, and how many each has."""
        for row, data, offsets in A.slices(column, SLICE_BYTES):
            rows = len(offsets) - 1
            starts, ends, text = self._units(data, offsets)
            entry = self._entries(data, starts, ends)
            n = self.table.n_ids.data[entry].astype(np.int64)
            lengths = np.bincount(text, n, rows).astype(np.int64) + 1
            ids = np.full(int(lengths.sum()), end_id, np.uint32)
            ids[_ranges(np.cumsum(n) - n + text, n)] = self.table.ids.data[_ranges(self.table.id_at.data[entry].astype(np.int64), n)]
            yield row, ids, lengths


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def located(tokenizer: str) -> str:
    """A tokenizer's file: a path, or the name of one of the public tokenizers, looked for where the code runs."""
    if os.sep in tokenizer:
        return tokenizer
    import public_tokenizers

    return public_tokenizers.path(tokenizer)
