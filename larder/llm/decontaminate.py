"""Benchmark decontamination with a generalised suffix automaton.

All test items, as word sequences, are put into one suffix automaton: a state stands for all runs of words with the same end places,
and its link leads to the longest shorter run with more. A document's words are streamed through it; after each word the state
gives the longest run of the document, ending there, that is in some item. Where that run is ``size`` words or more (or holds a whole shorter item), the
words are hit. States carry the items their runs are in, so the items of a window are read off the state.

Streaming is done only where it can lead to a hit: stretches whose neighbouring words are neighbours in some item, as long as the shortest window.
Elsewhere the automaton would be back at its root. Items are dealt to automata of at most ``shard_words`` words; an automaton
is what is broadcast, so its size is bounded, and more items make more passes over the documents.

Words are lower-cased letters, digits and what lies beyond ASCII. Null has no words.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm import arrays as A
from larder.llm.shared import free

SIZE = 13
SHARD_WORDS = 400_000


@dataclass
class Automaton:
    """``go``: transitions by word number; ``link``, ``length``: per state; ``items``: items with a run of the state."""

    size: int
    go: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    items: list[set[int]] = field(default_factory=lambda: [set()])
    short: dict[int, list[tuple[int, int]]] = field(default_factory=dict)  # state: whole short items (length, item) that are its suffix
    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # sorted hashes; a word's number is its place
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # sorted neighbours
    shortest: int = 0

    def _state(self, length: int, go: dict, link: int) -> int:
        self.go.append(go)
        self.length.append(length)
        self.link.append(link)
        self.items.append(set())
        return len(self.go) - 1

    def _extend(self, last: int, word: int) -> int:
        """The state of an item's run extended by a word, as for one string, but where the run exists it is used again."""
        go, link, length = self.go, self.link, self.length
        if word in go[last]:
            q = go[last][word]
            if length[q] == length[last] + 1:
                return q
            return self._split(last, q, word)
        new = self._state(length[last] + 1, {}, 0)
        p = last
        while p >= 0 and word not in go[p]:
            go[p][word] = new
            p = link[p]
        if p >= 0:
            q = go[p][word]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, q, word)
        return new

    def _split(self, p: int, q: int, word: int) -> int:
        copy = self._state(self.length[p] + 1, dict(self.go[q]), self.link[q])
        self.items[copy] = set(self.items[q])
        self.link[q] = copy
        while p >= 0 and self.go[p].get(word) == q:
            self.go[p][word] = copy
            p = self.link[p]
        return copy

    def _mark(self, state: int, item: int) -> None:
        while state > 0 and item not in self.items[state]:
            self.items[state].add(item)
            state = self.link[state]


def build(items: dict[int, np.ndarray], size: int = SIZE) -> Automaton:
    """The automaton of items given as word hashes."""
    made = Automaton(size)
    filled = {k: v for k, v in items.items() if len(v)}
    if not filled:
        return made
    made.words = np.unique(np.concatenate(list(filled.values())))
    numbered = {k: np.searchsorted(made.words, v) for k, v in filled.items()}
    pairs = [v[:-1].astype(np.int64) * len(made.words) + v[1:] for v in numbered.values()]
    made.pairs = np.unique(np.concatenate(pairs))
    made.shortest = min(size, min(map(len, filled.values())))
    for word_ids in numbered.values():
        last = 0
        for w in word_ids.tolist():
            last = made._extend(last, w)
    # Marking when all states are made: a later split would have to hand marks on.
    for item, word_ids in numbered.items():
        state = 0
        for w in word_ids.tolist():
            state = made.go[state][w]
            made._mark(state, item)
        if len(word_ids) < size:
            made.short.setdefault(state, []).append((len(word_ids), item))
    return made


def stream(made: Automaton, word_ids: list[int]) -> list[tuple[int, int, set[int]]]:
    """(first, behind last, items) of every window met in a run of words known to the automaton, one for each end place."""
    go, link, length, size, short = made.go, made.link, made.length, made.size, made.short
    out, state, run = [], 0, 0
    for place, w in enumerate(word_ids):
        while state and w not in go[state]:
            state = link[state]
            run = length[state]
        if w in go[state]:
            state = go[state][w]
            run += 1
        items: set[int] = set()
        longest = 0
        at = state
        if run >= size:
            while length[link[at]] >= size:
                at = link[at]
            items |= made.items[at]
            longest = size
        if short:
            at = state
            while at > 0:
                for n, item in short.get(at, ()):
                    if n <= run:
                        items.add(item)
                        longest = max(longest, n)
                at = link[at]
        if longest:
            out.append((place + 1 - longest, place + 1, items))
    return out


def hits(made: Automaton, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[list[tuple[int, int, set[int]]]]]:
    """Words of each text, and its windows (in words of the text) with their items."""
    data = A.LOWER[data]
    starts, ends, text = A.words(data, offsets, A.ALNUM)
    rows = len(offsets) - 1
    out: list[list] = [[] for _ in range(rows)]
    n_words = A.counts(text, rows)
    if not len(made.words) or not len(starts):
        return n_words, out
    hashes = A.span_hashes(data, starts, ends)
    number = np.minimum(np.searchsorted(made.words, hashes), len(made.words) - 1)
    known = made.words[number] == hashes
    joined = np.zeros(len(starts), bool)  # does a word follow the one before in some item?
    both = np.flatnonzero(known[1:] & known[:-1] & (text[1:] == text[:-1])) + 1
    if len(made.pairs) and len(both):
        pair = number[both - 1].astype(np.int64) * len(made.words) + number[both]
        at = np.minimum(np.searchsorted(made.pairs, pair), len(made.pairs) - 1)
        joined[both[made.pairs[at] == pair]] = True
    begin = np.flatnonzero(known & ~joined)
    stop = np.append(begin[1:], len(starts))
    # A stretch ends where it is not joined on, also before an unknown word.
    unknown = np.flatnonzero(~known)
    nxt = np.searchsorted(unknown, begin)
    stop = np.minimum(stop, np.append(unknown, len(starts))[nxt])
    word0 = np.cumsum(n_words) - n_words
    for a, b in zip(begin[stop - begin >= made.shortest], stop[stop - begin >= made.shortest], strict=True):
        base = int(a - word0[text[a]])
        for x, y, items in stream(made, number[a:b].tolist()):
            out[text[a]].append((base + x, base + y, items))
    return n_words, out


def _merged(windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(windows):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _without(raw: bytes, spans: list[tuple[int, int]]) -> str:
    """A text without the words of disjoint spans and what lies between those words."""
    data = np.frombuffer(raw, np.uint8)
    starts, ends, _ = A.words(data, np.array([0, len(data)]), A.ALNUM)
    parts, at = [], 0
    for a, b in spans:
        parts.append(raw[at : starts[a]])
        at = ends[b - 1]
    return b"".join([*parts, raw[at:]]).decode()


_FOUND = "struct<n_words:bigint,spans:array<struct<start:bigint,end:bigint>>,items:array<string>,rest:string>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def find(text, model: Broadcast):
    """n_words; hit spans in words; ids (as text) of the items with windows in it; and, if hit, the text without the spans."""

    @F.arrow_udf(_FOUND)
    def run(column: pa.Array) -> pa.Array:
        made, names = model.value
        n, spans, items, rest = [], [], [], []
        for _, data, offsets in A.slices(column):
            n_words, found = hits(made, data, offsets)
            n += n_words.tolist()
            for k, windows in enumerate(found):
                whole = _merged([w[:2] for w in windows])
                spans.append([{"start": a, "end": b} for a, b in whole])
                rest.append(_without(data[offsets[k] : offsets[k + 1]].tobytes(), whole) if whole else None)
                items.append(sorted({names[i] for w in windows for i in w[2] if names[i] is not None}))
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string())), pa.array(rest, pa.string())], names=["n_words", "spans", "items", "rest"])

    # Not to be run anew for the filter and for each column made from it.
    return run.asNondeterministic()(text)


def automata(benchmark: DataFrame, size: int = SIZE, shard_words: int = SHARD_WORDS) -> Iterator[tuple[Automaton, list[str]]]:
    """Automata over the items, each of at most ``shard_words`` words (or one longer item), with the items' ids as text.

    Items arrive on the driver one partition at a time, and one automaton is held at a time. Items without an id are left
    out of the ids, but their words are hit.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in A.slices(batch.column("text")):
                low = A.LOWER[data]
                starts, ends, text = A.words(low, offsets, A.ALNUM)
                value = A.span_hashes(low, starts, ends)
                cuts = np.cumsum(np.bincount(text, minlength=len(offsets) - 1))
                parts = np.split(value, cuts[:-1])
                yield pa.RecordBatch.from_arrays([batch.column("item_id").slice(row, len(parts)), pa.array([p.tobytes() for p in parts], pa.binary())], names=["item_id", "words"])

    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(hashed, "item_id string, words binary")
    items, names, held = {}, [], 0
    for row in rows.toLocalIterator():
        value = np.frombuffer(row["words"], np.uint64)
        if held and held + len(value) > shard_words:
            yield build(items, size), names
            items, names, held = {}, [], 0
        items[len(names)] = value
        names.append(row["item_id"])
        held += len(value)
    yield build(items, size), names


def _overlaps(docs: DataFrame, benchmark: DataFrame, size: int, name: str) -> DataFrame:
    """``docs`` with a column of what was found. One pass per automaton; with several, spans and items are united in place."""
    context, out = docs.sparkSession.sparkContext, docs
    more = free(docs, "_more")
    for k, model in enumerate(automata(benchmark, size)):
        found = find(F.col("text"), context.broadcast(model))
        if k == 0:
            out = out.withColumn(name, found)
            continue
        out = out.withColumn(more, found)
        f, g = F.col(name), F.col(more)
        united = F.struct(f["n_words"].alias("n_words"), F.concat(f["spans"], g["spans"]).alias("spans"), F.array_union(f["items"], g["items"]).alias("items"), F.lit(None).cast("string").alias("rest"), F.lit(True).alias("several"))
        out = out.withColumn(name, united).drop(more)
    return out


def _n_hit(found):
    """Words in the union of spans, which may overlap if they come from several automata."""
    spans = F.array_sort(found["spans"])
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("to"))
    step = lambda s, x: F.struct(
        (s["n"] + F.greatest(F.lit(0).cast("bigint"), x["end"] - F.greatest(s["to"], x["start"]))).alias("n"), F.greatest(s["to"], x["end"]).alias("to")
    )
    return F.aggregate(spans, start, step, lambda s: s["n"])


def measured(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, name: str = "_found") -> DataFrame:
    """``docs`` (text and any other columns) with n_words, n_hit, items and spans under ``name``."""
    out = _overlaps(docs, benchmark, size, name)
    f = F.col(name)
    marks = [f[x.name].alias(x.name) for x in out.schema[name].dataType.fields if x.name == "several"]
    items = F.array_sort(F.filter(f["items"], lambda x: x.isNotNull()))
    return out.withColumn(name, F.struct(f["n_words"].alias("n_words"), _n_hit(f).alias("n_hit"), items.alias("items"), f["spans"].alias("spans"), f["rest"].alias("rest"), *marks))


def contaminated(found, coverage: float = 0.05):
    """Is at least ``coverage`` of the words hit?"""
    per = round(1 / coverage)
    return (found["n_hit"] > 0) & (per * found["n_hit"] >= found["n_words"])


def clean(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, coverage: float = 0.05) -> DataFrame:
    """``docs`` without documents over the coverage limit; of the others, spans over the length limit (``size`` words) are cut out.

    The text outside the words of a span stays as it is. Columns stay as they are; n_chars, if there, is counted anew for
    texts that were cut.
    """
    columns = docs.columns
    name = free(docs, "_found")
    found = F.col(name)
    rows = measured(docs, benchmark, size, name)
    several = any(f.name == "several" for f in rows.schema[name].dataType.fields)
    rows = rows.where(~contaminated(found, coverage) | F.col("text").isNull())
    hit = F.size(found["spans"]) > 0
    # Several automata may each have found a part: their spans are cut out together.
    united = found["rest"].isNull() & hit
    if several:
        rows = rows.withColumn("text", F.when(united, cut_words(F.col("text"), found["spans"])).otherwise(F.col("text")))
    rows = rows.withColumn("text", F.when(hit, F.coalesce(found["rest"], F.col("text"))).otherwise(F.col("text")))
    if "n_chars" in columns:
        rows = rows.withColumn("n_chars", F.when(hit, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return rows.select(*columns)


def cut_words(text, spans):
    """The text without the words of the spans and what lies between them."""

    @F.arrow_udf("string")
    def run(texts: pa.Array, cuts: pa.Array) -> pa.Array:
        out = []
        for text, spans in zip(texts.to_pylist(), cuts.to_pylist(), strict=True):
            if not text or not spans:
                out.append(text)
                continue
            out.append(_without(text.encode(), _merged([(s["start"], s["end"]) for s in spans])))
        return pa.array(out, pa.string())

    return run(text, spans)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document, in one pass and without a shuffle."""
    rows = measured(docs.select("doc_id", "text"), benchmark).select("doc_id", "_found")
    f = F.col("_found")
    return rows.select(
        "doc_id", f["n_words"].alias("n_words"), f["n_hit"].alias("n_hit"), F.size(f["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(f["items"], ","), 256).alias("items_sha256"), contaminated(f).alias("contaminated"),
    )
