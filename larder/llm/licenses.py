"""License scan by template markup.

A template is the wording of a license or notice with markup for what may differ: ``<<beginOptional>>`` ...
``<<endOptional>>`` for wording that may be missing, ``<<var>>`` or ``<<var;words=n>>`` for up to n words of any kind (the holder, a year). It is compiled to
an automaton over words. A text is accepted where its words take the automaton from start to end: every mandatory word in its
place, nothing else between. Words are lower-cased letters, digits and what lies beyond ASCII, so punctuation and layout do not matter.

Automata run only from words that can begin a template, in texts that hold a word each template cannot do without.
Null is an empty text: no words, no labels, score 0.
"""

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm import arrays as A

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# Phrases and labels that the result is defined by.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

_NOTICE = "<<beginOptional>>this <<var;words=6>> is<<endOptional>> <<beginOptional>>licensed<<endOptional>> <<beginOptional>>released<<endOptional>> under "
_WARRANTY = (
    'the software is provided "as is", without warranty of any kind, express or implied, including but not limited to the warranties of '
    "merchantability, fitness for a particular purpose and noninfringement. in no event shall the authors or copyright holders be liable for any claim, "
    "damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use "
    "or other dealings in the software."
)
_BSD_HEAD = (
    "redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "<<var;words=1>> redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "<<var;words=1>> redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
_BSD_TAIL = (
    "this software is provided by <<var;words=12>> \"as is\" and any express or implied warranties, including, but not limited to, the implied warranties of "
    "merchantability and fitness for a particular purpose are disclaimed. in no event shall <<var;words=12>> be liable for any direct, indirect, incidental, "
    "special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits; "
    "or business interruption) however caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence or "
    "otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage."
)
# Public wordings of notices and licenses, by label.
TEMPLATES = (
    ("Apache-2.0", _NOTICE + "the apache license<<beginOptional>>,<<endOptional>> version 2.0"),
    ("GPL-2.0", _NOTICE + "the gnu general public license, version 2"),
    ("GPL-3.0", _NOTICE + "the gnu general public license, version 3"),
    (
        "GPL-notice",
        "this program is free software<<beginOptional>>;<<endOptional>> you can redistribute it and/or modify it under the terms of the gnu general public license as published by "
        "the free software foundation<<beginOptional>>;<<endOptional>> either version <<var;words=1>> of the license, or (at your option) any later version",
    ),
    ("CC-BY-4.0", _NOTICE + "<<beginOptional>>a<<endOptional>> <<beginOptional>>creative commons<<endOptional>> cc by 4.0"),
    ("CC-BY-SA-4.0", _NOTICE + "<<beginOptional>>a<<endOptional>> <<beginOptional>>creative commons<<endOptional>> cc by-sa 4.0"),
    ("CC-BY-NC-4.0", _NOTICE + "<<beginOptional>>a<<endOptional>> <<beginOptional>>creative commons<<endOptional>> cc by-nc 4.0"),
    ("MIT-notice", _NOTICE + "the mit license"),
    (
        "MIT",
        "permission is hereby granted, free of charge, to any person obtaining a copy of <<var;words=12>> (the \"software\"), to deal in the software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, "
        "and to permit persons to whom the software is furnished to do so, subject to the following conditions: the above copyright notice and this permission "
        "notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial portions of the software. " + _WARRANTY,
    ),
    (
        "ISC",
        "permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright "
        "notice and this permission notice appear in all copies. the software is provided \"as is\" and <<var;words=6>> disclaims all warranties with regard to this "
        "software including all implied warranties of merchantability and fitness.",
    ),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    (
        "BSD-3-Clause",
        _BSD_HEAD + "<<var;words=1>> neither the name of <<var;words=12>> nor the names of its contributors may be used to endorse or promote products derived from "
        "this software without specific prior written permission. " + _BSD_TAIL,
    ),
)


def words(text: str) -> list[str]:
    return WORD.findall(text.translate(_LOWER))


@dataclass(frozen=True)
class Automaton:
    """States 0..n; ``on[s]`` moves on a word, ``other[s]`` on any word, ``free[s]`` without one."""

    label: str
    on: tuple
    other: tuple
    free: tuple
    depth: tuple  # mandatory words behind a state
    mandatory: frozenset
    n_mandatory: int

    def close(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in states:
                    states.add(t)
                    todo.append(t)
        return states

    def first(self) -> set[str]:
        return {w for s in self.close({0}) for w in self.on[s]}

    def run(self, text: list[str], at: int) -> tuple[int, int]:
        """End of the longest accepted run from word ``at`` (or -1), and the most mandatory words met in a row."""
        states, accepted, best, goal = self.close({0}), -1, 0, len(self.on) - 1
        for k in range(at, len(text)):
            word = text[k]
            moved = {self.on[s][word] for s in states if word in self.on[s]}
            moved |= {self.other[s] for s in states if self.other[s] >= 0}
            if not moved:
                break
            states = self.close(moved)
            best = max(best, max(self.depth[s] for s in states))
            if goal in states:
                accepted = k + 1
        return accepted, best


def compile_template(label: str, template: str) -> Automaton:
    on: list[dict[str, int]] = [{}]
    other, free, depth = [-1], [set()], [0]
    required: list[str] = []

    def state(behind: int) -> int:
        on.append({})
        other.append(-1)
        free.append(set())
        depth.append(behind)
        return len(on) - 1

    here, opened = 0, []
    for part in re.split(r"(<<[^>]*>>)", template):
        if part == "<<beginOptional>>":
            opened.append(here)
        elif part == "<<endOptional>>":
            if not opened:
                raise ValueError(f"{label}: an optional region ends that was not begun")
            start, there = opened.pop(), state(depth[here])
            free[start].add(there)
            free[here].add(there)
            here = there
        elif part.startswith("<<var"):
            most = int(m[1]) if (m := re.search(r"words=(\d+)", part)) else 40
            there = state(depth[here])
            free[here].add(there)
            for _ in range(most):
                step = state(depth[here])
                other[here] = step
                free[step].add(there)
                here = step
            here = there
        elif part.startswith("<<"):
            raise ValueError(f"{label}: unknown markup {part}")
        else:
            for word in words(part):
                there = state(depth[here] + (not opened))
                on[here][word] = there
                here = there
                if not opened:
                    required.append(word)
    if opened:
        raise ValueError(f"{label}: an optional region does not end")
    end = state(depth[here])
    free[here].add(end)
    return Automaton(label, tuple(on), tuple(other), tuple(map(tuple, free)), tuple(depth), frozenset(required), len(required))


@lru_cache(maxsize=4)
def _compiled(templates: tuple) -> list[Automaton]:
    return [compile_template(label, text) for label, text in templates]


def scan_words(text: list[str], templates: tuple = TEMPLATES) -> tuple[list[tuple[str, int, int]], float]:
    """(label, first word, word behind the last) of each accepted run, and the score.

    The score is 1 if any template is accepted, else the largest share of a template's mandatory words met in a row.
    """
    held, found, score = set(text), [], 0.0
    for automaton in _compiled(templates):
        # The rarest word a template must have decides whether it is tried; part of a template still scores.
        first = automaton.first()
        if not held & first or len(held & automaton.mandatory) * 2 < len(automaton.mandatory):
            continue
        at = 0
        while at < len(text):
            if text[at] in first:
                end, met = automaton.run(text, at)
                score = max(score, met / automaton.n_mandatory)
                if end > 0:
                    found.append((automaton.label, at, end))
                    at = end
                    continue
            at += 1
    return found, score


def _phrase_places(text: list[str]) -> list[tuple[str, int]]:
    out = []
    for phrase, label in PHRASES.items():
        want = phrase.split()
        at = -1
        while True:
            try:
                at = text.index(want[0], at + 1)
            except ValueError:
                break
            if text[at : at + len(want)] == want:
                out.append((label, at))
    return out


_FOUND = "struct<n_words:bigint,base:array<struct<label:string,word:bigint>>,found:array<struct<label:string,start:bigint,end:bigint>>,score:double>"
_BASE_TYPE = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
_FOUND_TYPE = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan(text: Column, templates: tuple = TEMPLATES) -> Column:
    """n_words; places of base phrases; accepted runs of templates, both in words from 0; score."""

    @F.arrow_udf(_FOUND)
    def run(column: pa.Array) -> pa.Array:
        needles = {p.split()[0] for p in PHRASES} - {"mit"} | {"license", "licence"}
        needles |= {max(sorted(a.mandatory), key=len) for a in _compiled(templates)}
        needle = re.compile("|".join(re.escape(n) for n in sorted(needles)).encode())
        n_words = np.zeros(len(column), np.int64)
        for at, data, offsets in A.slices(column):
            n_words[at : at + len(offsets) - 1] = A.counts(A.words(data, offsets, A.ALNUM)[2], len(offsets) - 1)
        base, found, scores = [], [], []
        for item in column:
            text = item.as_py() or ""
            # Case is folded on bytes, where it is A-Z alone.
            if not needle.search(text.encode().lower()):
                base.append([])
                found.append([])
                scores.append(0.0)
                continue
            list_of = words(text)
            runs, score = scan_words(list_of, templates)
            base.append([{"label": a, "word": b} for a, b in _phrase_places(list_of)])
            found.append([{"label": a, "start": b, "end": c} for a, b, c in runs])
            scores.append(score)
        return pa.StructArray.from_arrays(
            [pa.array(n_words), pa.array(base, _BASE_TYPE), pa.array(found, _FOUND_TYPE), pa.array(scores, pa.float64())],
            names=["n_words", "base", "found", "score"],
        )

    return run(text)


def report(docs: DataFrame) -> DataFrame:
    """One row per document, in one pass and without a shuffle."""
    rows = docs.select("doc_id", scan(F.col("text")).alias("s")).select("doc_id", "s.*")

    def listed(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    place, label = F.col("base.word"), F.col("base.label")
    return rows.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(place).alias("first_word"), F.array_max(place).alias("last_word"),
        listed(label).alias("base_labels"), listed(F.concat(label, F.col("found.label"))).alias("labels"), "score",
    )
