"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

The chance of a grade above k is ``sigmoid(f(text) - threshold_k)``: one set of weights f for all grades and one ordered
threshold between each two. Features are the words of a text (letters, digits, non-ASCII; A-Z in lower case) and their beginnings of
four and five bytes, present or not, so that inflected forms of a marked stem count though they were never seen.

Training takes at most ``sample`` labelled documents, those with the least hashes. Features that tell toxic from clean documents
in them (a two-sided test of proportions) make the vocabulary; weights are fitted with numpy by Adam under an L2 penalty. Scoring is one pass over whole
texts. The vocabulary has at most ``vocabulary`` entries, which bounds what is broadcast.

Null and empty texts have no features: their severity is that of a text without any mark.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm import arrays as A

STEMS = (4, 5)
_WHOLE = 9  # stands in for the stem length in the hash of a whole word


@dataclass
class Grades:
    keys: np.ndarray  # sorted feature hashes
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one less than grades


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes of all words and stems, and the text each is in. They may repeat."""
    data = A.LOWER[data]
    starts, ends, text = A.words(data, offsets, A.ALNUM)
    hashes, texts = [A.mix(A.span_hashes(data, starts, ends), _WHOLE)], [text]
    for n in STEMS:
        long = np.flatnonzero(ends - starts > n)
        hashes.append(A.mix(A.span_hashes(data, starts[long], starts[long] + n), n))
        texts.append(text[long])
    return np.concatenate(hashes), np.concatenate(texts)


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grade = batch.column("grade").to_numpy(zero_copy_only=False)
        for row, data, offsets in A.slices(batch.column("text")):
            keys, text = features(data, offsets)
            order = np.lexsort((keys, text))
            keys, text = keys[order], text[order]
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
            keys, text = keys[new], text[new]
            ends = np.cumsum(np.bincount(text, minlength=len(offsets) - 1))
            parts = np.split(keys, ends[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(grade[row : row + len(parts)], pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["grade", "keys"]
            )


def choose(keys: np.ndarray, doc: np.ndarray, toxic: np.ndarray, vocabulary: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Features whose share of toxic documents differs from that of clean ones by ``least`` standard errors or more.

    Also their scales, the difference in standard errors against the largest one: chance finds count for little.
    """
    unique, place = np.unique(keys, return_inverse=True)
    in_toxic, in_all = np.bincount(place, toxic[doc], len(unique)), np.bincount(place, minlength=len(unique))
    n1, n = max(toxic.sum(), 1), len(toxic)
    share = in_all / n
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n1 + 1 / max(n - n1, 1)))
    z = np.abs(in_toxic / n1 - (in_all - in_toxic) / max(n - n1, 1)) / error
    good = np.flatnonzero((z >= least) & (in_all >= 4))
    good = np.sort(good[np.lexsort((unique[good], -z[good]))][:vocabulary])
    return unique[good], z[good] / z.max(initial=1e-9)


def fit_ordinal(
    rows: np.ndarray, columns: np.ndarray, grade: np.ndarray, scale: np.ndarray, n_grades: int, steps: int = 500, l2: float = 1e-4
) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and ascending thresholds of the cumulative-link model, for a sparse 0/1 matrix with scaled columns.

    Clean and toxic documents weigh alike as a whole, so a chance of one half does not depend on how rare toxic ones are.
    """
    n, k, n_columns = len(grade), n_grades - 1, len(scale)
    weigh = np.where(grade > 0, 0.5 / max((grade > 0).sum(), 1), 0.5 / max((grade == 0).sum(), 1))
    at_most = np.cumsum(np.bincount(grade, weigh, n_grades))[:k]
    at_most = np.clip(at_most, 1e-3, 1 - 1e-3)
    first = np.log(at_most / (1 - at_most))
    weights = np.zeros(n_columns)
    # Thresholds are a first one and the logs of the steps above it, so they stay in order.
    cuts = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 0.1))])
    m, v = np.zeros(n_columns + k), np.zeros(n_columns + k)
    each = np.arange(n)
    for t in range(1, steps + 1):
        theta = np.concatenate([cuts[:1], cuts[0] + np.cumsum(np.exp(cuts[1:]))])
        f = np.bincount(rows, (weights * scale)[columns], n)
        below = np.concatenate([np.zeros((n, 1)), 1 / (1 + np.exp(np.clip(f[:, None] - theta, -30, 30))), np.ones((n, 1))], axis=1)
        slope = below * (1 - below)
        chance = np.maximum(below[each, grade + 1] - below[each, grade], 1e-9)
        d_f = (slope[each, grade + 1] - slope[each, grade]) / chance * weigh
        d_theta = np.zeros(k + 2)
        np.add.at(d_theta, grade + 1, -slope[each, grade + 1] / chance * weigh)
        np.add.at(d_theta, grade, slope[each, grade] / chance * weigh)
        d_theta = d_theta[1:-1]
        d_cuts = np.concatenate([[d_theta.sum()], [np.exp(cuts[j]) * d_theta[j:].sum() for j in range(1, k)]])
        g = np.concatenate([scale * np.bincount(columns, d_f[rows], n_columns) + l2 * weights, d_cuts])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        weights, cuts = weights - move[:n_columns], cuts - move[n_columns:]
    return weights * scale, np.concatenate([cuts[:1], cuts[0] + np.cumsum(np.exp(cuts[1:]))])


def labelled(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(text, grade) of at most ``sample`` labelled documents; of several labels of a document the gravest holds.

    The chosen ids are at most ``sample`` rows, whatever the tables, so they are broadcast. Rows that share an id
    count each for itself: of all rows found, the ``sample`` with the least hashes of id, then text, are taken.
    """
    graded = labels.where("doc_id IS NOT NULL AND grade IS NOT NULL").groupBy("doc_id").agg(F.max("grade").cast("int").alias("grade"))
    chosen = graded.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select(F.col("doc_id").alias("labelled_id"), "grade")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled_id"))
    return rows.orderBy(F.xxhash64("labelled_id"), F.xxhash64("text"), "grade").limit(sample).select("text", "grade")


def fit(rows: DataFrame, vocabulary: int = 50_000, least: float = 4.0, split: bool = False) -> Grades:
    """Fit to (text, grade), grades 0, 1, ... in ascending severity. Without a row above 0 nothing is ever toxic."""
    table = rows.mapInArrow(_training_rows, "grade int, keys binary").toArrow()
    grade = table["grade"].to_numpy().astype(np.int64)
    parts = [np.frombuffer(k, np.uint64) for k in table["keys"].to_pylist()]
    order = np.lexsort(([len(p) for p in parts], [int(np.bitwise_xor.reduce(p)) if len(p) else 0 for p in parts], grade)) if len(grade) else np.zeros(0, int)
    grade, parts = grade[order], [parts[i] for i in order]
    n_grades = int(grade.max()) + 1 if len(grade) else 1
    if n_grades < 2:
        return Grades(np.zeros(0, np.uint64), np.zeros(0), np.full(1, 30.0))
    keys, doc = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    kept, scale = choose(keys, doc, (grade > 0).astype(float), vocabulary, least)
    if not len(kept):
        return Grades(kept, np.zeros(0), np.full(n_grades - 1, 30.0))
    at = np.minimum(np.searchsorted(kept, keys), len(kept) - 1)
    hit = kept[at] == keys
    if split:
        density = np.bincount(doc[hit], scale[at[hit]], len(grade)) / np.maximum(np.bincount(doc, minlength=len(grade)), 1)
        grade = np.where(grade == 0, 0, 1 + (density > np.median(density[grade > 0])))
        n_grades = int(grade.max()) + 1
    weights, thresholds = fit_ordinal(doc[hit], at[hit], grade, scale, n_grades)
    return Grades(kept, weights, thresholds)


def assess(text: Column, model: Broadcast) -> Column:
    """(severity, grade, p_toxic): the expected grade, the likeliest grade, and the chance of a grade above 0."""

    @F.arrow_udf("struct<severity:double,grade:int,p_toxic:double>")
    def run(column: pa.Array) -> pa.Array:
        m: Grades = model.value
        f = np.zeros(len(column))
        for row, data, offsets in A.slices(column) if len(m.keys) else ():
            keys, owner = features(data, offsets)
            at = np.minimum(np.searchsorted(m.keys, keys), len(m.keys) - 1)
            hit = np.flatnonzero(m.keys[at] == keys)
            found = np.unique(owner[hit] * len(m.keys) + at[hit])
            f[row : row + len(offsets) - 1] = np.bincount(found // len(m.keys), m.weights[found % len(m.keys)], len(offsets) - 1)
        above = 1 / (1 + np.exp(np.clip(m.thresholds - f[:, None], -30, 30)))
        chance = np.diff(np.concatenate([np.zeros((len(f), 1)), 1 - above, np.ones((len(f), 1))], axis=1), axis=1)
        return pa.StructArray.from_arrays(
            [pa.array(above.sum(axis=1)), pa.array(chance.argmax(axis=1), pa.int32()), pa.array(above[:, 0])], names=["severity", "grade", "p_toxic"]
        )

    return run(text)


def fit_binary(rows: DataFrame, vocabulary: int = 50_000, least: float = 4.0) -> Grades:
    """Fit to (text, grade) with grades 0 and 1 only, splitting the toxic ones into mild and severe.

    Labels that only say toxic or not hold no severity, so it is taken from how dense the marks are: a toxic
    document is severe (2) if its marked features make up more of its features than in the median toxic document.
    """
    return fit(rows, vocabulary, least, split=True)


def learned(docs: DataFrame, labels: DataFrame, sample: int = 6_000) -> Broadcast:
    """The model of 0/1 labels (doc_id, toxic), ready for ``assess``."""
    rows = labelled(docs, labels.where("toxic IN (0, 1)").select("doc_id", F.col("toxic").alias("grade")), sample)
    model = fit_binary(rows)
    A.tidy()
    return docs.sparkSession.sparkContext.broadcast(model)


def report(docs: DataFrame, labels: DataFrame, sample: int = 6_000, limit: float = 0.5) -> DataFrame:
    """doc_id, expected severity, grade, p_toxic and toxic (p_toxic of ``limit`` or more) of every document."""
    model = learned(docs, labels, sample)
    rows = docs.select("doc_id", assess(F.col("text"), model).alias("s"))
    return rows.select("doc_id", "s.severity", "s.grade", "s.p_toxic", (F.col("s.p_toxic") >= limit).alias("toxic"))
