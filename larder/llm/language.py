"""Language of a text by a small convolutional network over bytes.

Bytes are folded to 128 classes. Filters of two, three and four bytes slide over windows of fixed length; each
filter's largest answer in a window goes through a ReLU to a softmax over the languages. Training is plain numpy
(Adam, gradients through the maximum) on windows of at most ``sample`` labelled documents. A text is cut into windows
from end to end, all of which are scored in batches; its language has the largest mean log probability, and its score is
the mean probability of that language.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm import arrays as A

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 8
CLASSES = 128
#: 0 padding, 1 anything that is no letter, 2 digits, then letters, continuation bytes, and leading bytes in pairs.
CLASS = np.ones(256, np.uint8)
CLASS[0x30:0x3A] = 2
CLASS[0x41:0x5B] = CLASS[0x61:0x7B] = np.arange(3, 29)
CLASS[0x80:0xC0] = np.arange(29, 93)
CLASS[0xC0:] = 93 + np.arange(64) // 2


@dataclass
class Network:
    languages: list[str]
    filters: list[np.ndarray]  # per width: (width, CLASSES, FILTERS)
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def tables(self) -> list[list[np.ndarray]]:
        """Answers of each filter to pairs of classes, so that a window needs few reads."""
        made = []
        for f in self.filters:
            pairs = [(f[k][:, None, :] + f[k + 1][None, :, :]).reshape(-1, FILTERS) for k in range(0, len(f) - 1, 2)]
            made.append(pairs + ([f[-1]] if len(f) % 2 else []))
        return made


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of classes, the text of each, and how many bytes it holds. Every byte is in one window."""
    length = np.diff(offsets)
    n = -(-length // WINDOW)
    text = np.repeat(np.arange(len(length)), n)
    first = (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * WINDOW
    held = np.minimum(length[text] - first, WINDOW)
    place = np.arange(WINDOW)
    at = np.minimum((offsets[:-1][text] + first)[:, None] + place, max(len(data) - 1, 0))
    return np.where(place < held[:, None], CLASS[data[at]] if len(data) else 0, 0).astype(np.uint8), text, held


def _answers(tables: list[list[np.ndarray]], x: np.ndarray) -> np.ndarray:
    """Largest answer of every filter in each window."""
    wide = x.astype(np.int32)
    pair = wide[:, :-1] * CLASSES + wide[:, 1:]
    out = []
    for width, parts in zip(WIDTHS, tables, strict=True):
        steps = WINDOW - width + 1
        total = None
        for k, table in enumerate(parts):
            at = pair[:, 2 * k : 2 * k + steps] if len(table) > CLASSES else wide[:, 2 * k : 2 * k + steps]
            read = table.take(at, axis=0)
            total = read if total is None else np.add(total, read, out=total)
        out.append(total.max(axis=1))
    return np.concatenate(out, axis=1)


def log_probabilities(net: Network, tables: list, x: np.ndarray) -> np.ndarray:
    parts = []
    for at in range(0, len(x), 512):
        h = np.maximum(_answers(tables, x[at : at + 512]) + net.bias, 0) @ net.out + net.out_bias
        h -= h.max(axis=1, keepdims=True)
        parts.append(h - np.log(np.exp(h).sum(axis=1, keepdims=True)))
    return np.concatenate(parts) if parts else np.zeros((0, len(net.languages)))


def train(x: np.ndarray, y: np.ndarray, languages: list[str], epochs: int = 8, seed: int = 7) -> Network:
    rng = np.random.default_rng(seed)
    wide = FILTERS * len(WIDTHS)
    params = [rng.normal(0, 0.3, (w, CLASSES, FILTERS)).astype(np.float32) for w in WIDTHS]
    params += [np.zeros(wide, np.float32), rng.normal(0, 0.2, (wide, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32)]
    m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 128):
            xb, yb = x[order[at : at + 128]].astype(np.int32), y[order[at : at + 128]]
            rows = np.arange(len(xb))
            best, places = [], []
            for width, f in zip(WIDTHS, params[:3], strict=True):
                steps = WINDOW - width + 1
                total = sum(f[k].take(xb[:, k : k + steps], axis=0) for k in range(width))
                place = total.argmax(axis=1)
                best.append(np.take_along_axis(total, place[:, None, :], axis=1)[:, 0])
                places.append(place)
            hidden = np.concatenate(best, axis=1) + params[3]
            live = np.maximum(hidden, 0)
            z = live @ params[4] + params[5]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[rows, yb] -= 1
            p /= len(xb)
            back = (p @ params[4].T) * (hidden > 0)
            grads = [np.zeros_like(f) for f in params[:3]] + [back.sum(axis=0), live.T @ p, p.sum(axis=0)]
            for i, width in enumerate(WIDTHS):
                part = back[:, i * FILTERS : (i + 1) * FILTERS]
                for k in range(width):
                    np.add.at(grads[i][k], (np.take_along_axis(xb, places[i] + k, axis=1), np.arange(FILTERS)[None, :]), part)
            t += 1
            for j, g in enumerate(grads):
                m[j] = 0.9 * m[j] + 0.1 * g
                v[j] = 0.999 * v[j] + 0.001 * g * g
                params[j] = params[j] - 0.01 * (m[j] / (1 - 0.9**t)) / (np.sqrt(v[j] / (1 - 0.999**t)) + 1e-7)
    params = [p.astype(np.float32) for p in params]
    return Network(languages, params[:3], *params[3:])


def _training_windows(batches: Iterator[pa.RecordBatch], each: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lang, h = batch.column("lang"), batch.column("h")
        for row, data, offsets in A.slices(batch.column("text")):
            x, text, held = cut(data, offsets)
            n = np.bincount(text, minlength=len(offsets) - 1)
            nth = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
            # Evenly spread windows of each text, none too short to tell.
            step = np.maximum(n[text] // each, 1)
            keep = (nth % step == 0) & (nth // step < each) & ((held >= 32) | (nth == 0))
            at = pa.array(row + text[keep])
            yield pa.RecordBatch.from_arrays([lang.take(at), h.take(at), pa.array([w.tobytes() for w in x[keep]], pa.binary())], names=["lang", "h", "x"])


def fit(docs: DataFrame, sample: int = 6000, each: int = 4) -> Network:
    """A network learned from ``docs`` (doc_id, text, lang): at most ``each`` windows of the ``sample`` rows with the least hashes.

    Of rows that share an id, however many, all are candidates; the ``sample * each`` windows with the least hashes, then bytes, are taken.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("text", F.col("lang").cast("string").alias("lang"), F.xxhash64("doc_id").alias("h"))
    last = docs.where("lang IS NOT NULL").select(F.xxhash64("doc_id").alias("h")).orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    windows = rows.where(F.col("h") <= F.lit(last)).mapInArrow(lambda b: _training_windows(b, each), "lang string, h long, x binary")
    table = windows.orderBy("h", "x", "lang").limit(sample * each).select("lang", "x").toArrow()
    names = table["lang"].to_pylist()
    languages = sorted(set(names))
    if not languages:
        return Network([], [np.zeros((w, CLASSES, FILTERS), np.float32) for w in WIDTHS], np.zeros(24, np.float32), np.zeros((24, 0), np.float32), np.zeros(0, np.float32))
    x = np.frombuffer(b"".join(table["x"].to_pylist()), np.uint8).reshape(-1, WINDOW)
    y = np.array([languages.index(n) for n in names])
    order = np.lexsort((*x.T[:16], y))  # the same whatever order Spark returns rows in
    return train(x[order], y[order], languages)


def identify(text: Column, model: Broadcast) -> Column:
    """(lang_pred, score). ``und`` with score 0 for texts that are null or have no letter, or if no language was learned."""

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def run(column: pa.Array) -> pa.Array:
        net: Network = model.value
        tables = net.tables()
        names, scores = [], []
        for _, data, offsets in A.slices(column):
            rows = len(offsets) - 1
            if not net.languages:
                names += ["und"] * rows
                scores += [0.0] * rows
                continue
            x, owner, held = cut(data, offsets)
            logs = log_probabilities(net, tables, x)
            weight = held / np.maximum(np.bincount(owner, held, rows)[owner], 1)
            mean = np.stack([np.bincount(owner, weight * logs[:, k], rows) for k in range(len(net.languages))], axis=1)
            best = mean.argmax(axis=1)
            chance = np.bincount(owner, weight * np.exp(logs[np.arange(len(owner)), best[owner]]), rows) if len(owner) else np.zeros(rows)
            names += [net.languages[b] for b in best]
            scores += chance.tolist()
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    lettered = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    found = run(F.when(lettered, text))
    none = F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    return F.when(lettered, found).otherwise(none)


def report(docs: DataFrame, sample: int = 6000) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; learned from the text and lang of those not held out."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = docs.sparkSession.sparkContext.broadcast(fit(docs.where(~held_out), sample))
    rows = docs.select("doc_id", held_out.alias("held_out"), identify(F.col("text"), model).alias("s"))
    return rows.select("doc_id", "held_out", "s.lang_pred", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "s.score")).alias("score"))
