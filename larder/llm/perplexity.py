"""Quality rules with an n-gram language model.

The model predicts each byte of a text from the four before it (letters in lower case, digits as one).
Spark counts the 5-grams of all texts: a task adds up its own before the shuffle, so that what is
shuffled is bounded by the distinct n-grams of a task. Modified Kneser-Ney smoothing (discounts for counts of one, two, and three or
more; continuation counts below the top order) is a chain of aggregates and joins over those counts. The discount for a count of one is
one: the texts judged are those counted, and an n-gram seen once was seen in the text itself only, so it gets what the lower order gives.

An n-gram is its bytes, packed into one number; none shares a place with another. As all texts were counted, a text's n-grams are all in the
table of the top order. That table is dealt to shards of about ``SHARD`` n-grams; a pass over the texts adds up what one shard knows, so
that one shard at a time is in memory, however many there are.

A document's perplexity is that of a byte. Each language has a lower and an upper band around its own median, as
wide as ``reach`` times the distance from the median to the quartile of that side. That distance is drawn towards the mean of all
languages as if ``least`` documents had that one: a language of a few documents has nearly the mean spread, a large one its own.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm import arrays as A
from larder.llm.shared import small, stored

ORDER = 5  # bytes; packed into a BIGINT, so at most 7
SHARD = 4_000_000
#: Of 2 to 8 in steps of a half, the reach with the largest difference between the share of bad documents rejected and the share of good ones
#: rejected, by the quality labels of sf0.1, among documents that pass the base rules.
REACH = 3.5
SYMBOLS = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")
_SYMBOL = np.isin(A.BYTE, [s[0] for s in SYMBOLS])
_FOLD = A.LOWER.copy()
_FOLD[0x30:0x3A] = 0x30
_STATS = "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint>"
_FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


# --- counts that need no model -------------------------------------------------------------


def _plain_counts(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    rows = len(offsets) - 1
    starts, ends, text = A.words(data, offsets, A.NOT_SPACE)
    points = np.concatenate([[0], np.cumsum(((data & 0xC0) != 0x80) & A.NOT_SPACE[data])])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    # Lines: cut at every line feed and at the ends of texts.
    cut = np.flatnonzero(data == 0x0A)
    begin = np.sort(np.concatenate([offsets[:-1], cut + 1]))
    line_text = np.concatenate([np.arange(rows), np.searchsorted(offsets, cut, "right") - 1])
    line_text = line_text[np.argsort(np.concatenate([offsets[:-1], cut + 1]), kind="stable")]
    order = np.lexsort((begin, line_text))
    begin, line_text = begin[order], line_text[order]
    stop = np.empty_like(begin)
    last = np.append(line_text[1:] != line_text[:-1], True)
    stop[:-1] = begin[1:] - 1
    stop[last] = offsets[1:]
    full = np.searchsorted(starts, stop) > np.searchsorted(starts, begin)
    begin, stop, line_text = begin[full], stop[full], line_text[full]
    _, later = A.repeated(A.in_text(A.span_hashes(data, begin, stop), line_text))
    # Words in three-word windows that occur twice or more.
    window, at = A.windows(A.span_hashes(data, starts, ends), text, 3)
    many, _ = A.repeated(A.in_text(window, text[at]))
    cover = np.zeros(len(starts) + 1, np.int64)
    for k in range(3):
        cover[at[many] + k] = 1
    return [
        A.counts(text, rows),
        points[offsets[1:]] - points[offsets[:-1]],
        symbols[offsets[1:]] - symbols[offsets[:-1]],
        A.counts(line_text[later], rows),
        A.counts(text[cover[:-1] > 0], rows),
    ]


def plain_counts(text: Column) -> Column:
    """Words, their code points, symbols, repeated lines, and words in repeated three-word windows."""

    @F.arrow_udf(_STATS)
    def run(column: pa.Array) -> pa.Array:
        parts = [_plain_counts(data, offsets) for _, data, offsets in A.slices(column)]
        merged = [np.concatenate(x) if parts else np.zeros(0, np.int64) for x in (zip(*parts) if parts else [[]] * 5)]
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in merged], names=list(_FIELDS))

    return run(text)


# --- the model -----------------------------------------------------------------------------


def _grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Packed n-grams that end in each byte of each text (pads before a text)."""
    rows, pads = len(offsets) - 1, ORDER - 1
    text = np.repeat(np.arange(rows), np.diff(offsets))
    padded = np.zeros(len(data) + pads * rows, np.int64)
    at = np.arange(len(data)) + pads * (text + 1)
    padded[at] = _FOLD[data]
    gram = padded.copy()
    for k in range(1, ORDER):
        gram[k:] |= padded[:-k] << (8 * k)
    return gram[at]


def _merged(keys: list, sums: list) -> tuple[np.ndarray, np.ndarray]:
    key, n = np.concatenate(keys), np.concatenate(sums)
    unique, place = np.unique(key, return_inverse=True)
    return unique, np.bincount(place, n, len(unique)).astype(np.int64)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, sums, held = [], [], 0
    for batch in batches:
        for _, data, offsets in A.slices(batch.column(0)):
            key, n = np.unique(_grams(data, offsets), return_counts=True)
            keys.append(key)
            sums.append(n)
            held += len(key)
            if held > 4_000_000:
                key, n = _merged(keys, sums)
                keys, sums, held = [key], [n], len(key)
                if held > 3_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["gram", "n"])
                    keys, sums, held = [], [], 0
    if keys:
        key, n = _merged(keys, sums)
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["gram", "n"])


def gram_counts(docs: DataFrame) -> DataFrame:
    """How often each n-gram of the top order occurs in all texts."""
    parts = docs.select("text").mapInArrow(_count_grams, "gram long, n long")
    return parts.groupBy("gram").agg(F.sum("n").alias("n"))


def _discounted(grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Adds to each n-gram its discounted share of its context; also the contexts with what is left to back off."""
    n = [F.coalesce(F.sum((F.col("n") == k).cast("long")), F.lit(0)) for k in (1, 2, 3, 4)]
    n1, n2, n3, n4 = (float(x) for x in grams.agg(*n).first())
    y = n1 / max(n1 + 2 * n2, 1.0)
    # Discounts stay within their counts where a corpus is too small for the estimate.
    _, *d = [min(max(k - (k + 1) * y * b / a, 0.1), k - 0.1) if a else 0.5 * k for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    off = F.when(F.col("n") == 1, 1.0).when(F.col("n") == 2, d[0]).otherwise(d[1])
    grams = grams.withColumn("context", F.shiftrightunsigned("gram", 8))
    contexts = grams.groupBy("context").agg(F.sum("n").alias("total"), F.sum(off).alias("left"))
    contexts = contexts.select("context", "total", (F.col("left") / F.col("total")).alias("back"))
    shared = grams.join(contexts, "context").select("gram", "context", ((F.col("n") - off) / F.col("total")).alias("own"), "back")
    return shared, contexts


def orders(docs: DataFrame) -> Iterator[tuple[DataFrame, DataFrame]]:
    """The model, lowest order first: n-grams (gram, p), and contexts (context, back) with the weight of the order below."""
    grams = stored(gram_counts(docs), "grams")
    tables = {ORDER: grams}
    for order in range(ORDER - 1, 0, -1):
        mask = (1 << (8 * order)) - 1
        tables[order] = tables[order + 1].groupBy(F.col("gram").bitwiseAND(F.lit(mask)).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        if order > 2:
            tables[order] = stored(tables[order], f"grams{order}")
    lower = None
    for order in range(1, ORDER + 1):
        shared, contexts = _discounted(tables[order])
        if order == 1:
            p = shared.select("gram", (F.col("own") + F.col("back") / 256).alias("p"))
        else:
            suffix = F.col("gram").bitwiseAND(F.lit((1 << (8 * (order - 1))) - 1))
            below = lower.select(F.col("gram").alias("suffix"), F.col("p").alias("below"))
            p = shared.withColumn("suffix", suffix).join(below, "suffix", "left")
            p = p.select("gram", (F.col("own") + F.col("back") * F.coalesce("below", F.lit(1 / 256))).alias("p"))
        lower = stored(p, f"order{order}")
        yield lower, contexts


def estimate(docs: DataFrame) -> dict[str, np.ndarray]:
    """The whole model in memory: n-grams in order with log probabilities, and contexts with log weights. For small corpora."""
    model: dict[str, np.ndarray] = {}
    for order, (grams, contexts) in enumerate(orders(docs), 1):
        model |= _arrays(f"p{order}", grams.select("gram", F.log("p").alias("value")))
        model |= _arrays(f"b{order}", contexts.select(F.col("context").alias("gram"), F.log("back").alias("value")))
    return model


def _arrays(name: str, rows: DataFrame) -> dict[str, np.ndarray]:
    table = rows.select("gram", F.col("value").cast("float")).toArrow()
    keys, values = table["gram"].to_numpy(), table["value"].to_numpy()
    order = np.argsort(keys)
    return {f"{name}_key": keys[order], f"{name}_value": values[order]}


def _found(model: dict, name: str, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, values = model[f"{name}_key"], model[f"{name}_value"]
    if not len(keys):
        return np.zeros(len(gram), bool), np.zeros(len(gram), np.float32)
    at = np.minimum(np.searchsorted(keys, gram), len(keys) - 1)
    return keys[at] == gram, values[at]


def log_probability(model: dict, gram: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Log probability of the last byte of packed n-grams, backing off where one was never seen."""
    gram = gram.astype(np.int64)
    known, out = _found(model, f"p{order}", gram)
    out = out.astype(np.float32)
    missing = np.flatnonzero(~known)
    if len(missing):
        rest = gram[missing]
        if order == 1:
            _, weight = _found(model, "b1", np.zeros(1, np.int64))
            out[missing] = weight - np.float32(np.log(256))
        else:
            seen, weight = _found(model, f"b{order}", rest >> 8)
            lower = log_probability(model, rest & ((1 << (8 * (order - 1))) - 1), order - 1)
            out[missing] = lower + np.where(seen, weight, 0)
    return out


def _part(text: Column, shard: Broadcast) -> Column:
    """What the n-grams of a shard add to the mean negative log probability of a text's bytes; null for empty texts."""

    @F.arrow_udf("double")
    def run(column: pa.Array) -> pa.Array:
        parts = []
        for _, data, offsets in A.slices(column):
            gram, place = np.unique(_grams(data, offsets), return_inverse=True)
            known, value = _found(shard.value, "p", gram)
            value = np.where(known, value, np.float32(0))[place]
            total = np.concatenate([[0], np.cumsum(value, dtype=np.float64)])
            n = np.diff(offsets)
            with np.errstate(invalid="ignore"):
                parts.append((total[offsets[:-1]] - total[offsets[1:]]) / n)
        out = np.concatenate(parts) if parts else np.zeros(0)
        return pa.array(out, pa.float64(), mask=np.isnan(out))

    return run(text)


def scored(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """doc_id, lang, counts and score of every row: the mean negative log probability of a byte, whose exponential is the perplexity.

    ``grams`` are those of the top order with p; all n-grams of the texts must be among them. Score is null for empty texts.
    """
    context, shards = docs.sparkSession.sparkContext, max(1, -(-grams.count() // SHARD))
    shard = F.pmod(F.xxhash64("gram"), F.lit(shards))
    rows = None
    for k in range(shards):
        here = context.broadcast(_arrays("p", grams.where(shard == k).select("gram", F.log("p").alias("value"))))
        part, digest = _part(F.col("text"), here), F.md5(F.col("text").cast("binary")).alias("digest")
        if rows is None:
            more = [digest] if shards > 1 else []
            rows = stored(docs.select("doc_id", "lang", plain_counts(F.col("text")).alias("s"), part.alias("score"), *more), "scored")
        else:  # rows may repeat and doc_id may be null: parts go by the text
            parts = stored(docs.select(digest, part.alias("part")).groupBy("digest").agg(F.first("part").alias("part")), "part")
            rows = rows.join(parts, "digest", "left").withColumn("score", F.col("score") + F.col("part")).drop("part")
        here.destroy()
    return rows.select("doc_id", "lang", "s.*", "score")


# --- bands and verdict ---------------------------------------------------------------------


def bands(scored: DataFrame, reach: float, least: int) -> DataFrame:
    """Lower and upper limit of each language; rows without a language are one of their own."""
    quartiles = F.percentile_approx("score", [0.25, 0.5, 0.75], 10_000).alias("q")
    own = scored.groupBy("lang").agg(quartiles, F.count("score").alias("m")).where("m > 0")
    own = own.select("lang", "m", F.col("q")[1].alias("mid"), (F.col("q")[1] - F.col("q")[0]).alias("down"), (F.col("q")[2] - F.col("q")[1]).alias("up"))
    pooled = own.agg(*(F.sum(F.col("m") * F.col(x)) / F.sum("m") for x in ("down", "up"))).first()
    spread = [(F.col("m") * F.col(x) + least * F.lit(p).cast("double")) / (F.col("m") + least) for x, p in zip(("down", "up"), pooled, strict=True)]
    return own.select("lang", (F.col("mid") - reach * spread[0]).alias("low"), (F.col("mid") + reach * spread[1]).alias("high"))


def judge(docs: DataFrame, reach: float = REACH, least: int = 100) -> DataFrame:
    """doc_id, counts, base_failed, perplexity, the limits of its language, and kept. Other columns do not matter.

    Empty and null texts fail the base rules. Rows may repeat; each is judged for itself. A language without
    any document that passes the base rules has no limits, and none of its documents is kept.
    """
    docs = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    for grams, _ in orders(docs):
        top = grams
    rows = scored(docs, top)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = stored(rows.withColumn("base_failed", failed), "judged")
    limits = bands(rows.where(~F.col("base_failed")), reach, least)
    rows = rows.join(small(limits.withColumnRenamed("lang", "own_lang")), F.col("lang").eqNullSafe(F.col("own_lang")), "left")
    kept = ~F.col("base_failed") & F.coalesce(F.col("score").between(F.col("low"), F.col("high")), F.lit(False))
    return rows.select(
        "doc_id", *_FIELDS, "base_failed", kept.alias("kept"),
        F.exp("score").alias("perplexity"), F.exp("low").alias("lower_band"), F.exp("high").alias("upper_band"),
    )
