"""Mixing sources to target weights by pivotal dependent rounding.

Each document of a source would be taken ``target / source size`` times. Whole copies are given at once; the
fractional rest is rounded by the pivotal method: two documents meet, and a random amount of *words* moves from one to the other until
one of them has a whole number of copies. The mass in words stays the same at every meeting, and each document's
expected copies stay as they were. A task does this along its documents and hands on the one that is left with a fraction; those meet again,
``FAN_IN`` at a time, level by level, until one per source is left, which alone is rounded to the nearest.
So a source misses its target by half of one document at most.

Rows that repeat in full are one document of several copies while copies are rounded, which are then dealt evenly to the rows: however many there are,
they are one item of a group, and together they take what their share asks for.

Random numbers are hashes of the document and the level: reruns agree, whatever the partitions.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.shared import free, numbered, small, stored

GROUP_ROWS = 2_000
FAN_IN = 64
WEIGHTS = (5.0, 2.0, 1.0)
_EDGE = 1e-9


def size_in_words(text: Column) -> Column:
    """Number of words parted by white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Adds to (source, source_size, n_docs) the words to take: ``share`` of all words, by weight, at most ``most`` times a source.

    ``sources`` has one row per source. What a full source cannot take is shared among the others by weight, until
    none is above its limit; that is the same as one rate for all that are not full, found in a few passes over the sources.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = stored(sources.withColumn("weight", weight), "sources")
    limit = most * F.col("source_size")
    total = share * float(ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    rate, full = 0.0, -1
    while True:
        over = F.col("weight") * rate > limit
        row = ranked.agg(
            F.coalesce(F.sum(F.when(over, limit)), F.lit(0.0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)), F.coalesce(F.sum(over.cast("int")), F.lit(0))
        ).first()
        if row[2] == full or not row[1]:
            break
        full, rate = row[2], (total - row[0]) / row[1]
    return ranked.select("source", "source_size", "n_docs", F.least(F.col("weight") * rate, limit).alias("target"))


def pivot(copies: np.ndarray, sizes: np.ndarray, chance: np.ndarray) -> tuple[np.ndarray, int]:
    """Round ``copies`` so that their sum weighted by ``sizes`` holds; the place of the one left with a fraction, or -1."""
    copies = copies.astype(np.float64).copy()
    open_at = -1
    for i in range(len(copies)):
        low = np.floor(copies[i] + _EDGE)
        if sizes[i] <= 0 or copies[i] - low <= _EDGE:
            copies[i] = low
            continue
        if open_at < 0:
            open_at = i
            continue
        j = open_at
        base_i, base_j = np.floor(copies[i]), np.floor(copies[j])
        f, g, s, t = copies[i] - base_i, copies[j] - base_j, float(sizes[i]), float(sizes[j])
        up, down = min((1 - f) * s, g * t), min(f * s, (1 - g) * t)  # words from j to i, or from i to j
        moved = up if chance[i] * (up + down) < down else -down
        f, g = f + moved / s, g - moved / t
        open_at = -1
        for k, base, x in ((i, base_i, f), (j, base_j, g)):
            if x <= _EDGE or x >= 1 - _EDGE:
                copies[k] = base + round(x)
            else:
                copies[k], open_at = base + x, k
    return copies, open_at


def _chance(order: np.ndarray, level: int) -> np.ndarray:
    """A number from 0 to 1 for each hash, another one at each level."""
    x = order.view(np.uint64) ^ np.uint64(0x9E3779B97F4A7C15 * (level + 1) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def _rounder(level: int, last: bool):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        return _round(rows.drop(columns="open", errors="ignore"), level, last)

    return run


def _round(rows: pd.DataFrame, level: int, last: bool) -> pd.DataFrame:
    # Long documents first: the one left over is then more often a short one.
    rows = rows.sort_values(["size", "order", "doc_id"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
    chance = _chance(rows["order"].to_numpy(np.int64).copy(), level)
    copies, left = pivot(rows["copies"].to_numpy(), rows["size"].to_numpy(), chance)
    if last and left >= 0:
        base = np.floor(copies[left])
        copies[left], left = base + (copies[left] - base > 0.5), -1
    rows["copies"] = copies
    rows["open"] = np.arange(len(rows)) == left
    return rows


def key(doc_id: Column, text: Column, source: Column) -> Column:
    """What tells documents apart and deals them out; rows that repeat share it."""
    return F.xxhash64(doc_id, text, source)


def copies(docs: DataFrame, by_source: DataFrame) -> DataFrame:
    """(doc_id, order, source, size, n, source_size, target, copies) of every row of ``docs`` (doc_id, order, source, size, n), n rows that repeat.

    ``by_source`` has source, source_size, n_docs and target. A source of any size is dealt to groups of about
    ``GROUP_ROWS`` documents by ``order``, the document's key.
    """
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    groups = F.ceil(F.col("n_docs") / GROUP_ROWS).cast("long")
    # One row per source, so the join is on a small table, and every source is in it.
    plan = by_source.select(F.col("source").alias("s"), "source_size", "target", share.alias("copies"), groups.alias("groups"))
    rows = docs.join(plan, F.col("source").eqNullSafe(F.col("s")))
    part = F.pmod(F.xxhash64(F.lit(3), "order"), "groups").alias("part")
    rows = rows.select("doc_id", "order", "source", "size", "n", "source_size", "target", (F.col("copies") * F.col("n")).alias("copies"), part, "groups")
    schema = "doc_id long, order long, source string, size long, n long, source_size long, target double, copies double, part long, groups long, open boolean"
    top = by_source.agg(F.coalesce(F.max(groups), F.lit(1))).first()[0]
    done, level = [], 0
    while True:
        last = top <= 1
        rounded = rows.groupBy("source", "part").applyInPandas(_rounder(level, last), schema)
        rounded = stored(rounded, f"round{level}")
        done.append(rounded.where(~F.col("open")))
        if last:
            break
        up = F.ceil(F.col("groups") / FAN_IN).cast("long")
        rows = rounded.where("open").withColumn("part", F.floor(F.col("part") / FAN_IN).cast("long")).withColumn("groups", up)
        top, level = -(-top // FAN_IN), level + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("open", "part", "groups").withColumn("copies", F.col("copies").cast("long"))


def mixed(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """How often each document is taken, by all its ``n`` rows together: see ``copies``. ``docs`` needs doc_id, text and source.

    Null texts have size 0 and are never taken; a null source is a source of its own, the last one. An empty table gives no rows.
    """
    doc_id, source = F.col("doc_id").cast("long"), F.col("source").cast("string")
    rows = docs.select(doc_id.alias("doc_id"), source.alias("source"), key(doc_id, F.col("text"), source).alias("order"), size_in_words(F.col("text")).alias("size"))
    rows = stored(rows.groupBy("doc_id", "source", "order", "size").agg(F.count(F.lit(1)).alias("n")), "sizes")
    by_source = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    aimed = targets(by_source, share, most, weights)
    return copies(rows, aimed)


def dealt(place: Column, copies: Column, n: Column) -> Column:
    """Copies of the row at ``place``, from 1, of the n rows that share them."""
    return F.call_function("div", copies, n) + (place <= copies % n).cast("long")


def mix(docs: DataFrame) -> DataFrame:
    """``docs`` with each row as often as the mix takes it; columns stay as they are. Rows that repeat share their copies as evenly as whole numbers allow."""
    order, same, times, copy, place = (free(docs, x) for x in ("_order", "_key", "_times", "_copy", "_place"))
    taken = stored(mixed(docs).where("copies > 0").select(F.col("order").alias(same), "copies", "n"), "taken")
    doc_id, source = F.col("doc_id").cast("long"), F.col("source").cast("string")
    marked = docs.withColumn(order, key(doc_id, F.col("text"), source))

    def given(rows: DataFrame, often: DataFrame, at: Column) -> DataFrame:
        often = small(often.withColumnsRenamed({"copies": f"{copy}s", "n": f"{copy}n"}))
        deal = dealt(at, F.col(f"{copy}s"), F.col(f"{copy}n")).cast("int")
        rows = rows.join(often, F.col(order) == F.col(same)).withColumn(times, deal).where(F.col(times) > 0)
        return rows.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)

    again = taken.where("n > 1")
    once = given(marked, taken.where("n = 1"), F.lit(1))
    if again.isEmpty():
        return once
    repeats = marked.join(small(again.select(F.col(same).alias(place))), F.col(order) == F.col(place), "left_semi")
    return once.unionByName(given(numbered(repeats, order, place), again, F.col(place)))


def report(docs: DataFrame) -> DataFrame:
    rows = mixed(docs).withColumn("place", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return rows.select("doc_id", "size", "source_size", "target", (dealt(F.col("place"), F.col("copies"), F.col("n")) * F.col("size")).alias("taken"))
