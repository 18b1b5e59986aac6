"""Label enrichment: cached labels first, a model function for the rest.

Labels live in one table (product_id, field, value, source, model); lists and structs are kept
as JSON text. The source is ``model``, ``name`` (decided by the name alone) or ``fallback``
(the call failed); fallbacks are not cached, so the next run asks again.
"""

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from larder import vocab
from larder.functions import replies
from larder.functions.text import drink_role_by_name
from larder.session import written

LABEL_SCHEMA = "product_id bigint, field string, value string, source string, model string"
REPLY_SCHEMA = "product_ids array<bigint>, reply string, attempts int, error string"


@dataclass(frozen=True)
class Label:
    """One label field: how to ask for it and how to read the answer."""

    field: str
    heading: str
    read: Callable[[Column], Column]
    fallback: Callable[[], Column]
    only_step: str | None = None
    name_rule: Callable[[Column], Column] | None = None
    fill_missing: bool = False


def menu_step(heading: str) -> Label:
    return Label(
        "menu_step", heading,
        lambda v: replies.label_value(v, vocab.STEPS, vocab.FALLBACK_STEP),
        lambda: F.lit(vocab.FALLBACK_STEP),
    )


def dish_role(heading: str) -> Label:
    return Label(
        "dish_role", heading,
        lambda v: replies.label_value(v, vocab.DISH_ROLES, vocab.FALLBACK_DISH_ROLE),
        lambda: F.lit(vocab.FALLBACK_DISH_ROLE),
        only_step=vocab.MAIN_STEP,
    )


def drink_role(heading: str) -> Label:
    return Label(
        "drink_role", heading,
        lambda v: replies.label_value(v, vocab.DRINK_ROLES, vocab.FALLBACK_DRINK_ROLE),
        lambda: F.lit(vocab.FALLBACK_DRINK_ROLE),
        only_step=vocab.DRINK_STEP, name_rule=drink_role_by_name, fill_missing=True,
    )


def event_fit(heading: str) -> Label:
    return Label(
        "could_fit_event", heading,
        lambda v: F.to_json(replies.events_value(v)),
        lambda: F.lit(f'["{vocab.ALL_EVENTS}"]'),
    )


def predicted_diet(heading: str) -> Label:
    return Label(
        "predicted_diet", heading,
        lambda v: F.when(v.isNotNull(), _diet_json(replies.diet_value(v))),
        lambda: F.lit('{"profile":null,"contains":[]}'),
    )


def _diet_json(diet: Column) -> Column:
    return F.to_json(diet, {"ignoreNullFields": "false"})


def uncached(items: DataFrame, cache: DataFrame, field: str, force: bool = False) -> DataFrame:
    """Items whose label has not been settled yet. Runs before any model call."""
    if force:
        return items
    settled = cache.where((F.col("field") == field) & (F.col("source") != "fallback"))
    return items.join(settled, "product_id", "left_anti")


def numbered_batches(
    df: DataFrame, key: str, size: int = vocab.LABEL_BATCH, span: int = 3200
) -> DataFrame:
    """Adds (bucket, batch, number): batches of at most ``size``, numbered from 1 within.

    Each window partition is a range of ``span`` keys, so with a unique whole-number key no
    task orders more than ``span`` rows, and the numbers are the same in every run.
    """
    by_key = W.partitionBy("bucket").orderBy(key)
    place = F.row_number().over(by_key) - 1
    return (
        df.withColumn("bucket", F.floor(F.col(key) / span))
        .withColumn("_place", place)
        .withColumn("batch", F.floor(F.col("_place") / size) + 1)
        .withColumn("number", F.col("_place") % size + 1)
        .drop("_place")
    )


BATCHES_PER_TASK = 20
MAX_FAILED = 0.5


def ask(
    items: DataFrame,
    heading: str,
    call: Callable[[str], str],
    batch: int = vocab.LABEL_BATCH,
    parallel: int | None = None,
    path: str | None = None,
    attempts: int = 3,
    max_failed: float | None = MAX_FAILED,
) -> DataFrame:
    """(product_ids, reply, attempts, error) per batch of items (product_id, line).

    A batch is asked again, up to ``attempts`` times, if the call fails or its reply holds no JSON object; ``error`` is what
    the last attempt failed with, null if it did not. A failed call has a null reply. The job ends if more than ``max_failed`` of
    the batches have an error: a broken call must not label a catalogue with fallbacks.
    Batches form inside each partition, in the order of the keys. ``parallel`` is the number of partitions, by default as many as
    give each ``BATCHES_PER_TASK`` batches: neither the prompts nor what a lost task repeats depend on the cluster. Replies are written before anything reads them, so
    no later step can repeat a call.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def answer(rows: list) -> pd.DataFrame:
            lines = "\n".join(f"{i}. {line}" for i, (_, line) in enumerate(rows, start=1))
            reply = error = None
            for tried in range(1, attempts + 1):
                try:
                    reply = call(f"{heading}\n{lines}")
                    json.loads(reply[reply.index("{") : reply.rindex("}") + 1])
                    error = None
                    break
                except Exception as e:  # the last reply, if any, is read as far as it can be
                    error = f"{type(e).__name__}: {e}"
            return pd.DataFrame({"product_ids": [[pid for pid, _ in rows]], "reply": [reply], "attempts": [tried], "error": [error]})

        waiting: list = []
        for frame in frames:
            for row in zip(frame["product_id"].tolist(), frame["line"].tolist()):
                waiting.append(row)
                if len(waiting) == batch:
                    yield answer(waiting)
                    waiting = []
        if waiting:
            yield answer(waiting)

    if parallel is None:
        parallel = max(1, -(-items.count() // (batch * BATCHES_PER_TASK)))
    rows = items.select("product_id", "line").repartition(parallel, "product_id").sortWithinPartitions("product_id")
    failures = Observation()
    made = rows.mapInPandas(run, REPLY_SCHEMA).observe(
        failures, F.count(F.lit(1)).alias("batches"), F.count("error").alias("failed"), F.max("error").alias("error")
    )
    replies_ = written(made, "replies", path)
    n = failures.get
    if max_failed is not None and n["failed"] > max_failed * n["batches"]:
        raise RuntimeError(f"{n['failed']} of {n['batches']} model calls failed, one with {n['error']}")
    return replies_


def read_replies(batches: DataFrame, label: Label) -> DataFrame:
    """(product_id, value, source) of every item of every batch.

    Numbers count within their own batch. A reply that cannot be read gives the whole batch
    the fallback; an item that a good reply leaves out has a null value.
    """
    found = batches.withColumn("found", replies.answers(F.col("reply")))
    items = found.select("found", F.posexplode("product_ids").alias("place", "product_id"))
    items = items.select(
        "product_id",
        F.col("found").isNull().alias("failed"),
        replies.answer_for(F.col("found"), F.col("place") + 1).alias("answer"),
    )
    failed = F.col("failed")
    return items.select(
        "product_id",
        F.when(failed, label.fallback()).otherwise(label.read(F.col("answer"))).alias("value"),
        F.when(failed, "fallback").otherwise("model").alias("source"),
    )


def settle(items: DataFrame, read: DataFrame, label: Label) -> DataFrame:
    """Read values with the rules that follow the model: name rules, then the default."""
    if label.name_rule is None and not label.fill_missing:
        return read.where("value is not null")
    joined = items.select("product_id", "name").join(read, "product_id", "left")
    by_name = F.lit(None).cast("string")
    if label.name_rule is not None:
        by_name = label.name_rule(F.coalesce("name", F.lit("")))
    joined = joined.withColumn("_forced", by_name).withColumn("answer", F.col("value"))
    value = F.coalesce("_forced", "value", *([label.fallback()] if label.fill_missing else []))
    forced = F.col("_forced").isNotNull()
    source = F.when(forced, "name").otherwise(F.coalesce("source", F.lit("model")))
    return joined.select(
        "product_id",
        value.alias("value"),
        source.alias("source"),
        (forced & ~F.col("_forced").eqNullSafe(F.col("answer"))).alias("overridden"),
    ).where("value is not null")


def enrich(
    items: DataFrame,
    label: Label,
    call: Callable[[str], str],
    cache: DataFrame,
    model: str,
    force: bool = False,
    parallel: int | None = None,
    path: str | None = None,
    max_failed: float | None = MAX_FAILED,
) -> DataFrame:
    """Labels of all items for one field: cached ones, and new ones from the model.

    ``items`` holds (product_id, name, line), and menu_step for a label of one step only. ``overridden`` marks
    new labels for which the name's rule won over another answer of the model.
    """
    if label.only_step:
        items = items.where(F.col("menu_step") == label.only_step)
    todo = uncached(items, cache, label.field, force)
    batches = ask(todo, label.heading, call, parallel=parallel, path=path, max_failed=max_failed)
    settled = settle(todo, read_replies(batches, label), label)
    fresh = settled.select(
        "product_id",
        F.lit(label.field).alias("field"),
        "value",
        "source",
        F.lit(model).alias("model"),
        (F.col("overridden") if "overridden" in settled.columns else F.lit(False)).alias("overridden"),
    )
    if force:
        return fresh
    kept = cache.where((F.col("field") == label.field) & (F.col("source") != "fallback"))
    kept = kept.join(items, "product_id", "left_semi").withColumn("overridden", F.lit(False))
    return kept.select(*fresh.columns).unionByName(fresh)


def relabel_stale(
    items: DataFrame,
    label: Label,
    call: Callable[[str], str],
    stale: tuple[str, ...],
    model: str,
    dry_run: bool = True,
    **how,
) -> DataFrame | None:
    """New labels for items whose ``menu_step`` is retired; nothing is asked on a dry run."""
    old = items.where(F.col("menu_step").isin(*stale))
    if dry_run:
        return None
    empty = items.sparkSession.createDataFrame([], LABEL_SCHEMA)
    return enrich(old, label, call, empty, model, force=True, **how)


DIET = "struct<profile:string,contains:array<string>>"


def pivot_labels(labels: DataFrame, diet_source: str = "model") -> DataFrame:
    """One row per product with the five label columns, typed."""

    def one(field: str, column: str = "value") -> Column:
        return F.max(F.when(F.col("field") == field, F.col(column)))

    wide = labels.groupBy("product_id").agg(
        one("menu_step").alias("menu_step"),
        one("dish_role").alias("dish_role"),
        one("drink_role").alias("drink_role"),
        F.from_json(one("could_fit_event"), "array<string>").alias("could_fit_event"),
        F.from_json(one("predicted_diet"), DIET).alias("_diet"),
        one("predicted_diet", "model").alias("_model"),
    )
    stamped = F.when(
        F.col("_diet").isNotNull(),
        F.struct(
            F.col("_diet.profile").alias("profile"),
            F.col("_diet.contains").alias("contains"),
            F.lit(diet_source).alias("source"),
            F.col("_model").alias("model"),
        ),
    )
    return wide.withColumn("predicted_diet", stamped).drop("_diet", "_model")
