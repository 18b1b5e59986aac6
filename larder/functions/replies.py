"""Column expressions that read a model's reply: fence, numbered answers, label values."""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder import vocab
from larder.functions import variants as V
from larder.functions.text import strip


def unfence(reply: Column) -> Column:
    """Reply text without its code fence and the "json" mark after it."""
    text = strip(reply)
    inner = F.get(F.split(text, "```"), F.lit(1))
    return F.when(
        F.startswith(text, F.lit("```")), F.regexp_replace(inner, r"\Ajson", "")
    ).otherwise(text)


def answers(reply: Column) -> Column:
    """ARRAY<STRUCT<number INT, value VARIANT>> of a reply, null when it is no JSON object.

    Keys that are no whole number (a product name, say) are left out.
    """
    parsed = V.try_parse(unfence(reply))
    pairs = F.map_entries(
        F.when(V.is_object(parsed), F.try_variant_get(parsed, "$", "map<string,variant>"))
    )
    numbered = F.transform(
        pairs, lambda p: F.struct(_item_number(p["key"]).alias("number"), p["value"])
    )
    return F.filter(numbered, lambda a: a["number"].isNotNull())


def _item_number(key: Column) -> Column:
    text = strip(key)
    digits = F.replace(text, F.lit("_"), F.lit(""))
    return F.when(text.rlike(r"^[+-]?\d+(_\d+)*$"), digits.try_cast("int"))


def answer_for(found: Column, number: Column) -> Column:
    """Value answered for one item, null when the reply leaves it out."""
    mine = F.filter(found, lambda a: a["number"] == number)
    return F.get(mine, F.size(mine) - 1)["value"]


def label(text: Column, allowed: Iterable[str], fallback: str | None = None) -> Column:
    """Known label in its own spelling, whatever the case of ``text``; else the fallback."""
    return F.coalesce(
        F.try_element_at(_spelling(allowed), strip(F.upper(text))), F.lit(fallback)
    )


def _spelling(allowed: Iterable[str]) -> Column:
    pairs = [F.lit(part) for word in allowed for part in (word.upper(), word)]
    return F.create_map(*pairs)


def event_tags(tags: Column) -> Column:
    """Events of a list of texts: sorted, once each; ["ALL"] when it says so or names none."""
    known = F.transform(tags, lambda t: label(t, (*vocab.EVENTS, vocab.ALL_EVENTS)))
    known = F.array_sort(F.array_distinct(F.array_compact(known)))
    every = F.array(F.lit(vocab.ALL_EVENTS))
    partial = (F.size(known) > 0) & ~F.array_contains(known, vocab.ALL_EVENTS)
    return F.when(F.coalesce(partial, F.lit(False)), known).otherwise(every)


def diet(profile: Column, contains: Column) -> Column:
    """Diet prediction. A profile that its own contents contradict becomes unknown."""
    held = F.transform(contains, lambda c: label(c, vocab.DIET_CONTAINS))
    held = F.array_sort(F.array_distinct(F.array_compact(held)))
    held = F.coalesce(held, F.array().cast("array<string>"))
    named = label(profile, vocab.DIET_PROFILES)
    animal = F.arrays_overlap(held, F.array(*map(F.lit, ("viande", "poisson", "crustaces"))))
    contradicted = (named.isin("vegan", "vegetarien") & animal) | (
        (named == "poisson") & F.array_contains(held, "viande")
    )
    return F.struct(F.when(~contradicted, named).alias("profile"), held.alias("contains"))


def label_value(value: Column, allowed: Iterable[str], fallback: str) -> Column:
    """Answer of a one-word label; anything unknown, lists too, becomes the fallback."""
    return F.when(value.isNotNull(), label(value.try_cast("string"), allowed, fallback))


def events_value(value: Column) -> Column:
    """Answer of the event label as a list; an answer that is no list means every event."""
    texts = F.transform(V.items(value, "$"), lambda t: t.try_cast("string"))
    return F.when(value.isNotNull(), event_tags(texts))


def diet_value(value: Column) -> Column:
    """Answer of the diet label; an answer that is no object means unknown."""
    contains = F.transform(V.items(value, "$.contient"), lambda t: t.try_cast("string"))
    return F.when(value.isNotNull(), diet(V.text(value, "$.profil"), contains))
