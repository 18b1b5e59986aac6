"""Curated concepts per store from a wide table of flags."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder import vocab
from larder.functions.numbers import to_double
from larder.operators.merge import last_by_key


def carried_concepts(
    wide: DataFrame, store: str, status: str, concepts: list[str], order: str = "position"
) -> DataFrame:
    """(store_id, concept) for every flag "1" of an active store.

    A store id that is no whole number is skipped; of a repeated one the last row counts.
    """
    whole = F.when(F.col(store).rlike(r"^\s*[+-]?\d+\s*$"), to_double(F.col(store)).cast("bigint"))
    rows = wide.where(F.col(status) == vocab.ACTIVE_STATUS).withColumn("store_id", whole)
    rows = rows.where("store_id is not null").select(
        "store_id", order, F.array(*[F.col(f"`{c}`") for c in concepts]).alias("flags")
    )
    rows = last_by_key(rows, ["store_id"], order)
    names = F.array(*map(F.lit, concepts))
    kept = F.filter(
        F.zip_with(names, "flags", lambda c, f: F.when(f == "1", c)), lambda c: c.isNotNull()
    )
    return rows.select("store_id", F.explode(kept).alias("concept"))


def concept_sets(carried: DataFrame) -> DataFrame:
    """(store_id, curated_concepts): sorted set, as many entries as there are columns at most."""
    return carried.groupBy("store_id").agg(
        F.sort_array(F.collect_set("concept")).alias("curated_concepts")
    )
