"""Exact median per group that never brings an unbounded group into one task."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from larder.session import written


def exact_median(
    df: DataFrame,
    keys: list[str],
    value: str,
    out: str,
    size: str | None = None,
    weight: str | None = None,
) -> DataFrame:
    """(keys..., out): median of the non-null values, mean of the two middles if even.

    ``value`` must be a finite double. Groups without a value have no row, unless ``size`` names
    a column for the number of rows, nulls included. ``weight`` names a column that says how
    often a row counts.

    A distributed selection. Equal values of a group combine before the shuffle. The counts
    are then dealt to ranges of (keys, value), so a group of any size is spread over as many
    ranges as its values need, however close they lie. Totals per group and range tell
    which range holds the middle; only that one is searched. No task orders more than a range.
    """
    times = F.sum(weight) if weight else F.count(F.lit(1))
    rows = df if size else df.where(F.col(value).isNotNull())
    counts = rows.groupBy(*keys, value).agg(times.alias("_n"))
    ranged = counts.repartitionByRange(*keys, value).withColumn("_range", F.spark_partition_id())
    # Written, so that totals and values are of the same ranges whatever is run again.
    placed = written(ranged, "ranges").withColumn("_known", F.when(F.col(value).isNotNull(), F.col("_n")).otherwise(0))
    totals = placed.groupBy(*keys, "_range").agg(F.sum("_n").alias("_all"), F.sum("_known").alias("_in"))
    group = W.partitionBy(*keys)
    upto = F.sum("_in").over(group.orderBy("_range").rowsBetween(W.unboundedPreceding, W.currentRow))
    total = F.sum("_in").over(group)
    middle = totals.select(
        *keys, "_range", "_in", upto.alias("_upto"), F.sum("_all").over(group).alias("_size"),
        F.floor((total + 1) / 2).alias("_low"), (F.floor(total / 2) + 1).alias("_high"),
    )
    middle = middle.where(_holds_middle("_in")).withColumn("_before", F.col("_upto") - F.col("_in")).drop("_in", "_upto")
    inside = _match(placed, middle, [*keys, "_range"])
    running = W.partitionBy(*keys, "_range").orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    searched = inside.withColumn("_upto", F.col("_before") + F.sum("_known").over(running))
    hit = F.when(F.col(value).isNotNull() & _holds_middle("_known"), F.col(value))
    found = searched.groupBy(*keys).agg(((F.min(hit) + F.max(hit)) / 2).alias(out), F.max("_size").alias(size or "_size"))
    return found.select(*keys, size, out) if size else found.drop("_size")


def _match(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Join on keys that may be null, keeping the left side's."""
    renamed = right.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    return left.join(renamed, same).drop(*[f"_of_{k}" for k in keys])


def _holds_middle(n: str):
    """Is one of the two middles among the ``n`` places that end at ``_upto``?"""
    return (F.col("_upto") - F.col(n) < F.col("_high")) & (F.col("_upto") >= F.col("_low"))
