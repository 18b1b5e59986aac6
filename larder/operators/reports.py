"""Label distributions, gap and hygiene reports."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from larder import vocab
from larder.session import written


def label_distribution(df: DataFrame, label: Column, missing: str = vocab.UNCLASSIFIED) -> DataFrame:
    """(label, n), null labels under the name ``missing``."""
    return df.groupBy(F.coalesce(label, F.lit(missing)).alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )


def tag_distribution(df: DataFrame, tags: str) -> DataFrame:
    """(label, n) over the entries of a list column."""
    return label_distribution(df.select(F.explode(tags).alias("tag")), F.col("tag"))


def unclassified(distribution: DataFrame) -> DataFrame:
    """The count of unclassified rows, no row when there is none."""
    return distribution.where(F.col("label") == vocab.UNCLASSIFIED)


def label_counts(labels: DataFrame) -> DataFrame:
    """(field, n, fallback, overridden) of a run's labels."""
    return labels.groupBy("field").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("source") == "fallback").alias("fallback"),
        F.count_if("overridden").alias("overridden"),
    )


def field_distributions(labels: DataFrame) -> DataFrame:
    """(field, label, n) of all fields in one pass; each event of a list counts, and of a diet its profile."""
    event = F.col("field") == "could_fit_event"
    diet = F.col("field") == "predicted_diet"
    one = F.when(diet, F.get_json_object("value", "$.profile")).otherwise(F.col("value"))
    values = F.when(event, F.from_json("value", "array<string>")).otherwise(F.array(one))
    rows = labels.select("field", F.explode(values).alias("label"))
    return rows.groupBy("field", F.coalesce("label", F.lit(vocab.UNCLASSIFIED)).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def missing_portions(products: DataFrame) -> DataFrame:
    """(step, product_id, sku) of active products without a portion count."""
    gaps = products.where("status = 'active' and persons is null")
    step = F.coalesce("menu_step", F.lit(vocab.UNCLASSIFIED_REPORT))
    return gaps.select(step.alias("step"), "product_id", "sku", "menu_step")


def gap_summary(gaps: DataFrame) -> DataFrame:
    """(position, step, n): steps by number of gaps, ties in step order, unknown first.

    The window runs over one row per step, not over the gaps.
    """
    counts = gaps.groupBy("step", "menu_step").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.groupBy("step").agg(
        F.sum("n").alias("n"),
        F.min(F.struct(F.col("menu_step").isNotNull(), "menu_step")).alias("first"),
    )
    order = W.orderBy(F.desc("n"), "first")
    return counts.select(F.row_number().over(order).alias("position"), "step", "n")


def grouped_report(rows: DataFrame, group: str, order: str) -> DataFrame:
    """Adds ``position``: the place, from 1, of each row in its group.

    Rows are dealt to ranges of (group, order) and sorted there. A row's place in its range, less that of the group's first row there, is
    added to the number of the group's rows in earlier ranges: no task needs a whole group.
    """
    ranged = rows.repartitionByRange(group, order).sortWithinPartitions(group, order)
    # Range number and place in one: the id counts the rows of each partition as they come.
    placed = written(ranged.withColumn("_id", F.monotonically_increasing_id()), "grouped")
    placed = placed.withColumn("_range", F.shiftright("_id", 33))
    totals = placed.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = W.partitionBy(group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(F.col(group).alias("_group"), F.col("_range").alias("_of"), "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_of"))
    position = F.col("_before") + F.col("_id") - F.col("_first") + 1
    return placed.join(totals, same).select(*rows.columns, position.alias("position"))


def write_gap_report(gaps: DataFrame, path: str) -> None:
    """The gaps as JSON lines, one folder per step, numbered in order of product id.

    Range partitions split a step of any size over many files; no list is built in memory.
    """
    rows = grouped_report(gaps.select("step", "product_id", "sku"), "step", "product_id")
    ranged = rows.repartitionByRange("step", "position").sortWithinPartitions("step", "position")
    ranged.write.mode("overwrite").partitionBy("step").json(path)


def stale_steps(
    products: DataFrame, stale: tuple[str, ...] = vocab.STALE_STEPS, step: str = "menu_step"
) -> DataFrame:
    """(position, step, n) of retired steps still in use, in list order."""
    position = F.array_position(F.array(*map(F.lit, stale)), F.col(step))
    return (
        products.where(F.col(step).isin(*stale))
        .groupBy(F.col(step).alias("step"), position.alias("position"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def field_presence(df: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """(field, n, total): rows that hold each field, and all rows, in one pass; a column the table lacks counts 0."""
    counts = [
        (F.count(c) if c in df.columns else F.lit(0).cast("bigint")).alias(c) for c in fields
    ]
    one = df.agg(*counts, F.count(F.lit(1)).alias("_rows"))
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("n"), F.col("_rows").alias("total")) for c in fields])
    return one.select(F.inline(pairs))


def any_field(df: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Rows that hold at least one of the fields."""
    here = [c for c in fields if c in df.columns]
    return df.where(F.coalesce(*[F.when(F.col(c).isNotNull(), True) for c in here], F.lit(False)))
