"""Keyed upsert, soft delete and update of tables, each one join."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_by_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key: the one with the greatest ``order``, which is kept.

    An aggregate, not a window: rows of a hot key combine before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_last"))
    return picked.select(*keys, "_last.*").select(*df.columns)


def upsert(old: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Old table with the batch merged in; both sides hold each key once.

    Columns of the batch overwrite, nulls included; columns it lacks survive.
    """
    joined = _matched(old, batch, keys)
    columns = [*old.columns, *[c for c in batch.columns if c not in old.columns]]
    return joined.select(*[_merged(c, old, batch, keys).alias(c) for c in columns])


def upsert_counts(old: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """One row (upserted, modified): new keys, and matched rows the batch really changes."""
    merged = merge_export(old, batch, keys, F.lit(None).cast("timestamp"))
    return merged.agg(*[counted(kind).alias(kind) for kind in ("upserted", "modified")])


def counted(kind: str) -> Column:
    """Rows of a merge with that change."""
    return F.count_if(F.col("change") == kind)


def change_feed(merged: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., change): one row per key that a merge adds, changes or removes."""
    return merged.where(F.col("change").isNotNull()).select(*keys, "change")


def merge_export(
    old: DataFrame,
    batch: DataFrame,
    keys: list[str],
    now: Column,
    status: tuple[str, object] | None = None,
) -> DataFrame:
    """Upsert and soft delete in the same join, with a ``change`` column per row.

    The batch is the whole export, so the join also tells which rows it lacks. ``change`` is
    "upserted", "modified", "removed" or null. Without ``status`` nothing is removed.
    """
    if status and "removed_at" not in old.columns:
        old = old.withColumn("removed_at", F.lit(None).cast("timestamp"))
    joined = _matched(old, batch, keys)
    columns = [*old.columns, *[c for c in batch.columns if c not in old.columns]]
    shaped = {c: _merged(c, old, batch, keys) for c in columns}
    change = _change(old, [c for c in batch.columns if c not in keys])
    if status:
        field, inactive = status
        absent = F.col("new._here").isNull()
        gone = absent & ~F.col(f"old.{field}").eqNullSafe(F.lit(inactive))
        shaped[field] = F.when(gone, F.lit(inactive)).otherwise(shaped[field])
        shaped["removed_at"] = F.when(gone, now).when(absent, F.col("old.removed_at"))
        change = F.when(gone, "removed").otherwise(change)
    return joined.select(*[shaped[c].alias(c) for c in columns], change.alias("change"))


def active_before(status: tuple[str, object]) -> Column:
    """Rows of a merge that the table held as active."""
    gone = F.col("change").eqNullSafe(F.lit("removed"))
    old = ~F.col("change").eqNullSafe(F.lit("upserted"))
    return F.count_if(old & (gone | ~F.col(status[0]).eqNullSafe(F.lit(status[1]))))


def check_removals(gone: int, active: int, max_ratio: float) -> None:
    """Stop the run when an export, an empty one say, would remove too many active rows."""
    if active and gone / active > max_ratio:
        raise ValueError(f"{gone} of {active} active rows would be removed")


def _change(old: DataFrame, fields: list[str]) -> Column:
    """What the batch does to a row of the join with it, null when nothing."""
    changed = F.lit(False)
    for c in fields:
        before = F.col(f"old.{c}") if c in old.columns else F.lit(None)
        changed = changed | ~F.col(f"new.{c}").eqNullSafe(before)
    there = F.col("new._here").isNotNull()
    return F.when(there & F.col("old._here").isNull(), "upserted").when(there & changed, "modified")


def _matched(old: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    left = old.withColumn("_here", F.lit(True)).alias("old")
    right = batch.withColumn("_here", F.lit(True)).alias("new")
    same = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys]
    return left.join(right, same, "full_outer")


def _merged(c: str, old: DataFrame, batch: DataFrame, keys: list[str]) -> Column:
    if c in keys:
        return F.coalesce(F.col(f"new.{c}"), F.col(f"old.{c}"))
    if c not in batch.columns:
        return F.col(f"old.{c}")
    if c not in old.columns:
        return F.col(f"new.{c}")
    return F.when(F.col("new._here"), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}"))


def soft_delete(
    table: DataFrame,
    seen: DataFrame,
    keys: list[str],
    field: str,
    inactive,
    now: Column,
    max_ratio: float | None = None,
) -> DataFrame:
    """Rows whose key the export lacks become inactive, with ``removed_at``; none is dropped.

    A merge of the export's keys alone. Rows that are inactive already keep their date, and a row that
    is back loses it. With ``max_ratio`` the job stops when more than that share of the active rows
    would go, as it does for an empty export.
    """
    status = (field, inactive)
    merged = merge_export(table, seen.select(*keys).distinct(), keys, now, status)
    merged = merged.where(~F.col("change").eqNullSafe(F.lit("upserted")))
    if max_ratio is not None:
        n = merged.agg(counted("removed").alias("gone"), active_before(status).alias("active")).first()
        check_removals(n.gone, n.active, max_ratio)
    return merged.drop("change")


def update_matched(
    table: DataFrame, changes: DataFrame, keys: list[str], overwrite: bool = True
) -> DataFrame:
    """Set the columns of ``changes`` on rows with a match; unmatched keys are ignored.

    ``changes`` holds each key once. With ``overwrite`` off, nulls leave the old value.
    """
    fields = [c for c in changes.columns if c not in keys]
    marked = changes.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in fields], F.lit(True).alias("_here"))
    joined = table.join(marked, keys, "left")
    shaped = {}
    for c in fields:
        old = F.col(c) if c in table.columns else F.lit(None)
        new = F.col(f"_new_{c}") if overwrite else F.coalesce(f"_new_{c}", old)
        shaped[c] = F.when(F.col("_here"), new).otherwise(old)
    columns = [*table.columns, *[c for c in fields if c not in table.columns]]
    return joined.select(*[shaped.get(c, F.col(c)).alias(c) for c in columns])


def drop_fields(table: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Table without the given columns; those it lacks are ignored."""
    return table.drop(*fields)
