"""Where intermediate tables go: the folder that all executors share."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` as the cluster names it, else the context's; a local master may go without."""
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not path:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        context.setCheckpointDir(path := tempfile.mkdtemp(prefix="shared-"))
    return path.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def lean(spark: SparkSession, rows: int = 2_000) -> None:
    """Arrow batches of at most ``rows`` rows: texts are long, and several Python workers share an executor's memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written once and read back, so that costly work is neither repeated nor lost with an executor."""
    path = fresh(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free(df: DataFrame, name: str) -> str:
    """``name``, or with underscores behind it if ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """Marked for broadcast if it has at most ``rows`` (narrow) rows; else left to Spark, which joins by shuffling.

    Stored first, so that counting costs no second run.
    """
    df = stored(df, "small")
    return F.broadcast(df) if df.count() <= rows else df


def numbered(df: DataFrame, key: str, place: str) -> DataFrame:
    """Adds ``place``: the number, from 1, of each row among those that share ``key``.

    Rows are dealt to ranges, so that a hot key is spread; a row's place in its range is added to the key's rows in earlier ones.
    """
    tie, spot, group, first, before = (free(df, x) for x in ("_tie", "_spot", "_group", "_first", "_before"))
    ranged = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(key, tie).sortWithinPartitions(key, tie)
    placed = stored(ranged.withColumn(spot, F.monotonically_increasing_id()), "numbered")
    per = placed.groupBy(F.col(key).alias(group), F.shiftright(spot, 33).alias(tie)).agg(F.min(spot).alias(first), F.count(F.lit(1)).alias(spot))
    earlier = Window.partitionBy(group).orderBy(tie).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(group, first, F.col(tie).alias(before), F.coalesce(F.sum(spot).over(earlier), F.lit(0)).alias(tie))
    rows = placed.drop(tie).join(per, (F.col(key) == F.col(group)) & (F.shiftright(spot, 33) == F.col(before)))
    return rows.withColumn(place, F.col(tie) + F.col(spot) - F.col(first) + 1).select(*df.columns, place)
