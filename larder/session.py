"""Session helpers: a configured builder and the shared folder for written intermediates."""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "larder", cpus: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench. A cluster brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LARDER_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read, as the cluster names it in spark.checkpoint.dir.

    Only a local master, where driver and executors share one disk, may go without it.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="larder-"))
    return context.getCheckpointDir()


def spread(df: DataFrame) -> DataFrame:
    """Rows of a scan over all cores, when its files give fewer partitions than there are cores.

    For costly work per row (parsing, markup, model calls) on few or unsplittable files. A scan
    with enough partitions, as any large one has, is left as it is: no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage behind costly or unrepeatable work (a model call): a lost executor
    re-reads the files instead of running that work again.
    """
    spark = df.sparkSession
    target = path or f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(target)
    return spark.read.schema(df.schema).parquet(target)
