"""Name embeddings: which products, the plugged-in embedder, the vector table."""

from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from larder import vocab
from larder.functions.text import is_blank, strip
from larder.session import written

BATCHES_PER_TASK = 4
EMBEDDED = "product_id bigint, menu_step string, status string, values array<float>"


def embeddable(products: DataFrame) -> DataFrame:
    """Active products with a step and a name, unless they are not recommendable."""
    return products.where(
        (F.col("status") == "active")
        & F.col("menu_step").isNotNull()
        & (F.col("name") != "")
        & ~F.col("recommendable").eqNullSafe(F.lit(False))
    )


def embed(
    products: DataFrame,
    embedder: Callable[[list[str]], list],
    batch: int = vocab.EMBED_BATCH,
    parallel: int | None = None,
    path: str | None = None,
) -> DataFrame:
    """(product_id, menu_step, status, values); a failed batch gives null values.

    Batches form inside each partition, in the order of the keys. ``parallel`` is the number of partitions, by default as many as give each
    ``BATCHES_PER_TASK`` batches, so batches do not depend on the cluster. The result is written, so the embedder runs once.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch):
                part = frame.iloc[start : start + batch]
                try:
                    found = [np.asarray(v, "float32") for v in embedder(part["text"].tolist())]
                    if len(found) != len(part):
                        raise ValueError(f"{len(found)} vectors for {len(part)} texts")
                except Exception:
                    found = [None] * len(part)
                yield part[["product_id", "menu_step", "status"]].assign(values=found)

    rows = embeddable(products).select(
        "product_id", "menu_step", "status", strip(F.col("name")).alias("text")
    )
    rows = rows.where("text <> ''")
    parallel = parallel or max(1, -(-rows.count() // (batch * BATCHES_PER_TASK)))
    rows = rows.repartition(parallel, "product_id").sortWithinPartitions("product_id")
    return written(rows.mapInPandas(run, EMBEDDED), "vectors", path)


def embed_counts(products: DataFrame, embedded: DataFrame) -> DataFrame:
    """One row (eligible, blank_name, failed)."""
    none = F.lit(0).cast("bigint")
    named = embeddable(products).agg(
        F.count(F.lit(1)).alias("eligible"),
        F.count_if(is_blank(F.col("name"))).alias("blank_name"),
        none.alias("failed"),
    )
    lost = embedded.agg(
        none.alias("eligible"),
        none.alias("blank_name"),
        F.count_if(F.coalesce(F.size("values") <= 0, F.lit(True))).alias("failed"),
    )
    both = named.unionByName(lost)
    return both.agg(*[F.sum(c).alias(c) for c in both.columns])


def vector_records(embedded: DataFrame) -> DataFrame:
    """(id, values, metadata) of everything that has a vector."""
    return embedded.where(F.size("values") > 0).select(
        F.col("product_id").cast("string").alias("id"),
        "values",
        F.struct(
            F.coalesce("menu_step", F.lit("")).alias("menu_step"),
            F.coalesce("status", F.lit("inactive")).alias("status"),
        ).alias("metadata"),
    )


Client = Callable[[], Callable[[list[dict]], None]]


def _sink(client: Client, batch: int, attempts: int) -> type[DataSource]:
    """A data source that writes records to a remote index through ``client``."""

    class Writer(DataSourceWriter):
        def write(self, rows: Iterator[Row]) -> WriterCommitMessage:
            send = client()  # one per partition
            rows = iter(rows)
            while part := [r.asDict(recursive=True) for r in islice(rows, batch)]:
                for left in range(attempts - 1, -1, -1):
                    try:
                        send(part)
                        break
                    except Exception:
                        if not left:
                            raise
            return WriterCommitMessage()

        def commit(self, messages: list[WriterCommitMessage | None]) -> None:
            """Nothing to do: every slice is written by id as a whole."""

        def abort(self, messages: list[WriterCommitMessage | None]) -> None:
            """Slices that were sent stay; the next run sends the same ids again."""

    class Sink(DataSource):
        @classmethod
        def name(cls) -> str:
            return "vector_index"

        def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
            return Writer()

    return Sink


def send_vectors(records: DataFrame, client: Client, batch: int = vocab.VECTOR_BATCH, attempts: int = 3) -> int:
    """Write the records to a remote index in slices; how many there were.

    ``client()`` is called once per partition and gives the function that takes a slice. It must write by id: a slice that fails is sent again, up to
    ``attempts`` times, and so is all of a task that Spark runs again. What fails every time ends the job.
    """
    spark = records.sparkSession
    spark.dataSource.register(_sink(client, batch, attempts))
    sent = Observation()
    records.observe(sent, F.count(F.lit(1)).alias("n")).write.format("vector_index").mode("append").save()
    return sent.get["n"]
