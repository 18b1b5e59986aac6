"""One document of each class of near duplicates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm import parity_join
from larder.llm.shared import free, small, stored


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without documents that link, over any number of links, to one with a smaller doc_id. Columns stay.

    Rows that share a doc_id are one document, of which the row with the least hash of all its columns stays. Rows without a doc_id cannot be
    named and stay, and so do documents without words, which link with nothing.
    """
    gone_id, again_id, tie, least, first_id = (free(docs, x) for x in ("_gone", "_again", "_tie", "_least", "_id"))
    classes = stored(parity_join.classes(docs).where("doc_id IS NOT NULL"), "classes")
    gone = classes.where("doc_id <> component_id").select(F.col("doc_id").alias(gone_id)).distinct()
    kept = docs.join(small(gone), F.col("doc_id") == F.col(gone_id), "left_anti")
    again = small(classes.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(again_id)))
    once = kept.join(again, F.col("doc_id") == F.col(again_id), "left_anti")
    if again.isEmpty():
        return kept
    repeats = kept.join(again, F.col("doc_id") == F.col(again_id), "left_semi").withColumn(tie, F.xxhash64(F.to_json(F.struct(*docs.columns))))
    first = repeats.groupBy("doc_id").agg(F.min(tie).alias(least)).withColumnRenamed("doc_id", first_id)
    repeats = repeats.join(first, (F.col("doc_id") == F.col(first_id)) & (F.col(tie) == F.col(least))).dropDuplicates(["doc_id"])
    return once.unionByName(repeats.select(*docs.columns))
