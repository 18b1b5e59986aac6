"""Product families per group of names."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from larder import vocab
from larder.functions.text import family_word, fold_word


def with_family(df: DataFrame, name: str, word: str = "word", key: str = "key") -> DataFrame:
    """Adds the family word of a name and its grouping key.

    Two steps on purpose: the key's expression uses the word several times.
    """
    return df.withColumn(word, family_word(F.col(name))).withColumn(key, fold_word(F.col(word)))


def rank_families(
    df: DataFrame, group: list[str], limit: int = vocab.MAX_FAMILIES, n: str | None = None
) -> DataFrame:
    """(group..., rank, label, n): families of each group, most frequent first.

    Takes rows with ``word`` and ``key``, each counting once or ``n`` times. Ties of count go
    by key; the label is the most frequent spelling, the smaller one if tied.
    """
    times = F.sum(n) if n else F.count(F.lit(1))
    spellings = df.groupBy(*group, "key", "word").agg(times.alias("n"))
    families = spellings.groupBy(*group, "key").agg(
        F.min_by("word", F.struct(-F.col("n"), F.col("word"))).alias("label"),
        F.sum("n").alias("n"),
    )
    # Names without a family go only here: an earlier filter would work out every word twice.
    families = families.where("label <> ''")
    best = W.partitionBy(*group).orderBy(F.desc("n"), F.asc("key"))
    return (
        families.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= limit)
        .select(*group, "rank", "label", "n")
    )
