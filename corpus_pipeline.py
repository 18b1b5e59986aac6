"""From documents to token files: toxic, copied and contaminated documents go, sources are mixed, ids are written.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next one's docs. All but the last return the columns of documents; extra columns are passed on.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import decontaminate, mixing, near_duplicates, planes, severity
from larder.llm.queries import TOKENIZER
from larder.llm.shared import free, fresh, lean, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of any toxic grade is below one half. Texts without a word, null ones too, stay."""
    lean(spark)
    model = severity.learned(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = free(docs, "_assessed")
    rows = docs.withColumn(name, severity.assess(F.col("text"), model))
    empty = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return rows.where((F.col(name)["p_toxic"] < 0.5) | empty).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near duplicates."""
    lean(spark)
    return near_duplicates.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text, without the spans that are."""
    lean(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the target weights of its source ask for: not at all, once or twice."""
    lean(spark)
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in bit-plane files under the shared folder; one row per document written, read back from them."""
    lean(spark)
    return planes.report(docs, fresh(spark, "token-planes"), TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_copies),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]

#: No SQL: toxicity is a fitted model, mixing rounds by chance, and token ids come from a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
