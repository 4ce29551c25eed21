"""A training corpus from ``documents`` in five stages, each of which works on all rows that the
one before it has kept.

Toxic documents go, one document of each group of near duplicates stays, documents that hold
benchmark items go, personal data is replaced in the texts of the rest, and what is left is
packed into length buckets. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linclass.llm import decontaminate, jaccard_join, packing, pii, toxicity
from linclass.llm.text import scratch_folder, small_batches


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels of the given rows."""
    small_batches(spark)
    return toxicity.drop_toxic(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of the 5-shingle Jaccard join (0.8) the document with the least id stays."""
    small_batches(spark)
    return jaccard_join.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark item, or a piece of one, within the edit budget go."""
    small_batches(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are replaced; ``n_chars`` follows the text."""
    small_batches(spark)
    clean = pii.sanitise(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document that is left."""
    small_batches(spark)
    return packing.length_buckets(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("personal_data", replace_personal_data),
    ("packing", pack),
]

#: The stages are not SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again by the next."""
    folder = scratch_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
