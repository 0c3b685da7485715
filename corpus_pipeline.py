"""The corpus pipeline: toxic documents go, one of each near-duplicate group stays, sources are mixed, the rest is packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.

Odd rows: null, empty and blank texts are not toxic, are copies of each other, weigh nothing in the mix, and are packed
as the end id alone if they are taken; null ids and sources are kept as such; repeated rows are copies; very long texts
are read whole; extra columns of any type and name pass through; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import mixing, nearcopies, packing, toxicity
from lectern.llm.queries import WORD_BPE
from lectern.runtime import new_path


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier chain judges toxic; a text without words is judged by the base rate."""
    return toxicity.reject(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the smallest id (null last, ties by row hash) in each group linked by five-word similarity of 0.8 or more.

    SimHash links give the first candidates, MinHash bands those that SimHash cannot find; exact shingle sets decide.
    """
    return nearcopies.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that the sources' words come to the target weights; a null source is a source."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents' tokens into sequences: one row for each piece; a null id stays null."""
    return packing.pack(docs, WORD_BPE)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Model fitting, near copies, random rounding and tokenization are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each written as Parquet to shared storage and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
