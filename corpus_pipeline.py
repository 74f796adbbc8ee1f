"""The corpus pipeline: filter, keep one of near copies, replace personal data, pack.

Every stage gets what the one before kept, read from Parquet, and gives documents with the
same columns; the last gives the pieces of the documents and the sequence of each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evalflow.llm import bpe, jaccard, packing, pii, rules, toxicity
from evalflow.llm.common import written

#: Key of the surrogates; a real corpus takes its own.
KEY = pii.DEMO_KEY


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return rules.filter_documents(docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, learned from the labelled ones among them, scores below one half."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.filter_documents(docs, toxicity.learn_model(docs, labels, toxicity.not_held_out()))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group of near copies: five words, similarity 0.75."""
    return jaccard.one_of_each(docs)


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by surrogates; lengths follow the new text."""
    replaced = pii.replace_personal(docs, KEY)
    return replaced.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else replaced


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens, and the sequence and place of each."""
    return packing.pack(packing.pieces(docs, bpe.word_vocabulary()))


STAGES = [
    ("quality", quality),
    ("toxicity", toxic),
    ("near_copies", near_copies),
    ("personal", personal),
    ("packing", packed),
]

#: Learned scores, keyed surrogates and packing are beyond SQL; tests hold the
#: stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each from the Parquet of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
