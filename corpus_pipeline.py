"""From raw documents to packed training sequences: quality, near copies, benchmark passages, secrets, packing."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from locusflow.llm import decontaminate, neardup, packing, quality, secrets
from locusflow.operators.scaling import checkpoint_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels of the rows that aren't held out."""
    return quality.accepted(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near copies."""
    return neardup.one_of_each_class(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def redacted_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking secrets replaced by a mark; ``n_chars`` follows the text."""
    out = secrets.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in training sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality classifier", good_documents), ("near duplicates", distinct_documents), ("benchmark decontamination", clean_documents),
          ("secret scan", redacted_documents), ("packing", packed_documents)]

# The stages hold a trained model, sketches and a tokenizer, which SQL can't express; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage's result is written as Parquet to the shared folder of the session and read again by the next."""
    docs = _table(spark, sf_dir, "documents")
    folder = f"{checkpoint_folder(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
