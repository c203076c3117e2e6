"""Queries of the operators that look for copies."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusflow.llm import decontaminate, embeddings, neardup, repeats
from locusflow.llm.registry import documents, query, table


@query("op3_benchmark_decontamination")
def op3_benchmark_decontamination(spark, sf_dir):
    """Which documents hold which benchmark items, with at least 0.8 of the words in place?"""
    found = decontaminate.contaminated(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.drop("th").withColumnsRenamed({"id": "doc_id", "item": "item_id"})


@query("op8_minhash_near_dedup")
def op8_minhash_near_dedup(spark, sf_dir):
    """Which class of near copies does each document belong to, and which one stands for it?"""
    return neardup.near_duplicates(documents(spark, sf_dir)).drop("th")


@query("op9_repeated_strings")
def op9_repeated_strings(spark, sf_dir):
    """What is left of each document without byte strings of 400 or more that stand elsewhere too?"""
    out = repeats.remove_repeats(documents(spark, sf_dir))
    share = F.when(F.col("n_bytes") > 0, F.col("n_removed") / F.col("n_bytes")).otherwise(F.lit(0.0))
    return out.withColumns({"removed": F.col("n_removed") > 0, "share_removed": share})


@query("op10_embedding_near_dedup")
def op10_embedding_near_dedup(spark, sf_dir):
    """Which embeddings of a label are near copies of each other?"""
    return embeddings.near_embeddings(table(spark, sf_dir, "embeddings"))
