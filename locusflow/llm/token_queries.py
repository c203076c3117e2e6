"""Queries of the operators that tokenize: token counts and packing."""

from __future__ import annotations

import public_tokenizers

from locusflow.llm import packing, token_counts
from locusflow.llm.registry import documents, query


@query("op2_token_counts")
def op2_token_counts(spark, sf_dir):
    """How many tokens has each document, and which exceed 512?"""
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query("op6_packing")
def op6_packing(spark, sf_dir):
    """In which sequence does each piece of each document lie?"""
    return packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
