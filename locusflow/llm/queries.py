"""All dealt queries; importing this module registers them."""

from __future__ import annotations

import corpus_pipeline
from locusflow.llm import duplicate_queries, line_queries, negative_queries, text_queries, token_queries, trie_queries  # noqa: F401
from locusflow.llm.registry import REGISTRY, query

query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
