"""Token counts of whole texts, map-side, without any shuffle of pre-tokens."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from locusflow.llm import tokens


def frequent_lengths(docs: DataFrame, path: str, text_col: str = "text", sample_docs: int = 1000,
                     longest: int = 20_000, entries: int = 50_000) -> dict[str, int]:
    """Token counts of the chunks that are frequent in ``sample_docs`` texts of at most ``longest`` characters.

    The sample only decides what workers know from the start, never a count: every text is counted in full. Its size
    and that of the table are bounded by the parameters.
    """
    lookup, seen = tokens.TwoTier(path, "byte", False), Counter()
    for row in docs.select(F.col(text_col).alias("text")).filter(F.length("text") <= longest).take(sample_docs):
        seen.update(lookup._cut(row.text)[1:])
    table = {}
    for chunk, n in seen.most_common(entries):
        if n < 2 or len(chunk) > 64:
            continue
        try:
            table[chunk] = lookup.chunks[chunk]
        except tokens.Whole:
            continue
    return table


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512,
                 frequent: dict[str, int] | None = None) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (``n_tokens > limit``).

    Special strings inside a text count as the library counts them by default. A null text counts as empty (0 tokens);
    repeated rows give repeated rows; a null id is kept; other columns are left out; an empty table gives no rows.
    ``frequent`` is broadcast; its size is bounded by ``frequent_lengths``.
    """
    if frequent is None:
        frequent = frequent_lengths(docs, path, text_col)
    table = docs.sparkSession.sparkContext.broadcast(frequent)
    kind = docs.schema[id_col].dataType.simpleString()

    def count(batches):
        lookup = tokens.worker_lookup(path, "byte", False, table.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n = [lookup(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())], ["id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return (rows.mapInArrow(count, f"id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
            .withColumnRenamed("id", id_col))
