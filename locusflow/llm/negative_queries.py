"""Query of the hard-negative mining, with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusflow.llm import negatives
from locusflow.llm.registry import query, table

_SQL = """
WITH sound AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
               FROM embeddings
               WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
positives AS (SELECT a.id AS anchor_id, b.id AS positive_id, a.label, a.v, list_inner_product(a.v, b.v)::BIGINT AS score
              FROM sound a JOIN sound b ON a.label = b.label AND a.id <> b.id WHERE a.id % 50 = 0
              QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY list_inner_product(a.v, b.v) DESC, b.id) <= 5),
scored AS (SELECT a.id AS anchor_id, a.label, b.id AS negative_id, list_inner_product(a.v, b.v)::BIGINT AS score
           FROM sound a JOIN sound b ON a.label <> b.label WHERE a.id % 50 = 0)
SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.negative_id)::INTEGER AS rank,
       s.negative_id, p.score AS positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY rank <= 3
"""


@query("op11_hard_negatives", _SQL)
def op11_hard_negatives(spark, sf_dir):
    """Which rows of other labels come closest to an anchor without coming as close as its positives?"""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)
