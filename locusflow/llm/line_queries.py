"""Query of the line dedup, with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusflow.llm import lines
from locusflow.llm.registry import documents, query

_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_SQL = f"""
WITH texts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS line FROM texts),
keyed AS (SELECT doc_id, i, line,
                 translate(trim(line, {_BLANK}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
often AS (SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT a.*, b.k IS NOT NULL AND a.doc_id <> b.last AS goes FROM keyed a LEFT JOIN often b ON a.k = b.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE goes) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT goes), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query("op12_line_dedup", _SQL)
def op12_line_dedup(spark, sf_dir):
    """What is left of each document without lines that stand in three or more?"""
    out = lines.deduplicate_lines(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
