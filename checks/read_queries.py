"""Read classification, trimming and collapsing."""

from pyspark.sql import functions as F

from checks.fixtures import duck, view
from checks.registry import query
from locusflow.operators import align as al, funnel as fn, reads as rd
from locusflow.schema import AdapterSet

A = AdapterSet()


def _reads(spark, d):
    return view(spark, d, "fx_reads")


def _matched(name: str, src: str, mate: str, adapter: str, end: str, low: int, rate: float) -> str:
    """CTEs adding the best match of an adapter as m_start (0-based), m_stop; NULL without a match."""
    m = len(adapter)
    seq = f"{mate}_seq"
    last = f"length({seq}) - {m} + 1" if end == "5p" else f"length({seq}) - {low} + 1"
    return f"""
{name}_p AS (SELECT read_id, {seq} AS s, unnest(generate_series(1, {last})) AS i FROM {src}),
{name}_o AS (SELECT *, least({m}, length(s) - i + 1) AS o FROM {name}_p),
{name}_e AS (SELECT *, hamming(substr(s, i, o), substr('{adapter}', 1, o)) AS e FROM {name}_o WHERE o >= {low}),
{name}_b AS (SELECT read_id, i - 1 AS m_start, i - 1 + o AS m_stop FROM {name}_e WHERE e <= floor({rate} * o + 1e-9)
             QUALIFY row_number() OVER (PARTITION BY read_id ORDER BY o - e DESC, e, i) = 1),
{name} AS (SELECT s.*, m_start, m_stop FROM {src} s LEFT JOIN {name}_b USING (read_id))"""


_PROV = _matched("prov", "fx_reads", "r1", A.provirus, "5p", 28, 0.1)
_LTR = _matched("ltr", "fx_reads", "r1", A.ltr, "5p", 23, 0.1)
_AFTER_LTR = ("""aftltr AS (SELECT sample, tag, read_id, substr(r1_seq, m_stop + 1) AS r1_seq, substr(r1_qual, m_stop + 1) AS r1_qual, r2_seq, r2_qual
                 FROM ltr WHERE m_stop IS NOT NULL)""")
_ELONG = _matched("elong", "aftltr", "r1", A.elongation, "5p", 43, 0.16)
_AFTER_ELONG = """aftelong AS (SELECT sample, tag, read_id, substr(r1_seq, m_stop + 1) AS r1_seq, substr(r1_qual, m_stop + 1) AS r1_qual, r2_seq, r2_qual
                 FROM elong WHERE m_stop IS NOT NULL)"""
_LINK1 = _matched("link1", "fx_reads", "r1", A.linker_r1, "3p", 8, 0.2)
_LINK2 = _matched("link2", "fx_reads", "r2", A.linker_r2, "5p", 20, 0.16)


@query("without_provirus", duck(f"WITH {_PROV} SELECT * EXCLUDE (m_start, m_stop) FROM prov WHERE m_start IS NULL", "fx_reads"))
def without_provirus(spark, d):
    return rd.without_provirus(_reads(spark, d))


@query("ltr_trimmed", duck(f"WITH {_LTR}, {_AFTER_LTR} SELECT * FROM aftltr", "fx_reads"))
def ltr_trimmed(spark, d):
    return rd.require_ltr(_reads(spark, d))


@query("elongation_trimmed", duck(f"WITH {_LTR}, {_AFTER_LTR}, {_ELONG}, {_AFTER_ELONG} SELECT * FROM aftelong", "fx_reads"))
def elongation_trimmed(spark, d):
    return rd.require_elongation(rd.require_ltr(_reads(spark, d)))


@query("prefix_required", duck(f"""WITH {_LTR}, {_AFTER_LTR}, {_ELONG}, {_AFTER_ELONG}
SELECT * REPLACE (substr(r1_seq, 4) AS r1_seq, substr(r1_qual, 4) AS r1_qual) FROM aftelong WHERE r1_seq LIKE 'GCA%'""", "fx_reads"))
def prefix_required(spark, d):
    return rd.require_prefix(rd.require_elongation(rd.require_ltr(_reads(spark, d))))


@query("linker_r1_split", duck(f"""WITH {_LINK1}
SELECT * EXCLUDE (m_start, m_stop) REPLACE (substr(r1_seq, 1, coalesce(m_start, length(r1_seq))) AS r1_seq,
       substr(r1_qual, 1, coalesce(m_start, length(r1_qual))) AS r1_qual), m_start IS NOT NULL AS matched FROM link1""", "fx_reads"))
def linker_r1_split(spark, d):
    return rd.split_linker_r1(_reads(spark, d))


@query("linker_r2_split", duck(f"""WITH {_LINK2}
SELECT * EXCLUDE (m_start, m_stop) REPLACE (substr(r2_seq, coalesce(m_stop, 0) + 1) AS r2_seq,
       substr(r2_qual, coalesce(m_stop, 0) + 1) AS r2_qual), m_start IS NOT NULL AS matched FROM link2""", "fx_reads"))
def linker_r2_split(spark, d):
    return rd.split_linker_r2(_reads(spark, d))


_QUAL = """
q AS (SELECT read_id, i, sum(53 - ascii(c)) OVER (PARTITION BY read_id ORDER BY i DESC) AS s
      FROM (SELECT read_id, unnest(generate_series(1, length(r2_qual))) AS i, unnest(string_split(r2_qual, '')) AS c FROM fx_reads) x),
live AS (SELECT *, min(s) OVER (PARTITION BY read_id ORDER BY i DESC) AS low FROM q),
cut AS (SELECT read_id, i - 1 AS keep FROM live WHERE low >= 0 AND s > 0 QUALIFY row_number() OVER (PARTITION BY read_id ORDER BY s DESC, i DESC) = 1),
qt AS (SELECT r.* REPLACE (substr(r2_seq, 1, coalesce(keep, length(r2_seq))) AS r2_seq, substr(r2_qual, 1, coalesce(keep, length(r2_qual))) AS r2_qual)
       FROM fx_reads r LEFT JOIN cut USING (read_id))"""


@query("quality_trimmed", duck(f"WITH {_QUAL.strip()} SELECT * FROM qt", "fx_reads"))
def quality_trimmed(spark, d):
    return rd.quality_trim(_reads(spark, d))


@query("r2_tail_trimmed", duck(f"""WITH {_QUAL.strip()}, {_matched('tail', 'qt', 'r2', A.rc_ltr, '3p', 8, 0.25)}
SELECT * EXCLUDE (m_start, m_stop) REPLACE (substr(r2_seq, 1, coalesce(m_start, length(r2_seq))) AS r2_seq,
       substr(r2_qual, 1, coalesce(m_start, length(r2_qual))) AS r2_qual) FROM tail""", "fx_reads"))
def r2_tail_trimmed(spark, d):
    return rd.trim_r2_tail(_reads(spark, d))


@query("long_pairs", duck("SELECT * FROM fx_reads WHERE least(length(r1_seq), length(r2_seq)) >= 20", "fx_reads"))
def long_pairs(spark, d):
    return rd.min_length(_reads(spark, d), 20)


@query("long_reads_flagged", duck("""SELECT sample, tag, read_id, r1_seq AS seq, r1_qual AS qual, CAST(1 AS BIGINT) AS n_reads, length(r1_seq) >= 70 AS long_enough
FROM fx_reads""", "fx_reads"))
def long_reads_flagged(spark, d):
    return rd.with_length_ok(rd.single_reads(_reads(spark, d)), 70)


_CUT = "CASE WHEN instr(r2_seq, 'TTAA') > 0 THEN instr(r2_seq, 'TTAA') ELSE length(r2_seq) END"


@query("reads_cut_at_site", duck(f"""SELECT sample, tag, read_id, substr(r2_seq, 1, {_CUT}) AS seq, substr(r2_qual, 1, {_CUT}) AS qual, CAST(1 AS BIGINT) AS n_reads
FROM fx_reads""", "fx_reads"))
def reads_cut_at_site(spark, d):
    return rd.cut_reads(rd.single_reads(_reads(spark, d), "r2"))


@query("collapsed_reads", duck("""SELECT sample, tag, r2_seq AS seq, count(*) AS n_reads, max(r2_qual) AS qual, md5(r2_seq) || 'x' || CAST(count(*) AS STRING) AS qname
FROM fx_reads GROUP BY sample, tag, r2_seq""", "fx_reads"))
def collapsed_reads(spark, d):
    return rd.collapse_reads(rd.single_reads(_reads(spark, d), "r2"))


@query("residual_reads", duck("""
SELECT sample, tag, read_id, r1_seq AS seq, r1_qual AS qual, CAST(1 AS BIGINT) AS n_reads, 'no_linker' AS origin FROM fx_reads
UNION ALL SELECT sample, tag, read_id, r2_seq, r2_qual, 1, 'unmapped' FROM fx_reads""", "fx_reads"))
def residual_reads(spark, d):
    pairs = _reads(spark, d)
    return rd.residual_reads(no_linker=rd.single_reads(pairs), unmapped=rd.single_reads(pairs, "r2"))


_DEMUX = """
WITH h AS (SELECT r.read_id, b.tag, length(barcode) AS n, hamming(substr(r1_seq, 1, length(barcode)), barcode) AS mm
           FROM fx_reads r JOIN fx_long_barcodes b ON length(r1_seq) >= length(barcode)),
n AS (SELECT *, lead(mm) OVER (PARTITION BY read_id, n ORDER BY mm, tag) AS nxt, row_number() OVER (PARTITION BY read_id, n ORDER BY mm, tag) AS rk FROM h),
ok AS (SELECT read_id, tag, mm FROM n WHERE rk = 1 AND mm <= 1 AND (nxt IS NULL OR nxt >= mm + 2) QUALIFY row_number() OVER (PARTITION BY read_id ORDER BY n DESC) = 1),
dm AS (SELECT r.sample, r.read_id, coalesce(ok.tag, 'unmatched') AS tag, CAST(ok.mm AS INT) AS barcode_mm FROM fx_reads r LEFT JOIN ok USING (read_id))"""


def _demux(spark, d):
    """Barcodes of six and of eight bases."""
    return rd.demultiplex(_reads(spark, d), view(spark, d, "fx_long_barcodes"))


@query("demultiplexed", duck(_DEMUX + " SELECT * FROM dm", "fx_reads", "fx_long_barcodes"))
def demultiplexed(spark, d):
    return _demux(spark, d).select("sample", "read_id", "tag", "barcode_mm")


@query("demux_counts", duck(_DEMUX + """,
c AS (SELECT sample, coalesce(tag, 'total') AS tag, count(*) AS reads FROM dm GROUP BY GROUPING SETS ((sample, tag), (sample)))
SELECT *, round(100.0 * reads / sum(reads) FILTER (tag <> 'total') OVER (PARTITION BY sample), 6) AS percent FROM c""", "fx_reads", "fx_long_barcodes"))
def demux_counts(spark, d):
    return rd.demux_counts(_demux(spark, d)).withColumn("percent", F.round("percent", 6))


@query("read_statistics", duck("""
SELECT sample, tag, count(*) AS reads, min(length(r1_seq)) AS len_min, max(length(r1_seq)) AS len_max, round(avg(length(r1_seq)), 6) AS len_mean,
       CAST(sum(length(r1_seq)) AS BIGINT) AS total_bases,
       min(list_min([ascii(c) - 33 for c in string_split(r1_qual, '')])) AS qual_min, max(list_max([ascii(c) - 33 for c in string_split(r1_qual, '')])) AS qual_max,
       round(sum(list_sum([ascii(c) - 33 for c in string_split(r1_qual, '')])) / sum(length(r1_qual)), 6) AS qual_mean,
""" + ",\n".join(f"CAST(sum(length(r1_seq) - length(replace(r1_seq, '{b}', ''))) AS BIGINT) AS \"n_{b}\"" for b in "ACGTN")
    + " FROM fx_reads GROUP BY sample, tag", "fx_reads"))
def read_statistics(spark, d):
    return al.fastq_stats(rd.single_reads(_reads(spark, d))).withColumns({c: F.round(c, 6) for c in ("len_mean", "qual_mean")})


_CUT_BEHIND = "* EXCLUDE (m_start, m_stop) REPLACE (substr(r1_seq, m_stop + 1) AS r1_seq, substr(r1_qual, m_stop + 1) AS r1_qual)"
_ROUTED = f"""
WITH {_PROV}, p0 AS (SELECT * EXCLUDE (m_start, m_stop) FROM prov WHERE m_start IS NULL),
{_matched("t1", "p0", "r1", A.ltr, "5p", 23, 0.1)}, p1 AS (SELECT {_CUT_BEHIND} FROM t1 WHERE m_stop IS NOT NULL),
{_matched("t2", "p1", "r1", A.elongation, "5p", 43, 0.16)}, p2 AS (SELECT {_CUT_BEHIND} FROM t2 WHERE m_stop IS NOT NULL),
p3 AS (SELECT * REPLACE (substr(r1_seq, 4) AS r1_seq, substr(r1_qual, 4) AS r1_qual) FROM p2 WHERE r1_seq LIKE 'GCA%'),
{_matched("t3", "p3", "r1", A.linker_r1, "3p", 8, 0.2)}, p4 AS (SELECT * EXCLUDE (m_start, m_stop) FROM t3 WHERE m_start IS NULL),
{_matched("t4", "p4", "r2", A.linker_r2, "5p", 20, 0.16)},
routed AS (SELECT r.sample, r.tag, r.read_id,
        CASE WHEN p0.read_id IS NULL THEN 'provirus' WHEN p1.read_id IS NULL THEN 'no_ltr' WHEN p2.read_id IS NULL THEN 'no_elongation'
             WHEN p3.read_id IS NULL THEN 'no_prefix' WHEN t3.m_start IS NOT NULL THEN 'linker_r1' WHEN t4.m_start IS NOT NULL THEN 'linker_r2' ELSE 'no_linker' END AS outcome,
        substr(coalesce(p3.r1_seq, p2.r1_seq, p1.r1_seq, r.r1_seq), 1, coalesce(t3.m_start, length(r.r1_seq))) AS r1_seq,
        substr(coalesce(p3.r1_qual, p2.r1_qual, p1.r1_qual, r.r1_qual), 1, coalesce(t3.m_start, length(r.r1_seq))) AS r1_qual,
        substr(r.r2_seq, coalesce(t4.m_stop, 0) + 1) AS r2_seq, substr(r.r2_qual, coalesce(t4.m_stop, 0) + 1) AS r2_qual
    FROM fx_reads r LEFT JOIN p0 USING (read_id) LEFT JOIN p1 USING (read_id) LEFT JOIN p2 USING (read_id) LEFT JOIN p3 USING (read_id)
         LEFT JOIN t3 USING (read_id) LEFT JOIN t4 USING (read_id))"""


@query("routed_reads", duck(_ROUTED + " SELECT * FROM routed", "fx_reads"))
def routed_reads(spark, d):
    return rd.route_reads(_reads(spark, d))


_STAGE_VALUES = ", ".join(f"('{stage}', '{outcome}')" for stage, kept in fn._TRIMMING.items() for outcome in kept)


@query("trimming_counts", duck(_ROUTED + f""", s(stage, outcome) AS (VALUES {_STAGE_VALUES}),
runs AS (SELECT DISTINCT sample, tag FROM fx_reads)
SELECT sample, tag, stage, (SELECT count(*) FROM routed r JOIN s ON r.outcome = s.outcome WHERE s.stage = x.stage AND r.sample = runs.sample AND r.tag = runs.tag) AS reads
FROM runs, (SELECT DISTINCT stage FROM s) x""", "fx_reads"))
def trimming_counts(spark, d):
    return fn.trimming_counts(rd.route_reads(_reads(spark, d)))
