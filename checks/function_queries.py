"""Column functions, gene model projections and small report helpers."""

from pyspark.sql import functions as F

from checks.fixtures import duck, view
from checks.registry import query
from locusflow.functions import sequence as sq, special as sp
from locusflow.operators import diversity as dv, features as ft, funnel as fn, intervals as iv, reads as rd, sites as st


@query("sequence_functions", duck("""
SELECT doc_id, piece, reverse(translate(body, 'ACGTN', 'TGCAN')) AS rc, CAST(hamming(substr(body || '--------', 1, 8), 'ACGTACGT') AS INT) AS mm,
       CASE WHEN instr(body, 'TTAA') > 0 THEN instr(body, 'TTAA') ELSE length(body) END AS kept FROM fx_pieces""", "fx_pieces"))
def sequence_functions(spark, d):
    pieces = view(spark, d, "fx_pieces")
    return pieces.select("doc_id", "piece", sq.revcomp("body").alias("rc"), sq.hamming("body", "ACGTACGT").alias("mm"),
                         sq.cut_at_site("body").cast("int").alias("kept"))


@query("flag_bits", duck("""
SELECT flag, count(*) AS n, (flag // 16) % 2 = 1 AS is_reverse, (flag // 64) % 2 = 1 AS is_first, (flag // 4) % 2 = 1 AS is_unmapped
FROM (SELECT flag FROM fx_aln UNION ALL SELECT flag FROM fx_pair_aln) f GROUP BY flag""", "fx_aln", "fx_pair_aln"))
def flag_bits(spark, d):
    flags = view(spark, d, "fx_aln").select("flag").unionAll(view(spark, d, "fx_pair_aln").select("flag"))
    return flags.groupBy("flag").agg(F.count(F.lit(1)).alias("n")).select(
        "flag", "n", sq.has_flag("flag", 16).alias("is_reverse"), sq.has_flag("flag", 64).alias("is_first"), sq.has_flag("flag", 4).alias("is_unmapped"))


@query("gamma_functions", duck("""
SELECT event_id, round(lgamma(value + 0.001), 6) AS lg, round(lgamma(1001) - lgamma(floor(value) + 1) - lgamma(1001 - floor(value)), 6) AS lchoose FROM events""",
                               "fx_sizes"))
def gamma_functions(spark, d):
    events = spark.read.parquet(f"{d}/events.parquet")
    return events.select("event_id", F.round(sp.lgamma(F.col("value") + 0.001), 6).alias("lg"),
                         F.round(sp.log_choose(F.lit(1000.0), F.floor("value")), 6).alias("lchoose"))


@query("digamma", duck("""
SELECT n, round(sum(1.0::DOUBLE / greatest(j, 1)) FILTER (j > 0) - 0.5772156649015329, 6) AS psi
FROM (SELECT n, unnest(generate_series(0, n - 1)) AS j FROM (SELECT DISTINCT CAST(l_quantity AS BIGINT) + l_linenumber * 40 + 1 AS n FROM lineitem) t) u
GROUP BY n""", "fx_sizes"))
def digamma(spark, d):
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    whole = lines.select((F.col("l_quantity").cast("bigint") + F.col("l_linenumber") * 40 + 1).alias("n")).distinct()
    return whole.select("n", F.round(sp.digamma("n"), 6).alias("psi"))


@query("gene_bodies", duck("SELECT chrom, tx_start AS start0, tx_end AS end0, tx_id AS name, gene_symbol AS score, strand FROM fx_tx", "fx_tx"))
def gene_bodies(spark, d):
    return iv.gene_bodies(view(spark, d, "fx_tx"), score="gene_symbol")


@query("site_ids", duck("""SELECT sample, tag, chrom || '_' || CAST(start0 AS STRING) || '_' || strand AS is_id, n_reads, round(log10(n_reads), 6) AS log10_n_reads
FROM fx_sites""", "fx_sites"))
def site_ids(spark, d):
    sites = fn.with_log10(view(spark, d, "fx_sites"), "n_reads")
    return sites.select("sample", "tag", st.site_id().alias("is_id"), "n_reads", F.round("log10_n_reads", 6).alias("log10_n_reads"))


RUNS = [f"S{s}_TAG{t}" for s in (1, 2, 3) for t in (1, 2)]


@query("site_matrix", duck("""
SELECT chrom || '_' || CAST(start0 AS STRING) || '_' || strand AS is_id, """ + ", ".join(
    f"CAST(coalesce(sum(n_reads) FILTER (sample = '{r[:2]}' AND tag = '{r[3:]}'), 0) AS BIGINT) AS \"{r}\"" for r in RUNS)
    + " FROM fx_sites GROUP BY 1", "fx_sites"))
def site_matrix(spark, d):
    sites = view(spark, d, "fx_sites").withColumn("is_id", st.site_id())
    return dv.site_matrix(sites, "n_reads", RUNS)


@query("stacked_tables", duck("""
SELECT chrom, start0, NULL AS name, n_reads FROM fx_sites UNION ALL SELECT chrom, start0, name, NULL FROM fx_genes""", "fx_sites", "fx_genes"))
def stacked_tables(spark, d):
    return ft.bind_rows(view(spark, d, "fx_sites").select("chrom", "start0", "n_reads"), view(spark, d, "fx_genes").select("chrom", "start0", "name"))


@query("side_by_side", duck("SELECT (SELECT count(*) FROM fx_sites) AS sites, (SELECT count(*) FROM fx_genes) AS genes", "fx_sites", "fx_genes"))
def side_by_side(spark, d):
    return fn.bind_cols(view(spark, d, "fx_sites").agg(F.count(F.lit(1)).alias("sites")), view(spark, d, "fx_genes").agg(F.count(F.lit(1)).alias("genes")))


@query("fragment_union", duck("""
SELECT sample, tag, chrom, start0, end0, name, score, strand FROM fx_obs
UNION ALL SELECT sample, tag, chrom, start0, start0 + size, name, score, strand FROM fx_obs""", "fx_obs"))
def fragment_union(spark, d):
    obs = view(spark, d, "fx_obs")
    return st.union_fragments(obs, obs.withColumn("end0", F.col("start0") + F.col("size")))


@query("evidence_union", duck("""SELECT sample, tag, chrom, start0, end0, score, strand, n_reads FROM fx_sites
UNION ALL SELECT sample, tag, chrom, start0, end0, score, strand, n_reads FROM fx_obs""", "fx_sites", "fx_obs"))
def evidence_union(spark, d):
    return st.union_evidence(view(spark, d, "fx_sites"), view(spark, d, "fx_obs"))


@query("demux_shown", duck("""
SELECT sample, tag, count(*) AS reads, round(log10(count(*)), 6) AS log10_reads FROM fx_reads GROUP BY sample, tag""", "fx_reads"))
def demux_shown(spark, d):
    shown = fn.demux_shown(rd.demux_counts(view(spark, d, "fx_reads")))
    return shown.select("sample", "tag", "reads", F.round("log10_reads", 6).alias("log10_reads"))


@query("barcode_variants", duck("""
WITH s AS (SELECT DISTINCT substr(r1_seq, 1, 6) AS start FROM fx_reads WHERE length(r1_seq) >= 6),
h AS (SELECT start, tag, hamming(start, barcode) AS mm FROM s, fx_barcodes),
n AS (SELECT *, lead(mm) OVER (PARTITION BY start ORDER BY mm, tag) AS nxt, row_number() OVER (PARTITION BY start ORDER BY mm, tag) AS rk FROM h)
SELECT start, tag AS barcode_tag, CAST(mm AS INT) AS mm FROM n WHERE rk = 1 AND mm <= 1 AND nxt - mm >= 2""", "fx_reads", "fx_barcodes"))
def barcode_variants(spark, d):
    starts = view(spark, d, "fx_reads").filter("length(r1_seq) >= 6").select(F.substring("r1_seq", 1, 6).alias("start")).distinct()
    return rd.barcode_variants(view(spark, d, "fx_barcodes"), max_mm=1, min_distance=2).join(starts, "start", "left_semi")


@query("intragenic_sites", duck("""
SELECT DISTINCT a.* FROM fx_sites a JOIN fx_genes b ON a.chrom = b.chrom AND a.start0 < b.end0 AND b.start0 < a.end0""", "fx_sites", "fx_genes"))
def intragenic_sites(spark, d):
    from locusflow.operators import annotate as an
    sets = iv.label_sets(gene_body=view(spark, d, "fx_genes"))
    return an.intragenic(an.annotate_overlaps(view(spark, d, "fx_sites"), sets, per=["source"]))


@query("tss_distance", duck("""
WITH t AS (SELECT chrom, tx_id AS name, strand, CASE WHEN strand = '+' THEN tx_start ELSE tx_end - 1 END AS p FROM fx_tx),
spans AS (SELECT DISTINCT chrom, start0 FROM fx_sites),
d AS (SELECT s.chrom, s.start0, t.name, CASE WHEN t.p > s.start0 THEN t.p - s.start0 WHEN t.p < s.start0 THEN s.start0 - t.p ELSE 0 END AS dist,
             (t.p > s.start0) = (t.strand <> '-') AS neg, t.p, t.strand FROM spans s JOIN t USING (chrom)),
b AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY chrom, start0 ORDER BY dist, p, name, strand) = 1)
SELECT a.sample, a.tag, a.chrom, a.start0, a.strand, b.name AS b_name, CASE WHEN neg THEN -dist ELSE dist END AS distance
FROM fx_sites a LEFT JOIN b USING (chrom, start0)""", "fx_sites", "fx_tx"))
def tss_distance(spark, d):
    from locusflow.operators import annotate as an
    rows = an.distance_to_tss(view(spark, d, "fx_sites"), view(spark, d, "fx_tx"), ties="first")
    return rows.select("sample", "tag", "chrom", "start0", "strand", "b_name", "distance")
