"""Interval algebra: joins, counts, nearest features, clusters, derived intervals, window means."""

from pyspark.sql import functions as F

from checks.fixtures import duck, view
from checks.registry import query
from locusflow.operators import intervals as iv

_HIT = "a.chrom = b.chrom AND a.start0 < b.end0 AND b.start0 < a.end0"


def _sites(spark, d):
    return view(spark, d, "fx_sites")


def _genes(spark, d):
    return view(spark, d, "fx_genes")


_PAIR_COLS = ("a.*, b.start0 AS b_start0, b.end0 AS b_end0, b.name AS b_name, b.strand AS b_strand")


@query("overlap_inner", duck(f"SELECT {_PAIR_COLS} FROM fx_sites a JOIN fx_genes b ON {_HIT}", "fx_sites", "fx_genes"))
def overlap_inner(spark, d):
    return iv.overlap_join(_sites(spark, d), _genes(spark, d), points=True).drop("b_chrom", "b_score")


@query("overlap_left", duck(f"SELECT {_PAIR_COLS} FROM fx_sites a LEFT JOIN fx_genes b ON {_HIT}", "fx_sites", "fx_genes"))
def overlap_left(spark, d):
    return iv.overlap_join(_sites(spark, d), _genes(spark, d), "left", points=True).drop("b_chrom", "b_score")


@query("overlap_anti", duck(f"SELECT a.* FROM fx_sites a WHERE NOT EXISTS (SELECT 1 FROM fx_genes b WHERE {_HIT})",
                            "fx_sites", "fx_genes"))
def overlap_anti(spark, d):
    return iv.overlap_join(_sites(spark, d), _genes(spark, d), "anti")


@query("overlap_labelled_sets", duck(f"""
WITH sets AS (SELECT 'gene' AS source, chrom, start0, end0, name FROM fx_genes
              UNION ALL SELECT 'signal', chrom, start0, end0, track FROM fx_signal)
SELECT a.*, b.source AS b_source, b.start0 AS b_start0, b.name AS b_name FROM fx_sites a LEFT JOIN sets b ON {_HIT}
""", "fx_sites", "fx_genes", "fx_signal"))
def overlap_labelled_sets(spark, d):
    signal = view(spark, d, "fx_signal").withColumn("name", F.col("track")).withColumn("strand", F.lit("."))
    sets = iv.label_sets(gene=_genes(spark, d), signal=signal)
    return iv.overlap_join(_sites(spark, d), sets, "left", points=True).drop("b_chrom", "b_end0", "b_strand")


@query("overlap_count_windows", duck(f"""
WITH w AS (SELECT win AS "window", b AS half FROM (VALUES ('01kb', 50), ('1kb', 500), ('10kb', 5000), ('100kb', 50000),
           ('1Mb', 500000)) t(win, b)),
spans AS (SELECT DISTINCT chrom, start0 AS site_start0, "window", greatest(start0 - half, 0) AS start0,
                 least(end0 + half, 1000000) AS end0 FROM fx_sites CROSS JOIN w)
SELECT a.chrom, a.site_start0, a."window", a.start0, a.end0, count(b.name) AS n_overlap
FROM spans a LEFT JOIN fx_genes b ON {_HIT} GROUP BY ALL
""", "fx_sites", "fx_genes"))
def overlap_count_windows(spark, d):
    sites = _sites(spark, d).select("chrom", "start0", "end0").distinct()
    windows = iv.multi_window(sites, view(spark, d, "fx_sizes"))
    return iv.overlap_count(windows, _genes(spark, d))


_NEAREST = f"""
WITH starts AS (SELECT chrom, name, strand, CASE WHEN strand = '+' THEN start0 ELSE end0 - 1 END AS start0 FROM fx_genes),
b AS (SELECT *, start0 + 1 AS end0 FROM starts),
spans AS (SELECT DISTINCT chrom, start0, end0 FROM fx_sites),
d AS (SELECT a.chrom, a.start0, a.end0, b.start0 AS b_start0, b.name AS b_name, b.strand AS b_strand,
             CASE WHEN b.start0 >= a.end0 THEN b.start0 - a.end0 + 1 WHEN b.end0 <= a.start0 THEN a.start0 - b.end0 + 1 ELSE 0 END AS dist,
             b.start0 >= a.end0 AS is_right
      FROM spans a JOIN b ON a.chrom = b.chrom),
best AS (SELECT * FROM d QUALIFY {{rank}} = 1)
SELECT s.*, best.b_start0, best.b_name, best.b_strand,
       CASE WHEN (b_strand = '-' AND NOT is_right) OR (b_strand <> '-' AND is_right) THEN -dist ELSE dist END AS distance
FROM fx_sites s LEFT JOIN best USING (chrom, start0, end0)"""


def _tss(spark, d):
    return iv.tss(_genes(spark, d))


@query("closest_all_ties", duck(_NEAREST.format(rank="rank() OVER (PARTITION BY chrom, start0, end0 ORDER BY dist)"),
                                "fx_sites", "fx_genes"))
def closest_all_ties(spark, d):
    return iv.closest(_sites(spark, d), _tss(spark, d)).drop("b_chrom", "b_end0", "b_score")


@query("closest_first_tie", duck(
    _NEAREST.format(rank="row_number() OVER (PARTITION BY chrom, start0, end0 ORDER BY dist, b_start0, b_name, b_strand)"),
    "fx_sites", "fx_genes"))
def closest_first_tie(spark, d):
    return iv.closest(_sites(spark, d), _tss(spark, d), ties="first").drop("b_chrom", "b_end0", "b_score")


_ISLANDS = """
WITH f AS (SELECT sample, tag, chrom, strand, start0, start0 + size * 400 AS end0, name, n_reads FROM fx_obs),
r AS (SELECT *, max(end0) OVER (PARTITION BY sample, tag, chrom, strand ORDER BY start0, end0
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM f),
c AS (SELECT *, max(CASE WHEN reach IS NULL OR start0 - reach > {gap} THEN start0 END) OVER (
             PARTITION BY sample, tag, chrom, strand ORDER BY start0, end0 ROWS UNBOUNDED PRECEDING) AS cluster FROM r)
"""


def _fragments(spark, d):
    obs = view(spark, d, "fx_obs")
    return obs.withColumn("end0", F.col("start0") + F.col("size") * 400).select(
        "sample", "tag", "chrom", "strand", "start0", "end0", "name", "n_reads")


@query("cluster_intervals", duck(_ISLANDS.format(gap=-1) + "SELECT sample, tag, chrom, strand, start0, end0, name, n_reads, cluster FROM c",
                                 "fx_obs"))
def cluster_intervals(spark, d):
    return iv.cluster(_fragments(spark, d))


@query("merge_intervals", duck(_ISLANDS.format(gap=500) + """
SELECT sample, tag, chrom, strand, min(start0) AS start0, max(end0) AS end0, CAST(sum(n_reads) AS BIGINT) AS n_reads,
       count(*) AS n FROM c GROUP BY sample, tag, chrom, strand, cluster""", "fx_obs"))
def merge_intervals(spark, d):
    return iv.merge(_fragments(spark, d), max_gap=500, aggs={"n_reads": F.sum("n_reads"), "n": F.count(F.lit(1))})


@query("tss", duck("""SELECT chrom, name, strand, CASE WHEN strand = '+' THEN start0 ELSE end0 - 1 END AS start0,
       CASE WHEN strand = '+' THEN start0 + 1 ELSE end0 END AS end0 FROM fx_genes""", "fx_genes"))
def tss(spark, d):
    return _tss(spark, d).drop("score")


@query("promoter_tiers", duck("""
WITH s AS (SELECT chrom, name, strand, CASE WHEN strand = '+' THEN start0 ELSE end0 - 1 END AS p FROM fx_genes),
t(tier, near, far) AS (VALUES ('core', 0, 40), ('proximal', 40, 200), ('distal', 200, 1000)),
x AS (SELECT chrom, name, strand, tier,
             greatest(CASE WHEN strand = '-' THEN p + 1 + near ELSE p - far END, 0) AS start0,
             least(CASE WHEN strand = '-' THEN p + 1 + far ELSE p - near END, 1000000) AS end0 FROM s CROSS JOIN t)
SELECT * FROM x WHERE start0 < end0""", "fx_genes"))
def promoter_tiers(spark, d):
    return iv.promoters(_tss(spark, d), view(spark, d, "fx_sizes")).drop("score")


@query("flank", duck("""
WITH x AS (SELECT chrom, name, strand, 'left' AS side, CASE WHEN strand = '-' THEN end0 ELSE start0 - 300 END AS start0,
                  CASE WHEN strand = '-' THEN end0 + 300 ELSE start0 END AS end0 FROM fx_genes
           UNION ALL
           SELECT chrom, name, strand, 'right', CASE WHEN strand = '-' THEN start0 - 100 ELSE end0 END,
                  CASE WHEN strand = '-' THEN start0 ELSE end0 + 100 END FROM fx_genes)
SELECT chrom, name, strand, side, greatest(start0, 0) AS start0, least(end0, 1000000) AS end0 FROM x
WHERE greatest(start0, 0) < least(end0, 1000000)""", "fx_genes"))
def flank(spark, d):
    return iv.flank(_genes(spark, d), 300, 100, view(spark, d, "fx_sizes"), stranded=True).drop("score")


@query("slop", duck("""SELECT chrom, name, strand, greatest(start0 - 5000, 0) AS start0, least(end0 + 5000, 1000000) AS end0
FROM fx_genes""", "fx_genes"))
def slop(spark, d):
    return iv.slop(_genes(spark, d), 5000, view(spark, d, "fx_sizes")).drop("score")


@query("exons", duck("""
WITH e AS (SELECT *, unnest(generate_series(1, exon_count)) AS i FROM fx_tx)
SELECT chrom, exon_starts[i] AS start0, exon_ends[i] AS end0, gene_symbol, strand,
       tx_id || '_exon_' || CAST(CASE WHEN strand = '-' THEN exon_count - i + 1 ELSE i END AS STRING) AS name FROM e""", "fx_tx"))
def exons(spark, d):
    return iv.exons(view(spark, d, "fx_tx"))


@query("window_mean", duck("""
WITH w AS (SELECT DISTINCT chrom, greatest(start0 - h, 0) AS start0, least(end0 + h, 1000000) AS end0, win AS "window"
           FROM fx_sites CROSS JOIN (VALUES ('1kb', 500), ('100kb', 50000)) t(win, h)),
tracks AS (SELECT DISTINCT track FROM fx_signal),
m AS (SELECT a.chrom, a.start0, a.end0, b.track,
             sum((least(a.end0, b.end0) - greatest(a.start0, b.start0)) * b.value)
             / sum(least(a.end0, b.end0) - greatest(a.start0, b.start0)) AS value
      FROM (SELECT DISTINCT chrom, start0, end0 FROM w) a
      JOIN fx_signal b ON a.chrom = b.chrom AND a.start0 < b.end0 AND b.start0 < a.end0 GROUP BY ALL)
SELECT w.*, tracks.track, round(m.value, 6) AS value
FROM w CROSS JOIN tracks LEFT JOIN m USING (chrom, start0, end0, track)""", "fx_sites", "fx_signal"))
def window_mean(spark, d):
    sites = _sites(spark, d).select("chrom", "start0", "end0").distinct()
    windows = iv.multi_window(sites, view(spark, d, "fx_sizes"), {"1kb": 500, "100kb": 50_000}).drop("site_start0")
    return iv.window_mean(windows, view(spark, d, "fx_signal")).withColumn("value", F.round("value", 6))


@query("chrom_rank", duck("""
SELECT chrom, count(*) AS n, CASE chrom WHEN 'chrX' THEN 23 WHEN 'chrY' THEN 24 WHEN 'chrM' THEN 25
       ELSE CAST(substr(chrom, 4) AS INT) END AS chrom_rank FROM fx_sites GROUP BY chrom""", "fx_sites"))
def chrom_rank(spark, d):
    return iv.with_chrom_rank(_sites(spark, d).groupBy("chrom").agg(F.count(F.lit(1)).alias("n"))).orderBy("chrom_rank")


@query("sorted_intervals", duck("SELECT * FROM fx_genes", "fx_genes"))
def sorted_intervals(spark, d):
    return iv.sort_intervals(_genes(spark, d))
