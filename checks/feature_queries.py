"""Random controls, feature tables, ROC curves and genome composition."""

from pyspark.sql import functions as F

from checks.fixtures import duck, view
from checks.registry import query
from locusflow.operators import features as ft, genome as gn, intervals as iv

_RANDOM = """
WITH axis AS (SELECT chrom, length, sum(length) OVER (ORDER BY chrom) - length AS off, sum(length) OVER () AS total FROM fx_sizes),
h AS (SELECT sample, tag, md5(concat_ws('|', sample, tag, chrom, CAST(start0 AS STRING), strand, '1')) AS x FROM fx_sites),
p AS (SELECT sample, tag, CAST(('0x' || substr(x, 1, 15))::BIGINT % (SELECT max(total) FROM axis) AS BIGINT) AS g,
             CASE WHEN ('0x' || substr(x, 16, 4))::BIGINT % 2 = 0 THEN '+' ELSE '-' END AS strand FROM h),
rnd AS (SELECT sample, tag, chrom, CAST(g - off AS BIGINT) AS start0, CAST(g - off + 1 AS BIGINT) AS end0, min(strand) AS strand
        FROM p JOIN axis ON g >= off AND g < off + length GROUP BY ALL)"""


def _sites(spark, d):
    return view(spark, d, "fx_sites")


def _random(spark, d):
    return ft.random_sites(_sites(spark, d), view(spark, d, "fx_sizes"))


@query("random_sites", duck(_RANDOM + " SELECT * FROM rnd", "fx_sizes", "fx_sites"))
def random_sites(spark, d):
    return _random(spark, d)


def _both(spark, d):
    return ft.with_controls(_sites(spark, d), _random(spark, d))


_BOTH = _RANDOM + """,
s AS (SELECT sample, tag, chrom, start0, end0, strand, 'Experimental' AS cls FROM fx_sites
      UNION ALL SELECT sample, tag, chrom, start0, end0, strand, 'random' FROM rnd),
w AS (SELECT s.*, win AS "window", greatest(start0 - h, 0) AS lo, least(end0 + h, 1000000) AS hi
      FROM s CROSS JOIN (VALUES ('1kb', 500), ('100kb', 50000)) t(win, h)),
dens AS (SELECT w.sample, w.tag, w.chrom, w.start0, w.strand, w.cls, w."window", CAST(count(b.name) AS DOUBLE) AS value
         FROM w LEFT JOIN fx_genes b ON w.chrom = b.chrom AND w.lo < b.end0 AND b.start0 < w.hi
         GROUP BY ALL)"""

_BY = ["sample", "tag", "window"]


def _densities(spark, d):
    windows = iv.multi_window(_both(spark, d), view(spark, d, "fx_sizes"), {"1kb": 500, "100kb": 50_000})
    counted = iv.overlap_count(windows, view(spark, d, "fx_genes"), "value")
    return counted.select("sample", "tag", "chrom", F.col("site_start0").alias("start0"), "strand", "cls", "window",
                          F.col("value").cast("double").alias("value"))


@query("gene_density", duck(_BOTH + " SELECT * FROM dens", "fx_sizes", "fx_sites", "fx_genes"))
def gene_density(spark, d):
    return _densities(spark, d)


@query("auc_gene_density", duck(_BOTH + """,
c AS (SELECT sample, tag, "window", value, CAST(count(*) FILTER (cls = 'Experimental') AS DOUBLE) AS n1, CAST(count(*) FILTER (cls = 'random') AS DOUBLE) AS n0
      FROM dens GROUP BY ALL),
r AS (SELECT *, coalesce(sum(n0) OVER (PARTITION BY sample, tag, "window" ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM c)
SELECT sample, tag, "window", round(100 * sum(n1 * (below + n0 / 2)) / (sum(n1) * sum(n0)), 6) AS auc,
       CAST(sum(n1) AS BIGINT) AS cases, CAST(sum(n0) AS BIGINT) AS controls FROM r GROUP BY sample, tag, "window"
""", "fx_sizes", "fx_sites", "fx_genes"))
def auc_gene_density(spark, d):
    return ft.auc(_densities(spark, d), _BY).withColumn("auc", F.round("auc", 6))


_SCORES = """
WITH v AS (SELECT track, CASE WHEN chrom IN ('chr1', 'chr2', 'chr3', 'chr4', 'chr5', 'chr6') THEN 'random' ELSE 'Experimental' END AS cls, value FROM fx_signal)"""


def _scores(spark, d):
    chroms = [f"chr{i}" for i in range(1, 7)]
    return view(spark, d, "fx_signal").select(
        "track", F.when(F.col("chrom").isin(chroms), "random").otherwise("Experimental").alias("cls"), "value")


@query("auc_continuous", duck(_SCORES + """
SELECT a.track, round(100 * sum(CASE WHEN a.value > b.value THEN 1.0 WHEN a.value = b.value THEN 0.5 ELSE 0 END) / count(*), 6) AS auc
FROM v a JOIN v b ON a.track = b.track AND a.cls = 'Experimental' AND b.cls = 'random' GROUP BY a.track""", "fx_signal"))
def auc_continuous(spark, d):
    # the row limit is lowered so that the sliced path runs as well
    return ft.auc(_scores(spark, d), ["track"], slice_rows=100).select("track", F.round("auc", 6).alias("auc"))


_ROC = _SCORES + """,
r AS (SELECT track, min(value) AS lo, max(value) AS hi FROM v GROUP BY track),
t AS (SELECT track, i, CASE WHEN i = 99 THEN hi ELSE lo + i * ((hi - lo) / 99) END AS threshold FROM r, (SELECT unnest(generate_series(0, 99)) AS i) g),
roc AS (SELECT t.track, CAST(i AS BIGINT) AS i, round(threshold, 6) AS threshold,
       round(1 - count(*) FILTER (cls = 'random' AND value >= threshold) / count(*) FILTER (cls = 'random'), 6) AS specificity,
       round(count(*) FILTER (cls = 'Experimental' AND value >= threshold) / count(*) FILTER (cls = 'Experimental'), 6) AS sensitivity
FROM t JOIN v USING (track) GROUP BY t.track, i, threshold)"""


@query("roc_curve", duck(_ROC + " SELECT * FROM roc", "fx_signal"))
def roc_curve(spark, d):
    curve = ft.roc_curve(_scores(spark, d), ["track"])
    return curve.select("track", "i", *[F.round(c, 6).alias(c) for c in ("threshold", "specificity", "sensitivity")])


@query("roc_long", duck(_ROC + """
SELECT track, i, threshold, 'specificity' AS measure, specificity AS value FROM roc UNION ALL
SELECT track, i, threshold, 'sensitivity', sensitivity FROM roc""", "fx_signal"))
def roc_long(spark, d):
    return ft.roc_long(roc_curve(spark, d), ["track"])


@query("gc_feature_table", duck("""
SELECT 'GCcontent' AS feature, chrom, round(1 - sum(value) / 100, 6) AS total FROM fx_signal WHERE track = 'click' GROUP BY chrom
UNION ALL SELECT 'Other', chrom, round(sum(value) / 100, 6) FROM fx_signal WHERE track <> 'click' GROUP BY chrom""", "fx_signal"))
def gc_feature_table(spark, d):
    long = view(spark, d, "fx_signal").select(
        F.when(F.col("track") == "click", "GCcontent").otherwise("Other").alias("feature"), "chrom", (F.col("value") / 100).alias("value"))
    return ft.gc_from_at(ft.feature_table(long, ["feature", "chrom"])).withColumn("total", F.round("total", 6))


@query("class_by_name", duck("""
SELECT CASE WHEN contains(track, 'c') THEN 'random' ELSE 'Experimental' END AS cls, count(*) AS n FROM fx_signal GROUP BY 1""", "fx_signal"))
def class_by_name(spark, d):
    named = view(spark, d, "fx_signal").withColumn(
        "name", F.when(F.col("track").contains("c"), F.concat(F.lit("random"), "start0")).otherwise("IS"))
    return named.groupBy(ft.class_of().alias("cls")).agg(F.count(F.lit(1)).alias("n"))


@query("score_density", duck(_SCORES + """,
r AS (SELECT track, min(value) AS lo, (max(value) - min(value)) / 50 AS w FROM v GROUP BY track),
c AS (SELECT track, cls, least(CAST(floor((value - lo) / w) AS BIGINT), 49) AS bin, lo, w, count(*) AS n FROM v JOIN r USING (track) GROUP BY ALL)
SELECT track, cls, bin, round(lo + bin * w, 6) AS bin_start, n, round(n / (sum(n) OVER (PARTITION BY track, cls) * w), 6) AS density FROM c""", "fx_signal"))
def score_density(spark, d):
    out = ft.density(_scores(spark, d), ["track"])
    return out.select("track", "cls", "bin", F.round("bin_start", 6).alias("bin_start"), "n", F.round("density", 6).alias("density"))


@query("feature_table", duck("""
WITH wide AS (SELECT chrom, start0, CAST(value AS DOUBLE) AS v FROM fx_signal),
long AS (SELECT chrom, start0, 'H3K4me3' AS feature, v AS value FROM wide UNION ALL SELECT chrom, start0, 'H3K27ac', CASE WHEN v > 50 THEN NULL ELSE v * 2 END FROM wide)
SELECT chrom, start0, feature, round(coalesce(sum(value), 0), 6) AS total FROM long GROUP BY ALL""", "fx_signal"))
def feature_table(spark, d):
    wide = view(spark, d, "fx_signal").select(
        "chrom", "start0", F.col("value").alias("E.CD34.H3K4me3"),
        F.when(F.col("value") <= 50, F.col("value") * 2).alias("E.CD34.H3K27ac"))
    long = ft.unpivot_scores(wide, ["chrom", "start0"], part=2)
    return ft.feature_table(long, ["chrom", "start0", "feature"]).withColumn("total", F.round("total", 6))


# ---- genome ------------------------------------------------------------------------------------

_WINDOWS = """
WITH pos AS (SELECT chrom, seq, length(seq) AS len, unnest(generate_series(0, length(seq) - 1, 997)) AS p FROM fx_contigs WHERE length(seq) > 0),
w AS (SELECT DISTINCT chrom, p AS site, {half} AS half, CAST(greatest(p - {half}, 0) AS BIGINT) AS start0, CAST(least(p + 1 + {half}, len) AS BIGINT) AS end0,
             substr(seq, greatest(p - {half}, 0) + 1, least(p + 1 + {half}, len) - greatest(p - {half}, 0)) AS seq FROM pos)"""


def _windows(spark, d, half):
    contigs = view(spark, d, "fx_contigs")
    sizes = contigs.select("chrom", F.length("seq").cast("bigint").alias("length"))
    points = contigs.select("chrom", F.explode(F.expr("sequence(0L, greatest(CAST(length(seq) AS BIGINT) - 1, 0L), 997L)")).alias("start0"))
    return iv.slop(points.withColumn("end0", F.col("start0") + 1).withColumn("site", F.col("start0")), half, sizes)


@query("base_composition", duck(_WINDOWS.format(half=3000) + """,
n AS (SELECT DISTINCT *, length(seq) - length(replace(seq, 'A', '')) AS a, length(seq) - length(replace(seq, 'C', '')) AS c,
             length(seq) - length(replace(seq, 'G', '')) AS g, length(seq) - length(replace(seq, 'T', '')) AS t FROM w)
SELECT chrom, site, start0, end0, round((a + t) / length(seq), 6) AS pct_at, round((c + g) / length(seq), 6) AS pct_gc, a AS "n_A", c AS "n_C", g AS "n_G", t AS "n_T",
       0 AS "n_N", 0 AS n_other, length(seq) AS length FROM n""", "fx_contigs"))
def base_composition(spark, d):
    out = gn.base_composition(_windows(spark, d, 3000), gn.chunked(view(spark, d, "fx_contigs")))
    return out.withColumn("pct_at", F.round("pct_at", 6)).withColumn("pct_gc", F.round("pct_gc", 6))


@query("fetch_sequence", duck(_WINDOWS.format(half=20) + " SELECT chrom, site, start0, end0, seq FROM w", "fx_contigs"))
def fetch_sequence(spark, d):
    return gn.fetch_sequence(_windows(spark, d, 20), gn.chunked(view(spark, d, "fx_contigs")))


@query("position_frequency", duck(_WINDOWS.format(half=20) + """,
l AS (SELECT unnest(generate_series(1, length(seq))) AS i, seq FROM w),
c AS (SELECT CAST(i - 1 AS INT) AS pos, substr(seq, i, 1) AS base, count(*) AS n FROM l GROUP BY ALL)
SELECT pos, base, n, round(n / sum(n) OVER (PARTITION BY pos), 6) AS share FROM c""", "fx_contigs"))
def position_frequency(spark, d):
    return gn.position_frequency(fetch_sequence(spark, d)).withColumn("share", F.round("share", 6))
