"""Site collapse, annotation and fragment queries."""

from pyspark.sql import functions as F

from checks.fixtures import duck, view
from checks.registry import query
from locusflow.operators import annotate as an, fragments as fr, sites as st


def _obs(spark, d):
    return view(spark, d, "fx_obs")


def _sites(spark, d):
    return view(spark, d, "fx_sites")


_BY_SIZE = """
SELECT sample, tag, chrom, strand, start0 AS cluster, size, start0, start0 + 1 AS end0, median(score) AS score,
       CAST(sum(n_reads) AS BIGINT) AS n_reads, count(*) AS n_variants FROM {src} GROUP BY sample, tag, chrom, strand, start0, size"""
_COLLAPSED = """
SELECT sample, tag, chrom, strand, cluster, start0, end0, median(score) AS score, CAST(sum(n_reads) AS BIGINT) AS n_reads,
       count(*) AS n_sizes FROM {src} GROUP BY sample, tag, chrom, strand, cluster, start0, end0"""


@query("collapse_by_size", duck(_BY_SIZE.format(src="fx_obs"), "fx_obs"))
def collapse_by_size(spark, d):
    return st.collapse_by_size(_obs(spark, d))


@query("collapse_sites", duck(f"WITH z AS ({_BY_SIZE.format(src='fx_obs')}) {_COLLAPSED.format(src='z')}", "fx_obs"))
def collapse_sites(spark, d):
    return st.collapse_sites(st.collapse_by_size(_obs(spark, d)))


_WIDE = """
WITH r AS (SELECT *, lag(start0) OVER w AS prev FROM fx_obs WINDOW w AS (PARTITION BY sample, tag, chrom, strand ORDER BY start0)),
c AS (SELECT *, max(CASE WHEN prev IS NULL OR start0 - (prev + 1) > 9000 THEN start0 END) OVER (
             PARTITION BY sample, tag, chrom, strand ORDER BY start0) AS cluster FROM r),
k AS (SELECT sample, tag, chrom, strand, cluster, size, start0, count(*) AS n FROM c GROUP BY ALL),
modes AS (SELECT * EXCLUDE (n) FROM k
          QUALIFY row_number() OVER (PARTITION BY sample, tag, chrom, strand, cluster, size ORDER BY n DESC, start0) = 1),
g AS (SELECT sample, tag, chrom, strand, cluster, size, median(score) AS score, CAST(sum(n_reads) AS BIGINT) AS n_reads,
             count(*) AS n_variants FROM c GROUP BY sample, tag, chrom, strand, cluster, size)
SELECT g.*, modes.start0, modes.start0 + 1 AS end0 FROM g JOIN modes USING (sample, tag, chrom, strand, cluster, size)"""


@query("collapse_by_size_with_gap", duck(_WIDE, "fx_obs"))
def collapse_by_size_with_gap(spark, d):
    return st.collapse_by_size(_obs(spark, d), max_gap=9000)


@query("site_names", duck("""
SELECT sample, tag, chrom, strand, start0 AS cluster, count(*) AS n_names, CAST(sum(n) AS BIGINT) AS n_obs,
       string_agg(name, ',' ORDER BY name) AS names
FROM (SELECT sample, tag, chrom, strand, start0, name, count(*) AS n FROM fx_obs GROUP BY ALL) x
GROUP BY sample, tag, chrom, strand, start0""", "fx_obs"))
def site_names(spark, d):
    names = st.site_names(_obs(spark, d))
    return names.select("sample", "tag", "chrom", "strand", "cluster", F.size("name_list").cast("bigint").alias("n_names"),
                        F.aggregate("name_list", F.lit(0).cast("bigint"), lambda s, x: s + x["n_value"]).alias("n_obs"),
                        F.array_join(F.transform("name_list", lambda x: x["name"]), ",").alias("names"))


_EVIDENCE = f"""
WITH z AS ({_BY_SIZE.format(src='fx_obs')}), a AS ({_COLLAPSED.format(src='z')}),
z2 AS ({_BY_SIZE.format(src="(SELECT * REPLACE ('+' AS strand) FROM fx_obs)")}), b AS ({_COLLAPSED.format(src='z2')}),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b)"""


@query("qualitative_sites", duck(_EVIDENCE + """
SELECT sample, tag, chrom, strand, start0, end0, median(score) AS score, CAST(sum(n_reads) AS BIGINT) AS n_reads
FROM u GROUP BY sample, tag, chrom, strand, start0, end0""", "fx_obs"))
def qualitative_sites(spark, d):
    obs = _obs(spark, d)
    plus = obs.withColumn("strand", F.lit("+"))
    return st.qual_is(*[st.collapse_sites(st.collapse_by_size(o)) for o in (obs, plus)])


@query("quantitative_sites", duck(f"""
WITH z AS ({_BY_SIZE.format(src='fx_obs')}),
u AS (SELECT sample, tag, chrom, start0, end0, score, strand, size, n_reads FROM fx_obs
      UNION ALL SELECT sample, tag, chrom, start0, end0, score, strand, size, n_variants FROM z),
q AS ({_BY_SIZE.format(src='u')}) {_COLLAPSED.format(src='q')}""", "fx_obs"))
def quantitative_sites(spark, d):
    obs = _obs(spark, d)
    return st.quant_is(obs, st.collapse_by_size(obs, count_rows=True))


@query("site_count", duck("SELECT sample, tag, count(*) AS n_sites FROM fx_sites GROUP BY sample, tag", "fx_sites"))
def site_count(spark, d):
    return st.site_count(_sites(spark, d))


# ---- annotation --------------------------------------------------------------------------------

_SETS = """
WITH body AS (SELECT DISTINCT ON (rowid) chrom, start0, end0, name, strand FROM (SELECT *, row_number() OVER () AS rowid FROM fx_genes)),
s AS (SELECT chrom, name, strand, CASE WHEN strand = '+' THEN start0 ELSE end0 - 1 END AS p FROM fx_genes),
t(tier, near, far) AS (VALUES ('core_promoter', 0, 40), ('proximal_promoter', 40, 200), ('distal_promoter', 200, 1000)),
x AS (SELECT chrom, name, strand, tier AS source,
             greatest(CASE WHEN strand = '-' THEN p + 1 + near ELSE p - far END, 0) AS start0,
             least(CASE WHEN strand = '-' THEN p + 1 + far ELSE p - near END, 1000000) AS end0 FROM s CROSS JOIN t),
sets AS (SELECT chrom, start0, end0, name, 'gene_body' AS source FROM body
         UNION ALL SELECT chrom, start0, end0, name, source FROM x WHERE start0 < end0),
hits AS (SELECT a.*, b.source, b.name AS tx_id FROM fx_sites a
         LEFT JOIN sets b ON a.chrom = b.chrom AND a.start0 < b.end0 AND b.start0 < a.end0),
sym AS (SELECT h.*, t.gene_symbol FROM hits h LEFT JOIN fx_tx t ON h.tx_id = t.tx_id AND h.chrom = t.chrom),
regions AS (SELECT sample, tag, chrom, start0, end0, score, strand, n_reads, gene_symbol,
                   coalesce(string_agg(DISTINCT source, ', ' ORDER BY source), '') AS sources, count(tx_id) AS n_transcripts,
                   CASE WHEN bool_or(source = 'gene_body') THEN 'Intragenic'
                        WHEN bool_or(source LIKE '%_promoter') THEN 'Promoter' ELSE 'Intergenic' END AS region
            FROM sym GROUP BY ALL)"""
_EXONS = """,
ex AS (SELECT *, unnest(generate_series(1, exon_count)) AS i FROM fx_tx),
exon AS (SELECT chrom, gene_symbol, exon_starts[i] AS start0, exon_ends[i] AS end0,
                tx_id || '_exon_' || CAST(CASE WHEN strand = '-' THEN exon_count - i + 1 ELSE i END AS STRING) AS name FROM ex),
inside AS (SELECT DISTINCT sample, tag, chrom, start0, end0, score, strand, n_reads FROM hits WHERE source = 'gene_body'),
exhit AS (SELECT a.*, b.gene_symbol, b.name FROM inside a
          LEFT JOIN exon b ON a.chrom = b.chrom AND a.start0 < b.end0 AND b.start0 < a.end0),
exagg AS (SELECT sample, tag, chrom, start0, end0, score, strand, n_reads, gene_symbol, count(name) AS n_exons, count(*) AS k
          FROM exhit GROUP BY ALL),
pos AS (SELECT r.*, coalesce(e.n_exons, 0) AS n_exons,
               CASE WHEN region <> 'Intragenic' THEN region WHEN e.k IS NOT NULL THEN 'Exonic' ELSE 'Intronic' END AS position
        FROM regions r LEFT JOIN exagg e
          ON r.region = 'Intragenic' AND r.gene_symbol IS NOT DISTINCT FROM e.gene_symbol AND r.sample = e.sample AND r.tag = e.tag
         AND r.chrom = e.chrom AND r.start0 = e.start0 AND r.end0 = e.end0 AND r.score = e.score AND r.strand = e.strand
         AND r.n_reads = e.n_reads)"""


def _sets(spark, d):
    tx = view(spark, d, "fx_tx")
    return an.add_gene_symbol(an.annotation_sets(tx, view(spark, d, "fx_sizes")), tx), tx


def _hits(spark, d, found="counts", abundance=None):
    """The sites, what is hit at each of their positions, and the gene model."""
    sites, (sets, tx) = _sites(spark, d), _sets(spark, d)
    return sites, an.annotate_overlaps(an.positions(sites, True, abundance), sets, found=found), tx


def _regions(spark, d):
    sites, hits, _ = _hits(spark, d)
    return an.at_sites(sites, an.classify_regions(hits, an.SOURCES), ("n_transcripts",))


def _annotated(spark, d, abundance=None):
    sites, hits, tx = _hits(spark, d, abundance=abundance)
    rows = an.classify_position(an.classify_regions(an.exon_hits(an.intragenic(hits), tx), an.SOURCES))
    return an.at_sites(sites, rows, ("n_transcripts",))


@query("gene_hits", duck(_SETS + "SELECT sample, tag, chrom, start0, strand, source AS b_source, tx_id AS b_name, gene_symbol FROM sym",
                         "fx_sites", "fx_genes", "fx_tx"))
def gene_hits(spark, d):
    return an.annotate_overlaps(_sites(spark, d), _sets(spark, d)[0]).select("sample", "tag", "chrom", "start0", "strand", "b_source", "b_name", "gene_symbol")


@query("region_classes", duck(_SETS + "SELECT * FROM regions", "fx_sites", "fx_genes", "fx_tx"))
def region_classes(spark, d):
    return _regions(spark, d)


@query("position_classes", duck(_SETS + _EXONS + "SELECT * FROM pos", "fx_sites", "fx_genes", "fx_tx"))
def position_classes(spark, d):
    return _annotated(spark, d)


@query("transcript_lists", duck(_SETS + """
SELECT sample, tag, chrom, start0, strand, gene_symbol, string_agg(DISTINCT tx_id, ',' ORDER BY tx_id) AS transcripts
FROM sym WHERE tx_id IS NOT NULL GROUP BY sample, tag, chrom, start0, strand, gene_symbol""", "fx_sites", "fx_genes", "fx_tx"))
def transcript_lists(spark, d):
    sites, hits, _ = _hits(spark, d, "names")
    # written out once per position, not for each of its sites
    lists = an.transcript_lists(hits).withColumn("b_name_list", F.array_join(F.transform("b_name_list", lambda x: x.b_name), ","))
    return an.at_sites(sites, lists).select("sample", "tag", "chrom", "start0", "strand", "gene_symbol", F.col("b_name_list").alias("transcripts"))


@query("exon_lists", duck(_SETS + _EXONS + """
SELECT sample, tag, chrom, start0, strand, gene_symbol AS b_gene_symbol, string_agg(DISTINCT name, ',' ORDER BY name) AS exons
FROM exhit WHERE name IS NOT NULL GROUP BY sample, tag, chrom, start0, strand, gene_symbol""", "fx_sites", "fx_genes", "fx_tx"))
def exon_lists(spark, d):
    sites, hits, tx = _hits(spark, d)
    lists = an.exon_lists(an.exon_hits(an.intragenic(hits), tx, "names"))
    lists = lists.withColumn("b_name_list", F.array_join(F.transform("b_name_list", lambda x: x.b_name), ","))
    return an.at_sites(sites, lists).select("sample", "tag", "chrom", "start0", "strand", "b_gene_symbol", F.col("b_name_list").alias("exons"))


@query("annotated_sites", duck(f"""
WITH z AS ({_BY_SIZE.format(src='fx_obs')}), sites AS ({_COLLAPSED.format(src='z')}),
body AS (SELECT chrom, start0, end0, CASE WHEN strand = '+' THEN start0 ELSE end0 - 1 END AS p, strand FROM fx_genes),
prom AS (SELECT chrom, greatest(CASE WHEN strand = '-' THEN p + 1 ELSE p - 1000 END, 0) AS start0,
                least(CASE WHEN strand = '-' THEN p + 1001 ELSE p END, 1000000) AS end0 FROM body)
SELECT a.sample, a.tag, a.chrom, a.start0, a.strand, a.n_reads, a.n_sizes,
       CASE WHEN EXISTS (SELECT 1 FROM body b WHERE a.chrom = b.chrom AND a.start0 < b.end0 AND b.start0 < a.end0) THEN 'Intragenic'
            WHEN EXISTS (SELECT 1 FROM prom b WHERE a.chrom = b.chrom AND a.start0 < b.end0 AND b.start0 < a.end0) THEN 'Promoter'
            ELSE 'Intergenic' END AS region
FROM sites a""", "fx_obs", "fx_genes"))
def annotated_sites(spark, d):
    sites = st.collapse_sites(st.collapse_by_size(_obs(spark, d)))
    hits = an.annotate_overlaps(sites, an.annotation_sets(view(spark, d, "fx_tx"), view(spark, d, "fx_sizes")), per=["source"])
    body = F.bool_or(F.col("b_source") == an.GENE_BODY)
    return (hits.groupBy("sample", "tag", "chrom", "start0", "strand", "n_reads", "n_sizes")
            .agg(F.when(body, "Intragenic").when(F.count("b_source") > 0, "Promoter").otherwise("Intergenic").alias("region")))


@query("intergenic_sites", duck("""SELECT a.* FROM fx_sites a WHERE NOT EXISTS (
  SELECT 1 FROM fx_genes b WHERE a.chrom = b.chrom AND a.start0 < b.end0 AND b.start0 < a.end0)""", "fx_sites", "fx_genes"))
def intergenic_sites(spark, d):
    from locusflow.operators.intervals import gene_bodies, overlap_join
    return overlap_join(_sites(spark, d), gene_bodies(view(spark, d, "fx_tx")), "anti")


# ---- fragments ---------------------------------------------------------------------------------

_FRAG = """
WITH frag AS (SELECT sample, tag, chrom || '_' || CAST(start0 AS STRING) || '_' || strand AS is_id, size, CAST(sum(n_reads) AS BIGINT) AS n_reads
              FROM fx_obs GROUP BY sample, tag, chrom, start0, end0, strand, size),
n AS (SELECT *, lag(n_reads) OVER w AS prev, lead(size) OVER w AS up, lag(size) OVER w AS down FROM frag
      WINDOW w AS (PARTITION BY sample, tag, is_id ORDER BY size)),
moved AS (SELECT sample, tag, is_id, n_reads,
                 CASE WHEN NOT (coalesce(n_reads / CAST(prev AS DOUBLE), 1) < 0.2 OR n_reads <= 10) THEN size
                      WHEN up - size < 3 THEN up WHEN size - down < 3 THEN down ELSE size END AS size FROM n),
corr AS (SELECT sample, tag, is_id, size, CAST(sum(n_reads) AS BIGINT) AS n_reads FROM moved GROUP BY sample, tag, is_id, size),
raw AS (SELECT sample, tag, is_id, CAST(sum(n_reads) AS BIGINT) AS reads_raw, count(*) AS fragments_raw FROM frag GROUP BY sample, tag, is_id),
tot AS (SELECT sample, tag, is_id, CAST(sum(n_reads) AS BIGINT) AS reads_corrected, count(*) AS fragments_corrected,
               CAST(coalesce(sum(n_reads) FILTER (n_reads > 10), 0) AS BIGINT) AS reads_corrected_strong,
               count(*) FILTER (n_reads > 10) AS fragments_corrected_strong FROM corr GROUP BY sample, tag, is_id)"""


@query("fragment_ratio", duck(_FRAG + """
SELECT sample, tag, is_id, size, n_reads, round(coalesce(n_reads / CAST(prev AS DOUBLE), 1), 6) AS ratio FROM n""", "fx_obs"))
def fragment_ratio(spark, d):
    return fr.with_ratio(fr.fragment_counts(_obs(spark, d))).withColumn("ratio", F.round("ratio", 6))


@query("fragment_correction", duck(_FRAG + "SELECT * FROM corr", "fx_obs"))
def fragment_correction(spark, d):
    return fr.correct_sizes(fr.fragment_counts(_obs(spark, d)))


@query("site_abundance", duck(_FRAG + "SELECT * FROM raw LEFT JOIN tot USING (sample, tag, is_id)", "fx_obs"))
def site_abundance(spark, d):
    return fr.site_abundance(_obs(spark, d), estimate=False)


@query("full_annotation", duck(_SETS + _EXONS + ", " + _FRAG.strip()[5:] + """
SELECT pos.sample, pos.tag, pos.chrom, pos.start0, pos.strand, pos.gene_symbol, pos.region, pos.position,
       t.reads_corrected, t.fragments_corrected
FROM pos LEFT JOIN tot t ON pos.sample = t.sample AND pos.tag = t.tag
     AND t.is_id = pos.chrom || '_' || CAST(pos.start0 AS STRING) || '_' || pos.strand""",
                              "fx_sites", "fx_genes", "fx_tx", "fx_obs"))
def full_annotation(spark, d):
    abundance = fr.site_abundance(_obs(spark, d), estimate=False).select("sample", "tag", "is_id", "reads_corrected", "fragments_corrected")
    return _annotated(spark, d, abundance).select(
        "sample", "tag", "chrom", "start0", "strand", "gene_symbol", "region", "position", "reads_corrected", "fragments_corrected")


# the rounds of the estimate one fragment at a time, far beyond the point where they settle
@query("abundance_estimate", duck(_FRAG + """,
em AS (SELECT sample, tag, is_id, size, CAST(1 AS DOUBLE) AS e, 0 AS it FROM corr
       UNION ALL
       SELECT sample, tag, is_id, size, m / (1 - exp(-m)), it + 1
       FROM (SELECT *, sum(e) OVER (PARTITION BY sample, tag, is_id) * sum(e) OVER (PARTITION BY sample, tag, size)
                       / sum(e) OVER (PARTITION BY sample, tag) AS m FROM em WHERE it < 120) x)
SELECT sample, tag, is_id, round(sum(e), 4) AS theta, true AS converged FROM em WHERE it = 120 GROUP BY ALL""", "fx_obs").replace("WITH ", "WITH RECURSIVE ", 1))
def abundance_estimate(spark, d):
    found = fr.estimate_abundance(fr.correct_sizes(fr.fragment_counts(_obs(spark, d))), tol=1e-9)
    return found.withColumn("theta", F.round("theta", 4))


@query("top_sites", duck(_FRAG + """
SELECT sample, tag, is_id, size, n_reads FROM corr WHERE (sample, tag, is_id) IN (
  SELECT (sample, tag, is_id) FROM tot QUALIFY row_number() OVER (PARTITION BY sample, tag ORDER BY fragments_corrected DESC, is_id) <= 10)
""", "fx_obs"))
def top_sites(spark, d):
    corrected = fr.correct_sizes(fr.fragment_counts(_obs(spark, d)))
    top = fr.top_sites(fr.corrected_totals(corrected), "fragments_corrected", 10)
    return fr.top_site_fragments(corrected, top)


@query("fragment_scatter", duck(_FRAG + """
SELECT sample, tag, is_id, fragments_corrected AS fragments, reads_corrected AS reads FROM tot""", "fx_obs"))
def fragment_scatter(spark, d):
    return fr.fragment_scatter(fr.correct_sizes(fr.fragment_counts(_obs(spark, d))))
