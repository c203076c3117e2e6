"""Alignment filters, pair routing and site positions."""

from pyspark.sql import functions as F

from checks.fixtures import duck, view
from checks.registry import query
from locusflow.operators import align as al, sites as st

_UNIQUE = "coalesce((as_score = 0 AND abs(xs_score) > 0) OR abs(as_score) + 8 < abs(xs_score), true)"
_COLS = "sample, tag, qname, flag, mapq, as_score, xs_score, md"


def _aln(spark, d):
    return view(spark, d, "fx_aln")


def _short(df):
    return df.select(*_COLS.split(", "))


@query("exact_junction", duck(f"""SELECT {_COLS} FROM fx_aln WHERE (flag = 0 AND NOT regexp_matches(md, '^[012][A-Za-z]'))
OR (flag = 16 AND NOT regexp_matches(md, '[A-Za-z][012]$'))""", "fx_aln"))
def exact_junction(spark, d):
    return _short(al.exact_junction(_aln(spark, d)))


@query("unique_hit", duck(f"SELECT {_COLS} FROM fx_aln WHERE {_UNIQUE}", "fx_aln"))
def unique_hit(spark, d):
    return _short(al.unique_hit(_aln(spark, d)))


@query("min_mapq", duck(f"SELECT {_COLS} FROM fx_aln WHERE mapq >= 10", "fx_aln"))
def min_mapq(spark, d):
    return _short(al.min_mapq(_aln(spark, d), 10))


@query("flagged_mates", duck(f"""
SELECT sample, tag, qname, flag, (flag = 99 AND regexp_matches(md, '^[012][A-Za-z]')) OR (flag = 83 AND regexp_matches(md, '[A-Za-z][012]$')) AS mismatch,
       coalesce((abs(xs_score) - abs(as_score) <= 8 AND as_score <> 0) OR xs_score = 0, false) AS multihit FROM fx_pair_aln""", "fx_pair_aln"))
def flagged_mates(spark, d):
    return al.flag_multihit(al.flag_junction(view(spark, d, "fx_pair_aln"))).select(
        "sample", "tag", "qname", "flag", "mismatch", "multihit")


_MATES = """
WITH f AS (SELECT *, (flag = 99 AND regexp_matches(md, '^[012][A-Za-z]')) OR (flag = 83 AND regexp_matches(md, '[A-Za-z][012]$')) AS mm,
                  coalesce((abs(xs_score) - abs(as_score) <= 8 AND as_score <> 0) OR xs_score = 0, false) AS mh,
                  CASE WHEN (flag // 16) % 2 = 1 THEN '-' ELSE '+' END AS strand,
                  pos1 - 1 AS s, pos1 - 1 + CAST(regexp_extract(cigar, '(\\d+)M', 1) AS BIGINT) AS e FROM fx_pair_aln),
one AS (SELECT * FROM f WHERE (flag // 64) % 2 = 1 QUALIFY row_number() OVER (PARTITION BY sample, tag, qname ORDER BY chrom, s, e, strand, mapq) = 1),
two AS (SELECT * FROM f WHERE (flag // 128) % 2 = 1 QUALIFY row_number() OVER (PARTITION BY sample, tag, qname ORDER BY chrom, s, e, strand, mapq) = 1),
fl AS (SELECT sample, tag, qname, bool_or(mm) AS mm, bool_or(mh) AS mh FROM f GROUP BY ALL),
p AS (SELECT sample, tag, qname, one.chrom, one.s AS s1, one.e AS e1, one.strand AS st, two.s AS s2, two.e AS e2,
             CAST(least(one.mapq, two.mapq) AS DOUBLE) AS score, one.seq AS seq, one.qual AS qual,
             CASE WHEN fl.mh THEN 'rescue' WHEN fl.mm THEN 'dropped' ELSE 'confident' END AS route
      FROM one JOIN two USING (sample, tag, qname) JOIN fl USING (sample, tag, qname))"""


def _routed(spark, d):
    return al.route_pairs(al.join_mates(view(spark, d, "fx_pair_aln")))


@query("pair_routes", duck(_MATES + " SELECT sample, tag, qname, route FROM p", "fx_pair_aln"))
def pair_routes(spark, d):
    return _routed(spark, d).select("sample", "tag", "qname", "route")


@query("pair_sites", duck(_MATES + """
SELECT sample, tag, chrom, CASE WHEN st = '+' THEN s1 ELSE e1 - 1 END AS start0, CASE WHEN st = '+' THEN s1 + 1 ELSE e1 END AS end0,
       qname AS name, score, st AS strand, CASE WHEN st = '+' THEN e2 - s1 ELSE e1 - s2 END AS size FROM p WHERE route = 'confident'""", "fx_pair_aln"))
def pair_sites(spark, d):
    return st.pair_insertion_point(al.pairs_to_bedpe(_routed(spark, d).filter("route = 'confident'")))


@query("pair_fragments", duck(_MATES + """
SELECT sample, tag, chrom, CASE WHEN st = '+' THEN s1 ELSE s2 END AS start0, CASE WHEN st = '+' THEN e2 ELSE e1 END AS end0,
       qname AS name, score, st AS strand FROM p""", "fx_pair_aln"))
def pair_fragments(spark, d):
    return st.pair_fragment(al.pairs_to_bedpe(_routed(spark, d)))


@query("pair_sites_collapsed", duck(_MATES + """,
o AS (SELECT sample, tag, chrom, CASE WHEN st = '+' THEN s1 ELSE e1 - 1 END AS start0, score, st AS strand,
             CASE WHEN st = '+' THEN e2 - s1 ELSE e1 - s2 END AS size FROM p WHERE route = 'confident')
SELECT sample, tag, chrom, strand, start0 AS cluster, size, start0, start0 + 1 AS end0, median(score) AS score,
       count(*) AS n_reads, count(*) AS n_variants FROM o GROUP BY sample, tag, chrom, strand, start0, size""", "fx_pair_aln"))
def pair_sites_collapsed(spark, d):
    return st.collapse_by_size(pair_sites(spark, d), count_rows=True)


@query("rescued_reads", duck(_MATES + """
SELECT sample, tag, qname AS read_id, CASE WHEN st = '-' THEN reverse(translate(seq, 'ACGTN', 'TGCAN')) ELSE seq END AS seq,
       CASE WHEN st = '-' THEN reverse(qual) ELSE qual END AS qual, CAST(1 AS BIGINT) AS n_reads FROM p WHERE route = 'rescue'""", "fx_pair_aln"))
def rescued_reads(spark, d):
    return al.alignment_to_read(_routed(spark, d).filter("route = 'rescue'"))


_SPANS = """
WITH a AS (SELECT sample, tag, chrom, qname AS name, CAST(mapq AS DOUBLE) AS score, CASE WHEN flag = 16 THEN '-' ELSE '+' END AS strand,
                  pos1 - 1 AS start0, pos1 - 1 + list_sum([CAST(x AS BIGINT) for x in regexp_extract_all(cigar, '(\\d+)[MDN=X]', 1)]) AS end0,
                  CAST(split_part(qname, 'x', 2) AS BIGINT) AS n_reads FROM fx_aln)"""


@query("alignment_intervals", duck(_SPANS + " SELECT *, CAST(end0 - start0 AS INT) AS size FROM a", "fx_aln"))
def alignment_intervals(spark, d):
    return st.with_size(st.aln_to_interval(_aln(spark, d)))


@query("insertion_points", duck(_SPANS + """
SELECT * REPLACE (CASE WHEN strand = '-' THEN end0 - 1 ELSE start0 END AS start0, CASE WHEN strand = '-' THEN end0 ELSE start0 + 1 END AS end0),
       0 AS size FROM a""", "fx_aln"))
def insertion_points(spark, d):
    return st.insertion_point(st.with_size(st.aln_to_interval(_aln(spark, d))), size=0)


@query("ligation_points", duck(_SPANS + """
SELECT * REPLACE (CASE WHEN strand = '-' THEN start0 ELSE end0 - 1 END AS start0, CASE WHEN strand = '-' THEN start0 + 1 ELSE end0 END AS end0) FROM a""", "fx_aln"))
def ligation_points(spark, d):
    rows = st.ligation_point(st.with_size(st.aln_to_interval(_aln(spark, d))))
    return rows.drop("size")


@query("alignments_to_sites", duck(_SPANS.replace("FROM fx_aln)", f"""FROM fx_aln
       WHERE {_UNIQUE} AND mapq >= 10 AND ((flag = 0 AND NOT regexp_matches(md, '^[012][A-Za-z]')) OR (flag = 16 AND NOT regexp_matches(md, '[A-Za-z][012]$'))))""") + """,
o AS (SELECT *, CASE WHEN strand = '-' THEN end0 - 1 ELSE start0 END AS p, end0 - start0 AS size FROM a),
z AS (SELECT sample, tag, chrom, strand, p, size, median(score) AS score, sum(n_reads) AS n_reads FROM o GROUP BY ALL)
SELECT sample, tag, chrom, strand, p AS cluster, p AS start0, p + 1 AS end0, median(score) AS score,
       CAST(sum(n_reads) AS BIGINT) AS n_reads, count(*) AS n_sizes FROM z GROUP BY sample, tag, chrom, strand, p""", "fx_aln"))
def alignments_to_sites(spark, d):
    kept = al.min_mapq(al.unique_hit(al.exact_junction(_aln(spark, d))), 10)
    return st.collapse_sites(st.collapse_by_size(st.insertion_point(st.with_size(st.aln_to_interval(kept)))))


@query("flag_statistics", duck("""
SELECT sample, tag, count(*) AS total, count(*) FILTER ((flag // 4) % 2 = 0) AS mapped, count(*) FILTER ((flag // 256) % 2 = 1) AS secondary,
       count(*) FILTER ((flag // 2048) % 2 = 1) AS supplementary, count(*) FILTER ((flag // 1024) % 2 = 1) AS duplicates,
       count(*) FILTER (flag % 2 = 1) AS paired, count(*) FILTER ((flag // 64) % 2 = 1) AS read1, count(*) FILTER ((flag // 128) % 2 = 1) AS read2,
       count(*) - count(*) FILTER ((flag // 64) % 2 = 1) AS reads FROM fx_pair_aln GROUP BY sample, tag""", "fx_pair_aln"))
def flag_statistics(spark, d):
    return al.flag_stats(view(spark, d, "fx_pair_aln"))
