"""Diversity statistics over site abundances (fragments per site)."""

from pyspark.sql import functions as F

from checks.fixtures import duck, view
from checks.registry import query
from locusflow.operators import diversity as dv

_FREQ = """
WITH ab AS (SELECT sample, tag, chrom, start0, strand, sum(n_reads) AS x FROM fx_obs GROUP BY ALL),
x AS (SELECT sample, tag, x FROM ab),
fr AS (SELECT sample, tag, CAST(x AS BIGINT) AS k, count(*) AS f FROM ab GROUP BY ALL),
m AS (SELECT sample, tag, CAST(sum(k * f) AS DOUBLE) AS n, CAST(sum(f) AS DOUBLE) AS s,
             CAST(coalesce(sum(f) FILTER (k = 1), 0) AS DOUBLE) AS f1, CAST(coalesce(sum(f) FILTER (k = 2), 0) AS DOUBLE) AS f2,
             CAST(coalesce(sum(f) FILTER (k = 3), 0) AS DOUBLE) AS f3, CAST(coalesce(sum(f) FILTER (k = 4), 0) AS DOUBLE) AS f4
      FROM fr GROUP BY sample, tag)"""


def _freq(spark, d):
    sites = (view(spark, d, "fx_obs").groupBy("sample", "tag", "chrom", "start0", "strand").agg(F.sum("n_reads").alias("x")))
    return dv.frequencies(sites, "x")


def _rounded(df, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query("abundance_frequencies", duck(_FREQ + " SELECT * FROM fr", "fx_obs"))
def abundance_frequencies(spark, d):
    return _freq(spark, d)


@query("diversity_basic", duck(_FREQ + """
SELECT sample, tag, count(*) AS variety, round(-sum(x / n * ln(x / n)), 6) AS entropy, round(sum((x / n) * (x / n)), 6) AS simpson,
       round(-sum(x / n * ln(x / n)) / ln(count(*)), 6) AS evenness, round(1 - sum((x / n) * (x / n)), 6) AS gini_simpson
FROM x JOIN m USING (sample, tag) GROUP BY sample, tag""", "fx_obs"))
def diversity_basic(spark, d):
    return _rounded(dv.diversity_basic(_freq(spark, d)))


@query("gini", duck(_FREQ + """
SELECT sample, tag, round(2 * sum(i * x) / (count(*) * sum(x)) - (count(*) + 1) / count(*), 6) AS gini
FROM (SELECT sample, tag, CAST(x AS DOUBLE) AS x, row_number() OVER (PARTITION BY sample, tag ORDER BY x) AS i FROM x) y GROUP BY sample, tag""", "fx_obs"))
def gini(spark, d):
    return _rounded(dv.gini(_freq(spark, d)))


_COVER = """,
zh AS (SELECT sample, tag, 1 - sum((CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * f * exp(lgamma(k + 1) + lgamma(n - k + 1) - lgamma(n + 1))) AS zhang_huang
       FROM fr JOIN m USING (sample, tag) GROUP BY sample, tag),
cov AS (SELECT sample, tag, 1 - f1 / n AS turing,
               CASE WHEN f2 > 0 THEN 1 - f1 / n * ((n - 1) * f1 / ((n - 1) * f1 + 2 * f2))
                    WHEN f1 > 1 THEN 1 - f1 / n * ((n - 1) * (f1 - 1) / ((n - 1) * (f1 - 1) + 2)) ELSE 1 - f1 / n END AS chao, zhang_huang
        FROM m JOIN zh USING (sample, tag))"""


@query("sample_coverage", duck(_FREQ + _COVER + """
SELECT sample, tag, round(turing, 6) AS turing, round(chao, 6) AS chao, round(zhang_huang, 6) AS zhang_huang FROM cov""", "fx_obs"))
def sample_coverage(spark, d):
    return _rounded(dv.coverage(_freq(spark, d)))


@query("shannon_corrected", duck(_FREQ + _COVER + """
SELECT sample, tag, round(-sum(x / n * ln(x / n)) + (count(*) - 1) / (2 * max(n)), 6) AS miller_madow,
       round(-sum(turing * x / n * ln(turing * x / n) / (1 - pow(1 - turing * x / n, n))), 6) AS chao_shen,
       round(-sum(zhang_huang * x / n * ln(zhang_huang * x / n) / (1 - pow(1 - zhang_huang * x / n, n))), 6) AS chao_shen_zh
FROM x JOIN m USING (sample, tag) JOIN cov USING (sample, tag) GROUP BY sample, tag""", "fx_obs"))
def shannon_corrected(spark, d):
    return _rounded(dv.shannon_corrected(_freq(spark, d)))


# harmonic numbers H(j) for all whole j up to the largest total, and those of half arguments for the alternating term:
# psi(k) = H(k - 1) - gamma; psi(k + 1/2) = 2 H(2k) - H(k) - 2 ln 2 - gamma
_HARMONIC = """,
h AS (SELECT j, sum(1.0::DOUBLE / greatest(j, 1) * (j > 0)::INT) OVER (ORDER BY j) AS hj
      FROM (SELECT unnest(generate_series(0, (SELECT CAST(max(n) AS BIGINT) * 2 + 2 FROM m))) AS j) t),
g AS (SELECT fr.*, m.n, m.f1, m.f2, hn.hj AS h_n, hk.hj AS h_k,
             -- psi((k+1)/2) - psi(k/2) for even and odd k
             CASE WHEN k % 2 = 0 THEN (2 * h2.hj - hm.hj - 2 * ln(2)) - hm1.hj ELSE hm.hj - (2 * h2.hj - hm.hj - 2 * ln(2)) END AS diff
      FROM fr JOIN m USING (sample, tag) JOIN h hn ON hn.j = CAST(n AS BIGINT) - 1 JOIN h hk ON hk.j = k - 1
      JOIN h hm ON hm.j = k // 2 JOIN h h2 ON h2.j = 2 * (k // 2) JOIN h hm1 ON hm1.j = greatest(k // 2 - 1, 0)),
qq AS (SELECT *, 1 - CASE WHEN f2 > 0 THEN 2 * f2 / ((n - 1) * f1 + 2 * f2) WHEN f1 > 1 THEN 2 / ((n - 1) * (f1 - 1) + 2) ELSE 1 END AS q FROM m),
terms AS (SELECT sample, tag, n, f1, q, unnest(generate_series(CAST(n AS BIGINT), CAST(n AS BIGINT) + CAST(45 / (1 - q) AS BIGINT))) AS r FROM qq WHERE f1 > 0 AND q > 0),
rest AS (SELECT sample, tag, f1 / n * sum(exp((r - n + 1) * ln(q)) / r) AS unseen FROM terms GROUP BY sample, tag, n, f1)"""


@query("shannon_harmonic", duck(_FREQ + _HARMONIC + """
SELECT sample, tag, round(sum(f * k / n * (ln(n) - (h_k - 0.57721566490153286 + (CASE WHEN k % 2 = 0 THEN 0.5 ELSE -0.5 END) * diff))), 6) AS grassberger,
       round(sum(f * k / n * (h_n - h_k)), 6) AS zhang, round(sum(f * k / n * (h_n - h_k)) + coalesce(max(unseen), 0), 6) AS chao_wang_jost
FROM g LEFT JOIN rest USING (sample, tag) GROUP BY sample, tag""", "fx_obs"))
def shannon_harmonic(spark, d):
    return _rounded(dv.shannon_harmonic(_freq(spark, d)))


@query("richness", duck(_FREQ + """,
rare AS (SELECT sample, tag, CAST(coalesce(sum(f) FILTER (k <= 10), 0) AS DOUBLE) AS sr, CAST(coalesce(sum(f) FILTER (k > 10), 0) AS DOUBLE) AS sa,
                CAST(coalesce(sum(f * k) FILTER (k <= 10), 0) AS DOUBLE) AS nr, CAST(coalesce(sum(f * k * (k - 1)) FILTER (k <= 10), 0) AS DOUBLE) AS pr
         FROM fr GROUP BY sample, tag),
c AS (SELECT *, 1 - f1 / nr AS cv, s + CASE WHEN f2 > 0 THEN (n - 1) / n * f1 * f1 / (2 * f2) ELSE (n - 1) / n * f1 * (f1 - 1) / 2 END AS chao1
      FROM m JOIN rare USING (sample, tag)),
-- slopes of the estimate by small steps to both sides
step AS (SELECT sample, tag, k, f, sg, sa, sr + sg * 1e-4::DOUBLE AS sr, nr + sg * 1e-4::DOUBLE * k AS nr, pr + sg * 1e-4::DOUBLE * k * (k - 1) AS pr,
                f1 + CASE WHEN k = 1 THEN sg * 1e-4::DOUBLE ELSE 0 END AS f1
         FROM fr JOIN c USING (sample, tag) CROSS JOIN (VALUES (1), (-1)) t(sg) WHERE k <= 10),
slope AS (SELECT sample, tag, k, f, sum(sg * (sr / cv + f1 / cv * greatest(sr / cv * pr / (nr * (nr - 1)) - 1, 0))) / 2e-4::DOUBLE AS d
          FROM (SELECT *, 1 - f1 / nr AS cv FROM step) x GROUP BY sample, tag, k, f),
spread AS (SELECT sample, tag, sum(d * d * f) AS s2, sum(d * f) AS s1 FROM slope GROUP BY sample, tag)
SELECT sample, tag, CAST(s AS BIGINT) AS observed, round(chao1, 6) AS chao1,
       round(chao1 + (n - 3) / (4 * n) * f3 / greatest(f4, 1) * greatest(f1 - (n - 3) / (2 * (n - 1)) * f2 * f3 / greatest(f4, 1), 0), 6) AS ichao1,
       round(s + f1 * (f1 - 1) / (2 * (f2 + 1)), 6) AS chao1_unbiased,
       round(sqrt(greatest(CASE WHEN f1 > 0 AND f2 > 0 THEN f1 * (f1 - 1) / 2 / (f2 + 1) + f1 * pow(2 * f1 - 1, 2) / 4 / pow(f2 + 1, 2) + f1 * f1 * f2 * pow(f1 - 1, 2) / 4 / pow(f2 + 1, 4)
              WHEN f1 > 0 THEN f1 * (f1 - 1) / 2 + f1 * pow(2 * f1 - 1, 2) / 4 - pow(f1, 4) / 4 / (s + f1 * (f1 - 1) / 2) ELSE 0 END, 0)), 6) AS chao1_se,
       round(sa + sr / cv + f1 / cv * greatest(sr / cv * pr / (nr * (nr - 1)) - 1, 0), 6) AS ace,
       round(sqrt(s2 - s1 * s1 / (sa + sr / cv + f1 / cv * greatest(sr / cv * pr / (nr * (nr - 1)) - 1, 0))), 3) AS ace_se
FROM c JOIN spread USING (sample, tag)""", "fx_obs"))
def richness(spark, d):
    return _rounded(dv.richness(_freq(spark, d))).withColumn("ace_se", F.round("ace_se", 3))


@query("uc50", duck(_FREQ + """
SELECT sample, tag, CAST(count(*) FILTER (2 * c > t) AS BIGINT) AS uc50, round(100.0 * count(*) FILTER (2 * c > t) / count(*), 6) AS uc50_percent
FROM (SELECT sample, tag, sum(x) OVER (PARTITION BY sample, tag ORDER BY x ROWS UNBOUNDED PRECEDING) AS c, sum(x) OVER (PARTITION BY sample, tag) AS t FROM x) y
GROUP BY sample, tag""", "fx_obs"))
def uc50(spark, d):
    return _rounded(dv.uc50(_freq(spark, d)))


@query("lorenz_curve", duck(_FREQ + """
SELECT sample, tag, k, f, round(sum(f) OVER w / s, 6) AS site_share, round(sum(k * f) OVER w / n, 6) AS abundance_share
FROM fr JOIN m USING (sample, tag) WINDOW w AS (PARTITION BY sample, tag ORDER BY k)""", "fx_obs"))
def lorenz_curve(spark, d):
    return _rounded(dv.lorenz(_freq(spark, d)))


@query("rank_abundance", duck(_FREQ + """
SELECT sample, tag, CAST(x AS BIGINT) AS k, count(*) AS f, min(r) AS first_rank, max(r) AS last_rank
FROM (SELECT sample, tag, x, row_number() OVER (PARTITION BY sample, tag ORDER BY x DESC) AS r FROM x) y GROUP BY sample, tag, x""", "fx_obs"))
def rank_abundance(spark, d):
    return dv.rank_abundance(_freq(spark, d))


@query("broken_stick", duck(_FREQ + """,
r AS (SELECT sample, tag, x, row_number() OVER (PARTITION BY sample, tag ORDER BY x DESC) AS r FROM x),
e AS (SELECT sample, tag, x, r, n / s * sum(1.0::DOUBLE / r) OVER (PARTITION BY sample, tag ORDER BY r DESC) AS e FROM r JOIN m USING (sample, tag))
SELECT sample, tag, CAST(x AS BIGINT) AS k, count(*) AS f, min(r) AS first_rank, max(r) AS last_rank, round(max(e), 6) AS expected_first, round(min(e), 6) AS expected_last
FROM e GROUP BY sample, tag, x""", "fx_obs"))
def broken_stick(spark, d):
    return _rounded(dv.broken_stick(_freq(spark, d)))


@query("rarefaction", duck(_FREQ + """,
p AS (SELECT sample, tag, n, unnest(list_distinct(list_append(generate_series(1, CAST(n AS BIGINT), 1000), CAST(n AS BIGINT)))) AS m FROM m)
SELECT sample, tag, m, round(sum(f * (1 - CASE WHEN n - k < m THEN 0 ELSE exp(lgamma(n - k + 1) - lgamma(n - k - m + 1) - lgamma(n + 1) + lgamma(n - m + 1)) END)), 4) AS expected_sites
FROM p JOIN fr USING (sample, tag) GROUP BY sample, tag, m""", "fx_obs"))
def rarefaction(spark, d):
    return _rounded(dv.rarefaction(_freq(spark, d)), 4)


@query("diversity_table", duck(_FREQ + _COVER + """
SELECT sample, tag, count(*) AS variety, round(-sum(x / n * ln(x / n)), 6) AS entropy, round(max(turing), 6) AS turing,
       round(max(s + f1 * (f1 - 1) / (2 * (f2 + 1))), 6) AS chao1_unbiased
FROM x JOIN m USING (sample, tag) JOIN cov USING (sample, tag) GROUP BY sample, tag""", "fx_obs"))
def diversity_table(spark, d):
    table = dv.diversity_table(_freq(spark, d)).select("sample", "tag", "variety", "entropy", "turing", "chao1_unbiased")
    return _rounded(table)
