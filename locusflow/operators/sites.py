"""From alignments to insertion sites: positions, fragment sizes and the two-level collapse.

Site tables carry counts, not name lists: ``site_names`` gives the names of each site in bounded parts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from locusflow.operators.intervals import cluster
from locusflow.operators.scaling import spread, value_lists
from locusflow.schema import run_keys

OBS = ["chrom", "start0", "end0", "name", "score", "strand", "size", "n_reads"]


def with_interval(aln: DataFrame) -> DataFrame:
    """Add the 0-based interval (reference span of the CIGAR) and the strand of each alignment."""
    spans = F.transform(F.regexp_extract_all("cigar", F.lit(r"(\d+)[MDN=X]"), F.lit(1)), lambda x: x.cast("bigint"))
    span = F.aggregate(spans, F.lit(0).cast("bigint"), lambda total, x: total + x)
    return aln.withColumns({"start0": F.col("pos1") - 1, "end0": F.col("pos1") - 1 + span,
                            "strand": F.when(F.col("flag").bitwiseAND(16) != 0, "-").otherwise("+")})


def aln_to_interval(aln: DataFrame) -> DataFrame:
    """Alignment -> interval named after the read, with MAPQ as score."""
    extra = [c for c in ("n_reads",) if c in aln.columns]
    return with_interval(aln).select(*run_keys(aln), "chrom", "start0", "end0", F.col("qname").alias("name"),
                                     F.col("mapq").cast("double").alias("score"), "strand", *extra)


def with_size(df: DataFrame) -> DataFrame:
    """Add the fragment length, and the read count from names ending in ``x<count>`` when not yet a column."""
    out = df.withColumn("size", F.abs(F.col("end0") - F.col("start0")).cast("int"))
    if "n_reads" not in df.columns:
        counted = F.regexp_extract("name", r"x(\d+)$", 1)
        out = out.withColumn("n_reads", F.when(counted != "", counted).otherwise("1").cast("bigint"))
    return out


def insertion_point(df: DataFrame, size: int | None = None) -> DataFrame:
    """Interval -> the base next to the vector: its first base, or its last one on the minus strand."""
    start = F.when(F.col("strand") == "-", F.col("end0") - 1).otherwise(F.col("start0"))
    out = df.withColumn("start0", start).withColumn("end0", F.col("start0") + 1)
    return out if size is None else out.withColumn("size", F.lit(size))


def ligation_point(df: DataFrame) -> DataFrame:
    """Interval -> the base at the other, ligated fragment end."""
    start = F.when(F.col("strand") == "-", F.col("start0")).otherwise(F.col("end0") - 1)
    return df.withColumn("start0", start).withColumn("end0", F.col("start0") + 1)


def _pair_columns(df: DataFrame) -> list:
    return [*run_keys(df), F.col("m1.chrom").alias("chrom")]


def pair_insertion_point(pairs: DataFrame) -> DataFrame:
    """Mate pair -> insertion base at mate 1 and the fragment length spanned by both mates."""
    plus = F.col("m1.strand") == "+"
    start = F.when(plus, F.col("m1.start0")).otherwise(F.col("m1.end0") - 1)
    size = F.when(plus, F.col("m2.end0") - F.col("m1.start0")).otherwise(F.col("m1.end0") - F.col("m2.start0"))
    return pairs.select(*_pair_columns(pairs), start.alias("start0"), (start + 1).alias("end0"),
                        F.col("qname").alias("name"), F.col("score"), F.col("m1.strand").alias("strand"),
                        size.cast("int").alias("size"))


def pair_fragment(pairs: DataFrame) -> DataFrame:
    """Mate pair -> the whole fragment."""
    plus = F.col("m1.strand") == "+"
    return pairs.select(*_pair_columns(pairs),
                        F.when(plus, F.col("m1.start0")).otherwise(F.col("m2.start0")).alias("start0"),
                        F.when(plus, F.col("m2.end0")).otherwise(F.col("m1.end0")).alias("end0"),
                        F.col("qname").alias("name"), F.col("score"), F.col("m1.strand").alias("strand"))


def _cluster_keys(df: DataFrame) -> list[str]:
    return [*run_keys(df), "chrom", "strand", "cluster"]


def clustered(obs: DataFrame, max_gap: int = -1) -> DataFrame:
    """Observations with their site cluster (same strand; exact position unless ``max_gap`` is raised)."""
    return cluster(obs, max_gap, stranded=True, points=True)


def _collapse(rows: DataFrame, keys: list[str], sums: dict[str, str], home: list[str] | None = None,
              exact: bool = True) -> DataFrame:
    """Per group: modal start and end (smallest on ties), exact median score, and sums.

    ``sums`` maps result columns to columns of ``rows``; ``n`` is the weight of a row. The rows are first
    summed by distinct (start, end, score), on the map side too; mode and median are then read off these
    few rows (positions of a cluster times mapping qualities 0..255), laid out by ``home`` so that
    further collapses of the same sites need no new shuffle. With ``exact`` a cluster is a single position.
    """
    compact = rows.groupBy(*keys, *([] if exact else ["start0", "end0"]), "score").agg(
        F.sum("n").alias("n"), *[F.sum(c).alias(out) for out, c in sums.items()])
    if home:
        compact = spread(compact, *home)
    group = W.partitionBy(*keys).orderBy("score")
    # median: mean of the values at ranks (n+1) div 2 and (n+2) div 2
    ranked = compact.withColumns({
        "_upto": F.sum("n").over(group.rangeBetween(W.unboundedPreceding, 0)),
        "_all": F.sum("n").over(group.rangeBetween(W.unboundedPreceding, W.unboundedFollowing))})
    at = lambda r: F.min(F.when(F.col("_upto") >= F.floor((F.col("_all") + r) / 2), F.col("score")))
    rest = [((at(1) + at(2)) / 2).alias("score"), *[F.sum(out).alias(out) for out in sums]]
    if exact:
        place = [F.col("cluster").alias("start0"), (F.col("cluster") + 1).alias("end0")]
        out = ranked.groupBy(*keys).agg(*rest)
        return out.select(*keys, *place, *[c for c in out.columns if c not in keys])
    ranked = ranked.withColumns({f"_{c}": F.sum("n").over(W.partitionBy(*keys, c)) for c in ("start0", "end0")})
    mode = lambda c: F.min_by(c, F.struct(-F.col(f"_{c}"), F.col(c))).alias(c)
    return ranked.groupBy(*keys).agg(mode("start0"), mode("end0"), *rest)


def collapse_by_size(obs: DataFrame, count_rows: bool = False, max_gap: int = -1) -> DataFrame:
    """One row per site cluster and fragment size.

    ``n_variants`` is the number of observations. With ``count_rows`` (pairs, one row per read pair) the
    read count is that number as well.
    """
    rows = clustered(obs, max_gap).withColumn("n", F.lit(1).cast("bigint"))
    keys = _cluster_keys(rows)
    sums = {"n_reads": "n" if count_rows else "n_reads", "n_variants": "n"}
    return _collapse(rows, [*keys, "size"], sums, home=keys, exact=max_gap == -1)


def collapse_sites(by_size: DataFrame, max_gap: int = -1) -> DataFrame:
    """One row per site cluster: modal position, median score, reads and number of distinct fragment sizes."""
    rows = by_size.withColumn("n", F.lit(1).cast("bigint"))
    return _collapse(rows, _cluster_keys(by_size), {"n_reads": "n_reads", "n_sizes": "n"}, exact=max_gap == -1)


def union_evidence(*sources: DataFrame) -> DataFrame:
    """Stack site tables from several kinds of evidence, keeping the columns they share."""
    shared = [c for c in sources[0].columns if all(c in s.columns for s in sources)]
    return reduce(lambda x, y: x.unionByName(y), [s.select(*shared) for s in sources])


def qual_is(*sources: DataFrame, max_gap: int = -1) -> DataFrame:
    """Qualitative sites: the collapsed sites of all evidence merged by position."""
    merged = clustered(union_evidence(*[s.drop("cluster") for s in sources]), max_gap)
    rows = merged.withColumn("n", F.lit(1).cast("bigint"))
    keys = _cluster_keys(rows)
    return _collapse(rows, keys, {"n_reads": "n_reads"}, home=keys, exact=max_gap == -1).drop("cluster")


def union_quant(r1_obs: DataFrame, pair_by_size: DataFrame) -> DataFrame:
    """Quantitative observations: single-read observations and size-collapsed pairs."""
    columns = [*run_keys(r1_obs), "chrom", "start0", "end0", "score", "strand", "size", "n_reads"]
    return r1_obs.select(*columns).unionByName(pair_by_size.select(*columns))


def quant_is(r1_obs: DataFrame, pair_by_size: DataFrame, max_gap: int = -1) -> DataFrame:
    """Quantitative sites: re-clustered union, collapsed by size and then by site."""
    return collapse_sites(collapse_by_size(union_quant(r1_obs, pair_by_size), max_gap=max_gap), max_gap)


def site_names(obs: DataFrame, max_gap: int = -1, by_size: bool = False, part_size: int = 1000) -> DataFrame:
    """Read names of each site (or site and size) as lists, in parts of bounded length."""
    rows = clustered(obs, max_gap)
    keys = [*_cluster_keys(rows), *(["size"] if by_size else [])]
    return value_lists(rows, keys, "name", part_size)


def site_id(chrom: str = "chrom", start: str = "start0", strand: str = "strand"):
    """``chrom_start_strand`` identifier."""
    return F.concat_ws("_", F.col(chrom), F.col(start).cast("string"), F.col(strand))


def union_fragments(single: DataFrame, pairs: DataFrame) -> DataFrame:
    """Single-read alignments and pair fragments as one interval set."""
    columns = [*run_keys(single), "chrom", "start0", "end0", "name", "score", "strand"]
    return single.select(*columns).unionByName(pairs.select(*columns))


def site_count(sites: DataFrame) -> DataFrame:
    """Number of site rows per run, which sizes the random control set."""
    return sites.groupBy(*run_keys(sites)).agg(F.count(F.lit(1)).alias("n_sites"))
