"""Filters and projections over alignment records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from locusflow.functions.sequence import has_flag, quality_summary, revcomp
from locusflow.operators.sites import with_interval
from locusflow.schema import run_keys

READ1, READ2, REVERSE, UNMAPPED = 0x40, 0x80, 0x10, 0x4

# Fixed patterns: a mismatch within the first or last three reference bases in the MD string.
MISMATCH_HEAD = "^[012][A-Za-z]"
MISMATCH_TAIL = "[A-Za-z][012]$"


def _early_mismatch(forward: int, reverse: int) -> Column:
    """Mismatch next to the vector junction, seen from the alignment's direction."""
    return (((F.col("flag") == forward) & F.col("md").rlike(MISMATCH_HEAD))
            | ((F.col("flag") == reverse) & F.col("md").rlike(MISMATCH_TAIL)))


def is_exact() -> Column:
    """A single-read alignment without a mismatch in the three bases at the junction."""
    return F.col("flag").isin(0, 16) & ~_early_mismatch(0, 16)


def exact_junction(aln: DataFrame) -> DataFrame:
    """Single-read alignments without a mismatch in the three bases at the junction; other flags are dropped."""
    return aln.filter(is_exact())


def flag_junction(aln: DataFrame) -> DataFrame:
    """Add ``mismatch`` for first mates with a mismatch at the junction."""
    return aln.withColumn("mismatch", _early_mismatch(99, 83))


def is_unique(margin: int = 8) -> Column:
    """No second hit, or one worse by more than ``margin`` (by any amount below a perfect hit)."""
    best, second = F.abs("as_score"), F.abs("xs_score")
    return F.coalesce(((F.col("as_score") == 0) & (second > 0)) | (best + margin < second), F.lit(True))


def unique_hit(aln: DataFrame, margin: int = 8) -> DataFrame:
    """Keep reads with no second hit, or one worse by more than ``margin`` (by any amount below a perfect hit)."""
    return aln.filter(is_unique(margin))


def flag_multihit(aln: DataFrame, margin: int = 8) -> DataFrame:
    """Add ``multihit``: the opposite of ``unique_hit``."""
    return aln.withColumn("multihit", ~is_unique(margin))


def min_mapq(aln: DataFrame, q: int) -> DataFrame:
    return aln.filter(F.col("mapq") >= q)


def join_mates(aln: DataFrame) -> DataFrame:
    """Mate alignments as one row per read name: ``m1``, ``m2`` and whether either mate carries a flag.

    One aggregation, combined on the map side; no self-join. Further records of a name (secondary hits) do not
    multiply it: the first mate by coordinate is kept.
    """
    flagged = aln if "mismatch" in aln.columns else flag_multihit(flag_junction(aln))
    spans = with_interval(flagged)
    mate = F.struct("chrom", "start0", "end0", "strand", F.col("mapq").cast("double").alias("score"), "seq", "qual")
    return (spans.groupBy(*run_keys(aln), "qname")
            .agg(F.min(F.when(has_flag("flag", READ1), mate)).alias("m1"), F.min(F.when(has_flag("flag", READ2), mate)).alias("m2"),
                 F.bool_or("mismatch").alias("mismatch"), F.bool_or("multihit").alias("multihit")))


def route_pairs(mates: DataFrame) -> DataFrame:
    """Add ``route``: confident pairs, pairs whose R1 is rescued as a single read (multiple hits), others dropped."""
    return mates.withColumn("route", F.when(F.col("multihit"), "rescue").when(F.col("mismatch"), "dropped").otherwise("confident"))


def pairs_to_bedpe(mates: DataFrame) -> DataFrame:
    """Complete pairs with mate 1 first and the smaller of both mapping qualities as score."""
    return (mates.filter(F.col("m1").isNotNull() & F.col("m2").isNotNull())
            .select(*run_keys(mates), "qname", "m1", "m2", F.least("m1.score", "m2.score").alias("score")))


def alignment_to_read(rows: DataFrame, mate: str = "m1") -> DataFrame:
    """Mate alignments back to reads: reverse-complemented when aligned to the reverse strand."""
    reverse = F.col(f"{mate}.strand") == "-"
    return rows.filter(F.col(mate).isNotNull()).select(
        *run_keys(rows), F.col("qname").alias("read_id"),
        F.when(reverse, revcomp(f"{mate}.seq")).otherwise(F.col(f"{mate}.seq")).alias("seq"),
        F.when(reverse, F.reverse(F.col(f"{mate}.qual"))).otherwise(F.col(f"{mate}.qual")).alias("qual"),
        F.lit(1).cast("bigint").alias("n_reads"))


# SAM flag bits reported by the alignment statistics.
FLAG_BITS = {"secondary": 0x100, "supplementary": 0x800, "duplicates": 0x400, "paired": 0x1, "read1": 0x40, "read2": 0x80}


def flag_stats(aln: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Alignment counts by flag, and ``reads`` = total minus first mates, as used in the report."""
    groups = [*run_keys(aln), *by]
    counts = [F.count_if(has_flag("flag", bit)).alias(name) for name, bit in FLAG_BITS.items()]
    return (aln.groupBy(*groups).agg(F.count(F.lit(1)).alias("total"), F.count_if(~has_flag("flag", UNMAPPED)).alias("mapped"), *counts)
            .withColumn("reads", F.col("total") - F.col("read1")))


def fastq_stats(reads: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Read count, length range and mean, base and quality statistics, one column per metric; missing ones are 0."""
    size = F.length("seq")
    groups = [*run_keys(reads), *by]
    some = lambda c: F.when(F.col("_q.n") > 0, F.col(f"_q.{c}")).cast("int")
    count = lambda b: F.coalesce(F.sum(size - F.length(F.translate("seq", b, ""))), F.lit(0)).cast("bigint")
    return (reads.select(*groups, "seq", quality_summary("qual").alias("_q")).groupBy(*groups)
            .agg(F.count(F.lit(1)).alias("reads"), F.min(size).alias("len_min"), F.max(size).alias("len_max"),
                 F.avg(size).alias("len_mean"), F.sum(size).cast("bigint").alias("total_bases"),
                 F.min(some("lo")).alias("qual_min"), F.max(some("hi")).alias("qual_max"),
                 F.try_divide(F.sum("_q.total"), F.sum("_q.n")).alias("qual_mean"),
                 *[count(b).alias(f"n_{b}") for b in "ACGTN"])
            .na.fill(0))
