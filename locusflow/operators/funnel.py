"""Stage counts, read funnel and report tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from locusflow.operators.reads import OUTCOMES
from locusflow.operators.scaling import checkpointed, same_join
from locusflow.schema import run_keys


def stack_stages(*tables: DataFrame) -> DataFrame:
    """Stage counts of several tables as one."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), tables)


def stage_counts(**stages: DataFrame) -> DataFrame:
    """Rows per run and stage; the stage is named by the argument."""
    return stack_stages(*[df.groupBy(*run_keys(df)).agg(F.count(F.lit(1)).alias("reads")).withColumn("stage", F.lit(name))
                          for name, df in stages.items()])


def stage_flags(df: DataFrame, **stages: Column) -> DataFrame:
    """Rows per run for which each stage's condition holds, in one pass; the stage is named by the argument."""
    runs = run_keys(df)
    counted = df.groupBy(*runs).agg(*[F.count_if(c).alias(name) for name, c in stages.items()])
    named = F.explode(F.array(*[F.struct(F.lit(name).alias("stage"), F.col(name).alias("reads")) for name in stages])).alias("x")
    return counted.select(*runs, named).select(*runs, "x.reads", "x.stage")


# Stages of the trimming and the outcomes that a pair has if it is counted there.
_TRIMMING = {"R1_raw": OUTCOMES, "R1_provirus": OUTCOMES[:1], "R1_noProvirus": OUTCOMES[1:], "R1_noLTR": OUTCOMES[1:2], "R1_LTR": OUTCOMES[2:],
             "R1_noElongation": OUTCOMES[2:3], "R1_elongation": OUTCOMES[3:], "R1_noPrefix": OUTCOMES[3:4], "R1_trimmed": OUTCOMES[4:],
             "R1_linker": OUTCOMES[4:5], "R1_linkerR2": OUTCOMES[5:6], "R1_noLinker": OUTCOMES[6:]}


def trimming_counts(routed: DataFrame) -> DataFrame:
    """Pairs at every stage of the trimming, from the outcomes that ``route_reads`` gives."""
    return stage_flags(routed, **{name: F.col("outcome").isin(*kept) for name, kept in _TRIMMING.items()})


def describe_stages(counts: DataFrame, dim: DataFrame) -> DataFrame:
    """Attach description, parents and step of the stage whose pattern the stage name matches.

    The dimension holds one row per processing stage (a few dozen); it is looked up as an array, and stages
    without a match are left out. Several matching patterns give one row each.
    """
    table = dim.agg(F.collect_list(F.struct("pattern", "description", "parents", "step")).alias("d")).scalar()
    found = F.filter("_dim", lambda d: F.regexp_like(F.col("stage"), d["pattern"]))
    return (counts.withColumn("_dim", table).withColumn("_m", F.explode(found))
            .select(*counts.columns, "_m.description", "_m.parents", "_m.step"))


def funnel(counts: DataFrame, dim: DataFrame, root: str = "R1_raw") -> DataFrame:
    """Reads of each stage, and their percentage of the summed parents and of the ``root`` stage."""
    rows = checkpointed(describe_stages(counts, dim))  # a row per run and stage, so that every stage is counted once
    runs = run_keys(counts)
    by_name = rows.groupBy(*runs, F.trim("description").alias("_parent")).agg(F.sum("reads").alias("_reads"))
    keys = [*runs, "description"]
    # a stage has a handful of parents
    asked = rows.select(*keys, F.explode(F.split("parents", ";")).alias("_parent")).distinct()
    parents = same_join(asked, by_name, [*runs, "_parent"]).groupBy(*keys).agg(F.sum("_reads").alias("_parent_reads"))
    whole = F.max(F.when(F.col("description") == root, F.col("reads"))).over(W.partitionBy(*(runs or [F.lit(0)])))
    return (same_join(rows, parents, keys, "left").withColumn("_root", whole)
            .withColumn("pct_parent", F.round(100 * F.col("reads") / F.col("_parent_reads"), 1))
            .withColumn("pct_total", F.round(100 * F.col("reads") / F.col("_root"), 1))
            .drop("_parent_reads", "_root"))


# Outcome words at the end of a stage description, and the descriptions shown in the report.
OUTCOME_WORDS = "(Negative|Positive|mapped|unmapped|2short|filtered)$"
REPORTED = "^R1|^Qua"
READ_STEPS = "^0[0-9]"


def stage_outcomes(rows: DataFrame) -> DataFrame:
    """Reads per processing step and outcome of R1 stages."""
    kept = rows.filter(F.col("step").rlike(READ_STEPS) & F.col("description").rlike("^R1"))
    return (kept.withColumn("outcome", F.regexp_extract("description", OUTCOME_WORDS, 1))
            .groupBy(*run_keys(rows), "step", "outcome").agg(F.sum("reads").alias("reads")))


def reported_stages(rows: DataFrame) -> DataFrame:
    """Stages shown in the report, in step order, with grouped digits."""
    return (rows.filter(F.col("description").rlike(REPORTED))
            .withColumn("reads", F.format_number("reads", 0)).orderBy(*run_keys(rows), "step", "description"))


def run_summary(annotated: DataFrame, count_missing_gene: bool = False) -> DataFrame:
    """One row per run: distinct sites, annotation rows, distinct genes hit inside, reads over distinct sites.

    ``count_missing_gene`` counts a missing gene symbol as one more gene.
    """
    runs = run_keys(annotated)
    site = [c for c in ("chrom", "start0", "end0", "score", "strand", "n_reads") if c in annotated.columns]
    inside = F.col("region") == "Intragenic"
    rows = annotated.groupBy(*runs).agg(F.count(F.lit(1)).alias("annotated_rows"),
                                        F.countDistinct(F.when(inside, F.col("gene_symbol"))).alias("genes"),
                                        F.max(F.when(inside & F.col("gene_symbol").isNull(), 1).otherwise(0)).alias("_missing"))
    if count_missing_gene:
        rows = rows.withColumn("genes", F.col("genes") + F.col("_missing"))
    sites = (annotated.select(*runs, *site).distinct()
             .groupBy(*runs, "chrom", "start0", "strand").agg(F.sum("n_reads").alias("n_reads"))
             .groupBy(*runs).agg(F.count(F.lit(1)).alias("unique_sites"), F.sum("n_reads").alias("reads")))
    return same_join(rows.drop("_missing"), sites, runs) if runs else bind_cols(rows.drop("_missing"), sites)


def bind_cols(*tables: DataFrame) -> DataFrame:
    """One-row tables side by side."""
    first, *rest = tables
    return reduce(lambda x, y: x.withColumns({c: y.select(c).scalar() for c in y.columns}), rest, first)


def share_by(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per combination of ``columns`` and their share of the run."""
    runs = run_keys(df)
    whole = F.sum("n").over(W.partitionBy(*(runs or [F.lit(0)])))
    return (df.groupBy(*runs, *columns).agg(F.count(F.lit(1)).alias("n")).withColumn("share", F.col("n") / whole))


def position_share(annotated: DataFrame) -> DataFrame:
    """Percentage of annotation rows per position class, one column per class."""
    classes = ["Exonic", "Intergenic", "Intronic", "Promoter"]  # fixed values
    total = F.count(F.lit(1))
    return annotated.groupBy(*run_keys(annotated)).agg(
        *[(100 * F.count_if(F.col("position") == c) / total).alias(c) for c in classes])


def top_genes(annotated: DataFrame, min_count: int = 50, n: int = 200) -> DataFrame:
    """Most frequently hit genes."""
    rows = (annotated.filter(F.col("region") == "Intragenic").groupBy(*run_keys(annotated), "gene_symbol")
            .agg(F.count(F.lit(1)).alias("hits")).filter(F.col("hits") >= min_count))
    runs = run_keys(annotated)
    if not runs:
        return rows.orderBy(F.desc("hits"), "gene_symbol").limit(n)
    rank = F.row_number().over(W.partitionBy(*runs).orderBy(F.desc("hits"), "gene_symbol"))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= n)


def contingency(df: DataFrame, a: str, b: str, n: str | None = None) -> DataFrame:
    """Counts of two factors with expected counts and Pearson residuals; ``n`` names a column that tells how often a row counts."""
    runs = run_keys(df)
    cells = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(*runs, a, b).agg((F.sum(n) if n else F.count(F.lit(1))).alias("observed"))
    # a cell table has as many rows as pairs of levels
    over = lambda *c: F.sum("observed").over(W.partitionBy(*runs, *c) if runs or c else W.partitionBy(F.lit(0)))
    expected = over(a) * over(b) / over()
    return (cells.withColumn("expected", expected)
            .withColumn("residual", (F.col("observed") - F.col("expected")) / F.sqrt("expected")))


def demux_shown(counts: DataFrame) -> DataFrame:
    """Tags that got reads, without the total row, with the count on a log scale."""
    return with_log10(counts.filter((F.col("reads") > 0) & (F.col("tag") != "total")), "reads")


def with_log10(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(f"log10_{column}", F.log10(column))
