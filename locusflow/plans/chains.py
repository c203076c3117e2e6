"""End-to-end chains: reads to sites, annotation, feature association, report.

Each chain is one set of lazy DataFrames. Tables read by several branches are cut once through the
checkpoint folder, so that a lost executor does not set the whole chain back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from locusflow.operators import (align as al, annotate as an, diversity as dv, features as ft, fragments as fr, funnel as fn,
                                 genome as gn, intervals as iv, locate as lc, reads as rd, sites as st)
from locusflow.operators.scaling import checkpointed
from locusflow.schema import WINDOWS, AdapterSet, run_keys


@dataclass
class SiteTables:
    """Results of ``reads_to_sites``."""

    r1_obs: DataFrame
    pair_by_size: DataFrame
    residual_obs: DataFrame
    qualitative: DataFrame
    quantitative: DataFrame
    quant_obs: DataFrame
    fragments: DataFrame
    stages: DataFrame


def r1_branch(aln: DataFrame) -> DataFrame:
    """Alignments of reads with the linker in R1 -> site observations."""
    kept = al.min_mapq(al.unique_hit(al.exact_junction(aln)), 0)
    return st.insertion_point(st.with_size(st.aln_to_interval(kept)))


def residual_branch(aln: DataFrame) -> DataFrame:
    """Alignments of residual single reads -> site observations without a fragment size."""
    kept = al.min_mapq(al.unique_hit(al.exact_junction(aln)), 10)
    return st.insertion_point(st.with_size(st.aln_to_interval(kept)), size=0)


def pair_branch(aln: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pair alignments -> confident complete pairs, and first mates to be rescued as single reads."""
    routed = al.route_pairs(al.join_mates(aln))
    return (al.pairs_to_bedpe(routed.filter(F.col("route") == "confident")),
            al.alignment_to_read(routed.filter(F.col("route") == "rescue")))


def reads_to_sites(pairs: DataFrame, barcodes: DataFrame | None, index: lc.GenomeIndex,
                   adapters: AdapterSet = AdapterSet()) -> SiteTables:
    """Read pairs of any number of samples -> qualitative and quantitative site tables.

    Three branches: linker read in R1; linker only in R2, located as pairs; and everything left over,
    located by R1 alone and used for the qualitative table only.
    """
    tagged = rd.demultiplex(pairs, barcodes).filter(F.col("tag") != "unmatched").drop("barcode_mm") if barcodes is not None else pairs
    routed = checkpointed(rd.route_reads(tagged, adapters))
    branch = lambda outcome: routed.filter(F.col("outcome") == outcome).drop("outcome")
    with_r1, with_r2, without = branch("linker_r1"), branch("linker_r2"), branch("no_linker")

    collapsed = rd.with_length_ok(rd.collapse_reads(rd.single_reads(with_r1), 1))
    unique = collapsed.filter("long_enough").drop("long_enough")
    r1_aln = checkpointed(lc.locate_reads(unique, index))
    r1_obs = r1_branch(r1_aln)

    tailed = rd.with_length_ok(rd.trim_r2_tail(with_r2, adapters), 20, mates="any")
    ready = tailed.filter("long_enough").drop("long_enough")
    pair_aln = checkpointed(lc.locate_pairs(ready, index))
    confident, rescued = pair_branch(pair_aln)
    pair_by_size = st.collapse_by_size(st.pair_insertion_point(confident), count_rows=True)

    unplaced = lc.unlocated(ready.withColumn("qname", F.col("read_id")), pair_aln)
    left_over = rd.residual_reads(no_linker=rd.single_reads(without), rescued=rescued, unaligned_pair=rd.single_reads(unplaced),
                                  unmapped=lc.unlocated(unique, r1_aln).withColumnRenamed("qname", "read_id"))
    residual = rd.collapse_reads(rd.min_length(rd.cut_reads(left_over)))
    residual_aln = checkpointed(lc.locate_reads(residual, index, trim3=5))
    residual_obs = residual_branch(residual_aln)

    collapse = lambda obs: st.collapse_sites(st.collapse_by_size(obs))
    qualitative = st.qual_is(collapse(r1_obs), collapse(residual_obs), st.collapse_sites(pair_by_size))
    quantitative = st.quant_is(r1_obs, pair_by_size)
    single = st.aln_to_interval(al.unique_hit(al.exact_junction(r1_aln)))
    fragments = st.union_fragments(single, st.pair_fragment(confident))
    # one pass per table, whatever the number of stages counted on it
    exact, unique_hit, enough = al.is_exact(), al.is_unique(), F.col("long_enough")
    stages = fn.stack_stages(
        fn.trimming_counts(routed), fn.stage_flags(collapsed, R1_collapsed=enough, R1_tooShort=~enough),
        fn.stage_flags(r1_aln, R1_located=F.lit(True), R1_exact=exact, R1_unique=exact & unique_hit, R1_multihit=~unique_hit),
        fn.stage_flags(tailed, pairs_long=enough, pairs_tooShort=~enough), fn.stage_counts(pairs_located=pair_aln, pairs_confident=confident, pairs_rescued=rescued),
        # a run that has all its reads placed counts 0
        fn.stage_flags(lc.with_located(unique, r1_aln), R1_unmapped=~F.col("located")),
        fn.stage_flags(lc.with_located(ready.withColumn("qname", F.col("read_id")), pair_aln), pairs_unmapped=~F.col("located")),
        fn.stage_counts(residual=residual, residual_located=residual_aln,
                        Qual_sites=qualitative, Quant_sites=quantitative))
    return SiteTables(r1_obs, pair_by_size, residual_obs, qualitative, quantitative, st.union_quant(r1_obs, pair_by_size), fragments, stages)


def annotate_sites(qualitative: DataFrame, tx: DataFrame, sizes: DataFrame, abundance: DataFrame | None = None) -> DataFrame:
    """Sites with gene, region and position class, and their ``abundance`` if it is given."""
    qualitative = checkpointed(qualitative)
    hits = an.annotate_overlaps(an.positions(qualitative, True, abundance), an.add_gene_symbol(an.annotation_sets(tx, sizes), tx), found="counts")
    rows = an.classify_position(an.classify_regions(an.exon_hits(an.intragenic(hits), tx), an.SOURCES))
    return an.at_sites(qualitative, rows, ("n_transcripts",))


def full_annotation(qualitative: DataFrame, quant_obs: DataFrame, tx: DataFrame, sizes: DataFrame, iterations: int = 200) -> DataFrame:
    """Annotated sites with their raw, corrected and estimated abundance."""
    abundance = fr.site_abundance(quant_obs, iterations=iterations)
    rows = annotate_sites(qualitative, tx, sizes, abundance).withColumn("is_id", st.site_id())
    quantities = [c for c in abundance.columns if c not in (*run_keys(abundance), "is_id")]
    return rows.select(*[c for c in rows.columns if c not in ("is_id", *quantities)], "is_id", *quantities)


def feature_association(sites: DataFrame, sizes: DataFrame, tx: DataFrame, genome: DataFrame, regions: dict[str, DataFrame],
                        signal: DataFrame | None = None, windows: dict[str, int] | None = None, seed: int = 1) -> DataFrame:
    """Long table ``(run, window, site, cls, feature, value)`` of all features around observed and random sites."""
    both = checkpointed(ft.with_controls(sites, ft.random_sites(sites, sizes, seed)))
    around = iv.multi_window(both, sizes, windows or WINDOWS)
    runs = run_keys(sites)
    keys = [*runs, "window", "chrom", F.col("site_start0").alias("start0"), "strand", "cls"]
    tables = []
    for name, features in {"GeneDens": iv.gene_bodies(tx), **regions}.items():
        counted = iv.overlap_count(around, features, "value")
        tables.append(counted.select(*keys, F.lit(name).alias("feature"), F.col("value").cast("double").alias("value")))
    composed = gn.base_composition(around, genome)
    tables.append(composed.select(*keys, F.lit("GCcontent").alias("feature"), F.col("pct_gc").alias("value")))
    if signal is not None:
        means = iv.window_mean(around, signal)
        tables.append(means.select(*keys, F.col("track").alias("feature"), "value"))
    nearest = iv.closest(both, iv.tss(iv.gene_bodies(tx)), ties="first")
    tables.append(nearest.select(*runs, F.lit("0kb").alias("window"), "chrom", "start0", "strand", "cls",
                                 F.lit("DistTSS").alias("feature"), F.col("distance").cast("double").alias("value")))
    return ft.bind_rows(*tables)


def association_auc(long: DataFrame) -> DataFrame:
    """AUC of every feature and window of each run."""
    return ft.auc(long, [*run_keys(long), "window", "feature"])


def motif_tables(fragments: DataFrame, genome: DataFrame, sizes: DataFrame, around: int = 20) -> DataFrame:
    """Base shares around insertion and ligation points."""
    out = []
    for label, points in (("insertion", st.insertion_point(fragments)), ("ligation", st.ligation_point(fragments))):
        merged = iv.merge(points, points=True)
        windows = iv.slop(merged, around, sizes)
        out.append(gn.position_frequency(gn.fetch_sequence(windows, genome)).withColumn("end", F.lit(label)))
    return ft.bind_rows(*out)


def report_tables(annotated: DataFrame, abundance: DataFrame, stages: DataFrame | None = None, dim: DataFrame | None = None,
                  reads: DataFrame | None = None, alignments: DataFrame | None = None) -> dict[str, DataFrame]:
    """Tables behind the report.

    ``stages`` (of ``reads_to_sites``) with their dimension ``dim`` give the read funnel; single ``reads`` and ``alignments``
    give their statistics.
    """
    freq = dv.frequencies(abundance, "theta" if "theta" in abundance.columns else "fragments_corrected")
    tables = {
        "summary": fn.run_summary(annotated), "position_share": fn.position_share(annotated),
        "chrom_strand": fn.share_by(annotated, "chrom", "strand"), "top_genes": fn.top_genes(annotated),
        "rank_abundance": dv.broken_stick(freq), "lorenz": dv.lorenz(freq), "diversity": dv.diversity_table(freq),
    }
    if stages is not None and dim is not None:
        rows = fn.funnel(stages, dim)
        tables |= {"funnel": rows, "stage_outcomes": fn.stage_outcomes(rows), "reported_stages": fn.reported_stages(rows)}
    if reads is not None:
        tables["read_statistics"] = al.fastq_stats(reads)
    if alignments is not None:
        tables["flag_statistics"] = al.flag_stats(alignments)
    return tables
