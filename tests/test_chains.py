"""The chains from read pairs to report tables on a small constructed run."""

import random

import pytest
from pyspark.sql import functions as F

from locusflow.operators import features as ft, fragments as fr, genome as gn, locate as lc, reads as rd
from locusflow.plans import chains
from locusflow.schema import AdapterSet

A = AdapterSet()
COMP = str.maketrans("ACGT", "TGCA")
TAGS = {"TAG1": "AACCGG", "TAG2": "TTGGCC"}


def rc(s):
    return s.translate(COMP)[::-1]


@pytest.fixture(scope="module")
def run(spark):
    rng = random.Random(77)
    genome = {c: "".join(rng.choice("ACGT") for _ in range(12_000)) for c in ("chr1", "chr2")}
    head = A.ltr + A.elongation + A.prefix
    pairs, truth = [], {"r1": [], "pair": [], "residual": []}

    def add(sample, tag, r1, r2):
        pairs.append((sample, f"q{len(pairs)}", TAGS[tag] + r1, "I" * (6 + len(r1)), r2, "I" * len(r2)))

    def insert(chrom, site, strand, size):
        """Genome bases read outwards from a site; its base is the first of the fragment on either strand."""
        g = genome[chrom]
        return g[site:site + size] if strand == "+" else rc(g[site - size + 1:site + 1])

    for sample, tag, chrom, site, strand, sizes in (
            ("S1", "TAG1", "chr1", 1000, "+", [40, 40, 45, 60]), ("S1", "TAG2", "chr1", 1000, "+", [50]),
            ("S2", "TAG1", "chr2", 5000, "-", [33, 47, 47])):
        truth["r1"].append((sample, tag, chrom, site, strand, len(sizes), len(set(sizes))))
        for n in sizes:
            body = insert(chrom, site, strand, n)
            add(sample, tag, head + body + A.linker_r1, A.linker_r2 + rc(body) + rc(head)[:10])
    for sample, tag, chrom, site, strand, sizes in (("S1", "TAG1", "chr2", 8000, "+", [300, 350]), ("S2", "TAG2", "chr1", 7000, "-", [250])):
        truth["pair"].append((sample, tag, chrom, site, strand, len(sizes), len(sizes)))
        for n in sizes:
            body = insert(chrom, site, strand, n).replace("TTAA", "TTCA")
            add(sample, tag, head + body[:70], A.linker_r2 + rc(body)[:60])
    plain = "".join(c for c in insert("chr1", 3000, "+", 70))
    truth["residual"].append(("S2", "TAG1", "chr1", 3000, "+"))
    add("S2", "TAG1", head + plain, "ACGT" * 12)
    # reads that must not yield sites: provirus, no LTR, wrong prefix, unknown barcode
    add("S1", "TAG1", A.provirus + insert("chr1", 4000, "+", 60), "ACGT" * 10)
    add("S1", "TAG1", insert("chr1", 4000, "+", 60), "ACGT" * 10)
    add("S1", "TAG1", A.ltr + A.elongation + "CCC" + insert("chr1", 4000, "+", 60) + A.linker_r1, "ACGT" * 10)
    pairs.append(("S1", "lost", "GATTACA" + head + insert("chr1", 4000, "+", 50) + A.linker_r1, "I" * 150, "ACGT" * 10, "I" * 40))
    reads = spark.createDataFrame(pairs, "sample string, read_id string, r1_seq string, r1_qual string, r2_seq string, r2_qual string")
    reads = reads.withColumn("r1_qual", F.expr("substring(r1_qual, 1, length(r1_seq))"))
    barcodes = spark.createDataFrame(list(TAGS.items()), "tag string, barcode string")
    table = gn.chunked(spark.createDataFrame(list(genome.items()), "chrom string, seq string")).cache()
    return reads, barcodes, table, truth


@pytest.fixture(scope="module")
def tables(run):
    reads, barcodes, table, _ = run
    return chains.reads_to_sites(reads, barcodes, lc.genome_index(table))


def test_sites_of_all_three_branches_are_found(run, tables):
    truth = run[3]
    rows = tables.qualitative.collect()
    got = {(r.sample, r.tag, r.chrom, r.start0, r.strand) for r in rows}
    assert got == {t[:5] for branch in truth.values() for t in branch}
    quant = {(r.sample, r.tag, r.chrom, r.start0, r.strand, r.n_reads, r.n_sizes) for r in tables.quantitative.collect()}
    assert quant == set(truth["r1"] + truth["pair"])


def test_stage_counts_shrink_along_the_chain(tables):
    stages = {}
    for r in tables.stages.collect():
        stages[r.stage] = stages.get(r.stage, 0) + r.reads
    assert stages["R1_raw"] == 15 and stages["R1_trimmed"] == 12
    assert (stages["R1_linker"], stages["R1_linkerR2"], stages["R1_collapsed"]) == (8, 3, 6)
    assert stages["R1_located"] == 6 and stages["pairs_located"] == 6 and stages["Qual_sites"] == 6
    assert stages["R1_provirus"] + stages["R1_noLTR"] + stages["R1_noElongation"] + stages["R1_noPrefix"] == 3
    assert stages["R1_raw"] >= stages["R1_noProvirus"] >= stages["R1_LTR"] >= stages["R1_elongation"] >= stages["R1_trimmed"]
    assert stages["R1_collapsed"] == stages["R1_located"] + stages["R1_unmapped"] and stages["R1_tooShort"] == 0 and stages["R1_multihit"] >= 0


def test_annotation_abundance_association_and_report(spark, run, tables):
    table = run[2]
    tx = spark.createDataFrame([("GA", "NM_1", "chr1", "+", 900, 2900, [900, 2000], [1100, 2900]),
                                ("GB", "NM_2", "chr1", "-", 7200, 9000, [7200], [9000]),
                                ("GC", "NM_3", "chr2", "+", 5050, 9000, [5050, 8900], [5100, 9000])],
                               "gene_symbol string, tx_id string, chrom string, strand string, tx_start bigint, tx_end bigint, "
                               "exon_starts array<bigint>, exon_ends array<bigint>")
    sizes = spark.createDataFrame([("chr1", 12_000), ("chr2", 12_000)], "chrom string, length bigint")
    obs = tables.quant_obs
    annotated = chains.full_annotation(tables.qualitative, obs, tx, sizes, iterations=3).cache()
    position = {(r.sample, r.tag, r.chrom, r.start0): (r.gene_symbol, r.position) for r in annotated.collect()}
    assert position[("S1", "TAG1", "chr1", 1000)] == ("GA", "Exonic")
    assert position[("S1", "TAG1", "chr2", 8000)] == ("GC", "Intronic")
    assert position[("S2", "TAG1", "chr2", 5000)] == ("GC", "Promoter")
    assert position[("S2", "TAG1", "chr1", 3000)] == (None, "Intergenic")

    signal = spark.createDataFrame([("H3K4me3", "chr1", 900, 1100, 5.0)], "track string, chrom string, start0 bigint, end0 bigint, value double")
    long = chains.feature_association(tables.qualitative, sizes, tx, table, {"CpG": tx.select("chrom", F.col("tx_start").alias("start0"),
                                      F.col("tx_end").alias("end0"))}, signal, {"1kb": 500}).cache()
    features = {(r.window, r.feature) for r in long.select("window", "feature").distinct().collect()}
    assert features == {(w, f) for w in ("1kb",) for f in ("GeneDens", "CpG", "GCcontent", "H3K4me3")} | {("0kb", "DistTSS")}
    assert chains.association_auc(long).filter("auc < 0 OR auc > 100").count() == 0
    assert long.filter("feature = 'GeneDens' AND cls = 'Experimental'").count() == 6

    motif = chains.motif_tables(tables.fragments, table, sizes).collect()
    assert {r.end for r in motif} == {"insertion", "ligation"} and max(r.pos for r in motif) == 40

    abundance = fr.site_abundance(obs, estimate=False)
    dim = spark.createDataFrame([("^R1_raw$", "R1_raw", "", "00"), ("^R1_noProvirus$", "R1_provirus Negative", "R1_raw", "01"),
                                 ("^R1_LTR$", "R1_LTR Positive", "R1_provirus Negative", "02")], "pattern string, description string, parents string, step string")
    report = chains.report_tables(annotated, abundance, tables.stages, dim, reads=rd.single_reads(run[0]))
    assert set(report) == {"summary", "position_share", "chrom_strand", "top_genes", "rank_abundance", "lorenz", "diversity", "funnel", "stage_outcomes",
                           "reported_stages", "read_statistics"}
    assert {r.pct_total for r in report["funnel"].filter("stage = 'R1_raw'").collect()} == {100.0} and report["read_statistics"].count() > 0
    assert {r.unique_sites for r in report["summary"].collect()} == {1, 2}
    assert report["top_genes"].count() == 0 and report["lorenz"].count() > 0
