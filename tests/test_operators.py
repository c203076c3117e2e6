"""Worked examples and brute-force comparisons."""

import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusflow.functions import sequence as sq, special as sp
from locusflow.operators import (align as al, diversity as dv, features as ft, fragments as fr, funnel as fn, genome as gn, intervals as iv,
                                 locate as lc, reads as rd, scaling as sc, sites as st)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# ---- fragments ---------------------------------------------------------------------------------


@pytest.mark.parametrize("given, expected", [
    ([(100, 50), (101, 5), (110, 8), (140, 30)], [(100, 55), (110, 8), (140, 30)]),
    ([(200, 3), (201, 40)], [(201, 43)]),
    ([(300, 4), (301, 6)], [(300, 6), (301, 4)]),
])
def test_size_correction(spark, given, expected):
    df = spark.createDataFrame([("s", a, b) for a, b in given], "is_id string, size int, n_reads bigint")
    assert rows(fr.correct_sizes(df).select("size", "n_reads")) == expected


def test_abundance_estimate_recovers_more_than_the_distinct_lengths(spark):
    rng = random.Random(5)
    truth = {"a": 10, "b": 150, **{f"c{i}": 3 for i in range(300)}}
    lengths, weights = list(range(50, 150)), [1 + (i % 10) for i in range(100)]
    data = [("S", "T", k, j) for k, n in truth.items() for j in set(rng.choices(lengths, weights, k=n))]
    df = spark.createDataFrame(data, "sample string, tag string, is_id string, size int").withColumn("n_reads", F.lit(20))
    theta = {r.is_id: r.theta for r in fr.estimate_abundance(df, iterations=30).collect()}
    seen = sum(1 for d in data if d[2] == "b")
    assert len(theta) == len(truth) and seen < theta["b"] < 260 and 8 < theta["a"] < 13


def plain_abundance(data, rounds=400):
    """The rounds one after the other, without extrapolation."""
    sites, lengths = sorted({d[0] for d in data}), sorted({d[1] for d in data})
    there = np.zeros((len(sites), len(lengths)), bool)
    for site, length in data:
        there[sites.index(site), lengths.index(length)] = True
    e, theta = there.astype(float), there.sum(1).astype(float)
    for _ in range(rounds):
        m = theta[:, None] * (e.sum(0) / e.sum())
        e = np.where(there, m / -np.expm1(-np.where(there, m, 1.0)), 0.0)
        theta = e.sum(1)
    return dict(zip(sites, theta, strict=True))


def test_abundance_estimate_of_several_runs_settles_where_the_plain_rounds_do(spark, tmp_path):
    rng = random.Random(9)
    runs = {}
    for run, n in (("S1", 60), ("S2", 25), (None, 10)):
        runs[run] = sorted({(f"s{i}", 30 + int(rng.gammavariate(3, 9))) for i in range(n) for _ in range(rng.choice([1, 2, 5, 40]))})
    data = [(run, "T", site, length, 20) for run, rows in runs.items() for site, length in rows]
    df = spark.createDataFrame(data, "sample string, tag string, is_id string, size int, n_reads bigint")
    before = spark.sparkContext.getCheckpointDir()
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    try:
        got = {(r.sample, r.is_id): r for r in fr.estimate_abundance(df, iterations=200, tol=1e-8).collect()}
        folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
        assert not [f for f in os.listdir(folder) if f.startswith("landing")]
        assert fr.estimate_abundance(df.limit(0)).count() == 0
    finally:
        if before:
            spark.sparkContext.setCheckpointDir(before)
    want = {(run, site): theta for run, rows in runs.items() for site, theta in plain_abundance(rows).items()}
    assert got.keys() == want.keys()
    assert all(r.converged and abs(r.theta - want[k]) <= 1e-5 * want[k] for k, r in got.items())


# ---- alignments --------------------------------------------------------------------------------


def test_junction_and_multihit_rules(spark):
    md = {0: ["50", "0T49", "2A47", "3A46", "12A37", "2^A48"], 16: ["48A1", "47A2", "46A3", "36A10"]}
    aln = spark.createDataFrame([(f, m) for f, ms in md.items() for m in ms], "flag int, md string")
    assert {r.md for r in al.exact_junction(aln).collect()} == {"50", "3A46", "12A37", "2^A48", "46A3", "36A10"}
    pairs = [(-6, None), (0, -6), (0, 0), (-6, -12), (-6, -14), (-6, -18), (-6, 0)]
    hits = spark.createDataFrame(pairs, "as_score int, xs_score int")
    assert {tuple(r) for r in al.unique_hit(hits).collect()} == {(-6, None), (0, -6), (-6, -18)}
    flagged = al.flag_multihit(hits)
    assert {tuple(r)[:2] for r in flagged.filter("multihit").collect()} == {(0, 0), (-6, -12), (-6, -14), (-6, 0)}


def test_pair_sites(spark):
    shape = "sample string, qname string, m1 struct<chrom:string,start0:bigint,end0:bigint,strand:string>, m2 struct<chrom:string,start0:bigint,end0:bigint,strand:string>, score double"
    df = spark.createDataFrame([("s", "p", ("chr1", 100, 150, "+"), ("chr1", 300, 350, "-"), 1.0),
                                ("s", "m", ("chr1", 300, 350, "-"), ("chr1", 100, 150, "+"), 1.0)], shape)
    got = {r.name: (r.start0, r.end0, r["size"]) for r in st.pair_insertion_point(df).collect()}
    assert got == {"p": (100, 101, 250), "m": (349, 350, 250)}
    assert {(r.start0, r.end0) for r in st.pair_fragment(df).collect()} == {(100, 350)}


# ---- intervals ---------------------------------------------------------------------------------


def _intervals(spark, seed, n, widest, chroms=3, limit=200_000):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        s = rng.randrange(limit)
        data.append((f"chr{rng.randrange(chroms)}", s, s + rng.randint(1, widest), f"n{i}", rng.choice("+-")))
    # a third of the rows share one interval
    data += [("chr0", 70_000, 70_050, f"hot{i}", "+") for i in range(n // 2)]
    return data, spark.createDataFrame(data, "chrom string, start0 bigint, end0 bigint, name string, strand string")


def test_overlaps_match_brute_force_and_partition_the_input(spark):
    a, adf = _intervals(spark, 1, 120, 30_000)
    b, bdf = _intervals(spark, 2, 90, 40_000)
    want = sorted((x[3], y[3]) for x in a for y in b if x[0] == y[0] and x[1] < y[2] and y[1] < x[2])
    inner = iv.overlap_join(adf, bdf, bin_width=4096).select("name", "b_name")
    assert rows(inner) == want
    anti = {r.name for r in iv.overlap_join(adf, bdf, "anti").collect()}
    assert anti.isdisjoint({p[0] for p in want}) and len(anti | {p[0] for p in want}) == len(a)
    left = iv.overlap_join(adf, bdf, "left", bin_width=4096).select("name", "b_name").collect()
    assert len(left) == len(want) + len(anti) and {r.name for r in left if r.b_name is None} == anti
    counts = {r.name: r.n_overlap for r in iv.overlap_count(adf, bdf).collect()}
    assert counts == {x[3]: sum(1 for p in want if p[0] == x[3]) for x in a}


def test_closest_matches_brute_force(spark):
    a, adf = _intervals(spark, 3, 80, 500, limit=400_000)
    b, bdf = _intervals(spark, 4, 60, 300, chroms=2, limit=400_000)

    def gap(x, y):
        return y[1] - x[2] + 1 if y[1] >= x[2] else x[1] - y[2] + 1 if y[2] <= x[1] else 0

    want = []
    for x in a:
        near = [(gap(x, y), y) for y in b if x[0] == y[0]]
        if not near:
            want.append((x[3], None, None))
        for d, y in near:
            if d == min(n[0] for n in near):
                negative = (y[4] == "+") == (y[1] >= x[2])
                want.append((x[3], y[3], -d if negative else d))
    got = iv.closest(adf, bdf).select("name", "b_name", "distance")
    key = lambda t: tuple(str(v) for v in t)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)
    first = iv.closest(adf, bdf, ties="first").collect()
    assert len(first) == len(a) and {(r.name, r.b_name) for r in first} <= {(w[0], w[1]) for w in want}


def test_cluster_asks_for_a_shared_base(spark):
    df = spark.createDataFrame([("chr1", "+", 10, 11), ("chr1", "+", 10, 11), ("chr1", "+", 11, 12), ("chr1", "-", 10, 11)],
                               "chrom string, strand string, start0 bigint, end0 bigint")
    assert iv.merge(df).count() == 3
    assert iv.merge(df, max_gap=0).count() == 2
    assert rows(iv.cluster(df).select("strand", "start0", "cluster")) == rows(iv.cluster(df, points=True).select("strand", "start0", "cluster"))


def test_clusters_across_tiles_do_not_depend_on_order(spark):
    data, df = _intervals(spark, 6, 150, 90_000, chroms=2, limit=2_000_000)
    got = {r.name: (r.chrom, r.strand, r.cluster) for r in iv.cluster(df, max_gap=100).collect()}
    want, reach, start = {}, {}, {}
    for x in sorted(data, key=lambda t: (t[0], t[4], t[1], t[2])):
        k = (x[0], x[4])
        if k not in reach or x[1] - reach[k] > 100:
            start[k], reach[k] = x[1], x[2]
        reach[k] = max(reach[k], x[2])
        want[x[3]] = (*k, start[k])
    assert got == want


def test_promoter_tiers_by_strand_and_border(spark):
    sizes = spark.createDataFrame([("chr1", 1_500)], "chrom string, length bigint")
    sites = spark.createDataFrame([("chr1", 1000, 1001, "p", "0", "+"), ("chr1", 1000, 1001, "m", "0", "-"), ("chr1", 30, 31, "b", "0", "+")],
                                  "chrom string, start0 bigint, end0 bigint, name string, score string, strand string")
    got = {(r.name, r.tier): (r.start0, r.end0) for r in iv.promoters(sites, sizes).collect()}
    assert got == {("p", "core"): (960, 1000), ("p", "proximal"): (800, 960), ("p", "distal"): (0, 800),
                   ("m", "core"): (1001, 1041), ("m", "proximal"): (1041, 1201), ("m", "distal"): (1201, 1500), ("b", "core"): (0, 30)}


def test_window_mean_of_overlapping_signal_over_empty_tiles(spark):
    rng = random.Random(8)
    signal = [("t", "chr1", s, s + rng.randint(1, 400), rng.random() * 50) for s in (rng.randrange(3_000_000) for _ in range(200))]
    windows = [("chr1", s, s + w) for s, w in ((0, 3_000_000), (10, 11), *((rng.randrange(2_500_000), rng.randint(1, 400_000)) for _ in range(30)))]
    got = {(r.start0, r.end0): r.value for r in iv.window_mean(
        spark.createDataFrame(windows, "chrom string, start0 bigint, end0 bigint"),
        spark.createDataFrame(signal, "track string, chrom string, start0 bigint, end0 bigint, value double")).collect()}
    for _, s, e in windows:
        parts = [(min(e, y) - max(s, x), v) for _, _, x, y, v in signal if x < e and s < y]
        if parts:
            assert got[s, e] == pytest.approx(sum(o * v for o, v in parts) / sum(o for o, _ in parts), rel=1e-9)
        else:
            assert got[s, e] is None


# ---- skew helpers ------------------------------------------------------------------------------


def test_lists_of_large_groups_come_in_bounded_parts_and_stay_whole(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("k"), (F.col("id") % 1500).alias("v"))
    parts = sc.value_lists(df, ["k"], "v", part_size=100).collect()
    for k in ("hot", "cold"):
        values = [(x.v, x.n_value) for p in parts if p.k == k for x in p.v_list]
        assert sum(n for _, n in values) == df.filter(F.col("k") == k).count() and len({v for v, _ in values}) == len(values)
    assert max(len(p.v_list) for p in parts) < 200 and sum(1 for p in parts if p.k == "hot") > 5


def test_sliced_auc_equals_plain_auc(spark):
    rng = random.Random(2)
    data = [("g" if i % 3 else "h", rng.gauss(0.3 * (i % 2), 1), "Experimental" if i % 2 else "random") for i in range(3000)]
    data += [("g", 1e9, "random"), ("g", 0.0, "random"), ("g", 0.0, "Experimental"), ("one", 1.0, "random")]
    df = spark.createDataFrame(data, "feature string, value double, cls string")
    plain = {r.feature: r.auc for r in ft.auc(df, ["feature"]).collect()}
    sliced = {r.feature: r.auc for r in ft.auc(df, ["feature"], slice_rows=50).collect()}
    assert set(plain) == {"g", "h"} and sliced == pytest.approx(plain)
    flipped = {r.feature: r.auc for r in ft.auc(df.withColumn("value", -F.col("value")), ["feature"]).collect()}
    assert plain["h"] + flipped["h"] == pytest.approx(100)


def test_auc_example(spark):
    df = spark.createDataFrame([("Experimental", 3.0), ("Experimental", 4.0), ("random", 1.0), ("random", 3.0)], "cls string, value double")
    assert ft.auc(df.withColumn("f", F.lit(1)), ["f"]).first().auc == 87.5


def test_random_sites_lie_on_the_genome_and_are_reproducible(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 50), ("c", 4000)], "chrom string, length bigint")
    sites = spark.range(500).select(F.lit("S").alias("sample"), F.lit("T").alias("tag"), F.lit("a").alias("chrom"),
                                    F.col("id").alias("start0"), (F.col("id") + 1).alias("end0"), F.lit("+").alias("strand"))
    one, two = rows(ft.random_sites(sites, sizes, 7)), rows(ft.random_sites(sites, sizes, 7))
    assert one == two and one != rows(ft.random_sites(sites, sizes, 8))
    limit = {"a": 1000, "b": 50, "c": 4000}
    assert 450 < len(one) <= 500 and all(0 <= r[3] < limit[r[2]] and r[4] == r[3] + 1 for r in one)
    assert sum(1 for r in one if r[2] == "c") > 300


# ---- diversity ---------------------------------------------------------------------------------


def test_diversity_example(spark):
    freq = dv.frequencies(spark.createDataFrame([(1.0,), (1.2,), (2.0,), (6.0,)], "x double"), "x")
    basic = dv.diversity_basic(freq).first()
    assert (basic.variety, round(basic.entropy, 6), round(basic.evenness, 6), round(basic.gini_simpson, 6)) == (4, 1.0889, 0.785475, 0.58)
    assert dv.gini(freq).first().gini == pytest.approx(0.40)
    assert dv.shannon_corrected(freq).first().miller_madow == pytest.approx(1.2389)
    harmonic = dv.shannon_harmonic(freq).first()
    assert (harmonic.zhang, harmonic.chao_wang_jost) == pytest.approx((1.258968, 1.371872), abs=1e-6)
    cov = dv.coverage(freq).first()
    assert (cov.turing, cov.chao, cov.zhang_huang) == pytest.approx((0.8, 0.82, 0.826984), abs=1e-6)
    rich = dv.richness(freq).first()
    assert (rich.chao1, rich.chao1_unbiased) == pytest.approx((5.8, 4.5))
    assert tuple(dv.uc50(freq).first()) == (1, 25.0)
    last = dv.rarefaction(freq, 3).orderBy(F.desc("m")).first()
    assert (last.m, round(last.expected_sites, 9)) == (10, 4)


def test_special_functions(spark):
    import math
    df = spark.createDataFrame([(x,) for x in (0.5, 1.0, 1.5, 2.0, 9.99, 10.0, 123.25, 1e7)], "x double")
    for r in df.select("x", sp.digamma("x").alias("d"), sp.lgamma("x").alias("l")).collect():
        h = 1e-4 * max(r.x, 1)
        assert r.l == pytest.approx(math.lgamma(r.x), rel=1e-12, abs=1e-12)
        assert r.d == pytest.approx((math.lgamma(r.x + h) - math.lgamma(r.x - h)) / (2 * h), rel=1e-5, abs=1e-5)
    assert df.filter("x = 1").select(sp.digamma("x")).first()[0] == pytest.approx(-0.5772156649015329, abs=1e-13)


# ---- reads -------------------------------------------------------------------------------------


def _brute_match(seq, adapter, end, low, rate):
    best, m = None, len(adapter)
    for p in range(-m + 1 if end == "5p" else 0, len(seq)):
        a, b = max(p, 0), min(p + m, len(seq))
        o = b - a
        if o < low or (end == "5p" and p + m > len(seq)) or (end == "3p" and p < 0):
            continue
        e = sum(seq[i] != adapter[i - p] for i in range(a, b))
        if e <= int(rate * o + 1e-9):
            key = (-(o - e), e, a)
            if best is None or key < best[0]:
                best = (key, (a, b, e))
    return best and best[1]


@pytest.mark.parametrize("end, low, rate", [("5p", 12, 0.1), ("3p", 5, 0.2), ("5p", 6, 0.2), ("3p", 12, 0.3)])
def test_adapter_match_equals_brute_force(spark, end, low, rate):
    rng, adapter = random.Random(9), "ACGTTGCAACGG"
    seqs = ["", "A", adapter, adapter[:7], adapter[5:], "N" * 30]
    for _ in range(300):
        core = "".join(c if rng.random() > 0.12 else rng.choice("ACGT") for c in adapter)
        cut = core[rng.randrange(8):] if rng.random() < 0.4 else core[: rng.randint(4, 12)] if rng.random() < 0.5 else core
        noise = lambda: "".join(rng.choice("ACGT") for _ in range(rng.randrange(40)))
        seqs.append(rng.choice([noise() + cut + noise(), cut + noise(), noise() + cut]))
    df = spark.createDataFrame(list(enumerate(seqs)), "i int, s string")
    got = df.select("i", sq.adapter_match("s", adapter, end, low, rate).alias("m")).collect()
    for r in got:
        assert (tuple(r.m) if r.m else None) == _brute_match(seqs[r.i], adapter, end, low, rate), seqs[r.i]


def test_cut_reverse_complement_and_quality(spark):
    df = spark.createDataFrame([("ACGTTAAGG", "IIIIIIIII", 1), ("ACGG", "II##", 1)], "seq string, qual string, n_reads bigint")
    assert rows(rd.cut_reads(df).select("seq", "qual")) == [("ACGG", "II##"), ("ACGT", "IIII")]
    assert rows(df.select(sq.revcomp("seq"))) == [("CCGT",), ("CCTTAACGT",)]
    assert rows(df.select(sq.quality_keep("qual"))) == [(2,), (9,)]


def test_demultiplexing_drops_ambiguous_starts(spark):
    barcodes = spark.createDataFrame([("T1", "AAAA"), ("T2", "AATT"), ("T3", "GGGGG")], "tag string, barcode string")
    starts = {"AAAACC": "T1", "CAAACC": "T1", "AAATCC": "unmatched", "AATTGG": "T2", "GGGGGT": "T3", "GGCGGT": "T3", "CCCCCC": "unmatched", "NAAAC": "T1"}
    pairs = spark.createDataFrame([("S", s) for s in starts], "sample string, r1_seq string")
    assert {r.r1_seq: r.tag for r in rd.demultiplex(pairs, barcodes).collect()} == starts


# ---- one exchange per scan ---------------------------------------------------------------------


def _scans(df, folder):
    """How often the plan that ran reads each table of a folder, and whether an exchange was used again."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0] if "Subquery" not in plan else plan
    return {x: sum(1 for line in final.split("\n") if "FileScan" in line and f"{folder}/{x}" in line) for x in "abg"}, "ReusedExchange" in plan


def test_scans_read_their_input_once(spark, tmp_path):
    for seed, (name, n, widest) in enumerate((("a", 200, 900), ("b", 150, 5_000))):
        _intervals(spark, seed + 3, n, widest)[1].withColumnRenamed("name", f"{name}_only").write.parquet(str(tmp_path / name))
    contigs = spark.createDataFrame([(f"chr{i}", "ACGTN" * 40_000) for i in range(3)], "chrom string, seq string")
    gn.chunked(contigs, 128).write.parquet(str(tmp_path / "g"))
    a, b, genome = (spark.read.parquet(str(tmp_path / name)) for name in "abg")
    # the rows of a are read for their distinct spans and to be returned, the sequence for its counts and its pieces
    for df, want in ((iv.span_profile(iv._spans(a), b), {"a": 1, "b": 1, "g": 0}), (iv.overlap_count(a, b), {"a": 2, "b": 1, "g": 0}),
                     (iv.overlap_join(a, b, "anti"), {"a": 2, "b": 1, "g": 0}), (iv.islands(b, 0), {"a": 0, "b": 1, "g": 0}),
                     (gn.base_composition(a, genome, 128), {"a": 2, "b": 0, "g": 2})):
        assert _scans(df, tmp_path) == (want, True)
    signal = b.selectExpr("'t' AS track", "chrom", "start0", "end0", "1.5D AS value", "b_only")
    assert _scans(iv.window_mean(a, signal), tmp_path)[1]


# ---- genome and location -----------------------------------------------------------------------


def test_composition_and_sequence_over_chunk_borders(spark):
    rng = random.Random(4)
    genome = {"c1": "".join(rng.choice("ACGTNacgtR") for _ in range(1000)), "c2": "ACGT"}
    table = gn.chunked(spark.createDataFrame(list(genome.items()), "chrom string, seq string"), 64)
    spans = [("c2", 0, 4, "-")] + [("c1", s, min(s + rng.randint(1, 400), 1000), "-") for s in (rng.randrange(1000) for _ in range(40))] + [("c1", 0, 1000, "+"), ("c1", 64, 128, "+")]
    windows = spark.createDataFrame(spans, "chrom string, start0 bigint, end0 bigint, strand string")
    for r in gn.base_composition(windows, table, 64).collect():
        s = genome[r.chrom][r.start0:r.end0].upper()
        assert (r.n_A, r.n_C, r.n_G, r.n_T, r.n_N, r.length) == (*[s.count(b) for b in "ACGTN"], len(s)) and r.n_other == s.count("R")
        assert r.pct_gc == pytest.approx((s.count("G") + s.count("C")) / len(s))
    for r in gn.fetch_sequence(windows, table, 64).collect():
        assert r.seq == genome[r.chrom][r.start0:r.end0]
    flipped = {r.start0: r.seq for r in gn.fetch_sequence(windows.filter("chrom = 'c2'"), table, 64, stranded=True).collect()}
    assert flipped == {0: "ACGT"}


def _brute_hits(genome, read):
    comp = str.maketrans("ACGTN", "TGCAN")
    out = []
    for strand, q in (("+", read), ("-", read.translate(comp)[::-1])):
        for c, g in genome.items():
            for p in range(len(g) - len(q) + 1):
                wrong = sum(x != y for x, y in zip(q, g[p:p + len(q)]))
                if -6 * wrong >= -0.16 * len(q):
                    out.append((strand, c, p, -6 * wrong))
    return sorted(out)


def stored(spark, table, folder, monkeypatch):
    """A stored index in which repeated seeds lie in several parts."""
    monkeypatch.setattr(lc, "HOT", 7)
    return lc.store_index(table, str(folder / "index"), buckets=5, chunk=128)


@pytest.mark.parametrize("kept", [False, True])
def test_location_finds_every_accepted_placement(spark, tmp_path, monkeypatch, kept):
    rng = random.Random(11)
    unit = "".join(rng.choice("ACGT") for _ in range(150))
    near = unit[:70] + ("A" if unit[70] != "A" else "C") + unit[71:]
    genome = {"g1": "".join(rng.choice("ACGT") for _ in range(700)) + unit + "A" * 60, "g2": near + "".join(rng.choice("ACGT") for _ in range(500)) + unit}
    comp = str.maketrans("ACGT", "TGCA")
    reads = {}
    for i in range(40):
        c = rng.choice(list(genome))
        n = rng.choice((20, 25, 37, 38, 39, 60, 75, 76, 100, 113, 120))
        p = rng.randrange(len(genome[c]) - n)
        s = list(genome[c][p:p + n])
        for j in rng.sample(range(n), rng.choice((0, 0, 1, 2, 3))):
            s[j] = rng.choice("ACGT")
        s = "".join(s)
        reads[f"r{i}"] = s if rng.random() < 0.5 else s.translate(comp)[::-1]
    reads["poly"], reads["rep"] = "A" * 40, unit[40:140]
    reads |= {f"short{n}": genome["g1"][200 + n:200 + 2 * n] for n in (15, 16, 17, 18)}
    reads |= {"long": genome["g1"][100:500], "long_off": "A" + genome["g1"][301:641].translate(comp)[::-1]}
    table = gn.chunked(spark.createDataFrame(list(genome.items()), "chrom string, seq string"), 128)
    index = stored(spark, table, tmp_path, monkeypatch) if kept else lc.genome_index(table, 128)
    df = spark.createDataFrame(list(reads.items()), "qname string, seq string").withColumn("n_reads", F.lit(2))
    found = {}
    for r in lc.all_hits(df, index).collect():
        found.setdefault(r.qname, []).append((r.strand, r.chrom, r.start0, r.as_score))
    want = {n: _brute_hits(genome, s) for n, s in reads.items()}
    assert {n: sorted(h) for n, h in found.items()} == {n: h for n, h in want.items() if h}
    best = {r.qname: r for r in lc.locate_reads(df, index).collect()}
    for name, hits in want.items():
        if hits:
            scores = sorted((h[3] for h in hits), reverse=True)
            assert (best[name].as_score, best[name].xs_score) == (scores[0], scores[1] if len(scores) > 1 else None)
            assert best[name].mapq == 42 or len(scores) > 1
    assert best["rep"].mapq == 0
    missing = {r.qname for r in lc.unlocated(df, spark.createDataFrame([(n,) for n in best], "qname string")).collect()}
    assert missing == {n for n, h in want.items() if not h}


def test_runs_without_a_tag_are_runs(spark):
    rng = random.Random(3)
    genome = "".join(rng.choice("ACGT") for _ in range(500))
    table = gn.chunked(spark.createDataFrame([("g", genome)], "chrom string, seq string"), 128)
    df = spark.createDataFrame([("s", None, "r", genome[50:110], 2), (None, "t", "r", genome[90:150], 1)],
                               "sample string, tag string, qname string, seq string, n_reads long")
    got = lc.locate_reads(df, lc.genome_index(table, 128))
    assert {(r.sample, r.tag, r.pos1) for r in got.collect()} == {("s", None, 51), (None, "t", 91)}
    assert lc.unlocated(df, got).isEmpty()


def test_pairs_are_located_within_the_fragment_range(spark):
    rng = random.Random(21)
    genome = {"g1": "".join(rng.choice("ACGT") for _ in range(6000))}
    comp = str.maketrans("ACGT", "TGCA")
    rc = lambda s: s.translate(comp)[::-1]
    g = genome["g1"]
    pairs = {"plus": (g[100:150] + "TTTTT", rc(g[350:400]) + "GGGGG"), "minus": (rc(g[2350:2400]) + "CCCCC", g[2100:2150] + "AAAAA"),
             "far": (g[100:150] + "TTTTT", rc(g[1500:1550]) + "TTTTT"), "same_strand": (g[100:150] + "TTTTT", g[350:400] + "TTTTT")}
    df = spark.createDataFrame([(k, a, b) for k, (a, b) in pairs.items()], "read_id string, r1_seq string, r2_seq string")
    df = df.withColumns({f"{m}_qual": F.repeat(F.lit("I"), F.length(f"{m}_seq")) for m in ("r1", "r2")})
    table = gn.chunked(spark.createDataFrame(list(genome.items()), "chrom string, seq string"), 512)
    got = sorted((r.qname, r.flag, r.pos1) for r in lc.locate_pairs(df, lc.genome_index(table, 512)).collect())
    assert got == [("minus", 83, 2351), ("minus", 163, 2101), ("plus", 99, 101), ("plus", 147, 351)]


def test_stored_index_is_opened_again_and_never_shuffled(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    genome = "".join(rng.choice("ACGT") for _ in range(3000)) + "A" * 400
    table = gn.chunked(spark.createDataFrame([("g", genome)], "chrom string, seq string"), 128)
    stored(spark, table, tmp_path, monkeypatch)
    index = lc.open_index(spark, str(tmp_path / "index"))
    assert index.hot.filter("parts > 1").count() == 2 and index.seeds.count() == 2 * 3400 - 18 - 14
    reads = spark.createDataFrame([(f"r{i}", genome[i:i + 60], 1) for i in range(0, 2900, 50)], "qname string, seq string, n_reads long")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        placed = lc.locate_reads(reads, index)
        plan = placed._jdf.queryExecution().executedPlan().toString().split("\n")
        assert sorted((r.qname, r.pos1) for r in placed.collect()) == sorted((f"r{i}", i + 1) for i in range(0, 2900, 50))
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    depth = [re.match(r"[ :]*([+:]- )?", x).end() for x in plan]
    scans = [i for i, x in enumerate(plan) if "FileScan" in x and (".seeds_" in x or ".chunks_" in x)]
    assert len(scans) >= 2 and not any("regexp_extract_all" in x for x in plan)
    for i in scans:
        for j in range(i, -1, -1):  # up to the join that reads the table
            if depth[j] < depth[i] and "Join" in plan[j]:
                break
            assert not (depth[j] < min(depth[j + 1:i + 1], default=99) and "Exchange" in plan[j]), plan[j]


def _brute_pair(genome, one, two, least, most):
    """Best concordant placement of two mates by all of their placements."""
    found = []
    for a in _brute_hits(genome, one):
        for b in _brute_hits(genome, two):
            ends = (a[2] + len(one), b[2] + len(two))
            if a[1] == b[1] and a[0] != b[0] and least <= max(ends) - min(a[2], b[2]) <= most:
                found.append((-(a[3] + b[3]), a[1], a[2], b[2], a[0]))
    return min(found, default=None)


def test_pairs_in_repeats_like_all_pairs_of_placements(spark, monkeypatch):
    monkeypatch.setattr(lc, "PAIRS_AT_ONCE", 50)
    rng = random.Random(31)
    comp = str.maketrans("ACGT", "TGCA")
    unit = "".join(rng.choice("ACGT") for _ in range(60))
    genome = {"g1": unit * 25 + "".join(rng.choice("ACGT") for _ in range(400)), "g2": "".join(rng.choice("ACGT") for _ in range(300)) + unit * 9}
    pairs = []
    for i in range(30):
        c = rng.choice(list(genome))
        p = rng.randrange(len(genome[c]) - 200)
        one, two = genome[c][p:p + 45], genome[c][p + 90:p + 140].translate(comp)[::-1]
        pairs.append((f"p{i}", *((one, two) if i % 2 else (two, one))))
    pairs += [("same", unit[:40], unit[20:60]), ("far", genome["g1"][:40], genome["g2"][:40].translate(comp)[::-1]), ("none", "ACGT" * 10, "TTGA" * 10)]
    df = spark.createDataFrame(pairs, "read_id string, r1_seq string, r2_seq string").withColumns({f"{m}_qual": F.lit(None).cast("string") for m in ("r1", "r2")})
    table = gn.chunked(spark.createDataFrame(list(genome.items()), "chrom string, seq string"), 256)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # placements of a read come in many batches
    try:
        got = lc.locate_pairs(df, lc.genome_index(table, 256), 30, 180, trim3=0).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {n: _brute_pair(genome, a, b, 30, 180) for n, a, b in pairs}
    place = {(r.qname, r.flag >= 128): (r.chrom, r.pos1 - 1) for r in got}
    assert {k[0] for k in place} == {n for n, w in want.items() if w}
    for n, w in want.items():
        if w:
            assert (place[n, False], place[n, True]) == ((w[1], w[2]), (w[1], w[3]))


def test_intron_of_an_unnamed_gene_is_intronic(spark):
    from locusflow.operators import annotate

    site = "chrom string, start0 bigint, end0 bigint, score double, strand string, n_reads bigint"
    regions = spark.createDataFrame([("c", 5, 6, 1.0, "+", 3, "Intragenic", None)], site + ", region string, gene_symbol string")
    exons = spark.createDataFrame([("c", 5, 6, 1.0, "+", 3, None, None)], site + ", b_name string, b_gene_symbol string")
    row = annotate.classify_position(regions, exons).first()
    assert (row.n_exons, row.position) == (0, "Intronic")


def test_signal_that_is_not_finite_covers_nothing(spark):
    signal = spark.createDataFrame([("t", "c", 0, 10, 1.0), ("t", "c", 10, 20, float("nan")), ("t", "c", 20, 30, float("inf")),
                                    ("t", "c", 30, 40, None), ("t", "c", 990, 1000, 3.0)],
                                   "track string, chrom string, start0 bigint, end0 bigint, value double")
    windows = spark.createDataFrame([("c", 0, 40), ("c", 15, 35), ("c", 980, 1000)], "chrom string, start0 bigint, end0 bigint")
    got = {r.start0: r.value for r in iv.window_mean(windows, signal).collect()}
    assert got == {0: 1.0, 15: None, 980: 3.0}


def test_unseen_entropy_keeps_its_digits(spark):
    import math

    cases = {"a": (100_000, 1, 20), "b": (100_000, 1, 400), "c": (500, 30, 7), "d": (50, 3, 0)}
    rows = [(t, k, f) for t, (n, f1, f2) in cases.items() for k, f in ((1, f1), (2, f2), (n - f1 - 2 * f2, 1)) if f]
    got = {r.t: r.unseen for r in dv._unseen_entropy(spark.createDataFrame(rows, "tag string, k bigint, f bigint")
                                                     ).withColumnRenamed("tag", "t").collect()}
    for t, (n, f1, f2) in cases.items():
        a = 2 * f2 / ((n - 1) * f1 + 2 * f2) if f2 else 2 / ((n - 1) * (f1 - 1) + 2)
        want = f1 / n * math.fsum((1 - a) ** (r - n + 1) / r for r in range(n, n + int(50 / a)))
        assert math.isclose(got[t], want, rel_tol=1e-9)


def test_slices_follow_the_rows_whatever_the_groups(spark):
    from locusflow.operators.scaling import value_slices

    df = spark.range(60_000).selectExpr("CASE WHEN id < 20000 THEN 0 ELSE id % 50 + 1 END AS g", "CAST(id AS double) AS score")
    cut = value_slices(df, ["g"], "score", 1000)
    assert cut.groupBy("_tile").count().agg(F.max("count")).first()[0] <= 3000
    per = cut.groupBy("g", "_tile").agg(F.min("score").alias("lo"), F.max("score").alias("hi")).orderBy("g", "_tile").collect()
    assert all(x.hi < y.lo for x, y in zip(per, per[1:]) if x.g == y.g) and len({r._tile for r in per if r.g == 0}) >= 10


def test_an_adapter_is_searched_once_for_each_rule(spark):
    from locusflow.operators import reads as rd

    pairs = spark.createDataFrame([("r", "ACGT", "IIII", "ACGT", "IIII")], "read_id string, r1_seq string, r1_qual string, r2_seq string, r2_qual string")
    plan = rd.require_elongation(rd.require_ltr(pairs))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 2 and plan.count("find(") == 2


def test_scans_fold_no_frame_anew_for_every_row(spark):
    from locusflow.operators.scaling import tiled_scan
    rows = spark.range(200).selectExpr("'a' AS k", "id AS pos", "id div 64 AS tile", "(id * 37) % 101 AS v")
    scanned = tiled_scan(rows, ["k"], "tile", ["pos"], {"least": ("min", F.col("v"), "after"), "most": ("max", F.col("v"), "before")})
    values = [i * 37 % 101 for i in range(200)]
    got = {r.pos: (r.least, r.most) for r in scanned.collect()}
    assert got == {i: (min(values[i + 1:], default=None), max(values[:i], default=None)) for i in range(200)}
    # a frame up to unbounded following costs the square of its rows
    assert "unboundedfollowing" not in scanned._jdf.queryExecution().toString().lower()


def test_regions_found_by_position_equal_those_found_by_site(spark):
    from locusflow.operators import annotate as an
    site = "sample string, chrom string, start0 bigint, end0 bigint, score double, strand string, n_reads bigint"
    at = [("A", "chr1", 1000), ("B", "chr1", 1000), ("B", "chr1", 1000), ("A", "chr1", 9000), ("A", "chr2", 1000), ("A", None, 1000), (None, "chr1", 4990)]
    at += [("A", "chr1", 955), ("N", "chr1", 955)]  # in exons; site N has no score
    sites = spark.createDataFrame([(s, c, p, p + 1, None if s == "N" else 3.0, "+", 5) for s, c, p in at], site)
    model = [("g1", "t1", 900, 5000), ("g1", "t2", 950, 1100), ("g2", "t2", 950, 1100), ("g3", "t3", 1020, 1200), (None, "t4", 990, 1010), ("g1", "t5", 5050, 6000)]
    tx = spark.createDataFrame([(g, t, "chr1", "+", a, b, 1, [a], [a + 60]) for g, t, a, b in model],
                               "gene_symbol string, tx_id string, chrom string, strand string, tx_start bigint, tx_end bigint, exon_count int, "
                               "exon_starts array<bigint>, exon_ends array<bigint>")
    sets = an.annotation_sets(tx, spark.createDataFrame([("chr1", 100_000)], "chrom string, length bigint"))
    by_site = an.add_gene_symbol(an.annotate_overlaps(sites, sets), tx)
    plain = an.classify_position(an.classify_regions(by_site), an.exon_hits(an.intragenic(by_site), tx))
    hits = an.annotate_overlaps(an.positions(sites), an.add_gene_symbol(sets, tx))
    regions = an.classify_regions(hits, an.SOURCES)
    found = an.at_sites(sites, an.classify_position(regions, an.exon_hits(an.intragenic(hits), tx)), ("n_transcripts",))
    columns = [*plain.columns]
    assert sorted(map(str, found.select(*columns).collect())) == sorted(map(str, plain.collect()))
    lists = ["sample", "chrom", "start0", "gene_symbol", "part", "parts", "b_name_list.b_name"]
    one, two = an.at_sites(sites, an.transcript_lists(hits, 1)), an.transcript_lists(by_site, 1)
    assert sorted(map(str, one.selectExpr(*lists).collect())) == sorted(map(str, two.selectExpr(*lists).collect()))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(kept, ("false", "-1"), strict=True):
            spark.conf.set(k, v)
        for df in (an.classify_regions(hits, an.SOURCES), an.transcript_lists(hits)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan[:plan.index("SortMergeJoin")]  # hits stay where they were found
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_annotation_by_lists_equals_annotation_by_pairs_without_shuffling_hits(spark):
    from locusflow.operators import annotate as an
    rng = random.Random(12)
    site = "sample string, chrom string, start0 bigint, end0 bigint, score double, strand string, n_reads bigint"
    at = [("c1", p) for p in rng.sample(range(4096), 2500)] + [(rng.choice(["c1", "c2", None]), p) for p in rng.choices(range(20_000), k=300)] + [("c1", None)] * 3
    rows_in = [(rng.choice(["A", "B"]), c, p, None if p is None else p + 1, rng.choice([1.0, 2.0, None]), rng.choice("+-"), 2) for c, p in at]
    sites = spark.createDataFrame(rows_in + rows_in[::7], site)
    starts = [rng.randrange(0, 20_000) for _ in range(40)]
    model = [(rng.choice(["g1", "g2", "g3", None]), rng.choice([f"t{i}", "t0", None]), rng.choice(["c1", "c1", "c2", None]), rng.choice("+-"), a, a + rng.choice([0, 30, 900, 9000]))
             for i, a in enumerate(starts)]
    tx = spark.createDataFrame([(g, t, c, s, a, b, 2, [a, a + 20], [a + 10, a + 400]) for g, t, c, s, a, b in model],
                               "gene_symbol string, tx_id string, chrom string, strand string, tx_start bigint, tx_end bigint, exon_count int, exon_starts array<bigint>, exon_ends array<bigint>")
    sets = an.add_gene_symbol(an.annotation_sets(tx, spark.createDataFrame([("c1", 20_000), ("c2", 20_000)], "chrom string, length bigint")), tx)
    abundance = sites.select("sample", st.site_id().alias("is_id")).distinct().withColumn("theta", F.length("is_id"))
    pairs = an.annotate_overlaps(an.positions(sites), sets)
    lists = lambda found, *more: an.annotate_overlaps(an.positions(sites, True, *more), sets, found=found)
    plain = an.at_sites(sites, an.classify_position(an.classify_regions(pairs, an.SOURCES), an.exon_hits(an.intragenic(pairs), tx)), ("n_transcripts",))
    inside = an.intragenic(lists("counts", abundance))
    found = an.at_sites(sites, an.classify_position(an.classify_regions(an.exon_hits(inside, tx), an.SOURCES)), ("n_transcripts",))
    shown = lambda df, columns: sorted(map(str, df.select(*columns).collect()))
    with_theta = an.join_abundance(plain, abundance)
    assert shown(found, [*plain.columns, "theta"]) == shown(with_theta, [*plain.columns, "theta"])
    assert shown(an.at_sites(sites, an.classify_regions(lists("counts"), an.SOURCES), ("n_transcripts",)), plain.columns[:-2]) == shown(plain, plain.columns[:-2])
    for size in (1000, 1):
        one, two = an.at_sites(sites, an.transcript_lists(lists("names"), size)), an.at_sites(sites, an.transcript_lists(pairs, size))
        assert shown(one, two.columns) == shown(two, two.columns) and any(r.parts > 1 for r in one.collect()) == (size == 1)
        one = an.at_sites(sites, an.exon_lists(an.exon_hits(an.intragenic(lists("counts")), tx, "names"), size))
        two = an.at_sites(sites, an.exon_lists(an.exon_hits(an.intragenic(pairs), tx), size))
        assert shown(one, two.columns) == shown(two, two.columns)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan[:plan.index("MapInArrow")] and "Repartition" not in plan[:plan.index("MapInArrow")]  # rows by gene go nowhere


def test_collapsed_and_corrected_tables_keep_the_partitions_of_the_session(spark):
    from locusflow.operators import fragments as fr
    rows = [("A", "chr1", i % 9, i % 9 + 1, float(i % 5), "+", 20 + i % 3, 1) for i in range(60)]
    obs = spark.createDataFrame(rows, "sample string, chrom string, start0 bigint, end0 bigint, score double, strand string, size int, n_reads bigint")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by_size = st.collapse_by_size(obs)
    for df in (by_size, st.collapse_sites(by_size), st.qual_is(st.collapse_sites(by_size)), fr.correct_sizes(fr.fragment_counts(obs))):
        assert df.rdd.getNumPartitions() == parts  # merging them by packed size makes tasks of any memory


# ---- overlaps counted per label ----------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left"])
def test_overlaps_of_points_are_counted_per_label_without_pairs(spark, how):
    rng = random.Random(3)
    chroms = ["c1", "c2", None]
    sites = [("S", rng.choice(chroms), p, p + 1, rng.choice("+-")) for p in rng.choices(range(140_000), k=300)] + [("S", "c3", 5, 6, "+"), ("S", "c1", None, None, "+")] * 2
    features = [(rng.choice(chroms), s, s + rng.choice([0, 1, 700, 80_000]), rng.choice(["x", "y", None])) for s in rng.choices(range(140_000), k=200)]
    a = spark.createDataFrame(sites, "sample string, chrom string, start0 bigint, end0 bigint, strand string")
    b = spark.createDataFrame(features, "chrom string, start0 bigint, end0 bigint, source string")
    pairs = iv.overlap_join(a.withColumn("i", F.monotonically_increasing_id()), b, how, points=True)
    counted = iv.overlap_join(a, b, how, points=True, per=["source"])
    expected = pairs.groupBy("i", *a.columns, "b_source").agg(F.count("b_start0").alias("n_pairs")).drop("i")
    plain = lambda df: sorted(map(repr, map(tuple, df.select(*a.columns, "b_source", "n_pairs").collect())))
    assert plain(counted) == plain(expected) and any(r.n_pairs > 1 for r in counted.collect())
    assert "b_start0" not in counted._jdf.queryExecution().executedPlan().toString()  # no pair is formed


def test_contingency_and_sources_come_from_counted_overlaps(spark):
    from locusflow.operators import annotate as an

    sites = spark.createDataFrame([("S", "c", 10, 11, 1.0, "+", 1), ("S", "c", 20, 21, 1.0, "-", 1), ("S", "c", 900, 901, 1.0, "-", 1)],
                                  "sample string, chrom string, start0 bigint, end0 bigint, score double, strand string, n_reads bigint")
    genes = spark.createDataFrame([("c", 0, 15, "g", "+")] * 3 + [("c", 5, 30, "h", "-")], "chrom string, start0 bigint, end0 bigint, name string, strand string")
    table = lambda df: rows(df.select("strand", "b_strand", "observed", F.round("residual", 6)))
    plain = table(fn.contingency(iv.overlap_join(sites, genes, points=True), "strand", "b_strand"))
    assert plain == table(fn.contingency(iv.overlap_join(sites, genes, points=True, per=["strand"]), "strand", "b_strand", "n_pairs"))
    hits = an.annotate_overlaps(sites, iv.label_sets(gene_body=genes), per=["source"])
    assert rows(hits.select("start0", "b_source", "n_pairs")) == [(10, "gene_body", 4), (20, "gene_body", 1), (900, None, 0)]
    assert rows(an.intragenic(hits).select("start0")) == [(10,), (20,)]


# ---- equal texts are located once --------------------------------------------------------------


def test_equal_pairs_are_located_once_and_repeated_names_stand_for_themselves(spark, monkeypatch):
    rng = random.Random(8)
    genome = "".join(rng.choice("ACGT") for _ in range(1500))
    index = lc.genome_index(gn.chunked(spark.createDataFrame([("g", genome)], "chrom string, seq string"), 256), 256)
    back = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    pair = lambda name, p, run="S": (run, name, genome[p:p + 50], "I" * 50, back(genome[p + 150:p + 200]), name[0] * 50)
    data = [pair("a", 100), pair("b", 100), pair("c", 100, "S2"), pair("d", 700), pair("e", 900), pair("e", 1100)]
    df = spark.createDataFrame(data, "sample string, read_id string, r1_seq string, r1_qual string, r2_seq string, r2_qual string")
    asked, every = [], lc.all_hits
    monkeypatch.setattr(lc, "all_hits", lambda reads, *more, **named: (asked.append(reads.count()), every(reads, *more, **named))[1])
    got = sorted((r.sample, r.qname, r.pos1, r.flag, r.qual[0]) for r in lc.locate_pairs(df, index, trim3=0).collect() if r.qname != "e")
    assert asked == [4, 4]  # one of a, b and c, then d and both rows of e
    assert got == sorted((s, n, p + 1 + 150 * (f == 147), f, "I" if f == 99 else n) for s, n, p in (("S", "a", 100), ("S", "b", 100), ("S2", "c", 100), ("S", "d", 700)) for f in (99, 147))


def test_often_repeated_seeds_are_counted_on_the_texts(spark, monkeypatch):
    monkeypatch.setattr(lc, "HOT", 50)
    table = gn.chunked(spark.createDataFrame([("a", "ACGTTGCA" * 60), ("b", "".join(random.Random(4).choices("ACGT", k=400)))], "chrom string, seq string"), 64)
    every = lc.kmer_seeds(table)
    want = {r.kmer: r.n for r in every.groupBy("kmer").agg(F.count("pos").alias("n")).collect() if r.n > 50}
    often = lc._often(table)
    got = {r.kmer: r.n for r in often.groupBy("kmer").agg(F.count("kmer").alias("n")).collect() if r.n > 50}
    assert len(want) == 16 and got == want
    assert often.columns == ["kmer"] and "rest" not in often._jdf.queryExecution().optimizedPlan().toString()  # no seed is written out for it


def test_best_placements_are_the_first_of_all_in_order(spark):
    genome = "".join(random.Random(2).choices("ACGT", k=200))
    table = gn.chunked(spark.createDataFrame([(c, genome) for c in "pqrs"], "chrom string, seq string"), 128)
    index = lc.genome_index(table, 128)
    reads = spark.createDataFrame([("x", genome[20:60], 1), ("y", genome[20:60], 1), ("z", genome[90:150], 1)], "qname string, seq string, n_reads long")
    place = lambda df: rows(df.select("qname", "chrom", "start0", "as_score", "md"))
    every, best = place(lc.all_hits(reads, index)), place(lc.all_hits(reads, index, best=2))
    assert len(every) == 12 and best == [r for r in every if r[1] in "pq"]


def test_seeds_of_genomes_beyond_ascii_and_of_short_ends(spark):
    texts = {"a": "ACGTTGCAACGTACGTTTGCAAGC" * 3, "b": "ACGÜTGCAACGTACGTTTGCAAGCATTACG", "c": "ACGTACGTACGTACGTA", "d": "ACGT"}
    table = gn.chunked(spark.createDataFrame([*texts.items()], "chrom string, seq string"), 64)
    got = sorted((r.chrom, r.pos, r.rest) for r in lc.kmer_seeds(table).collect())
    want = sorted((c, i, t[i + k:i + w]) for c, t in texts.items() for k, w in ((19, 37), (15, 18)) for i in range(len(t) - k + 1))
    assert got == want
    asked = lc._segments(lc._oriented(spark.createDataFrame([(texts["b"][:20],)], "_s string")), lc.K).filter("strand = '+'").first()
    assert [r.pos for r in lc.kmer_seeds(table).filter(F.col("kmer") == asked.kmer).collect()] == [0]


# ---- searches in Arrow batches -----------------------------------------------------------------


def test_adapter_search_by_brute_force(spark):
    rng = random.Random(4)
    adapter = "AGTCCCTTAAGCGGAGCCCT"
    texts = [None, "", "N" * 9]
    for _ in range(250):
        body, end = ("".join(rng.choice("ACGT") for _ in range(rng.randrange(60))) for _ in range(2))
        part = "".join(c if rng.random() > 0.08 else rng.choice("ACGTN") for c in adapter)
        texts.append(rng.choice([body, body + part[:rng.randint(1, 20)], part[-rng.randint(1, 20):] + body, body + part + end]))

    def plain(t, end, low, rate):
        best = None
        for at in range(-len(adapter) + 1, len(t)):
            if (at < 0 and end == "3p") or (end == "5p" and at + len(adapter) > len(t)):
                continue
            a, b = max(at, 0), min(at + len(adapter), len(t))
            wrong = sum(x != y for x, y in zip(t[a:b], adapter[a - at:b - at], strict=True))
            if b - a >= low and wrong <= int(rate * (b - a) + 1e-9) and (best is None or (b - a - wrong, -wrong) > best[0]):
                best = ((b - a - wrong, -wrong), (a, b, wrong))
        return best and best[1]

    df = spark.createDataFrame([*enumerate(texts)], "i int, s string")
    for end, low, rate in (("5p", 20, 0.16), ("3p", 8, 0.2), ("5p", 8, 0.1)):
        got = {r.i: r.m and tuple(r.m) for r in df.select("i", sq.adapter_match("s", adapter, end, low, rate).alias("m")).collect()}
        assert got == {i: plain(t or "", end, low, rate) for i, t in enumerate(texts)}


def test_quality_summary_of_texts_nulls_and_empty_ones(spark):
    df = spark.createDataFrame([(0, "I5+B"), (1, ""), (2, None), (3, "!~"), (4, "é")], "i int, q string")
    got = {r.i: r.s and tuple(r.s) for r in df.select("i", sq.quality_summary("q").alias("s")).collect()}
    assert got == {0: (10, 40, 103, 4), 1: (0, 0, 0, 0), 2: None, 3: (0, 93, 93, 2), 4: (200, 200, 200, 1)}
    from locusflow.operators import align
    stats = align.fastq_stats(df.withColumnRenamed("q", "qual").withColumn("seq", F.lit("ACGN")))
    row = stats.first()
    assert (row.reads, row.qual_min, row.qual_max, round(row.qual_mean, 6)) == (5, 0, 200, round(396 / 7, 6))
    assert "regexp_extract_all" not in stats._jdf.queryExecution().executedPlan().toString()
