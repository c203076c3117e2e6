import gzip
import random

import pytest
from pyspark.sql import functions as F

from locusflow.operators import intervals as iv
from locusflow.sources import fastq, sinks, text


def _write(path, content):
    if str(path).endswith(".gz"):
        with gzip.open(path, "wt") as f:
            f.write(content)
    else:
        path.write_text(content)
    return str(path)


def _fastq(mate, n):
    return "".join(f"@r{i}/{mate}\n{'ACGT' * mate}\n+\n{'IIII' * mate}\n" for i in range(n))


def test_fastq_pairs_read_in_step(spark, tmp_path):
    for lane, n in (("001", 5), ("002", 3)):
        _write(tmp_path / f"smp_TAG7_R1_{lane}.fastq.gz", _fastq(1, n))
        _write(tmp_path / f"smp_TAG7_R2_{lane}.fastq.gz", _fastq(2, n))
    df = fastq.read_fastq_pairs(spark, f"{tmp_path}/*_R1_*.fastq.gz", f"{tmp_path}/*_R2_*.fastq.gz", partitions=3)
    rows = df.collect()
    assert len(rows) == 8
    assert {(r.sample, r.tag, r.lane) for r in rows} == {("smp", "TAG7", "001"), ("smp", "TAG7", "002")}
    assert all(r.r1_seq == "ACGT" and r.r2_seq == "ACGTACGT" for r in rows)


def test_fastq_pairs_of_unequal_length_fail(spark, tmp_path):
    _write(tmp_path / "s_TAG1_R1_001.fastq", _fastq(1, 3))
    _write(tmp_path / "s_TAG1_R2_001.fastq", _fastq(2, 2))
    try:
        fastq.read_fastq_pairs(spark, f"{tmp_path}/*_R1_*", f"{tmp_path}/*_R2_*").count()
    except Exception as e:
        assert "missing" in str(e)
    else:
        raise AssertionError("unequal files were accepted")


def test_fasta_chunks_cover_each_record(spark, tmp_path):
    seqs = {"chr1": "ACGTN" * 50, "chr2": "acg"}
    body = "".join(f">{c} note\n" + "".join(s[i:i + 60] + "\n" for i in range(0, len(s), 60)) for c, s in seqs.items())
    _write(tmp_path / "g.fa.gz", body)
    rows = fastq.read_fasta_chunks(spark, f"{tmp_path}/*.fa.gz", chunk=64).orderBy("chrom", "chunk_no").collect()
    for chrom, seq in seqs.items():
        assert "".join(r.seq for r in rows if r.chrom == chrom) == seq
    assert [r.chunk_start for r in rows if r.chrom == "chr1"] == [0, 64, 128, 192]


def test_wig_fixed_and_variable_step(spark, tmp_path):
    _write(tmp_path / "H3K4me3.wig.gz", "track type=wiggle_0\nfixedStep chrom=chr1 start=11 step=10 span=5\n1.5\n2\n"
                                        "variableStep chrom=chr2 span=3\n101 7\n201 -1e2\n")
    rows = sorted(tuple(r) for r in fastq.read_wig(spark, f"{tmp_path}/*.wig.gz").collect())
    assert rows == [("H3K4me3", "chr1", 10, 15, 1.5), ("H3K4me3", "chr1", 20, 25, 2.0),
                    ("H3K4me3", "chr2", 100, 103, 7.0), ("H3K4me3", "chr2", 200, 203, -100.0)]


def test_sam_tags_are_found_by_name(spark, tmp_path):
    path = _write(tmp_path / "a.sam", "@HD\tVN:1.0\n"
                  "r1x3\t0\tchr1\t101\t42\t30M\t*\t0\t0\tACGT\tIIII\tAS:i:-6\tXN:i:0\tMD:Z:12A17\n"
                  "r2\t16\tchr2\t5\t7\t28M2D\t*\t0\t0\tACGT\tIIII\tXN:i:0\tMD:Z:30\tXS:i:-12\tAS:i:0\n")
    rows = {r.qname: r for r in text.read_sam(spark, path).collect()}
    assert (rows["r1x3"].as_score, rows["r1x3"].xs_score, rows["r1x3"].md) == (-6, None, "12A17")
    assert (rows["r2"].as_score, rows["r2"].xs_score, rows["r2"].md, rows["r2"].pos1) == (0, -12, "30", 5)


def test_gene_models_and_regions(spark, tmp_path):
    ref = _write(tmp_path / "refFlat.txt", "GENE\tNM_1\tchr1\t-\t100\t500\t150\t450\t2\t100,400,\t200,500,\n")
    row = text.read_transcripts(spark, ref).first()
    assert (row.gene_symbol, row.tx_id, row.exon_starts, row.exon_ends) == ("GENE", "NM_1", [100, 400], [200, 500])
    names = {r.name: (r.start0, r.end0) for r in iv.exons(text.read_transcripts(spark, ref)).collect()}
    assert names == {"NM_1_exon_2": (100, 200), "NM_1_exon_1": (400, 500)}
    known = _write(tmp_path / "known.txt", "uc1\tchr2\t+\t10\t90\t10\t10\t1\t10,\t90,\tP1\tuc1\n")
    assert text.read_transcripts(spark, known, "knowngene").first().exon_ends == [90]
    dump = _write(tmp_path / "cpg.txt", "585\tchr1\t10\t60\tCpG: \t116\t800\n")
    assert tuple(text.read_regions(spark, dump, name=(4, 5)).first()) == ("chr1", 10, 60, "CpG: 116")


def test_small_text_sources(spark, tmp_path):
    bed = _write(tmp_path / "x_GeneDens01kb.bed", "#c\nchr1\t1\t2\tn\t0\t+\n")
    assert tuple(text.read_bed(spark, bed, comment="#").first()) == ("chr1", 1, 2, "n", 0.0, "+")
    many = text.read_many(spark, [bed], text.BED6, text.WINDOW_LABEL, "window", comment="#").first()
    assert many.window == "01kb"
    assert text.read_many(spark, [bed], text.BED6, text.FEATURE_LABEL, "feature", comment="#").first().feature == "GeneDens"
    sizes = _write(tmp_path / "chrom.sizes", "chr1\t1000\n")
    assert tuple(text.read_chrom_sizes(spark, sizes).first()) == ("chr1", 1000)
    tab = _write(tmp_path / "m.tab", "#'chr'\t'start'\t'end'\t'E.CD34.H3K4me3.bw'\nchr1\t1\t2\t0.5\nchr1\t5\t6\tnan\n")
    matrix = text.read_score_matrix(spark, tab)
    assert matrix.columns == ["chr", "start", "end", "E.CD34.H3K4me3.bw"]
    info = _write(tmp_path / "i.txt", "Sample_name:S1_TAG2\nAnnotation_path:hdfs://x/y\n")
    assert {r.key: r.value for r in text.read_manifest(spark, info).collect()}["Annotation_path"] == "hdfs://x/y"
    log = _write(tmp_path / "d.log", "Id\tCount\tFile(s)\tr2\nTAG1\t5\ta\tb\ntotal\t5\t\t\n")
    assert {r.tag: r.reads for r in text.read_demux_log(spark, log).collect()} == {"TAG1": 5, "total": 5}


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("chr2", 5, 6, ["a", "b"], None), ("chr1", 9, 10, ["c"], 3)],
                               "chrom string, start0 bigint, end0 bigint, names array<string>, size int")
    sinks.write_bed(df, f"{tmp_path}/bed")
    lines = [r.value for r in spark.read.text(f"{tmp_path}/bed").collect()]
    assert sorted(lines) == ["chr1\t9\t10\tc\t3", "chr2\t5\t6\ta,b\t-1"]
    sinks.write_tsv(df, f"{tmp_path}/tsv")
    assert spark.read.option("sep", "\t").option("header", True).csv(f"{tmp_path}/tsv").count() == 2
    reads = spark.createDataFrame([("T1", "r1", "AC", "II"), ("T2", "r2", "GG", "##")], "tag string, read_id string, seq string, qual string")
    sinks.write_fastq(reads, f"{tmp_path}/fq", ("tag",))
    assert [r.value for r in spark.read.text(f"{tmp_path}/fq/tag=T1").collect()] == ["@r1", "AC", "+", "II"]
    sinks.write_fasta(spark.createDataFrame([("chr1", 3, 5, "AC")], "chrom string, start0 bigint, end0 bigint, seq string"), f"{tmp_path}/fa")
    assert [r.value for r in spark.read.text(f"{tmp_path}/fa").collect()] == [">chr1:3-5", "AC"]
    sinks.write_manifest(spark, {"Sample_name": "S", "Genome": "hg"}, f"{tmp_path}/info")
    assert text.read_manifest(spark, f"{tmp_path}/info").count() == 2
    sinks.save_run({"reads": reads.withColumnRenamed("read_id", "id")}, f"{tmp_path}/run")
    assert sinks.load_run(spark, f"{tmp_path}/run", "reads")["reads"].count() == 2


def test_wiggle_gaps_keep_their_place(spark, tmp_path):
    from locusflow.sources import fastq

    (tmp_path / "t.wig").write_text("track type=wiggle_0\nfixedStep chrom=c start=1 step=1\n1\nNaN\n3\ninf\n5\n")
    rows = sorted((r.start0, r.value) for r in fastq.read_wig(spark, str(tmp_path / "t.wig")).collect())
    assert rows == [(0, 1.0), (2, 3.0), (4, 5.0)]


def test_sam_tag_behind_many_others(spark, tmp_path):
    from locusflow.sources import text

    fields = ["r", "0", "c", "1", "42", "4M", "*", "0", "0", "ACGT", "IIII", *[f"X{i:04d}:Z:x" for i in range(1200)], "AS:i:-6"]
    (tmp_path / "a.sam").write_text("\t".join(fields) + "\n")
    assert text.read_sam(spark, str(tmp_path / "a.sam")).first().as_score == -6


# ---- byte ranges -------------------------------------------------------------------------------


def _random_reads(n, seed=7):
    rng = random.Random(seed)
    draw = lambda: "".join(rng.choice("ACGTN") for _ in range(rng.randrange(1, 90)))
    one, two, want = [], [], []
    for i in range(n):
        a, b = draw(), draw()
        one.append(f"@read{i}/1 lane\n{a}\n+\n{'@' * len(a)}\n")  # qualities that look like headers
        two.append(f"@read{i}/2\n{b}\n+read{i}\n{'+' * len(b)}\n")
        want.append((f"read{i}", a, b))
    return "".join(one), "".join(two), want


@pytest.mark.parametrize("split", [1, 37, 500, 4096, 1 << 20])
def test_fastq_ranges_of_any_size_give_the_same_pairs(spark, tmp_path, split):
    one, two, want = _random_reads(40 if split == 1 else 400)
    _write(tmp_path / "a_TAG1_R1_001.fastq", one if split > 1 else one[: one.index("@read3/1")])
    _write(tmp_path / "a_TAG1_R2_001.fastq", two if split > 1 else two[: two.index("@read3/2")])
    _write(tmp_path / "b_TAG2_R1_001.fastq", "@x/1\nAC\n+\nII")  # no line end
    _write(tmp_path / "b_TAG2_R2_001.fastq", "@x/2\nGT\n+\nII")
    df = fastq.read_fastq_pairs(spark, f"{tmp_path}/*_R1_*", f"{tmp_path}/*_R2_*", split=split)
    want = sorted((want if split > 1 else want[:3]) + [("x", "AC", "GT")])
    assert sorted((r.read_id, r.r1_seq, r.r2_seq) for r in df.collect()) == want
    if split == 500:
        assert df.rdd.getNumPartitions() >= len(one) // 500


def test_fastq_ranges_notice_missing_and_surplus_mates(spark, tmp_path):
    one, two, _ = _random_reads(200)
    for name, a, b in (("less", one, two[: two.index("@read150/2")]), ("more", one[: one.index("@read150/1")], two)):
        (tmp_path / name).mkdir()
        _write(tmp_path / name / "a_R1_001.fastq", a)
        _write(tmp_path / name / "a_R2_001.fastq", b)
        with pytest.raises(Exception, match="missing|more reads"):
            fastq.read_fastq_pairs(spark, f"{tmp_path}/{name}/*_R1_*", f"{tmp_path}/{name}/*_R2_*", split=700).count()


@pytest.mark.parametrize("width", [60, 7, None])
@pytest.mark.parametrize("split", [3, 50, 333, 1 << 20])
def test_fasta_ranges_of_any_size_give_the_same_chunks(spark, tmp_path, width, split):
    rng = random.Random(split)
    sizes = (200, 1, 0, 333, 64) if split > 3 else (90, 0, 40)
    seqs = {f"chromosome_{i}": "".join(rng.choice("ACGTNacgt") for _ in range(n)) for i, n in enumerate(sizes)}
    lines = lambda s: [s] if width is None else [s[i:i + width] for i in range(0, len(s), width)]
    _write(tmp_path / "g.fa", "".join(f">{c} a long note behind the name of the sequence\r\n" + "".join(x + "\n" for x in lines(s)) for c, s in seqs.items()))
    _write(tmp_path / "h.fa", ">last\n" + "ACGT" * 30)
    seqs["last"] = "ACGT" * 30
    df = fastq.read_fasta_chunks(spark, f"{tmp_path}/*.fa", chunk=64, split=split)
    want = sorted((c, i // 64, i, s[i:i + 64]) for c, s in seqs.items() for i in range(0, len(s), 64))
    assert sorted(map(tuple, df.collect())) == want


@pytest.mark.parametrize("split", [1, 40, 200, 1 << 20])
def test_wiggle_ranges_of_any_size_give_the_same_signal(spark, tmp_path, split):
    n = 120 if split > 1 else 12
    body = ["track type=wiggle_0", "fixedStep chrom=chr1 start=11 step=10 span=5", *[f"{i / 4}" if i % 5 else "NaN" for i in range(n)], "# note",
            "variableStep chrom=chr2 span=3", *[f"{100 + 7 * i} {i}" for i in range(n)], "", "fixedStep chrom=chr3 start=1", *map(str, range(n))]
    _write(tmp_path / "t.wig", "\n".join(body) + "\n")
    want = [("t", "chr1", 10 + 10 * i, 15 + 10 * i, i / 4) for i in range(n) if i % 5]
    want += [("t", "chr2", 99 + 7 * i, 102 + 7 * i, float(i)) for i in range(n)] + [("t", "chr3", i, i + 1, float(i)) for i in range(n)]
    assert sorted(map(tuple, fastq.read_wig(spark, f"{tmp_path}/*.wig", split=split).collect())) == sorted(want)


def test_mates_are_written_in_step_when_rows_come_in_another_order_each_time(spark, monkeypatch):
    from checks import source_queries
    chance = F.udf(lambda: random.SystemRandom().random(), "double").asNondeterministic()
    rows = [(f"r{i}", "ACGT" * (1 + i % 3), "IIII" * (1 + i % 3), "GG" + "ACGT" * (i % 2), "55" + "IIII" * (i % 2)) for i in range(200)]
    columns = ["read_id", "r1_seq", "r1_qual", "r2_seq", "r2_qual"]
    given = spark.createDataFrame(rows, columns).coalesce(1).withColumn("o", chance()).sortWithinPartitions("o").drop("o")
    monkeypatch.setattr(source_queries, "view", lambda *_: given)
    read = source_queries.fastq_pairs(spark, "")
    assert sorted(map(tuple, read.select(*columns).collect())) == sorted(rows)
