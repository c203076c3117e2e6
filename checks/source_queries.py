"""Sources and sinks: tables derived from the given ones are written in each format and read again."""

import uuid

from pyspark.sql import functions as F

from checks.fixtures import duck, view
from checks.registry import query
from locusflow.operators.scaling import checkpoint_folder, checkpointed
from locusflow.sources import fastq, sinks, text


def _folder(spark) -> str:
    return f"{checkpoint_folder(spark)}/formats-{uuid.uuid4().hex}"


def _lines(df, *columns, sep: str = "\t") -> str:
    """Folder of text files with one line per row; missing columns are left out."""
    folder = _folder(df.sparkSession)
    df.select(F.concat_ws(sep, *columns).alias("value")).write.text(folder)
    return folder


@query("fastq_pairs", duck("SELECT read_id, r1_seq, r1_qual, r2_seq, r2_qual FROM fx_reads", "fx_reads"))
def fastq_pairs(spark, d):
    # landed once: rows of a shuffle come in another order, and partitions in another number, each time it is read
    reads, folder = checkpointed(view(spark, d, "fx_reads")), _folder(spark)
    for mate in ("r1", "r2"):
        sinks.write_fastq(reads.select("read_id", F.col(f"{mate}_seq").alias("seq"), F.col(f"{mate}_qual").alias("qual")), f"{folder}/{mate}")
    return fastq.read_fastq_pairs(spark, f"{folder}/r1/part-*", f"{folder}/r2/part-*").drop("sample", "tag", "lane")


@query("sam_records", duck("SELECT qname, flag, chrom, pos1, mapq, cigar, seq, qual, as_score, xs_score, md FROM fx_aln", "fx_aln"))
def sam_records(spark, d):
    tags = [F.concat(F.lit(mark), F.col(c).cast("string")) for mark, c in (("AS:i:", "as_score"), ("XS:i:", "xs_score"), ("MD:Z:", "md"))]
    fixed = ["qname", "flag", "chrom", "pos1", "mapq", "cigar", F.lit("*"), F.lit("0"), F.lit("0"), "seq", "qual"]
    return text.read_sam(spark, _lines(view(spark, d, "fx_aln"), *fixed, *tags))


@query("bed_intervals", duck("SELECT chrom, start0, end0, name, score, strand, size, n_reads FROM fx_obs", "fx_obs"))
def bed_intervals(spark, d):
    folder = _folder(spark)
    sinks.write_bed(view(spark, d, "fx_obs"), folder, ["chrom", "start0", "end0", "name", "score", "strand", "size", "n_reads"])
    return text.read_bed(spark, folder, text.BED8)


@query("transcript_records", duck("""
SELECT 'refflat' AS source, gene_symbol, tx_id, chrom, strand, tx_start, tx_end, tx_start AS cds_start, tx_end AS cds_end, exon_count,
       array_to_string(exon_starts, ',') AS exon_starts, array_to_string(exon_ends, ',') AS exon_ends FROM fx_tx""", "fx_tx"))
def transcript_records(spark, d):
    borders = [F.concat(F.array_join(c, ","), F.lit(",")) for c in ("exon_starts", "exon_ends")]
    folder = _lines(view(spark, d, "fx_tx"), "gene_symbol", "tx_id", "chrom", "strand", "tx_start", "tx_end", "tx_start", "tx_end",
                    "exon_count", *borders)
    return text.read_transcripts(spark, folder).withColumns({c: F.array_join(c, ",") for c in ("exon_starts", "exon_ends")})


@query("open_regions", duck("SELECT chrom, start0, end0 FROM fx_genes", "fx_genes"))
def open_regions(spark, d):
    return text.read_regions(spark, _lines(view(spark, d, "fx_genes"), F.lit("585"), "chrom", "start0", "end0", "name"))


@query("named_regions", duck("SELECT chrom, start0, end0, 'CpG: ' || name AS name FROM fx_genes", "fx_genes"))
def named_regions(spark, d):
    folder = _lines(view(spark, d, "fx_genes"), F.lit("585"), "chrom", "start0", "end0", F.lit("CpG: "), "name", "strand")
    return text.read_regions(spark, folder, name=(4, 5))


@query("chrom_sizes", duck("SELECT chrom, length FROM fx_sizes", "fx_sizes"))
def chrom_sizes(spark, d):
    return text.read_chrom_sizes(spark, _lines(view(spark, d, "fx_sizes"), "chrom", "length"))


@query("fasta_chunks", duck("""
SELECT chrom || ':0-' || CAST(length(seq) AS VARCHAR) AS chrom, CAST(i AS BIGINT) AS chunk_no, CAST(i * 1024 AS BIGINT) AS chunk_start,
       substr(seq, i * 1024 + 1, 1024) AS seq
FROM (SELECT *, unnest(generate_series(0, (length(seq) - 1) // 1024)) AS i FROM fx_contigs WHERE length(seq) > 0) c""", "fx_contigs"))
def fasta_chunks(spark, d):
    contigs = view(spark, d, "fx_contigs").filter(F.length("seq") > 0)
    folder = _folder(spark)
    sinks.write_fasta(contigs.select("chrom", F.lit(0).alias("start0"), F.length("seq").alias("end0"), "seq"), folder)
    return fastq.read_fasta_chunks(spark, f"{folder}/part-*")


@query("wiggle_intervals", duck("SELECT chrom, start0, end0, value FROM fx_signal WHERE value IS NOT NULL", "fx_signal"))
def wiggle_intervals(spark, d):
    signal = view(spark, d, "fx_signal").filter("value IS NOT NULL")
    block = F.concat(F.lit("variableStep chrom="), "chrom", F.lit(" span="), (F.col("end0") - F.col("start0")).cast("string"))
    folder = _lines(signal, block, F.concat((F.col("start0") + 1).cast("string"), F.lit(" "), F.col("value").cast("string")), sep="\n")
    return fastq.read_wig(spark, f"{folder}/part-*").drop("track")


@query("many_files", duck("SELECT chrom, start0, end0, name, CAST(score AS DOUBLE) AS score, strand, 'part' AS source FROM fx_genes", "fx_genes"))
def many_files(spark, d):
    folder = _folder(spark)
    for half in (0, 1):
        rows = view(spark, d, "fx_genes").filter(F.pmod(F.xxhash64("name"), F.lit(2)) == half)
        sinks.write_bed(rows, f"{folder}/{half}", ["chrom", "start0", "end0", "name", "score", "strand"])
    return text.read_many(spark, [f"{folder}/0", f"{folder}/1"], text.BED6, r"^([a-z]+)-")


@query("score_matrix", duck("""
SELECT chrom AS chr, start0 AS start, end0 AS "end", score, CAST(n_reads AS DOUBLE) AS reads FROM fx_sites""", "fx_sites"))
def score_matrix(spark, d):
    folder = _folder(spark)
    sinks.write_tsv(view(spark, d, "fx_sites").selectExpr("chrom AS `'chr'`", "start0 AS `'start'`", "end0 AS `'end'`", "score AS `'score'`",
                                                         "n_reads AS `'reads'`"), folder)
    return text.read_score_matrix(spark, folder)


@query("manifest", """
SELECT 'reads' AS key, CAST(count(*) AS VARCHAR) AS value FROM lineitem
UNION ALL SELECT 'folder', 's3://run/' || CAST(max(l_orderkey) AS VARCHAR) FROM lineitem""")
def manifest(spark, d):
    folder = _folder(spark)
    total = spark.read.parquet(f"{d}/lineitem.parquet").agg(F.count(F.lit(1)).alias("n"), F.max("l_orderkey").alias("last")).first()
    sinks.write_manifest(spark, {"reads": str(total.n), "folder": f"s3://run/{total.last}"}, folder)
    return text.read_manifest(spark, folder)


@query("demux_log", duck("""
SELECT coalesce(tag, 'total') AS tag, count(*) AS reads, tag || '_R1.fastq' AS file_r1, tag || '_R2.fastq' AS file_r2
FROM fx_reads GROUP BY ROLLUP (tag)""", "fx_reads"))
def demux_log(spark, d):
    folder = _folder(spark)
    counted = view(spark, d, "fx_reads").rollup("tag").agg(F.count(F.lit(1)).alias("Count"))
    sinks.write_tsv(counted.select(F.coalesce("tag", F.lit("total")).alias("Id"), "Count", F.concat("tag", F.lit("_R1.fastq")).alias("R1"),
                                   F.concat("tag", F.lit("_R2.fastq")).alias("R2")), folder)
    return text.read_demux_log(spark, folder)


@query("saved_run", duck("SELECT * FROM fx_sites", "fx_sites"))
def saved_run(spark, d):
    folder = _folder(spark)
    sinks.save_run({"sites": view(spark, d, "fx_sites"), "genes": view(spark, d, "fx_genes")}, folder)
    return sinks.load_run(spark, folder, "sites")["sites"]
