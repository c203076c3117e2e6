"""Readers for the line-oriented formats: alignments, intervals, gene models, signal, logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BED6 = "chrom string, start0 bigint, end0 bigint, name string, score double, strand string"
BED8 = BED6 + ", size int, n_reads bigint"
FASTQ_SUFFIX = r"\.f(?:ast)?q(?:\.gz)?$"


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignment records; header lines are skipped and optional tags are found by name."""
    parts = F.split(F.col("value"), "\t")
    lines = spark.read.text(path).filter(~F.col("value").startswith("@")).select(parts.alias("p"))

    def tag(name: str) -> Column:
        return F.get(F.filter(F.slice("p", F.lit(12), F.greatest(F.size("p") - 11, F.lit(0))), lambda x: x.startswith(name + ":")), F.lit(0))

    def number(name: str) -> Column:
        return F.regexp_extract(tag(name), r"^..:i:(-?\d+)$", 1).try_cast("int")

    field = lambda i: F.get("p", F.lit(i))
    return lines.select(
        field(0).alias("qname"), field(1).cast("int").alias("flag"), field(2).alias("chrom"), field(3).cast("bigint").alias("pos1"),
        field(4).cast("int").alias("mapq"), field(5).alias("cigar"), field(9).alias("seq"), field(10).alias("qual"),
        number("AS").alias("as_score"), number("XS").alias("xs_score"), F.nullif(F.regexp_extract(tag("MD"), r"^MD:Z:(.*)$", 1), F.lit("")).alias("md"))


def read_bed(spark: SparkSession, path, schema: str = BED6, comment: str | None = None) -> DataFrame:
    """Headerless tab-separated intervals with positional columns."""
    reader = spark.read.option("sep", "\t").option("quote", "").schema(schema)
    return (reader.option("comment", comment) if comment else reader).csv(path)


# Column positions (0-based) of the gene model dialects.
_MODELS = {
    "refflat": dict(gene=0, tx=1, chrom=2, strand=3, start=4, end=5, cds_start=6, cds_end=7, count=8, starts=9, ends=10, width=11),
    "knowngene": dict(gene=0, tx=0, chrom=1, strand=2, start=3, end=4, cds_start=5, cds_end=6, count=7, starts=8, ends=9, width=12),
    "ensgene": dict(gene=12, tx=1, chrom=2, strand=3, start=4, end=5, cds_start=6, cds_end=7, count=8, starts=9, ends=10, width=16),
}


def read_transcripts(spark: SparkSession, path: str, dialect: str = "refflat") -> DataFrame:
    """Gene model with exon borders as arrays; the lists in the files end with a comma."""
    at = _MODELS[dialect]
    schema = ", ".join(f"c{i} string" for i in range(at["width"]))
    rows = spark.read.option("sep", "\t").option("quote", "").schema(schema).csv(path)
    col = lambda key: F.col(f"c{at[key]}")
    count = col("count").cast("int")
    borders = lambda key: F.slice(F.split(col(key), ","), F.lit(1), count).cast("array<bigint>")
    return rows.select(F.lit(dialect).alias("source"), col("gene").alias("gene_symbol"), col("tx").alias("tx_id"),
                       col("chrom").alias("chrom"), col("strand").alias("strand"),
                       *[col(k).cast("bigint").alias(n) for k, n in (("start", "tx_start"), ("end", "tx_end"),
                                                                     ("cds_start", "cds_start"), ("cds_end", "cds_end"))],
                       count.alias("exon_count"), borders("starts").alias("exon_starts"), borders("ends").alias("exon_ends"))


def read_regions(spark: SparkSession, path: str, cols: tuple[int, int, int] = (1, 2, 3), name: tuple[int, ...] = (),
                 width: int = 16) -> DataFrame:
    """Intervals from a table dump: three of its columns, and a name joined from further ones."""
    schema = ", ".join(f"c{i} string" for i in range(max(width, max((*cols, *name)) + 1)))
    rows = spark.read.option("sep", "\t").option("quote", "").schema(schema).csv(path)
    chrom, start, end = (F.col(f"c{i}") for i in cols)
    named = [F.concat(*[F.col(f"c{i}") for i in name]).alias("name")] if name else []
    return rows.select(chrom.alias("chrom"), start.cast("bigint").alias("start0"), end.cast("bigint").alias("end0"), *named)


def read_chrom_sizes(spark: SparkSession, path: str) -> DataFrame:
    return read_bed(spark, path, "chrom string, length bigint")


def read_many(spark: SparkSession, paths, schema: str, id_regex: str, id_name: str = "source", comment: str | None = None) -> DataFrame:
    """Many files of one layout as one table, labelled by a part of the file name."""
    label = F.regexp_extract(F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1), id_regex, 1)
    return read_bed(spark, paths, schema, comment).withColumn(id_name, label)


# Fixed patterns: window label and feature name in the names of association files.
WINDOW_LABEL = r"_[A-Za-z]*?([01]+[a-zA-Z]+)\.(?:bed|tab)$"
FEATURE_LABEL = r"_([A-Za-z]+?)[0-9]*[a-zA-Z]*\.bed$"


def clean_name(name: str) -> str:
    """Column name without the quoting and leading marks of the score matrix header."""
    return name.strip().lstrip("#").strip("'\"")


def read_score_matrix(spark: SparkSession, path) -> DataFrame:
    """Wide track scores with a header line: ``chr, start, end`` and one column per track."""
    raw = spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(path)
    names = [clean_name(c) for c in raw.columns]
    ids = 3
    casts = ["string", "bigint", "bigint", *["double"] * (len(names) - ids)]
    return raw.toDF(*names).select(*[F.col(f"`{c}`").try_cast(t).alias(c) for c, t in zip(names, casts)])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``key:value`` lines as rows; the value may itself hold colons."""
    parts = F.split("value", ":", 2)
    return spark.read.text(path).filter(F.col("value").contains(":")).select(
        F.get(parts, F.lit(0)).alias("key"), F.get(parts, F.lit(1)).alias("value"))


def read_demux_log(spark: SparkSession, path: str) -> DataFrame:
    """Reads per tag with the files written and the ``total`` row."""
    rows = spark.read.option("sep", "\t").option("header", True).csv(path).toDF("tag", "reads", "file_r1", "file_r2")
    return rows.withColumn("reads", F.col("reads").cast("bigint"))
