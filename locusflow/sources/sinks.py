"""Writers for result tables, intervals, reads and sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from locusflow.operators.intervals import sort_intervals
from locusflow.schema import run_keys


def _text(field) -> Column:
    """Column as text; arrays become comma lists."""
    c = F.col(f"`{field.name}`")
    return F.array_join(c, ",") if field.dataType.typeName() == "array" else c.cast("string")


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tab-separated table with a header and without quotes."""
    flat = df.select(*[_text(f).alias(f.name) for f in df.schema.fields])
    flat.write.mode(mode).option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(path)


def write_bed(df: DataFrame, path: str, columns: list[str] | None = None, mode: str = "overwrite", ordered: bool = True) -> None:
    """Headerless intervals in coordinate order; missing text is written as ``.`` and missing numbers as ``-1``."""
    rows = sort_intervals(df) if ordered else df
    fields = {f.name: f for f in df.schema.fields}
    out = []
    for name in columns or df.columns:
        kind = fields[name].dataType.typeName()
        out.append(F.coalesce(_text(fields[name]), F.lit("." if kind in ("string", "array") else "-1")).alias(name))
    rows.select(*out).write.mode(mode).option("sep", "\t").option("quote", "").csv(path)


def write_fastq(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), name: str = "read_id", seq: str = "seq",
                qual: str = "qual", mode: str = "overwrite") -> None:
    """Reads as gzipped FASTQ, split into folders by ``partition_by`` (such as tag and outcome)."""
    record = F.concat_ws("\n", F.concat(F.lit("@"), F.col(name)), F.col(seq), F.lit("+"), F.col(qual))
    writer = df.select(*partition_by, record.alias("value")).write.mode(mode).option("compression", "gzip")
    (writer.partitionBy(*partition_by) if partition_by else writer).text(path)


def write_fasta(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Sequence windows as FASTA, named ``chrom:start-end``."""
    title = F.concat(F.lit(">"), F.col("chrom"), F.lit(":"), F.col("start0").cast("string"), F.lit("-"), F.col("end0").cast("string"))
    df.select(F.concat_ws("\n", title, F.col("seq")).alias("value")).write.mode(mode).text(path)


def write_manifest(spark: SparkSession, entries: dict[str, str], path: str, mode: str = "overwrite") -> None:
    """Run description as ``key:value`` lines."""
    rows = spark.createDataFrame([(f"{k}:{v}",) for k, v in entries.items()], "value string")
    rows.coalesce(1).write.mode(mode).text(path)


def save_run(tables: dict[str, DataFrame], root: str, mode: str = "overwrite") -> None:
    """All result tables of a run as Parquet, partitioned by sample and tag where present."""
    for name, df in tables.items():
        writer = df.write.mode(mode)
        keys = run_keys(df)
        (writer.partitionBy(*keys) if keys else writer).parquet(f"{root}/{name}")


def load_run(spark: SparkSession, root: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{root}/{n}") for n in names}
