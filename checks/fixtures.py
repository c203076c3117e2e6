"""Views over the driver's tables that give them insertion-site shape.

Each view is one SQL text for Spark and, where the dialects differ, one for DuckDB. All views cover
their whole source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _chrom(key: str) -> str:
    return (f"CASE {key} % 25 WHEN 22 THEN 'chrX' WHEN 23 THEN 'chrY' WHEN 24 THEN 'chrM' "
            f"ELSE 'chr' || CAST({key} % 25 + 1 AS STRING) END")


_SLOT = "CAST(floor(l_orderkey / 2) AS BIGINT)"
_RUN = "'S' || CAST(l_orderkey % 3 + 1 AS STRING) AS sample, 'TAG' || CAST(l_orderkey % 2 + 1 AS STRING) AS tag"

FX_SIZES = f"SELECT {_chrom('n_nationkey')} AS chrom, CAST(1000000 AS BIGINT) AS length FROM nation"

FX_OBS = f"""
SELECT {_RUN}, {_chrom(_SLOT)} AS chrom, {_SLOT} * 7919 % 999983 AS start0, {_SLOT} * 7919 % 999983 + 1 AS end0,
       CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) AS name, CAST(l_partkey % 43 AS DOUBLE) AS score,
       CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand, CAST(20 + l_quantity AS INT) AS size,
       CAST(l_linenumber * (1 + l_partkey % 9) AS BIGINT) AS n_reads
FROM lineitem"""

FX_SITES = f"""
SELECT sample, tag, chrom, start0, end0, max(score) AS score, strand, CAST(sum(n_reads) AS BIGINT) AS n_reads
FROM ({FX_OBS}) o GROUP BY sample, tag, chrom, start0, end0, strand"""

_TX = f"""
SELECT 'G' || CAST(p_partkey % 97 AS STRING) AS gene_symbol,
       'NM_' || CAST(p_partkey % 25 + 50 * CAST(floor(p_partkey / 50) AS BIGINT) AS STRING) AS tx_id,
       {_chrom('p_partkey')} AS chrom, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand,
       p_partkey * 6151 % 990000 + 200 AS tx_start, p_partkey * 6151 % 990000 + 200 + p_size * 90 AS tx_end,
       CAST(p_size % 4 + 1 AS INT) AS exon_count, p_partkey
FROM part"""

FX_TX = (f"""
SELECT gene_symbol, tx_id, chrom, strand, tx_start, tx_end, exon_count,
       transform(sequence(0, exon_count - 1), i -> tx_start + i * w) AS exon_starts,
       transform(sequence(0, exon_count - 1), i -> tx_start + i * w + w div 2) AS exon_ends
FROM (SELECT *, (tx_end - tx_start) div exon_count AS w FROM ({_TX}) t) u""", f"""
SELECT gene_symbol, tx_id, chrom, strand, tx_start, tx_end, exon_count,
       [tx_start + i * w for i in generate_series(0, exon_count - 1)] AS exon_starts,
       [tx_start + i * w + w // 2 for i in generate_series(0, exon_count - 1)] AS exon_ends
FROM (SELECT *, (tx_end - tx_start) // exon_count AS w FROM ({_TX}) t) u""")

FX_GENES = f"SELECT chrom, tx_start AS start0, tx_end AS end0, tx_id AS name, '0' AS score, strand FROM ({_TX}) t"

FX_SIGNAL = f"""
SELECT event_type AS track, {_chrom('user_id')} AS chrom, event_id * 389 % 999900 AS start0,
       event_id * 389 % 999900 + 25 AS end0, value FROM events"""

FX_ALN = f"""
SELECT {_RUN}, CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) || 'x' || CAST(1 + l_partkey % 9 AS STRING) AS qname,
       CASE WHEN l_linestatus = 'F' THEN 0 WHEN l_suppkey % 10 = 0 THEN 4 ELSE 16 END AS flag, {_chrom(_SLOT)} AS chrom,
       {_SLOT} * 7919 % 999900 + 1 AS pos1, CAST(l_quantity AS INT) % 43 AS mapq,
       CAST(30 + l_suppkey % 9 AS STRING) || 'M' || CASE WHEN l_partkey % 4 = 0 THEN '2D5M1I3M' ELSE '' END AS cigar,
       'ACGTTGCAN' AS seq, 'IIIIIIII#' AS qual,
       -CAST(l_suppkey % 4 AS INT) * 6 AS as_score,
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE -CAST(l_partkey % 5 AS INT) * 6 END AS xs_score,
       CAST(l_partkey % 6 AS STRING) || 'A' || CAST(30 + l_suppkey % 9 AS STRING) || 'C' || CAST(l_linenumber - 1 AS STRING) AS md
FROM lineitem"""

_PAIR_BASE = f"""
SELECT {_RUN}, CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) || '_' || CAST(l_partkey AS STRING)
       || '_' || CAST(l_suppkey AS STRING) AS qname, l_linestatus = 'F' AS plus, {_chrom(_SLOT)} AS chrom,
       {_SLOT} * 7919 % 990000 + 1000 AS p, CAST(l_quantity AS BIGINT) * 9 AS d, CAST(l_quantity AS INT) % 43 AS mapq,
       -CAST(l_suppkey % 4 AS INT) * 6 AS as_score,
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE -CAST(l_partkey % 5 AS INT) * 6 END AS xs_score,
       CAST(l_partkey % 6 AS STRING) || 'A' || CAST(30 + l_suppkey % 9 AS STRING) || 'C' || CAST(l_linenumber - 1 AS STRING) AS md
FROM lineitem"""

FX_PAIR_ALN = f"""
SELECT sample, tag, qname, CASE WHEN plus THEN 99 ELSE 83 END AS flag, chrom, CASE WHEN plus THEN p ELSE p + d END AS pos1,
       mapq, '50M' AS cigar, 'ACGTTGCAN' AS seq, 'IIIIIIII#' AS qual, as_score, xs_score, md FROM ({_PAIR_BASE}) x
UNION ALL
SELECT sample, tag, qname, CASE WHEN plus THEN 147 ELSE 163 END AS flag, chrom, CASE WHEN plus THEN p + d ELSE p END AS pos1,
       mapq, '45M' AS cigar, 'GGGTTGCAN' AS seq, 'IIIIIII##' AS qual, 0 AS as_score, CAST(NULL AS INT) AS xs_score, '45' AS md
FROM ({_PAIR_BASE}) y"""

_LETTERS = "translate(upper({letters}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'ACGTACGTACGTACGTACGTACGTAC')"
_LETTERS_SPARK = _LETTERS.format(letters="regexp_replace(text, '[^A-Za-z]', '')")
_LETTERS_DUCK = _LETTERS.format(letters="regexp_replace(text, '[^A-Za-z]', '', 'g')")

# every text is cut into consecutive 60-base pieces; each piece is one read pair
_PIECES = (f"""
SELECT doc_id, piece, body
FROM (SELECT doc_id, {_LETTERS_SPARK} AS letters FROM documents) l
LATERAL VIEW posexplode(regexp_extract_all(letters, '.{{1,60}}', 0)) p AS piece, body""", f"""
SELECT doc_id, CAST(piece AS INT) AS piece, substring(letters, piece * 60 + 1, 60) AS body
FROM (SELECT doc_id, letters, unnest(generate_series(0, (length(letters) - 1) // 60)) AS piece
      FROM (SELECT doc_id, {_LETTERS_DUCK} AS letters FROM documents) l WHERE length(letters) > 0) p""")

_READ_SELECT = """
SELECT 'S' || CAST(doc_id % 3 + 1 AS STRING) AS sample, 'TAG' || CAST(doc_id % 2 + 1 AS STRING) AS tag,
       CAST(doc_id AS STRING) || '.' || CAST(piece AS STRING) AS read_id, r1_seq,
       translate(r1_seq, 'ACGT', 'I?F7') AS r1_qual, r2_seq, translate(r2_seq, 'ACGT', 'I5+B') AS r2_qual
FROM (SELECT doc_id, piece,
        CASE (doc_id + piece) % 5
          WHEN 0 THEN 'ACGTCTGTTGTGTGACTCTGGTAACTAGAGATCCCTCAGACCCTTTTAGTCAGTGTGGAAAATCTCTAGCA' || body || 'AGTCCCTTAAGCGGAGCCCT'
          WHEN 1 THEN 'AAAATCTCTAGCAGTGGCGCCCGAACAG' || body
          WHEN 2 THEN 'GTCTGTTGTGAGACTCTGGTAACTAGAGATCCCTCAGACCCTTTTAGTCAGTGTGGAAAATCTCTAGCA' || body
          WHEN 3 THEN 'TTGTCTGTTGTGTGACTCTGGTAACTAGAGATGCCTCAGACCCTTTTAGTCAGTCTGGAAAATCTCTAGCA' || body || 'AGTCCCTTAAG'
          ELSE body END AS r1_seq,
        CASE (doc_id + piece) % 3
          WHEN 0 THEN 'AGGGCTCCGCTTAAGGGACT' || reverse(translate(body, 'ACGT', 'TGCA')) || 'TGCTAGAGATTTTCCACACTGACTAAAAGG'
          WHEN 1 THEN 'AGGGCTCCGGTTAAGGGACT' || reverse(translate(body, 'ACGT', 'TGCA'))
          ELSE reverse(translate(body, 'ACGT', 'TGCA')) END AS r2_seq
      FROM ({pieces}) q) r"""
FX_READS = tuple(_READ_SELECT.format(pieces=p) for p in _PIECES)

_DIGIT = "substr('ACGT', CAST(floor((n_nationkey * 157 + 27) / {p}) AS INT) % 4 + 1, 1)"
FX_BARCODES = ("SELECT 'T' || CAST(n_nationkey AS STRING) AS tag, "
               + " || ".join(_DIGIT.format(p=4 ** i) for i in reversed(range(6))) + " AS barcode FROM nation")
# some barcodes have two bases more
FX_LONG_BARCODES = f"{FX_BARCODES} UNION ALL SELECT 'L' || substr(tag, 2, 9), barcode || 'CT' FROM ({FX_BARCODES}) b WHERE CAST(substr(tag, 2, 9) AS INT) % 3 = 0"

# the letters of every text are one contig
FX_CONTIGS = (f"SELECT 'doc' || CAST(doc_id AS STRING) AS chrom, {_LETTERS_SPARK} AS seq FROM documents",
              f"SELECT 'doc' || CAST(doc_id AS STRING) AS chrom, {_LETTERS_DUCK} AS seq FROM documents")

_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
           "conversations").split()

VIEWS: dict[str, str | tuple[str, str]] = {
    "fx_sizes": FX_SIZES, "fx_obs": FX_OBS, "fx_sites": FX_SITES, "fx_tx": FX_TX, "fx_genes": FX_GENES,
    "fx_signal": FX_SIGNAL, "fx_aln": FX_ALN, "fx_pair_aln": FX_PAIR_ALN, "fx_pieces": _PIECES,
    "fx_reads": FX_READS, "fx_barcodes": FX_BARCODES, "fx_long_barcodes": FX_LONG_BARCODES, "fx_contigs": FX_CONTIGS,
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Spark form of a fixture view over the tables of ``sf_dir``."""
    text = VIEWS[name]
    text = text if isinstance(text, str) else text[0]
    used = [t for t in _TABLES if f"FROM {t}" in text]
    text = text.replace("{", "{{").replace("}", "}}")
    for t in used:
        text = text.replace(f"FROM {t}", "FROM {" + t + "}")
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used}
    if "documents" in tables:
        # one small file holds all texts: spread them, as reads from many sequencer files would be
        tables["documents"] = tables["documents"].select("doc_id", "text").repartition("doc_id")
    return spark.sql(text, **tables)


def duck(body: str, *names: str) -> str:
    """A DuckDB query over fixture views, as one statement."""
    ctes = []
    for n in names:
        text = VIEWS[n]
        ctes.append(f"{n} AS ({text if isinstance(text, str) else text[1]})")
    head, rest = "WITH " + ",\n".join(ctes), body.strip()
    if rest.upper().startswith("WITH "):
        return f"{head},\n{rest[5:]}"
    return f"{head}\n{rest}"
