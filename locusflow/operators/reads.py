"""Read-pair classification, trimming and collapsing.

One row holds both mates, so that a rule on one mate routes the pair. Every rule adds columns or filters
rows; none shuffles except the collapse of identical sequences, which combines on the map side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from locusflow.functions.sequence import adapter_match, cut_at_site, quality_keep
from locusflow.schema import AdapterSet, run_keys

_BASES = ("A", "C", "G", "T", "N")


# ---- demultiplexing ----------------------------------------------------------------------------


def barcode_variants(barcodes: DataFrame, max_mm: int = 1, min_distance: int = 2) -> DataFrame:
    """Every read start that is assigned, with its barcode and number of mismatches.

    ``barcodes`` holds ``(tag, barcode)``. Starts that are nearer than ``min_distance`` mismatches to a
    second barcode are left out. The table grows with the barcode list only.
    """
    reach = max_mm + min_distance - 1
    frontier = barcodes.select(F.col("tag"), F.upper("barcode").alias("start"), F.lit(0).alias("mm"))
    found = frontier
    for step in range(1, reach + 1):
        changed = (frontier.withColumn("_i", F.explode(F.sequence(F.lit(1), F.length("start"))))
                   .withColumn("_b", F.explode(F.array(*[F.lit(b) for b in _BASES])))
                   .select("tag", F.expr("overlay(start PLACING _b FROM _i)").alias("start"), F.lit(step).alias("mm")))
        frontier = changed.distinct()
        found = found.unionByName(frontier)
    nearest = found.groupBy("start", "tag").agg(F.min("mm").alias("mm"))
    order = W.partitionBy("start").orderBy("mm", "tag")
    ranked = nearest.withColumn("_rank", F.row_number().over(order)).withColumn("_next", F.lead("mm").over(order))
    unique = F.col("_next").isNull() | (F.col("_next") - F.col("mm") >= min_distance)
    return (ranked.filter((F.col("_rank") == 1) & (F.col("mm") <= max_mm) & unique)
            .select("start", F.col("tag").alias("barcode_tag"), "mm"))


def demultiplex(pairs: DataFrame, barcodes: DataFrame, max_mm: int = 1, min_distance: int = 2) -> DataFrame:
    """Add ``tag`` (``unmatched`` without a unique barcode at the start of R1); the barcode stays in the read.

    A lookup by equality against all accepted read starts replaces the comparison with every barcode. Starts of all
    lengths are looked up at once, by as many bases as the shortest has; of those that the read begins with the longest
    wins. Only starts that share these bases lie in one row of the lookup.
    """
    variants = barcode_variants(barcodes, max_mm, min_distance)
    bases = variants.agg(F.min(F.length("start"))).scalar()
    longest_first = F.array_sort(F.collect_list(F.struct((-F.length("start")).alias("n"), "start", "barcode_tag", "mm")))
    table = variants.groupBy(F.substring("start", F.lit(1), bases).alias("_first")).agg(longest_first.alias("_starts"))
    rows = pairs.drop("tag").withColumn("_first", F.substring("r1_seq", F.lit(1), bases)).join(table, "_first", "left")
    found = F.get(F.filter("_starts", lambda s: F.col("r1_seq").startswith(s["start"])), 0)
    return (rows.withColumn("_found", found)
            .select(*[c for c in pairs.columns if c != "tag"], F.coalesce("_found.barcode_tag", F.lit("unmatched")).alias("tag"),
                    F.col("_found.mm").alias("barcode_mm")))


def demux_counts(pairs: DataFrame) -> DataFrame:
    """Reads per sample and tag with a ``total`` row per sample, and each tag's share in percent."""
    samples = [c for c in run_keys(pairs) if c == "sample"]
    counts = pairs.groupBy(*samples, "tag").agg(F.count(F.lit(1)).alias("reads"))
    totals = counts.groupBy(*samples).agg(F.sum("reads").alias("reads")).withColumn("tag", F.lit("total"))
    whole = F.sum(F.when(F.col("tag") != "total", F.col("reads"))).over(W.partitionBy(*(samples or [F.lit(0)])))
    return (counts.unionByName(totals).withColumn("percent", 100 * F.col("reads") / whole))


# ---- adapter rules -----------------------------------------------------------------------------


def with_match(pairs: DataFrame, adapter: str, end: str, min_overlap: int, error_rate: float,
               mate: str = "r1", name: str = "match") -> DataFrame:
    """Add the adapter match of one mate as a struct, NULL when there is none."""
    return pairs.withColumn(name, adapter_match(f"{mate}_seq", adapter, end, min_overlap, error_rate))


def _clip(pairs: DataFrame, mate: str, start, length) -> DataFrame:
    columns = {f"{mate}_seq": F.substring(f"{mate}_seq", start, length)}
    if f"{mate}_qual" in pairs.columns:
        columns[f"{mate}_qual"] = F.substring(f"{mate}_qual", start, length)
    return pairs.withColumns(columns)


def trim_match(pairs: DataFrame, end: str, mate: str = "r1", name: str = "match") -> DataFrame:
    """Remove a match and what lies beyond it: everything before its end (5p) or from its start on (3p)."""
    whole = F.length(f"{mate}_seq")
    if end == "5p":
        start, length = F.coalesce(F.col(f"{name}.stop"), F.lit(0)) + 1, whole
    else:
        start, length = F.lit(1), F.coalesce(F.col(f"{name}.start"), whole)
    return _clip(pairs, mate, start, length).drop(name)


def classify_adapter(pairs: DataFrame, adapter: str, end: str, min_overlap: int, error_rate: float,
                     mate: str = "r1") -> DataFrame:
    """Add ``matched``; the read is left as it is."""
    found = with_match(pairs, adapter, end, min_overlap, error_rate, mate)
    return found.withColumn("matched", F.col("match").isNotNull()).drop("match")


def trim_adapter(pairs: DataFrame, adapter: str, end: str, min_overlap: int, error_rate: float, mate: str = "r1",
                 keep_unmatched: bool = False) -> DataFrame:
    """Trim matched pairs; unmatched pairs are dropped unless ``keep_unmatched``, which adds ``matched``."""
    found = with_match(pairs, adapter, end, min_overlap, error_rate, mate)
    if not keep_unmatched:
        return trim_match(found.filter(F.col("match").isNotNull()), end, mate)
    return trim_match(found.withColumn("matched", F.col("match").isNotNull()), end, mate)


def without_provirus(pairs: DataFrame, adapters: AdapterSet = AdapterSet()) -> DataFrame:
    """Pairs whose R1 does not read into the provirus."""
    size = len(adapters.provirus)
    return classify_adapter(pairs, adapters.provirus, "5p", size, 0.1).filter(~F.col("matched")).drop("matched")


def require_ltr(pairs: DataFrame, adapters: AdapterSet = AdapterSet()) -> DataFrame:
    """Pairs whose R1 holds the LTR primer, trimmed behind it."""
    return trim_adapter(pairs, adapters.ltr, "5p", len(adapters.ltr), 0.1)


def require_elongation(pairs: DataFrame, adapters: AdapterSet = AdapterSet()) -> DataFrame:
    """Pairs whose R1 holds the rest of the LTR, trimmed behind it."""
    return trim_adapter(pairs, adapters.elongation, "5p", len(adapters.elongation), 0.16)


def require_prefix(pairs: DataFrame, prefix: str = AdapterSet.prefix) -> DataFrame:
    """Pairs whose R1 begins exactly with ``prefix``, which is removed."""
    rows = pairs.filter(F.col("r1_seq").startswith(prefix))
    return _clip(rows, "r1", F.lit(len(prefix) + 1), F.length("r1_seq"))


def split_linker_r1(pairs: DataFrame, adapters: AdapterSet = AdapterSet()) -> DataFrame:
    """Trim the linker at the end of R1; ``matched`` tells both branches apart."""
    return trim_adapter(pairs, adapters.linker_r1, "3p", 8, 0.2, keep_unmatched=True)


def split_linker_r2(pairs: DataFrame, adapters: AdapterSet = AdapterSet()) -> DataFrame:
    """Trim the linker at the start of R2; ``matched`` tells both branches apart."""
    return trim_adapter(pairs, adapters.linker_r2, "5p", len(adapters.linker_r2), 0.16, mate="r2", keep_unmatched=True)


# Where a pair leaves the trimming, in order; the last three are its branches.
OUTCOMES = ("provirus", "no_ltr", "no_elongation", "no_prefix", "linker_r1", "linker_r2", "no_linker")


def route_reads(pairs: DataFrame, adapters: AdapterSet = AdapterSet()) -> DataFrame:
    """All pairs with ``outcome``, one of ``OUTCOMES``: the rule of the trimming that a pair fails, or its branch.

    The rules are those of ``without_provirus``, ``require_ltr``, ``require_elongation``, ``require_prefix``,
    ``split_linker_r1`` and ``split_linker_r2`` in this order; pairs are trimmed as far as they came. A pair that has its
    outcome is not searched any more. So every intermediate count of the trimming is a count of one column.
    """
    size = len(adapters.provirus)
    rules = [(adapters.provirus, "5p", size, 0.1, "r1", "provirus", None), (adapters.ltr, "5p", len(adapters.ltr), 0.1, "r1", None, "no_ltr"),
             (adapters.elongation, "5p", len(adapters.elongation), 0.16, "r1", None, "no_elongation"), None,
             (adapters.linker_r1, "3p", 8, 0.2, "r1", "linker_r1", None),
             (adapters.linker_r2, "5p", len(adapters.linker_r2), 0.16, "r2", "linker_r2", "no_linker")]
    rows = pairs.withColumn("outcome", F.lit(None).cast("string"))
    going = F.col("outcome").isNull()
    for rule in rules:
        if rule is None:
            starts = going & F.col("r1_seq").startswith(adapters.prefix)
            cut = F.when(starts, len(adapters.prefix) + 1).otherwise(1)
            rows = (_clip(rows.withColumn("_starts", starts).withColumn("_cut", cut), "r1", F.col("_cut"), F.length("r1_seq"))
                    .withColumn("outcome", F.when(going & ~F.coalesce("_starts", F.lit(False)), "no_prefix").otherwise(F.col("outcome"))).drop("_starts", "_cut"))
            continue
        adapter, end, overlap, rate, mate, hit, miss = rule
        found = (rows.withColumn("match", adapter_match(F.when(going, F.col(f"{mate}_seq")), adapter, end, overlap, rate))
                 .withColumn("_hit", F.col("match").isNotNull()))
        rows = found.drop("match") if hit == "provirus" else trim_match(found, end, mate)
        rows = (rows.withColumn("outcome", F.when(going & F.col("_hit"), F.lit(hit)).when(going, F.lit(miss)).otherwise(F.col("outcome")))
                .drop("_hit"))
    return rows


def quality_trim(pairs: DataFrame, cutoff: int = 20, mate: str = "r2") -> DataFrame:
    """Cut the low-quality 3' end of one mate."""
    rows = pairs.withColumn("_keep", quality_keep(f"{mate}_qual", cutoff))
    return _clip(rows, mate, F.lit(1), F.col("_keep")).drop("_keep")


def trim_r2_tail(pairs: DataFrame, adapters: AdapterSet = AdapterSet()) -> DataFrame:
    """Quality-trim R2 and remove the reverse-complement LTR from its end; all pairs are kept."""
    return trim_adapter(quality_trim(pairs), adapters.rc_ltr, "3p", 8, 0.25, mate="r2", keep_unmatched=True).drop("matched")


def with_length_ok(df: DataFrame, length: int = 20, mates: str = "any") -> DataFrame:
    """Add ``long_enough``: the shorter mate (``any``), or the single read (``seq`` or R1), has ``length`` bases."""
    if mates == "any" and "r2_seq" in df.columns:
        size = F.least(F.length("r1_seq"), F.length("r2_seq"))
    else:
        size = F.length("seq" if "seq" in df.columns else "r1_seq")
    return df.withColumn("long_enough", size >= length)


def min_length(df: DataFrame, length: int = 20, mates: str = "any") -> DataFrame:
    return with_length_ok(df, length, mates).filter("long_enough").drop("long_enough")


# ---- single reads ------------------------------------------------------------------------------


def single_reads(pairs: DataFrame, mate: str = "r1") -> DataFrame:
    """One mate of each pair as ``(read_id, seq, qual, n_reads)``."""
    return pairs.select(*run_keys(pairs), "read_id", F.col(f"{mate}_seq").alias("seq"),
                        F.col(f"{mate}_qual").alias("qual"), F.lit(1).cast("bigint").alias("n_reads"))


def residual_reads(**sources: DataFrame) -> DataFrame:
    """Stack single reads from several origins with an ``origin`` label."""
    labelled = [df.withColumn("origin", F.lit(name)) for name, df in sources.items()]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), labelled)


def cut_reads(reads: DataFrame, site: str = "TTAA") -> DataFrame:
    """Cut reads (and qualities) at the first restriction site."""
    kept = cut_at_site("seq", site)
    return (reads.withColumn("_keep", kept).withColumn("seq", F.substring("seq", F.lit(1), F.col("_keep")))
            .withColumn("qual", F.substring("qual", F.lit(1), F.col("_keep"))).drop("_keep"))


def collapse_reads(reads: DataFrame, min_count: int = 0) -> DataFrame:
    """Identical sequences as one row with their summed read count; ``name`` is unique within a run."""
    rows = (reads.groupBy(*run_keys(reads), "seq").agg(F.sum("n_reads").alias("n_reads"), F.max("qual").alias("qual"))
            .filter(F.col("n_reads") >= min_count))
    return rows.withColumn("qname", F.concat(F.md5("seq"), F.lit("x"), F.col("n_reads").cast("string")))
