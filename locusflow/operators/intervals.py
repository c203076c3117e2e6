"""Genomic interval algebra as DataFrame joins and tiled scans.

Counting, nearest-feature and window-mean operators never form (interval, feature) pairs: they read
running totals of feature starts and ends at the interval borders. Only ``overlap_join`` emits pairs,
because the pairs are its result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from locusflow.operators.scaling import same_join, spread, tiled_scan, whole_rows
from locusflow.schema import PROMOTER_TIERS, SPAN, WINDOWS, run_keys

BIN = 4_096  # bin width of the overlap join, bp; an interval is compared with all features of its bins
TILE = 65_536  # tile width of positional scans, bp; bounds the distinct positions per window partition

DISTANCE_SIGNS = ("b", "a", "ref", None)


# ---- derived intervals -------------------------------------------------------------------------


def flank(df: DataFrame, left: int, right: int, sizes: DataFrame | None = None, stranded: bool = False) -> DataFrame:
    """Intervals beside each feature: ``left`` bp before and ``right`` bp after it.

    With ``stranded``, before and after follow the feature's strand. Flanks are clamped to the chromosome
    and empty ones are dropped. ``side`` tells which flank a row is.
    """
    minus = (F.col("strand") == "-") if stranded else F.lit(False)
    low = F.struct(F.when(minus, F.lit("right")).otherwise("left").alias("side"),
                   (F.col("start0") - F.when(minus, F.lit(right)).otherwise(F.lit(left))).alias("start0"),
                   F.col("start0").alias("end0"))
    high = F.struct(F.when(minus, F.lit("left")).otherwise("right").alias("side"), F.col("end0").alias("start0"),
                    (F.col("end0") + F.when(minus, F.lit(left)).otherwise(F.lit(right))).alias("end0"))
    others = [c for c in df.columns if c not in ("start0", "end0")]
    out = (df.withColumn("_f", F.explode(F.array(low, high)))
           .select(*others, F.col("_f.side").alias("side"), F.col("_f.start0").alias("start0"),
                   F.col("_f.end0").alias("end0")))
    return clamp(out, sizes)


def clamp(df: DataFrame, sizes: DataFrame | None) -> DataFrame:
    """Cut intervals at the chromosome borders; drop those left empty or on unknown chromosomes."""
    if sizes is None:
        return df.withColumn("start0", F.greatest("start0", F.lit(0))).filter("start0 < end0")
    # one row per chromosome: left to the size-checked broadcast of the optimizer
    limits = sizes.select("chrom", F.col("length").alias("_length"))
    return (df.join(limits, "chrom")
            .withColumn("start0", F.least(F.greatest("start0", F.lit(0)), "_length"))
            .withColumn("end0", F.least("end0", "_length"))
            .drop("_length").filter("start0 < end0"))


def slop(df: DataFrame, both: int, sizes: DataFrame | None = None) -> DataFrame:
    """Extend intervals by ``both`` bp on either side, clamped to the chromosome."""
    return clamp(df.withColumn("start0", F.col("start0") - both).withColumn("end0", F.col("end0") + both), sizes)


def multi_window(df: DataFrame, sizes: DataFrame, windows: dict[str, int] | None = None) -> DataFrame:
    """All association windows around each site in one pass; ``window`` holds the label."""
    windows = WINDOWS if windows is None else windows
    widths = F.array(*[F.struct(F.lit(label).alias("window"), F.lit(b).cast("bigint").alias("b"))
                       for label, b in windows.items()])
    out = df.withColumn("_w", F.explode(widths))
    out = (out.withColumn("window", F.col("_w.window"))
           .withColumn("site_start0", F.col("start0"))
           .withColumn("start0", F.col("start0") - F.col("_w.b"))
           .withColumn("end0", F.col("end0") + F.col("_w.b")).drop("_w"))
    return clamp(out, sizes)


# ---- gene model intervals ----------------------------------------------------------------------


def gene_bodies(tx: DataFrame, score: str | None = None) -> DataFrame:
    """Transcript -> gene body; ``score`` names a column kept as score (the gene id in Ensembl models), else 0."""
    kept = F.col(score).cast("string") if score else F.lit("0")
    return tx.select("chrom", F.col("tx_start").alias("start0"), F.col("tx_end").alias("end0"),
                     F.col("tx_id").alias("name"), kept.alias("score"), "strand")


def tss(bodies: DataFrame) -> DataFrame:
    """Gene body -> one-base transcription start: first base on ``+``, last base otherwise."""
    plus = F.col("strand") == "+"
    start = F.when(plus, F.col("start0")).otherwise(F.col("end0") - 1)
    return bodies.withColumn("start0", start).withColumn("end0", F.col("start0") + 1)


def promoters(starts: DataFrame, sizes: DataFrame, tiers=PROMOTER_TIERS) -> DataFrame:
    """Consecutive upstream flanks of transcription starts, labelled by ``tier``.

    Each tier begins where the previous one ends; what reaches past the chromosome is cut, and a tier
    left empty is dropped together with those beyond it.
    """
    minus = F.col("strand") == "-"
    spans, near = [], 0
    for label, length in tiers:
        far = near + length
        spans.append(F.struct(
            F.lit(label).alias("tier"),
            F.when(minus, F.col("end0") + near).otherwise(F.col("start0") - far).alias("start0"),
            F.when(minus, F.col("end0") + far).otherwise(F.col("start0") - near).alias("end0")))
        near = far
    others = [c for c in starts.columns if c not in ("start0", "end0")]
    out = (starts.withColumn("_t", F.explode(F.array(*spans)))
           .select(*others, F.col("_t.tier").alias("tier"), F.col("_t.start0").alias("start0"),
                   F.col("_t.end0").alias("end0")))
    return clamp(out, sizes)


def exons(tx: DataFrame) -> DataFrame:
    """One row per exon, numbered along the transcript's own direction."""
    pairs = F.arrays_zip(F.col("exon_starts").alias("s"), F.col("exon_ends").alias("e"))
    number = F.when(F.col("strand") == "-", F.size("exon_starts") - F.col("_i")).otherwise(F.col("_i") + 1)
    return (tx.select("*", F.posexplode(pairs).alias("_i", "_x"))
            .select("chrom", F.col("_x.s").alias("start0"), F.col("_x.e").alias("end0"),
                    F.concat(F.col("tx_id"), F.lit("_exon_"), number.cast("string")).alias("name"),
                    "gene_symbol", "strand"))


# ---- overlap -----------------------------------------------------------------------------------


def _spans(df: DataFrame) -> DataFrame:
    """Distinct non-empty spans: positions shared by runs and strands are looked up once."""
    return df.filter("start0 < end0").select(*SPAN).distinct()


def _bins(start: str, end: str, width: int) -> tuple[Column, Column]:
    return F.floor(F.col(start) / F.lit(width)), F.floor((F.col(end) - 1) / F.lit(width))


def point_bin(width: int = BIN) -> Column:
    """The bin of a one-base interval."""
    return _bins("start0", "end0", width)[0]


def _binned(df: DataFrame, prefix: str, width: int) -> DataFrame:
    first, last = _bins(f"{prefix}start0", f"{prefix}end0", width)
    return df.withColumn(f"_{prefix}first", first).withColumn("_bin", F.explode(F.sequence(first, last)))


def _prefixed(b: DataFrame) -> DataFrame:
    return b.filter("start0 < end0").select(*[F.col(c).alias(f"b_{c}") for c in b.columns])


def _point_counts(a: DataFrame, b: DataFrame, per: list[str]) -> DataFrame:
    """``(chrom, start0, b_<per>, n_pairs)``: how many features of each kind lie over the positions of ``a``, where there are any.

    A feature lies over a position if it has begun up to there and not ended, so the count is a running sum along the chromosome.
    """
    kinds, features = [f"b_{c}" for c in per], b.filter("start0 < end0")
    steps = F.explode(F.array(F.struct(F.col("start0").alias("pos"), F.lit(1).alias("m")), F.struct(F.col("end0").alias("pos"), F.lit(-1).alias("m"))))
    events = (features.select("chrom", *[F.col(c).alias(k) for c, k in zip(per, kinds, strict=True)], steps.alias("e"))
              .groupBy("chrom", *kinds, F.col("e.pos").alias("pos")).agg(F.sum("e.m").alias("m")).withColumn("rank", F.lit(0)))
    known = features.agg(F.collect_set(F.struct(*[F.col(c).alias(k) for c, k in zip(per, kinds, strict=True)]))).scalar()
    asked = (a.select("chrom", F.col("start0").alias("pos")).distinct().select("chrom", "pos", known.alias("_k"))
             .select("chrom", F.explode("_k").alias("_k"), "pos").select("chrom", "_k.*", "pos", F.lit(0).cast("bigint").alias("m"), F.lit(1).alias("rank")))
    # what begins or ends at a position (0) comes before the question (1)
    rows = (asked.unionByName(events).filter("chrom IS NOT NULL AND pos IS NOT NULL")
            .withColumn("_tile", F.floor(F.col("pos") / F.lit(TILE))))
    scanned = tiled_scan(rows, ["chrom", *kinds], "_tile", ["pos", "rank"], {"n_pairs": ("sum", F.col("m"), "upto")})
    return scanned.filter("rank = 1 AND n_pairs > 0").select("chrom", F.col("pos").alias("start0"), *kinds, "n_pairs")


def overlap_join(a: DataFrame, b: DataFrame, how: str = "inner", bin_width: int = BIN, points: bool = False,
                 per: list[str] | None = None) -> DataFrame:
    """Rows of ``a`` with the rows of ``b`` sharing at least one base; ``b`` columns are prefixed ``b_``.

    ``how`` is ``inner``, ``left`` (unmatched rows keep NULLs) or ``anti`` (unmatched rows only).
    ``b`` may be a union of labelled sets: the label is then part of the result. Both sides meet in bins
    of ``bin_width`` bp; a pair is kept in the first bin it shares. ``points`` says that ``a`` holds
    one-base intervals, which lie in a single bin, so that a left join needs no second pass; rows that come with
    their bin (``a_bin``, see ``point_bin``) keep it, and stay in the partition that they were dealt to by it.

    ``per`` names columns of ``b`` with few values, for one-base intervals: the pairs of a row are not returned but counted
    (``n_pairs``) for each value of these, at a cost that doesn't grow with the overlaps. An unmatched row has 0.
    """
    if per is not None:
        if not points or how not in ("inner", "left"):
            raise ValueError("per asks for points and an inner or left join")
        counted = a.join(_point_counts(a, b, per), ["chrom", "start0"], how)
        return counted.select(*a.columns, *[f"b_{c}" for c in per], F.coalesce("n_pairs", F.lit(0)).alias("n_pairs"))
    columns = [*a.columns, *[f"b_{c}" for c in b.columns]]
    if how == "anti":
        # pair-free: rows whose span overlaps something are removed
        hit = span_profile(_spans(a), b).filter("n_overlap > 0").select(*SPAN)
        return a.join(hit, SPAN, "left_anti").select(*a.columns)
    if how not in ("inner", "left"):
        raise ValueError(f"unknown join type {how!r}")
    right = _binned(_prefixed(b), "b_", bin_width)
    meets = ((F.col("chrom") == F.col("b_chrom")) & (F.col("a_bin") == F.col("_bin"))
             & (F.col("start0") < F.col("b_end0")) & (F.col("b_start0") < F.col("end0")))
    if points:
        # dealt by bin into as many partitions as the session names: sorting merged ones spills
        left = a if "a_bin" in a.columns else spread(a.withColumn("a_bin", point_bin(bin_width)), "chrom", "a_bin")
        return left.join(right, meets, how).select(*columns)
    left = _binned(a.filter("start0 < end0"), "", bin_width).withColumnRenamed("_bin", "a_bin")
    pairs = left.join(right, meets & (F.col("_bin") == F.greatest("_first", "_b_first"))).select(*columns)
    if how == "inner":
        return pairs
    return pairs.unionByName(overlap_join(a, b, "anti"), allowMissingColumns=True)


def label_sets(**sets: DataFrame) -> DataFrame:
    """Stack interval sets with a ``source`` label."""
    out = None
    for label, df in sets.items():
        rows = df.select(*SPAN, "name", "strand").withColumn("source", F.lit(label))
        out = rows if out is None else out.unionByName(rows)
    return out


def span_profile(spans: DataFrame, b: DataFrame) -> DataFrame:
    """Per distinct span: number of overlapping features, nearest feature end on the left and start on the right.

    A feature overlaps unless it starts at or after the span's end, or ends at or before its start; so
    the count is (starts before the end) - (ends up to the start), both running totals along the chromosome.
    """
    borders = F.array(F.struct(F.lit(0).alias("rank"), F.col("end0").alias("pos")),
                      F.struct(F.lit(2).alias("rank"), F.col("start0").alias("pos")))
    events = (b.filter("start0 < end0").select("chrom", F.explode(borders).alias("e"))
              .groupBy("chrom", F.col("e.pos").alias("pos"), F.col("e.rank").alias("rank"))
              .agg(F.count(F.lit(1)).alias("m")))
    asks = F.array(F.struct(F.lit("L").alias("ask"), F.col("start0").alias("pos")),
                   F.struct(F.lit("R").alias("ask"), F.col("end0").alias("pos")))
    queries = (spans.select(*SPAN, F.explode(asks).alias("q"))
               .select("chrom", F.col("q.pos").alias("pos"), F.lit(1).alias("rank"), F.lit(0).cast("bigint").alias("m"),
                       F.col("q.ask").alias("ask"), "start0", "end0"))
    # at one position: ends (0) come before the questions (1), starts (2) after them
    rows = queries.unionByName(events, allowMissingColumns=True).filter("chrom IS NOT NULL")
    rows = rows.withColumn("_tile", F.floor(F.col("pos") / F.lit(TILE)))
    scanned = tiled_scan(rows, ["chrom"], "_tile", ["pos", "rank"], {
        "ends": ("sum", F.when(F.col("rank") == 0, F.col("m")), "before"),
        "starts": ("sum", F.when(F.col("rank") == 2, F.col("m")), "before"),
        "left_end": ("max", F.when(F.col("rank") == 0, F.col("pos")), "before"),
        "right_start": ("min", F.when(F.col("rank") == 2, F.col("pos")), "after"),
    })
    left, right = F.col("ask") == "L", F.col("ask") == "R"
    return (scanned.filter(F.col("rank") == 1).groupBy(*SPAN)
            .agg((F.max(F.when(right, F.col("starts"))) - F.max(F.when(left, F.col("ends")))).alias("n_overlap"),
                 F.max(F.when(left, F.col("left_end"))).alias("left_end"),
                 F.max(F.when(right, F.col("right_start"))).alias("right_start")))


def overlap_count(a: DataFrame, b: DataFrame, name: str = "n_overlap") -> DataFrame:
    """Number of ``b`` features overlapping each row of ``a``, zero included; cost independent of the overlaps."""
    spans = _spans(a)
    counts = span_profile(spans, b).select(*SPAN, F.col("n_overlap").alias(name))
    return (a.join(counts, SPAN, "left")
            .withColumn(name, F.coalesce(name, F.lit(0))).select(*[c for c in a.columns if c != name], name))


# ---- nearest feature ---------------------------------------------------------------------------


def _signed(distance: Column, b_right: Column, signed: str | None) -> Column:
    """Negative when the feature (``ref``, ``a``) or the interval seen from the feature (``b``) lies upstream."""
    if signed is None:
        return distance
    if signed == "ref":
        negative = ~b_right
    elif signed == "a":
        negative = F.when(F.col("strand") == "-", b_right).otherwise(~b_right)
    else:
        negative = F.when(F.col("b_strand") == "-", ~b_right).otherwise(b_right)
    return F.when(negative, -distance).otherwise(distance)


def closest(a: DataFrame, b: DataFrame, ties: str = "all", signed: str | None = "b") -> DataFrame:
    """Nearest ``b`` feature of each row of ``a`` with ``distance``; all ties, or the first by coordinate.

    Overlapping features are at distance 0 and adjacent ones at 1. Rows on chromosomes without
    features keep NULLs.
    """
    if signed not in DISTANCE_SIGNS or ties not in ("all", "first"):
        raise ValueError("signed must be one of b, a, ref, None and ties all or first")
    spans = _spans(a)
    b_cols = [f"b_{c}" for c in b.columns]
    near = span_profile(spans, b).filter("n_overlap = 0")
    gap_left = F.col("start0") - F.col("left_end") + 1
    gap_right = F.col("right_start") - F.col("end0") + 1
    best = F.least(gap_left, gap_right)
    # 'first' prefers the left neighbour, which has the smaller coordinate
    take_right = (gap_right == best) if ties == "all" else ((gap_right == best) & F.coalesce(gap_left != best, F.lit(True)))
    sides = F.filter(F.array(
        F.struct(F.lit("L").alias("side"), F.when(gap_left == best, F.col("left_end")).alias("pos"), gap_left.alias("d")),
        F.struct(F.lit("R").alias("side"), F.when(take_right, F.col("right_start")).alias("pos"), gap_right.alias("d"))),
        lambda s: s.pos.isNotNull())
    asked = (near.select(*SPAN, F.explode(sides).alias("s"))
             .select(*SPAN, "s.side", "s.pos", F.col("s.d").alias("_d")))
    by_side = F.explode(F.array(F.struct(F.lit("L").alias("side"), F.col("end0").alias("pos")),
                                F.struct(F.lit("R").alias("side"), F.col("start0").alias("pos"))))
    features = (b.filter("start0 < end0").withColumn("_s", by_side)
                .select(F.col("chrom"), F.col("_s.side").alias("side"), F.col("_s.pos").alias("pos"),
                        F.struct(*[F.col(c).alias(f"b_{c}") for c in _first_order(b.columns)]).alias("f")))
    if ties == "first":
        features = features.groupBy("chrom", "side", "pos").agg(F.min("f").alias("f"))
    apart = (asked.join(features, ["chrom", "side", "pos"])
             .select(*SPAN, "_d", (F.col("side") == "R").alias("_right"), "f.*"))
    touching = _first_touching(spans, b) if ties == "first" else overlap_join(spans.select(*SPAN), b)
    both = apart.unionByName(touching.withColumn("_d", F.lit(0)).withColumn("_right", F.lit(False)))
    return (a.join(both, SPAN, "left")
            .withColumn("distance", _signed(F.col("_d"), F.col("_right"), signed).cast("bigint"))
            .select(*a.columns, *b_cols, "distance"))


def _first_touching(spans: DataFrame, b: DataFrame) -> DataFrame:
    """The first overlapping feature by coordinate of each span that has any, without forming overlap pairs.

    Of all features that end behind the start of a span the first by coordinate overlaps it, or none does. So it is a
    running least over the features in order of their ends, whatever the number of overlaps.
    """
    feature = F.struct(*[F.col(c).alias(f"b_{c}") for c in _first_order(b.columns)])
    ends = (b.filter("start0 < end0").select("chrom", F.col("end0").alias("pos"), feature.alias("f"))
            .groupBy("chrom", "pos").agg(F.min("f").alias("f")).withColumn("rank", F.lit(0)))
    # features that end at the start of a span come before it
    asked = spans.select(*SPAN, F.col("start0").alias("pos"), F.lit(1).alias("rank"))
    rows = (asked.unionByName(ends, allowMissingColumns=True).filter("chrom IS NOT NULL")
            .withColumn("_tile", F.floor(F.col("pos") / F.lit(TILE))))
    scanned = tiled_scan(rows, ["chrom"], "_tile", ["pos", "rank"], {"_first": ("min", F.col("f"), "after")})
    return scanned.filter((F.col("rank") == 1) & (F.col("_first.b_start0") < F.col("end0"))).select(*SPAN, "_first.*")


def _first_order(columns: list[str]) -> list[str]:
    """Columns with coordinates and name in front, so that the least struct is the first feature by coordinate."""
    front = [c for c in ("start0", "end0", "name") if c in columns]
    return [*front, *[c for c in columns if c not in front]]


# ---- clusters ----------------------------------------------------------------------------------


def islands(df: DataFrame, max_gap: int = -1, stranded: bool = True) -> DataFrame:
    """Distinct starts with the start of their cluster (``cluster``).

    An interval opens a cluster unless it begins at most ``max_gap`` bp after the furthest end so far;
    ``-1`` asks for a shared base, ``0`` also joins adjacent intervals.

    A start that opens a cluster as far as its own tile tells does so unless the end carried from the tiles before
    reaches it. Of the openings up to a row the last is reached last, so each row and each tile needs its last one only.
    """
    keys = [*run_keys(df), "chrom", *(["strand"] if stranded else [])]
    parts = [*keys, "_tile"]
    starts = (df.groupBy(*keys, "start0").agg(F.max("end0").alias("_end"))
              .withColumn("_tile", F.floor(F.col("start0") / F.lit(TILE))))
    at = W.partitionBy(*parts).orderBy("start0")
    reach = F.max("_end").over(at.rowsBetween(W.unboundedPreceding, -1))
    opens = F.when(F.col("_reach").isNull() | (F.col("start0") - F.col("_reach") > max_gap), F.col("start0"))
    local = (starts.repartition(*parts).withColumn("_reach", reach).withColumn("_open", opens)
             .withColumn("_last", F.max("_open").over(at.rowsBetween(W.unboundedPreceding, 0))))
    totals = local.groupBy(*parts).agg(F.max("_end").alias("_far"), F.max("_open").alias("_open"), whole_rows(starts))
    tiles = W.partitionBy(*keys).orderBy("_tile").rowsBetween(W.unboundedPreceding, -1)
    beyond = lambda start: F.col("_past").isNull() | (start - F.col("_past") > max_gap)
    carried = (totals.withColumn("_past", F.max("_far").over(tiles))
               .withColumn("_came", F.max(F.when(beyond(F.col("_open")), F.col("_open"))).over(tiles)).select(*parts, "_past", "_came", "_read"))
    return (same_join(local, carried, parts).filter("_read IS NOT NULL")
            .select(*keys, "start0", F.when(beyond(F.col("_last")), F.col("_last")).otherwise(F.col("_came")).alias("cluster")))


def cluster(df: DataFrame, max_gap: int = -1, stranded: bool = True, points: bool = False) -> DataFrame:
    """Add ``cluster``: the first start of the run of intervals joined with this one.

    ``(run keys, chrom[, strand], cluster)`` identifies a cluster. With ``points`` (one-base sites) and
    ``max_gap=-1`` the cluster is the position itself and nothing is shuffled.
    """
    if points and max_gap == -1:
        return df.withColumn("cluster", F.col("start0"))
    keys = [*run_keys(df), "chrom", *(["strand"] if stranded else [])]
    found = islands(df, max_gap, stranded)
    on = [*keys, "start0"]
    return same_join(df, found, on).select(*df.columns, "cluster")


def merge(df: DataFrame, max_gap: int = -1, stranded: bool = True, aggs: dict[str, Column] | None = None,
          points: bool = False) -> DataFrame:
    """Union of clustered intervals with per-cluster aggregates (output column -> aggregate expression)."""
    keys = [*run_keys(df), "chrom", *(["strand"] if stranded else [])]
    extra = [expr.alias(out) for out, expr in (aggs or {}).items()]
    return (cluster(df, max_gap, stranded, points).groupBy(*keys, "cluster")
            .agg(F.min("start0").alias("start0"), F.max("end0").alias("end0"), *extra).drop("cluster"))


# ---- signal ------------------------------------------------------------------------------------


def window_mean(windows: DataFrame, signal: DataFrame, track: str = "track") -> DataFrame:
    """Mean signal over the covered bases of each window, per track; NULL where nothing is covered.

    ``signal`` holds ``(track, chrom, start0, end0, value)``. The area under the signal and the covered
    length up to a position are running totals along the chromosome; a window's mean is the quotient of
    their differences at its two borders, whatever its width. Signal that is NULL, NaN or infinite covers nothing.
    """
    spans = _spans(windows)
    step = F.explode(F.array(F.struct(F.col("start0").alias("pos"), F.col("value").alias("dv"), F.lit(1).alias("dc")),
                             F.struct(F.col("end0").alias("pos"), (-F.col("value")).alias("dv"), F.lit(-1).alias("dc"))))
    keys = [track, "chrom"]
    events = (signal.filter((F.col("start0") < F.col("end0")) & (F.abs("value") < F.lit(float("inf")))).withColumn("_e", step)
              .groupBy(*keys, F.col("_e.pos").alias("pos"))
              .agg(F.sum("_e.dv").alias("dv"), F.sum("_e.dc").alias("dc")))
    tracks = signal.agg(F.array_sort(F.collect_set(track)).alias("t")).scalar()
    ask = F.explode(F.array(F.struct(F.col("start0").alias("pos"), F.lit(-1).alias("side")),
                            F.struct(F.col("end0").alias("pos"), F.lit(1).alias("side"))))
    queries = (spans.select(*SPAN, tracks.alias("_t")).select(*SPAN, F.explode("_t").alias(track))
               .select(track, *SPAN, ask.alias("_q"))
               .select(*keys, "start0", "end0", F.col("_q.pos").alias("pos"), F.col("_q.side").alias("side"),
                       F.lit(0.0).alias("dv"), F.lit(0).cast("bigint").alias("dc")))
    rows = (queries.unionByName(events, allowMissingColumns=True).filter(f"`{track}` IS NOT NULL AND chrom IS NOT NULL")
            .withColumn("_tile", F.floor(F.col("pos") / F.lit(TILE))))
    # height (value and cover) up to each row; area up to a row = sum of height * distance to the next position
    local = W.partitionBy(*keys, "_tile").orderBy("pos").rangeBetween(W.unboundedPreceding, 0)
    at = W.partitionBy(*keys, "_tile").orderBy("pos")
    border = (F.col("_tile") + 1) * TILE
    dealt = rows.repartition(*keys, "_tile")
    totals = dealt.groupBy(*keys, "_tile").agg(
        F.sum("dv").alias("tv"), F.sum("dc").alias("tc"), F.sum(F.col("dv") * (border - F.col("pos"))).alias("ta"),
        F.sum(F.col("dc") * (border - F.col("pos"))).alias("tk"), whole_rows(rows))
    stepped = (dealt.withColumn("_h", F.sum("dv").over(local)).withColumn("_k", F.sum("dc").over(local))
               .withColumn("_w", F.coalesce(F.lead("pos").over(at), border) - F.col("pos")))
    before = at.rowsBetween(W.unboundedPreceding, -1)
    inside = (stepped
              .withColumn("_area", F.coalesce(F.sum(F.col("_h") * F.col("_w")).over(before), F.lit(0.0)))
              .withColumn("_cover", F.coalesce(F.sum(F.col("_k") * F.col("_w")).over(before), F.lit(0))))
    # the totals of a tile: change of height, and area of its own steps up to its right border
    tiles = W.partitionBy(*keys).orderBy("_tile")
    past = tiles.rowsBetween(W.unboundedPreceding, -1)
    carried = (totals
               .withColumn("hv", F.coalesce(F.sum("tv").over(past), F.lit(0.0)))
               .withColumn("hc", F.coalesce(F.sum("tc").over(past), F.lit(0)))
               .withColumn("_skip", F.coalesce(F.lead("_tile").over(tiles), F.col("_tile") + 1) - F.col("_tile"))
               .withColumn("_a", F.col("hv") * F.col("_skip") * TILE + F.col("ta")
                           + F.col("tv") * (F.col("_skip") - 1) * TILE)
               .withColumn("_c", F.col("hc") * F.col("_skip") * TILE + F.col("tk")
                           + F.col("tc") * (F.col("_skip") - 1) * TILE)
               .select(*keys, "_tile", "hv", "hc", "_read",
                       F.coalesce(F.sum("_a").over(past), F.lit(0.0)).alias("av"),
                       F.coalesce(F.sum("_c").over(past), F.lit(0)).alias("ac")))
    offset = F.col("pos") - F.col("_tile") * TILE
    profile = (inside.filter(F.col("side").isNotNull()).join(carried.filter("_read IS NOT NULL"), [*keys, "_tile"])
               .withColumn("area", F.col("av") + F.col("hv") * offset + F.col("_area"))
               .withColumn("cover", F.col("ac") + F.col("hc") * offset + F.col("_cover"))
               .groupBy(*SPAN, track)
               .agg(F.sum(F.col("side") * F.col("area")).alias("area"), F.sum(F.col("side") * F.col("cover")).alias("cover"))
               .select(*SPAN, track, F.when(F.col("cover") > 0, F.col("area") / F.col("cover")).alias("value")))
    return windows.join(profile, SPAN).select(*windows.columns, track, "value")


def sort_intervals(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Coordinate order across and within partitions; meant for sinks."""
    by = ["chrom", "start0", "end0"]
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    return ranged.sortWithinPartitions(*by)


# Report order of the chromosomes.
CHROM_ORDER = [f"chr{i}" for i in range(1, 23)] + ["chrX", "chrY", "chrM"]


def with_chrom_rank(df: DataFrame, chrom: str = "chrom") -> DataFrame:
    """Add ``chrom_rank`` in report order; unlisted contigs rank last."""
    position = F.array_position(F.array(*[F.lit(c) for c in CHROM_ORDER]), F.col(chrom))
    return df.withColumn("chrom_rank", F.when(position > 0, position).otherwise(len(CHROM_ORDER) + 1).cast("int"))
