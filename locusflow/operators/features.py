"""Association of sites with genomic features against random control sites."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from locusflow.operators.intervals import overlap_join
from locusflow.operators.scaling import SLICE_ROWS, same_join, tiled_scan, value_slices
from locusflow.schema import run_keys

EXPERIMENTAL, RANDOM = "Experimental", "random"
_GENOME_BIN = 1 << 22


def random_sites(sites: DataFrame, sizes: DataFrame, seed: int = 1) -> DataFrame:
    """As many uniformly random one-base sites per run as it has sites, each coordinate once.

    The n-th control of a run belongs to its n-th site: position and strand come from a digest of run,
    site and seed, so the set is reproducible and no site is numbered or counted. Positions are drawn on
    the concatenated chromosomes and mapped back by an interval join.
    """
    runs = run_keys(sites)
    # one row per chromosome: a single small window
    ordered = W.partitionBy(F.lit(0)).orderBy("chrom")
    axis = (sizes.filter("length > 0").select("chrom", "length",
            (F.sum("length").over(ordered.rowsBetween(W.unboundedPreceding, 0)) - F.col("length")).alias("offset")))
    total = sizes.agg(F.sum("length").alias("t")).scalar()
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in [*runs, "chrom", "start0", "strand"]], F.lit(str(seed))))
    draw = lambda first, digits: F.conv(F.substring(digest, first, digits), 16, 10).cast("bigint")
    points = (sites.select(*runs, F.pmod(draw(1, 15), total).alias("start0"),
                           F.when(draw(16, 4) % 2 == 0, "+").otherwise("-").alias("strand"))
              .withColumn("end0", F.col("start0") + 1).withColumn("chrom", F.lit("genome")))
    spans = axis.select(F.lit("genome").alias("chrom"), F.col("offset").alias("start0"),
                        (F.col("offset") + F.col("length")).alias("end0"), F.col("chrom").alias("on"))
    placed = overlap_join(points, spans, bin_width=_GENOME_BIN, points=True)
    return (placed.select(*runs, F.col("b_on").alias("chrom"), (F.col("start0") - F.col("b_start0")).alias("start0"),
                          (F.col("end0") - F.col("b_start0")).alias("end0"), "strand")
            .groupBy(*runs, "chrom", "start0", "end0").agg(F.min("strand").alias("strand")))


def with_controls(sites: DataFrame, random: DataFrame) -> DataFrame:
    """Observed and random sites in one table, told apart by ``cls``."""
    columns = [*run_keys(sites), "chrom", "start0", "end0", "strand"]
    return (sites.select(*columns).withColumn("cls", F.lit(EXPERIMENTAL))
            .unionByName(random.select(*columns).withColumn("cls", F.lit(RANDOM))))


def class_of(name: str = "name") -> Column:
    """Class told by a site name: names with ``random`` are controls."""
    return F.when(F.col(name).contains("random"), RANDOM).otherwise(EXPERIMENTAL)


def bind_rows(*tables: DataFrame) -> DataFrame:
    """Stack tables of different columns; missing ones become NULL."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), tables)


def unpivot_scores(wide: DataFrame, ids: list[str], part: int | None = None) -> DataFrame:
    """Wide track columns -> ``(Feature, value)`` rows; ``part`` keeps that dotted part of the column name."""
    tracks = [c for c in wide.columns if c not in ids]
    long = wide.unpivot(ids, [F.col(f"`{c}`") for c in tracks], "feature", "value")
    return long if part is None else long.withColumn("feature", F.get(F.split("feature", r"\."), F.lit(part)))


def gc_from_at(long: DataFrame, column: str = "total", feature: str = "GCcontent") -> DataFrame:
    """Turn AT fractions stored under a GC feature into GC fractions."""
    return long.withColumn(column, F.when(F.col("feature") == feature, 1 - F.col(column)).otherwise(F.col(column)))


def feature_table(long: DataFrame, keys: list[str]) -> DataFrame:
    """Sum of the values of each window, site and feature; missing values count as nothing, all missing as 0."""
    return long.groupBy(*keys).agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("total"))


def _classes(df: DataFrame, score: str, by: list[str]) -> DataFrame:
    """Counts of both classes per distinct score."""
    return (df.filter(F.col(score).isNotNull()).groupBy(*by, F.col(score).cast("double").alias("score"))
            .agg(F.count_if(F.col("cls") == EXPERIMENTAL).alias("cases"), F.count_if(F.col("cls") == RANDOM).alias("controls")))


def auc(df: DataFrame, by: list[str], score: str = "value", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Area under the ROC curve in percent: chance that a case scores above a control, ties counting half.

    Works on distinct scores, counted once and cut into slices of about ``slice_rows`` of them, whatever the groups' sizes.
    Groups with a single class are left out.
    """
    counts = value_slices(_classes(df, score, by), by, "score", slice_rows)
    ranked = tiled_scan(counts, by, "_tile", ["score"], {"below": ("sum", F.col("controls"), "before")})
    wins = F.sum(F.col("cases") * (F.col("below") + F.col("controls") / 2))
    n1, n0 = F.sum("cases"), F.sum("controls")
    return (ranked.groupBy(*by).agg((100 * wins / (n1 * n0)).alias("auc"), n1.alias("cases"), n0.alias("controls"))
            .filter("cases > 0 AND controls > 0"))


def roc_curve(df: DataFrame, by: list[str], score: str = "value", points: int = 100) -> DataFrame:
    """Sensitivity and specificity at ``points`` evenly spaced thresholds from the least to the greatest score.

    A score at or above the threshold is called positive. Each distinct score is filed under the last threshold it
    reaches, so only ``points`` rows per group are accumulated.
    """
    counts = _classes(df, score, by)
    ranges = counts.groupBy(*by).agg(F.min("score").alias("lo"), F.max("score").alias("hi"),
                                     F.sum("cases").alias("n1"), F.sum("controls").alias("n0"))
    steps = points - 1
    threshold = lambda i: F.when(i >= steps, F.col("hi")).otherwise(F.col("lo") + i * ((F.col("hi") - F.col("lo")) / steps))
    joined = same_join(counts, ranges.drop("n1", "n0"), by)
    near = F.when(F.col("hi") > F.col("lo"), F.floor((F.col("score") - F.col("lo")) / (F.col("hi") - F.col("lo")) * steps)).otherwise(steps)
    # the quotient may be off by one unit in the last place: settle it against the thresholds themselves
    filed = (joined.withColumn("i", F.least(near, F.lit(steps)))
             .withColumn("i", F.when((F.col("i") < steps) & (threshold(F.col("i") + 1) <= F.col("score")), F.col("i") + 1)
                         .when((F.col("i") > 0) & (threshold(F.col("i")) > F.col("score")), F.col("i") - 1).otherwise(F.col("i")))
             .groupBy(*by, "i").agg(F.sum("cases").alias("cases"), F.sum("controls").alias("controls")))
    grid = ranges.select(*by, "lo", "hi", "n1", "n0", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(steps).cast("bigint"))).alias("i"))
    full = same_join(grid, filed, [*by, "i"], "left").na.fill(0, ["cases", "controls"])
    rest = W.partitionBy(*by).orderBy("i").rowsBetween(0, W.unboundedFollowing)
    return (full.withColumn("threshold", threshold(F.col("i")))
            .withColumn("tp", F.sum("cases").over(rest)).withColumn("fp", F.sum("controls").over(rest))
            .filter("n1 > 0 AND n0 > 0")
            .select(*by, "i", "threshold", (1 - F.col("fp") / F.col("n0")).alias("specificity"),
                    (F.col("tp") / F.col("n1")).alias("sensitivity")))


def roc_long(curve: DataFrame, by: list[str]) -> DataFrame:
    """ROC table with one row per threshold and measure."""
    return curve.unpivot([*by, "i", "threshold"], ["specificity", "sensitivity"], "measure", "value")


def density(df: DataFrame, by: list[str], score: str = "value", bins: int = 50) -> DataFrame:
    """Histogram density per class over the common range of a group."""
    rows = df.filter(F.col(score).isNotNull())
    ranges = rows.groupBy(*by).agg(F.min(score).alias("lo"), F.max(score).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    slot = F.when(width > 0, F.least(F.floor((F.col(score) - F.col("lo")) / width), F.lit(bins - 1))).otherwise(0)
    counted = same_join(rows, ranges, by).groupBy(*by, "cls", "lo", "hi", slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    whole = F.sum("n").over(W.partitionBy(*by, "cls"))
    return counted.select(*by, "cls", "bin", (F.col("lo") + F.col("bin") * width).alias("bin_start"), "n",
                          F.when(width > 0, F.col("n") / (whole * width)).alias("density"))
