"""Building blocks that keep plans even under skew: tiled running aggregates, bounded lists, checkpoints.

Equi-joins are left to the adaptive engine, which broadcasts a side only after measuring it and splits
hot partitions of either side over several tasks. What it cannot split - windows over a whole
chromosome or group, lists of a whole group - is cut into bounded pieces here.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

SLICE_ROWS = 250_000  # rows that one task scans in order, about


def checkpoint_folder(spark) -> str:
    """The folder named by ``spark.checkpoint.dir``; only a local-mode session that names none gets a temporary one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
            folder = tempfile.mkdtemp(prefix="locusflow-checkpoint-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage through the reliable checkpoint folder of the session."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=eager)


def spread(df: DataFrame, *by: str) -> DataFrame:
    """``df`` by hash over as many partitions as the session names (``spark.sql.shuffle.partitions``), which are not merged.

    The adaptive engine merges partitions up to a size in packed bytes. Rows of a few numbers and repeated names pack well, so
    sorting and grouping a merged partition takes far more memory than its size tells.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


class Landing:
    """Tables of an iteration, written as Parquet below the checkpoint folder and read back.

    A checkpoint keeps the size estimate of the plan that it cuts, so a state that is joined with something made of itself
    squares its estimate every round. A landed table has its true size, which joins may plan with. ``drop`` removes a table
    that no later plan reads, ``close`` all of them; both leave files of others alone.
    """

    def __init__(self, spark):
        self.spark, self.folder, self.made = spark, f"{checkpoint_folder(spark)}/landing-{uuid.uuid4().hex}", {}

    def land(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.made[id(out)] = (path, out)
        return out

    def drop(self, *landed: DataFrame) -> None:
        for df in landed:
            path, _ = self.made.pop(id(df))
            self._remove(path)

    def close(self) -> None:
        self.made.clear()
        self._remove(self.folder)

    def _remove(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def same_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """An equi-join on columns of the same names in which NULL equals NULL, so that a run without a tag is a run too."""
    named = right.select(*[F.col(c).alias(f"_same_{c}") if c in on else F.col(c) for c in right.columns])
    meets = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_same_{c}")) for c in on])
    return left.join(named, meets, how).drop(*[f"_same_{c}" for c in on])


_FOLD = {"sum": F.sum, "max": F.max, "min": F.min, "xor": F.bit_xor}
_REACH = {"upto": 0, "before": -1, "after": -1}


def _running(keys: list[str], order: list, reach: str):
    """The window of a running aggregate. ``after`` runs from the other end: Spark folds a frame that grows with its rows in
    one pass, but folds one that shrinks (up to unbounded following) anew for every row."""
    by = [F.col(c).desc_nulls_last() if reach == "after" else F.col(c).asc_nulls_first() for c in order]
    return W.partitionBy(*keys).orderBy(*by).rowsBetween(W.unboundedPreceding, _REACH[reach])


def whole_rows(df: DataFrame):
    """An aggregate ``_read`` that reads every column of ``df``.

    Window functions and totals over the same tiles can share one exchange, so that what lies below it is run once - but only
    if both ask for the same columns. With this in the totals the optimizer can't drop any from their side. The result must
    be used (``_read IS NOT NULL``), and ``df`` should have no column that the window side leaves unused.
    """
    return F.max(F.xxhash64(*df.columns)).alias("_read")


def tiled_scan(df: DataFrame, keys: list[str], tile: str | None, order: list[str], scans: dict) -> DataFrame:
    """Running aggregates within ``keys`` in ``order``, computed tile by tile.

    ``scans`` maps an output column to ``(fold, value, reach)`` with fold ``sum|max|min|xor`` and reach
    ``upto`` (rows up to and including this one), ``before`` or ``after``. ``tile`` must not decrease in
    ``order``. Each ``(keys, tile)`` group is one window partition and the tile totals are carried in a
    second, much smaller window, so no task ever sorts a whole key; both read ``df`` through one exchange.
    Without ``tile`` the window runs over ``keys`` alone.
    """
    parts = [*keys, tile] if tile else keys
    local = {}
    for out, (fold, value, reach) in scans.items():
        local[out] = _FOLD[fold](value).over(_running(parts, order, reach))
    if tile is None:
        return df.withColumns(local).withColumns({out: F.coalesce(F.col(out), F.lit(0))
                                                  for out, (fold, _, _) in scans.items() if fold == "sum"})
    dealt = df.repartition(*parts)
    totals = dealt.groupBy(*parts).agg(*[_FOLD[fold](value).alias(f"_t_{out}") for out, (fold, value, _) in scans.items()], whole_rows(df))
    carried = []
    for out, (fold, _, reach) in scans.items():
        window = _running(keys, [tile], "after" if reach == "after" else "before")
        carried.append(_FOLD[fold](f"_t_{out}").over(window).alias(f"_c_{out}"))
    joined = same_join(dealt.withColumns(local), totals.select(*parts, *carried, "_read"), parts).filter("_read IS NOT NULL")
    both = {}
    for out, (fold, _, _) in scans.items():
        if fold == "sum":
            both[out] = F.coalesce(F.col(out), F.lit(0)) + F.coalesce(F.col(f"_c_{out}"), F.lit(0))
        elif fold == "xor":
            both[out] = F.coalesce(F.col(out), F.lit(0)).bitwiseXOR(F.coalesce(F.col(f"_c_{out}"), F.lit(0)))
        else:
            both[out] = (F.greatest if fold == "max" else F.least)(F.col(out), F.col(f"_c_{out}"))
    return joined.withColumns(both).drop(*[f"_c_{out}" for out in scans], "_read")


def value_slices(df: DataFrame, keys: list[str], value: str, rows: int = SLICE_ROWS) -> DataFrame:
    """Add ``_tile``: consecutive slices of about ``rows`` rows in the order of ``keys`` and ``value``.

    Slices are cut by range over all groups together, so that their number follows the rows at every size and a group of
    any size spreads over as many as it needs. Rows should differ in ``keys`` and ``value``. The result is checkpointed,
    as a slice is named by its partition.
    """
    kept = checkpointed(df)
    slices = 1 + kept.count() // rows
    return checkpointed(kept.repartitionByRange(slices, *keys, value).withColumn("_tile", F.spark_partition_id()))


def value_lists(df: DataFrame, keys: list[str], value: str, part_size: int = 1000, together: bool = False) -> DataFrame:
    """All values of each group as lists, in parts of about ``part_size`` distinct values.

    A group of ordinary size is one row with ``part = 0``; a larger one takes ``parts`` rows, so that no
    cell or task ever holds an unbounded group. Equal values are stored once with their count. ``together`` says that the
    rows of a group lie in one partition already: groups are counted there, without a join.
    """
    distinct = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n_value"))
    parts = F.ceil(F.col("_n") / F.lit(part_size)).cast("int")
    if together:
        rows = distinct.withColumn("_n", F.count(F.lit(1)).over(W.partitionBy(*keys)))
        return _in_parts(rows.withColumn("parts", parts), keys, value)
    sizes = distinct.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    same = [F.col(f"d.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    rows = distinct.alias("d").join(sizes.alias("s"), same).select("d.*", F.col("s.n").alias("_n"))
    return _in_parts(rows.withColumn("parts", parts), keys, value)


def _in_parts(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    return (rows.withColumn("part", F.pmod(F.xxhash64(F.col(value)), F.col("parts")).cast("int"))
            .groupBy(*keys, "part", "parts")
            .agg(F.array_sort(F.collect_list(F.struct(value, "n_value"))).alias(f"{value}_list")))
