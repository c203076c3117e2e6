"""Hard-negative mining by a multiway hyperplane tree whose split points know the distance ranges of all sibling subtrees."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from locusflow.operators.scaling import checkpointed

SHARD = 4096  # vectors of one tree, about
ANCHORS = 8192  # anchors that are broadcast at once, about
SPLITS, LEAF = 16, 128
NO_SCORE, NO_ID = -(1 << 62), np.iinfo(np.int64).max
_EXACT = float(1 << 52)  # products of vectors up to this squared length are exact in doubles


def _products(a: np.ndarray, b: np.ndarray, most: float) -> np.ndarray:
    """Integer inner products of the rows of ``a`` with those of ``b``, whose squared lengths are ``most`` at most."""
    if most <= _EXACT:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


class Tree:
    """Integer vectors in a tree that finds those whose inner product with a query lies in a window.

    A vector x gets one more component, sqrt(M - |x|^2) with M the largest squared length, and a query a zero, so that
    |a' - x'|^2 = |a|^2 + M - 2 a.x: a window of scores is an annulus around the query. A node takes up to 16 split points
    far from each other, gives every vector to its nearest and stores, for each split point and each subtree, the least and
    the largest distance between them. Leaves hold the vectors and are searched exactly; equal vectors share a leaf of any size.
    """

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        self.vectors, self.ids = vectors, ids
        self.norms = np.einsum("nd,nd->n", vectors, vectors)
        self.top = int(self.norms.max())
        self.lifts = np.sqrt((self.top - self.norms).astype(float))
        self.root = self._node(np.arange(len(ids)))

    def _apart(self, p: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Distances between two sets of vectors of the tree."""
        dot = self.vectors[p].astype(float) @ self.vectors[x].astype(float).T + self.lifts[p][:, None] * self.lifts[x]
        return np.sqrt(np.maximum(2.0 * (self.top - dot), 0.0))

    def _node(self, members: np.ndarray):
        if len(members) <= LEAF:
            return members
        some = members[np.unique(np.linspace(0, len(members) - 1, 4 * SPLITS).astype(int))]
        points = [int(some[0])]
        far = self._apart(some[:1], some)[0]
        while len(points) < SPLITS and far.max() > 1e-6 * np.sqrt(self.top):
            points.append(int(some[far.argmax()]))
            far = np.minimum(far, self._apart(np.array(points[-1:]), some)[0])
        points = np.array(points)
        apart = self._apart(points, members)
        nearest = apart.argmin(0)
        groups = [np.flatnonzero(nearest == j) for j in range(len(points))]
        if max(map(len, groups)) == len(members):
            return members
        groups = [g for g in groups if len(g)]
        low = np.array([apart[:, g].min(1) for g in groups]).T
        high = np.array([apart[:, g].max(1) for g in groups]).T
        return points, low, high, [self._node(members[g]) for g in groups]

    def search(self, rows: np.ndarray, wanted: Wanted) -> None:
        """Brings the best of these rows of ``wanted`` up to date with the vectors of this tree."""
        self._visit(self.root, rows, wanted)

    def _visit(self, node, rows: np.ndarray, wanted: Wanted) -> None:
        if not isinstance(node, tuple):
            for a in range(0, len(rows), 4096):
                self._leaf(node, rows[a:a + 4096], wanted)
            return
        points, low, high, children = node
        slack = 1e-6 * np.sqrt(float(self.top) + float(wanted.norms.max()))
        used, back = np.unique(wanted.anchor[rows], return_inverse=True)
        dot = _products(wanted.vectors[used], self.vectors[points], max(self.top, wanted.norms.max()))
        to_point = np.sqrt(np.maximum((wanted.norms[used] + self.top)[:, None] - 2.0 * dot, 0.0))[back]
        for j in np.argsort((to_point.argmin(1)[:, None] == np.arange(len(children))).sum(0))[::-1] if len(children) == len(points) else range(len(children)):
            inner, outer = wanted.annulus(rows, self.top)
            inner, outer = inner[:, None] - slack, outer[:, None] + slack
            meets = ((low[:, j] <= to_point + outer) & (high[:, j] >= np.maximum(to_point - outer, inner - to_point))).all(1)
            if meets.any():
                self._visit(children[j], rows[meets], wanted)

    def _leaf(self, members: np.ndarray, rows: np.ndarray, wanted: Wanted) -> None:
        used, back = np.unique(wanted.anchor[rows], return_inverse=True)
        for a in range(0, len(members), 1024):
            part = members[a:a + 1024]
            scores = _products(wanted.vectors[used], self.vectors[part], max(self.top, wanted.norms.max()))[back]
            ok = (scores >= wanted.least(rows)[:, None]) & (scores <= wanted.high[rows][:, None]) & (self.ids[part] != wanted.own[rows][:, None])
            hit = np.flatnonzero(ok.any(1))
            if len(hit):
                wanted.offer(rows[hit], np.where(ok[hit], scores[hit], NO_SCORE), np.where(ok[hit], self.ids[part], NO_ID))


class Wanted:
    """For each row (an anchor and a window of scores) the best vectors so far: highest score first, then the smaller id."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, anchor: np.ndarray, low: np.ndarray, high: np.ndarray, most: int):
        self.vectors, self.anchor, self.low, self.high, self.own = vectors, anchor, low, high, ids[anchor]
        self.norms = np.einsum("nd,nd->n", vectors, vectors)
        self.scores, self.found = np.full((len(anchor), most), NO_SCORE), np.full((len(anchor), most), NO_ID)

    def least(self, rows: np.ndarray) -> np.ndarray:
        """Scores below these can't be among the best any more."""
        return np.maximum(self.low[rows], self.scores[rows, -1])

    def annulus(self, rows: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
        both = (self.norms[self.anchor[rows]] + top).astype(float)
        least = self.least(rows)
        outer = np.where(least <= NO_SCORE, np.inf, np.sqrt(np.maximum(both - 2.0 * least, 0.0)))
        return np.sqrt(np.maximum(both - 2.0 * self.high[rows], 0.0)), outer

    def offer(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores[rows], scores], 1), np.concatenate([self.found[rows], ids], 1)
        best = np.lexsort((ids, -scores), axis=-1)[:, :self.scores.shape[1]]
        self.scores[rows], self.found[rows] = np.take_along_axis(scores, best, 1), np.take_along_axis(ids, best, 1)


def _vectors(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _groups(batches):
    """Label, ids and vectors of one tree after the other from rows in order of ``label, dim, shard``."""
    held, at = [], None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        keys = list(zip(*[table.column(c).to_pylist() for c in ("label", "dim", "shard")], strict=True))
        edge = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
        for a, b in zip(edge, edge[1:], strict=False):
            if a == b:
                continue
            if held and keys[a] != at:
                yield at[0], np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])
                held = []
            at = keys[a]
            held.append((table.column("id")[a:b].to_numpy(), _vectors(table.column("v")[a:b])))
    if held:
        yield at[0], np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])


def _searched(placed: DataFrame, anchors: dict, same: bool, most: int) -> DataFrame:
    """``anchor, positive, id, score``: the best of every task for each anchor and window.

    ``anchors`` has ``ids``, ``labels``, ``vectors`` (lists of arrays) and the windows ``anchor`` (a row of these), ``low``,
    ``high`` and ``positive``. A task searches its trees one after the other and returns what is best over all of them.
    """
    told = placed.sparkSession.sparkContext.broadcast(anchors)

    def search(batches):
        a = told.value
        sizes = np.array([len(v) for v in a["vectors"]])
        kept = []
        for dim in np.unique(sizes[a["anchor"]]) if len(a["anchor"]) else ():
            own = np.flatnonzero(sizes == dim)
            row = np.flatnonzero(sizes[a["anchor"]] == dim)
            kept.append((int(dim), row, Wanted(np.array([a["vectors"][i] for i in own]), a["ids"][own], np.searchsorted(own, a["anchor"][row]),
                                               a["low"][row], a["high"][row], most)))
        labels = np.array(a["labels"], object)
        for label, ids, vectors in _groups(batches):
            tree = None
            for dim, row, wanted in kept:
                if vectors.shape[1] != dim:
                    continue
                equal = labels[a["anchor"][row]] == label
                rows = np.flatnonzero(equal if same else ~equal)
                if len(rows):
                    tree = tree or Tree(vectors, ids)
                    tree.search(rows, wanted)
        for _, row, wanted in kept:
            at, k = np.nonzero(wanted.found != NO_ID)
            for x in range(0, len(at), 65_536):
                i, j = at[x:x + 65_536], k[x:x + 65_536]
                yield pa.RecordBatch.from_arrays([pa.array(a["ids"][a["anchor"][row[i]]]), pa.array(a["positive"][row[i]]), pa.array(wanted.found[i, j]),
                                                  pa.array(wanted.scores[i, j])], ["anchor", "positive", "id", "score"])

    return placed.select("label", "dim", "shard", "id", "v").mapInArrow(search, "anchor bigint, positive bigint, id bigint, score bigint")


def _best(found: DataFrame, most: int) -> DataFrame:
    # a task returns at most this many rows for an anchor and window, so a group has the number of tasks times that
    rank = F.row_number().over(W.partitionBy("anchor", "positive").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= most)


def hard_negatives(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                   n_positives: int = 5, n_negatives: int = 3, scale: int = 256) -> DataFrame:
    """For each anchor and each of its positives the hardest negatives within 50 to 95 % of the positive's score.

    ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``. Components become floor(``scale`` * x); a
    score is an integer inner product; higher scores come first, then smaller ids. Positives are the first ``n_positives``
    other rows of the anchor's label, negatives the first ``n_negatives`` rows of other labels with 50 * positive <= 100 *
    negative <= 95 * positive; fewer where there are fewer. A positive without any gives no row.

    Every row is in the tree of one shard of its label; trees hold about 4,096 vectors. About 8,192 anchors at a time are
    broadcast and ask all trees, so that nothing but results is shuffled. Rows with a null id or label, or a vector that is
    null, empty, has null or non-finite components or a squared length beyond 2^61 (whose scores fit no long), take no part;
    vectors of different lengths aren't compared; of several rows with one id the least by label and vector counts; an empty
    table gives no rows; other columns are left out.
    """
    x = F.transform(F.col("v"), lambda c: F.lit(float(scale)) * c)
    squared = F.aggregate(x, F.lit(0.0), lambda acc, c: acc + c * c)
    sound = F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("v"), anchor.alias("asks"))
            .filter("id IS NOT NULL AND label IS NOT NULL AND size(v) > 0").filter(sound).filter(squared < 2.0 ** 61)
            .select("id", F.struct("label", F.transform(x, lambda c: F.floor(c)).alias("v"), F.coalesce("asks", F.lit(False)).alias("asks")).alias("r"))
            .groupBy("id").agg(F.min("r").alias("r")).select("id", "r.*", F.size("r.v").alias("dim")))
    rows = checkpointed(rows)
    shards = rows.groupBy("label", "dim").agg((1 + F.floor(F.count(F.lit(1)) / SHARD)).cast("int").alias("shards"))
    placed = checkpointed(rows.join(shards, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("id"), "shards").cast("int"))
                          .repartition("label", "dim", "shard").sortWithinPartitions("label", "dim", "shard", "id")
                          .select("label", "dim", "shard", "id", "v", "asks"))
    asking = placed.filter("asks").select("id", "label", "v")
    chunks = 1 + asking.count() // ANCHORS
    asking = asking.withColumn("chunk", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(chunks)))

    def loaded(chunk: int) -> dict:
        got = asking.filter(F.col("chunk") == chunk).drop("chunk").orderBy("id").toArrow()
        return {"ids": got.column("id").to_numpy(), "labels": got.column("label").to_pylist(), "vectors": [np.array(v, np.int64) for v in got.column("v").to_pylist()]}

    def union(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def near(chunk: int) -> DataFrame:
        a = loaded(chunk)
        n = len(a["ids"])
        return _searched(placed, a | {"anchor": np.arange(n), "low": np.full(n, NO_SCORE), "high": np.full(n, -NO_SCORE), "positive": a["ids"]}, True, n_positives)

    positives = checkpointed(_best(union([near(c) for c in range(chunks)]), n_positives).select("anchor", F.col("id").alias("positive"), "score"))

    def hard(chunk: int) -> DataFrame:
        a = loaded(chunk)
        own = positives.withColumn("chunk", F.pmod(F.xxhash64(F.lit(1), "anchor"), F.lit(chunks))).filter(F.col("chunk") == chunk)
        got = own.select("anchor", "positive", "score").toArrow()
        anchor_id, positive, score = (got.column(i).to_numpy() for i in range(3))
        low, high = -(-score // 2), 19 * (score // 20) + 19 * (score % 20) // 20
        some = low <= high
        return _searched(placed, a | {"anchor": np.searchsorted(a["ids"], anchor_id[some]), "low": low[some], "high": high[some], "positive": positive[some]},
                         False, n_negatives)

    found = _best(union([hard(c) for c in range(chunks)]), n_negatives)
    return found.join(positives.withColumnRenamed("score", "positive_score"), ["anchor", "positive"]).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
