"""Near-duplicate embeddings: navigable small-world graphs per shard, audited beams, cosine check, components."""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from locusflow.llm.components import connected_components
from locusflow.operators.scaling import checkpointed

SHARD = 8192  # vectors of a graph at most, about
DEGREE, BEAM, WIDTH = 16, 48, 4


def _beam(vectors, links, queries, entries, size):
    """Best ``size`` nodes for each query by a beam search over ``links``: ids (or -1) and similarities, best first."""
    n, q = len(vectors), len(queries)
    ids, sims = np.full((q, size), -1), np.full((q, size), -np.inf)
    done, seen = np.ones((q, size), bool), np.zeros((q, n), bool)
    rows = np.arange(q)[:, None]
    new = entries
    while True:
        near = np.einsum("qkd,qd->qk", vectors[np.maximum(new, 0)], queries)
        fresh = (new >= 0) & ~seen[rows, np.maximum(new, 0)]
        order = np.argsort(new, axis=1, kind="stable")  # a node reached twice counts once
        ranked = np.take_along_axis(new, order, 1)
        twice = np.zeros_like(fresh)
        np.put_along_axis(twice, order[:, 1:], ranked[:, 1:] == ranked[:, :-1], 1)
        fresh &= ~twice
        near = np.where(fresh, near, -np.inf)
        at, who = np.nonzero(fresh)
        seen[at, new[at, who]] = True
        all_ids, all_sims = np.concatenate([ids, np.where(fresh, new, -1)], 1), np.concatenate([sims, near], 1)
        all_done = np.concatenate([done, ~fresh], 1)
        best = np.argsort(-all_sims, axis=1, kind="stable")[:, :size]
        ids, sims, done = (np.take_along_axis(x, best, 1) for x in (all_ids, all_sims, all_done))
        rank = np.where(done, size, np.arange(size))
        pick = np.sort(rank, axis=1)[:, :WIDTH]
        active = pick < size
        if not active.any():
            return ids, sims
        chosen = np.where(active, np.take_along_axis(ids, np.minimum(pick, size - 1), 1), -1)
        at, k = np.nonzero(active)
        done[at, pick[at, k]] = True
        new = np.where(chosen[:, :, None] >= 0, links[np.maximum(chosen, 0)], -1).reshape(q, -1)


class Graph:
    """A hierarchical navigable small world over the rows of ``vectors`` (unit length)."""

    def __init__(self, vectors: np.ndarray, degree: int = DEGREE, beam: int = BEAM):
        self.vectors, self.degree = vectors, degree
        n = len(vectors)
        draw = (np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(11)).astype(float) / 2.0 ** 53
        level = np.minimum((-np.log(np.maximum(draw, 1e-12)) / np.log(degree)).astype(int), 4)
        if n:
            level[0] = level.max()
        self.layers = [np.full((n, 2 * degree), -1) for _ in range(level.max() + 1 if n else 1)]
        at, step = 1, 1
        while at < n:
            new = np.arange(at, min(n, at + step))
            entries = np.zeros((len(new), 1), int)
            for k in reversed(range(len(self.layers))):
                joins = level[new] >= k
                found, sims = _beam(vectors, self.layers[k], vectors[new], entries, beam if joins.any() else 4)
                entries = found[:, :4]
                if joins.any():
                    self._connect(k, new[joins], found[joins], sims[joins])
            at, step = at + len(new), min(256, step * 2)

    def _connect(self, k, new, found, sims):
        """Links new nodes of a layer with their nearest among the old and the new, both ways; full lists keep the nearest."""
        links, v = self.layers[k], self.vectors
        among = v[new] @ v[new].T
        np.fill_diagonal(among, -np.inf)
        ids, near = np.concatenate([found, np.broadcast_to(new, among.shape)], 1), np.concatenate([sims, among], 1)
        near = np.where(ids >= 0, near, -np.inf)
        best = np.argsort(-near, axis=1, kind="stable")[:, :self.degree]
        chosen = np.where(np.take_along_axis(near, best, 1) > -np.inf, np.take_along_axis(ids, best, 1), -1)
        links[new, :chosen.shape[1]] = chosen
        for a, row in zip(new.tolist(), chosen, strict=True):
            for b in row[row >= 0].tolist():
                back = links[b]
                if (back == a).any():
                    continue
                free = np.flatnonzero(back < 0)
                if len(free):
                    back[free[0]] = a
                else:  # the farthest goes, unless the new one is farther still; the second half of a list only is open
                    old = v[back[self.degree:]] @ v[b]
                    far = int(old.argmin())
                    if old[far] < v[a] @ v[b]:
                        back[self.degree + far] = a

    def near(self, queries: np.ndarray, least: float, beam: int) -> list[np.ndarray]:
        """For each query the nodes of at least ``least`` that a beam finds. A beam filled with such nodes is widened to all."""
        out = []
        for a in range(0, len(queries), 256):
            part = queries[a:a + 256]
            entries = np.zeros((len(part), 1), int)
            for k in reversed(range(1, len(self.layers))):
                entries = _beam(self.vectors, self.layers[k], part, entries, 4)[0]
            ids, sims = _beam(self.vectors, self.layers[0], part, entries, beam)
            full = sims[:, -1] >= least
            exact = iter(part[full] @ self.vectors.T if full.any() else ())
            out += [np.flatnonzero(next(exact) >= least) if f else i[s >= least] for f, i, s in zip(full, ids, sims, strict=True)]
        return out

    def audited(self, queries: np.ndarray, least: float, recall: float, audits: int = 64) -> tuple[list[np.ndarray], float, int]:
        """Neighbours, audited recall and beam: the beam doubles until the audited queries find ``recall`` of their true links."""
        beam, n = BEAM, len(self.vectors)
        sample = np.unique(np.linspace(0, len(queries) - 1, min(audits, len(queries))).astype(int))
        truth = queries[sample] @ self.vectors.T >= least
        while True:
            got = self.near(queries[sample], least, min(beam, n))
            found, true = sum(map(len, got)), int(truth.sum())
            if true == 0 or found >= recall * true or beam >= n:
                return self.near(queries, least, min(beam, n)), 1.0 if true == 0 else found / true, beam
            beam *= 2


def _components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node reachable by the links ``a - b``."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return label


def _prepared(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """``id, label, node`` (digest of label and vector) and the unit vector; null where the row links with nothing."""
    kinds = [vectors.schema[c].dataType.simpleString() for c in (id_col, label_col)]

    def prepare(batches):
        for batch in batches:
            nodes, units = [], []
            for label, parts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                node = unit = None
                if label is not None and parts and all(p is not None for p in parts):
                    v = np.array(parts, float)
                    top = np.abs(v).max()
                    if np.isfinite(v).all() and top > 0:
                        v = v / top
                        unit = (v / np.sqrt(v @ v)).tobytes()
                        node = hashlib.blake2b(repr(label).encode() + b"\0" + (np.array(parts, float) + 0.0).tobytes(), digest_size=16).digest()
                nodes.append(node)
                units.append(unit)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(nodes, pa.binary()), pa.array(units, pa.binary())],
                                             ["id", "label", "node", "unit"])

    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("v"))
    return rows.mapInArrow(prepare, f"id {kinds[0]}, label {kinds[1]}, node binary, unit binary")


def near_embeddings(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", least: float = 0.93,
                    recall: float = 0.99, shard: int = SHARD) -> DataFrame:
    """One row per row of ``vectors``: id, ``n_links``, ``component_id`` and ``kept``.

    Rows are linked when their labels are equal and their cosine in double precision is at least ``least``. Equal vectors
    are indexed once and count with their number. Every label is cut into shards of about ``shard`` vectors by digest; each
    has a graph, which every vector of the label asks; beams are widened until an audit finds ``recall`` of the true links.
    Vectors that are null, empty, zero or hold null or non-finite parts, and rows without label, have no link and stand for
    themselves; vectors of different lengths aren't compared; rows with a null id never name a component that has another;
    repeated rows are linked with each other; other columns are left out; an empty table gives no rows.
    """
    rows = checkpointed(_prepared(vectors, id_col, vec_col, label_col))
    nodes = checkpointed(rows.filter("node is not null").groupBy("node", "label", "unit").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
                         .withColumn("size", F.length("unit")))
    counts = nodes.groupBy("label", "size").agg(F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("shards"))
    counts = checkpointed(counts)
    placed = nodes.join(counts, ["label", "size"]).withColumn("shard", F.pmod(F.xxhash64("node"), F.col("shards")).cast("int"))
    label_type = nodes.schema["label"].dataType.simpleString()

    def build(key, part):
        part = part.sort_values("node")
        graph = Graph(np.frombuffer(b"".join(part["unit"]), float).reshape(len(part), -1))
        blob = pickle.dumps((list(part["node"]), part["copies"].to_numpy(), graph.vectors, [x.astype(np.int32) for x in graph.layers]))
        return pd.DataFrame({"label": [key[0]], "size": [key[1]], "shard": [key[2]], "graph": [blob]})

    graphs = checkpointed(placed.groupBy("label", "size", "shard").applyInPandas(build, f"label {label_type}, size int, shard int, graph binary"))
    pairs = (counts.select("label", "size", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "shards")
             .select("label", "size", "shard", F.explode(F.sequence(F.col("shard"), F.col("shards") - 1)).alias("other")))
    asked = (pairs.join(graphs, ["label", "size", "shard"])
             .join(graphs.select("label", "size", F.col("shard").alias("other"), F.col("graph").alias("asking")), ["label", "size", "other"]))

    def ask(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, copies, v, layers = pickle.loads(batch.column(0)[i].as_py())
                graph = Graph.__new__(Graph)
                graph.vectors, graph.layers, graph.degree = v, layers, DEGREE
                own = batch.column(2)[i].as_py()
                ids2, copies2, queries, _ = (ids, copies, v, layers) if own else pickle.loads(batch.column(1)[i].as_py())
                found, _, _ = graph.audited(queries, least, recall)
                b = np.repeat(np.arange(len(queries)), [len(f) for f in found])
                a = np.concatenate([*found, np.zeros(0, int)]).astype(int)
                exact = np.concatenate([np.einsum("nd,nd->n", v[a[k:k + 65536]], queries[b[k:k + 65536]])
                                        for k in range(0, len(a), 65536)] or [np.zeros(0)]) >= least
                a, b = a[exact], b[exact]
                if own:  # a link found from either side counts once
                    lo, hi = np.minimum(a, b), np.maximum(a, b)
                    pair = np.unique(lo[lo != hi] * len(ids) + hi[lo != hi])
                    a, b = pair // len(ids), pair % len(ids)
                    names, weight, shift = ids, copies, 0
                else:
                    names, weight, shift = ids + ids2, np.concatenate([copies, copies2]), len(ids)
                n = (np.bincount(a, weight[b + shift], len(names)) + np.bincount(b + shift, weight[a], len(names))).astype(int)
                head = _components(len(names), a, b + shift)
                linked = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([names[x] for x in linked], pa.binary()), pa.array([names[x] for x in head[linked]], pa.binary()),
                                                  pa.array(n[linked], pa.int64())], ["a", "b", "n"])

    answers = checkpointed(asked.repartition("label", "size", "shard", "other").select("graph", "asking", (F.col("shard") == F.col("other")).alias("own"))
                           .mapInArrow(ask, "a binary, b binary, n bigint"))
    component = connected_components(answers.select("a", "b"))
    links = answers.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    known = (nodes.select("node", "least", "copies").join(links, "node", "left").join(component, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    heads = checkpointed(known.groupBy("component").agg(F.min("least").alias("component_id")))
    by_node = checkpointed(known.join(heads, "component").select("node", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"))
    out = rows.select("id", "node").join(by_node, "node", "left")
    found = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), found.alias("component_id"),
                      found.eqNullSafe(F.col("id")).alias("kept"))
