"""Links and components of embeddings against all pairs; graph recall."""

import numpy as np

from locusflow.llm import embeddings

SF = "/root/testdata/sf0.01"


def brute(rows, least=0.93):
    ok = [i for i, (_, v, label) in enumerate(rows) if label is not None and v and all(x is not None for x in v)
          and np.isfinite(v).all() and np.any(np.array(v, float))]
    n, up = [0] * len(rows), list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for x, i in enumerate(ok):
        a = np.array(rows[i][1], float)
        for j in ok[:x]:
            b = np.array(rows[j][1], float)
            if rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= least:
                n[i], n[j] = n[i] + 1, n[j] + 1
                p, q = sorted((root(i), root(j)))
                up[q] = p
    least_id = {}
    for i, r in enumerate(rows):
        least_id[root(i)] = min(least_id.get(root(i), r[0]), r[0])
    return sorted((r[0], n[i], least_id[root(i)], least_id[root(i)] == r[0]) for i, r in enumerate(rows))


def test_links(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    rows = []
    for i in range(500):
        v = centres[i % 12] + rng.normal(size=16) * (0.1 + 0.05 * (i % 7))
        rows.append((i, [float(np.float32(x)) for x in v], i % 3))
    rows += [(500 + i, rows[5][1], rows[5][2]) for i in range(30)] + [(600, None, 1), (601, [0.0] * 16, 1), (602, [float("nan")] * 16, 1),
             (603, rows[0][1], None), (604, [], 0), (605, [None] * 16, 1), (606, rows[0][1][:8], 0), (607, [x * 3 for x in rows[0][1]], 0)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    for shard in (8192, 60):
        got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.near_embeddings(frame, shard=shard).collect())
        assert got == brute(rows)
    assert embeddings.near_embeddings(frame.limit(0)).count() == 0


def test_graph_recall():
    rng = np.random.default_rng(5)
    v = rng.normal(size=(3000, 32)) + 3 * rng.normal(size=(60, 32))[rng.integers(0, 60, 3000)]
    v /= np.linalg.norm(v, axis=1)[:, None]
    graph = embeddings.Graph(v)
    found, recall, _ = graph.audited(v, 0.93, 0.99)
    truth = v @ v.T >= 0.93
    assert sum(map(len, found)) >= 0.97 * truth.sum() and recall >= 0.99


def test_table(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in table.collect()]
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.near_embeddings(table).collect())
    assert got == brute(rows)
