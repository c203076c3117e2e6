"""Hard negatives against all pairs; the tree against plain windows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.compare import compare, duck_connection
from locusflow.llm import negatives

SF = "/root/testdata/sf0.001"
SHAPE = "vec_id bigint, embedding array<double>, label int"


def plain(rows, every=5):
    ints = {}
    for i, v, label in sorted((r for r in rows if r[0] is not None and r[2] is not None and r[1]), key=lambda r: (r[0], r[2])):
        if all(x is not None and math.isfinite(x) for x in v) and sum((256 * x) * (256 * x) for x in v) < 2.0 ** 61:
            ints.setdefault(i, ([math.floor(256 * x) for x in v], label))
    out = []
    for a, (va, la) in ints.items():
        if a % every:
            continue
        scores = sorted((-sum(p * q for p, q in zip(va, v, strict=True)), i, label) for i, (v, label) in ints.items() if i != a and len(v) == len(va))
        for s, p, _ in [x for x in scores if x[2] == la][:5]:
            hard = [(x, n) for x, n, label in scores if label != la and 50 * -s <= 100 * -x <= 95 * -s][:3]
            out += [(a, p, k + 1, n, -s, -x) for k, (x, n) in enumerate(hard)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def vectors(n=500, dim=12, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, dim))
    return [(i, [float(x) for x in centres[i % 9] + rng.normal(size=dim) * 0.5], int(rng.integers(0, 4))) for i in range(n)]


@pytest.mark.parametrize("shard, anchors", [(4096, 8192), (64, 20)])
def test_negatives_like_all_pairs(spark, tmp_path, monkeypatch, shard, anchors):
    monkeypatch.setattr(negatives, "SHARD", shard)
    monkeypatch.setattr(negatives, "ANCHORS", anchors)
    monkeypatch.setattr(negatives, "LEAF", 16)
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    rows = vectors()
    rows += [(600 + i, rows[5][1], i % 2) for i in range(150)]  # one very common vector, ties everywhere
    rows += [(800, None, 1), (805, [0.0] * 12, 1), (810, [float("nan")] * 12, 1), (815, [None] * 12, 2), (820, rows[3][1], None), (825, [], 1), (830, [float("inf")] * 12, 0),
             (835, [1e300] * 12, 0), (840, rows[0][1][:6], 0), (841, rows[0][1][:6], 0), (842, [0.8 * x for x in rows[0][1][:6]], 1), (845, [1e6 * x for x in rows[1][1]], 2),
             (846, [0.6e6 * x for x in rows[1][1]], 1), (847, [1.1e6 * x for x in rows[1][1]], 2), (None, rows[1][1], 1), (-5, rows[2][1], 3),
             (10, rows[10][1], rows[10][2]), (850, rows[7][1], 9)]
    df = spark.createDataFrame(rows, SHAPE)
    want = plain(rows)
    assert len(want) > 300
    assert found(negatives.hard_negatives(df, F.col("vec_id") % 5 == 0)) == want
    if shard == 64:
        clash = df.withColumns({c: F.lit(1) for c in ("id", "v", "asks", "dim", "shard", "rank", "score", "anchor", "positive", "chunk", "r")})
        assert found(negatives.hard_negatives(clash, F.col("vec_id") % 5 == 0)) == want


def test_nothing_to_mine(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    for rows in ([], [(0, [1.0], 1)], [(1, [1.0], 1), (2, [0.7], 2)], [(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [0.0, 1.0], 2)]):
        assert found(negatives.hard_negatives(spark.createDataFrame(rows, SHAPE), F.col("vec_id") % 5 == 0)) == []


def test_tree_finds_the_best_of_every_window_and_skips_subtrees():
    rng = np.random.default_rng(6)
    x = np.floor(256 * (rng.normal(size=(40, 6))[rng.integers(0, 40, 3000)] + 0.05 * rng.normal(size=(3000, 6)))).astype(np.int64)
    ids = rng.permutation(3000)
    tree = negatives.Tree(x, ids)
    scores = x[:200] @ x.T
    low = np.quantile(scores, 0.6, axis=1).astype(np.int64)
    high = np.quantile(scores, 0.95, axis=1).astype(np.int64)
    wanted = negatives.Wanted(x[:200], ids[:200], np.arange(200), low, high, 3)
    looked = []
    leaf = tree._leaf
    tree._leaf = lambda members, rows, w: (looked.append(len(members) * len(rows)), leaf(members, rows, w))
    tree.search(np.arange(200), wanted)
    for i in range(200):
        ok = [(-s, n) for s, n in zip(scores[i], ids, strict=True) if low[i] <= s <= high[i] and n != ids[i]]
        assert [(-s, n) for s, n in zip(wanted.scores[i], wanted.found[i], strict=True)] == sorted(ok)[:3]
    assert sum(looked) < 0.5 * 200 * 3000


def test_query_equals_sql(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    ok, note = compare(spark, SF, entry.queries()["op11_hard_negatives"], entry.oracle_sql()["op11_hard_negatives"], duck_connection(SF))
    assert ok, note
