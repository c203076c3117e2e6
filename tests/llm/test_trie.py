"""The conversation trie against plain dictionaries; subtree totals of any tree; endings of any length."""

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.compare import compare, duck_connection
from locusflow.llm import trie

SF = "/root/testdata/sf0.001"
SHAPE = "conv_id bigint, turn int, role string, text string"
BLANK = " \t\n\x0b\x0c\r"


def plain(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((-1 if turn is None else turn, role or "", text or ""))
    own = {c: [x[1:] for x in sorted(t)] for c, t in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]  # the remainder has the sign of c, as in SQL
    nodes = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            nodes.setdefault(tuple(path[:d]), []).append(c)
    kids = {n: [] for n in nodes}
    for n in nodes:
        if n:
            kids[n[:-1]].append(n)
    totals = {}
    for n in sorted(nodes, key=len, reverse=True):
        words = len("".join(" " if x in BLANK else x for x in n[-1][1]).split(" ")) - "".join(" " if x in BLANK else x for x in n[-1][1]).split(" ").count("") if n else 0
        leaves, saved = (0 if kids[n] else 1), (len(nodes[n]) - 1) * words
        for k in kids[n]:
            leaves, saved = leaves + totals[k][0], saved + totals[k][1]
        totals[n] = (leaves, saved)
    out = []
    for n, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if len(paths[c]) == len(n))))
        out.append((min(members), len(n), min(nodes[n[:-1]]) if n else -1, len(members), len(kids[n]), *totals[n], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def found(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                  for r in df.collect())


def talk(n=300, seed=2):
    rng = random.Random(seed)
    said = ["hello  there", "what\tis it", "", None, "yes", "yes\n", "no no no", "ça va  bien"]
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, 7)):
            rows.append((c, t, rng.choice(["user", "assistant"]) if t else "user", said[min(int(rng.expovariate(0.7)), 7)]))
    return rows


def test_trie_like_plain_dictionaries(spark, tmp_path, monkeypatch):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    rows = talk() + [(None, 0, "user", "nobody"), (None, None, None, None), (1000, None, None, None), (1000, 0, "user", "x"), (1001, 3, "user", "tie"),
             (1001, 3, "user", "a tie"), (1001, 3, "user", "tie"), (1001, 3, "user", "tie"), (1002, None, "b", ""), (1002, None, "a", "z"), (-7, 0, "user", "hello  there"), (3001, 0, "user", "alone"), (3003, 0, "user", "alone"),
             (0, 0, "user", "again at zero"), (2000, 0, "user", "w " * 200_000)]
    rows += [(4000 + i, t, "user", f"deep {t}") for i in range(2) for t in range(20)]
    rows += [(5000 + i, 0, "user", "hello  there") for i in range(120)]  # one very common conversation
    df = spark.createDataFrame(rows, SHAPE)
    want = plain(rows)
    assert found(trie.conversation_trie(df)) == want
    monkeypatch.setattr(trie, "TILE", 3)
    clash = df.withColumns({c: F.lit(1) for c in ("c", "p", "k1", "g1", "m", "tile", "words", "o", "depth", "length", "n_convs", "_c_k1")})
    assert found(trie.conversation_trie(clash)) == want


def test_conversations_without_turns(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    short = [c for c in range(1, 200) if c % 20 and zlib.crc32(str(c).encode()) % 4 >= 1][:5]
    rows = [(c, 0, "user", "gone") for c in short]
    got = found(trie.conversation_trie(spark.createDataFrame(rows, SHAPE)))
    assert got == plain(rows) and len(got) == 1 and got[0][3] == 5
    assert found(trie.conversation_trie(spark.createDataFrame([], SHAPE))) == []
    assert found(trie.conversation_trie(spark.createDataFrame([(None, 1, "a", "b")], SHAPE))) == []


@pytest.mark.parametrize("kind", ["chain", "star", "random", "caterpillar"])
def test_subtree_totals(spark, tmp_path, kind):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    rng, n = random.Random(8), 90
    parent = {"chain": lambda i: i - 1, "star": lambda i: 0, "random": lambda i: rng.randrange(i), "caterpillar": lambda i: i - 1 if i % 2 else max(i - 2, 0)}[kind]
    up = [None] + [parent(i) for i in range(1, n)]
    total = [i * i + 1 for i in range(n)]
    for i in range(n - 1, 0, -1):
        total[up[i]] += total[i]
    rows = [(i, 7, up[i], None if up[i] is None else 7, i * i + 1, 1) for i in range(n)]
    df = spark.createDataFrame(rows, "k1 bigint, k2 bigint, p1 bigint, p2 bigint, a bigint, b bigint")
    got = {r.k1: (r.a, r.b) for r in trie.subtree_totals(df, ["a", "b"]).collect()}
    assert {k: v[0] for k, v in got.items()} == dict(enumerate(total)) and got[0][1] == n


def test_endings_of_many_blocks(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    ids = {1: [5], 2: list(range(-9000, 9000, 7)), 3: [-1, 0, 1 << 40], 4: [10, 9]}
    df = spark.createDataFrame([(k, 0, c) for k, cs in ids.items() for c in cs], "k1 bigint, k2 bigint, c bigint")
    got = {r.k1: r.ends for r in trie._endings(df).collect()}
    assert got == {k: hashlib.sha256(",".join(map(str, sorted(cs))).encode()).hexdigest() for k, cs in ids.items()}


def test_query_equals_sql(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    ok, note = compare(spark, SF, entry.queries()["op13_conversation_trie"], entry.oracle_sql()["op13_conversation_trie"], duck_connection(SF))
    assert ok, note
