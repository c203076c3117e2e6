"""Near copies against all pairs by exact Jaccard similarity; components against union-find."""

import random
import re

import numpy as np
import zstandard

from locusflow.llm import neardup
from locusflow.llm.components import connected_components

SF = "/root/testdata/sf0.01"


def shingle_set(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def classes(texts):
    sets, up = [shingle_set(t) for t in texts], list(range(len(texts)))

    def root(i):
        while up[i] != i:
            i = up[i] = up[up[i]]
        return i

    index = {}
    for i, s in enumerate(sets):
        near = {}
        for x in s:
            for j in index.setdefault(x, []):
                near[j] = near.get(j, 0) + 1
            index[x].append(i)
        for j, common in near.items():
            if common / (len(s) + len(sets[j]) - common) >= 0.8:
                a, b = sorted((root(i), root(j)))
                up[b] = a
        if not s:
            for j in range(i):
                if not sets[j]:
                    a, b = sorted((root(i), root(j)))
                    up[b] = a
    return [root(i) for i in range(len(texts))]


def test_probability_jaccard():
    rng = np.random.default_rng(1)
    a, b = rng.integers(1, 1 << 62, 300).astype(np.uint64), rng.integers(1, 1 << 62, 60).astype(np.uint64)
    one, two = a, np.concatenate([a[:240], b])
    w1, w2 = np.ones(300), np.full(300, 3.0)
    sig = neardup.sketch(np.concatenate([one, two]), np.concatenate([w1, w2]), np.array([0, 300, 600]), 4096)
    assert abs((sig[0] == sig[1]).mean() - 240 / 360) < 0.03
    w1[:30] = 5.0  # unequal weights: the sum over common elements of 1 / sum max(a_j/a_i, b_j/b_i)
    x, y = dict(zip(one.tolist(), w1)), dict(zip(two.tolist(), w2))
    want = sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in x.keys() | y.keys()) for i in x.keys() & y.keys())
    sig = neardup.sketch(np.concatenate([one, two]), np.concatenate([w1, w2]), np.array([0, 300, 600]), 4096)
    assert abs((sig[0] == sig[1]).mean() - want) < 0.03


def test_components(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)]
    edges += [(5000, 5000 + i) for i in range(200)] + [(7, 7)]
    up = {}

    def root(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            up[b] = a
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: root(i) for i in up}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_near_copies_equal_all_pairs(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    rng = random.Random(4)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(500)]
    page = [rng.choice(vocab) for _ in range(300)]
    texts = [None, "", "!!", "one two", "One, two", "a b c d e", " ".join(page), " ".join(page), " ".join(page).upper()]
    for edits in (2, 4, 6, 8, 9, 10, 12, 15):
        for _ in range(8):
            copy = list(page)
            for at in rng.sample(range(300), edits):
                copy[at] = "x" + rng.choice(vocab)
            texts.append(" ".join(copy))
    texts += [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 200))) for _ in range(60)] + ["w " * 40000, "w " * 40 + "end of"]
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id bigint, text string, class_id int").repartition(3)
    got = {r.doc_id: r for r in neardup.near_duplicates(docs).collect()}
    want = classes(texts)
    assert [got[i].class_id for i in range(len(texts))] == want
    assert all(got[i].kept == (i == want[i]) for i in range(len(texts)))


def test_documents(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    want = classes([r.text for r in rows])
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
    assert got == {r.doc_id: rows[want[i]].doc_id for i, r in enumerate(rows)}


def test_passages_repeated_otherwise(spark, tmp_path):
    """Copies in which a passage stands 2, 4 and 16 times: the sets are alike, the counts are not."""
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    texts = []
    for times, edits in ((2, 6), (4, 4), (16, 0), (16, 2)):
        for _ in range(8):
            page = [word() for _ in range(400)]
            copy = page[:200] * times + page[200:]
            for at in rng.sample(range(len(copy) - 200, len(copy)), edits):
                copy[at] = word()
            texts += [" ".join(page), " ".join(copy)]
    want = classes(texts)
    assert want == [i - i % 2 for i in range(len(texts))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_equal_sets_of_few_shingles(spark, tmp_path):
    """Repeats of period 1 to 3, of different lengths, are one class each; so are longer periods."""
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    texts = ["buy now cheap " * 10, "buy now cheap " * 11, "w " * 40, "w " * 50, "w " * 7, "on off " * 9, "on off " * 30, "w w w w", "buy now cheap",
             "a b c d e f g " * 5, "a b c d e f g " * 9]
    want = classes(texts)
    assert want == [0, 0, 2, 2, 2, 5, 5, 7, 8, 9, 9]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in neardup.near_duplicates(docs).collect()}
    assert [got[i].class_id for i in range(len(texts))] == want
    assert all(got[i].kept == (i == want[i]) for i in range(len(texts)))
    assert {r.doc_id for r in neardup.one_of_each_class(docs).collect()} == set(want)


def test_null_and_repeated_ids(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    page = " ".join(f"word{i}" for i in range(100))
    rows = [(1, page), (1, page), (None, page + " tail"), (1, "other text of few words"), (None, None)]
    got = sorted((r.n_shingles, r.class_id or 0, r.kept) for r in
                 neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got == [(0, 0, True), (1, 1, True), (96, 1, False), (96, 1, False), (97, 1, True)]
    assert neardup.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_wide_bucket_loses_no_link_off_its_stars(spark):
    """Forty unlike members of one bucket, three of which are alike but never the most connected one."""
    rng, registers = np.random.default_rng(5), 320
    sigs = rng.integers(0, 256, (1300, registers), dtype=np.uint8)
    for x in (7, 9):
        sigs[x] = sigs[5]
    sigs[1200] = sigs[1100]
    rows = [(i.to_bytes(4, "big"), 100 + 30 * (i in (9, 1200)) + 60 * (i % 3 == 0 and i not in (9, 1200)), s.tobytes()) for i, s in enumerate(sigs)]
    words = rng.integers(0, 10**9, (1300, 110))
    words[[7, 9]], words[1200] = words[5], words[1100]
    words[7, 0] = words[9, 109] = 1
    packed = [(r[0], zstandard.compress(" ".join(map(str, w)).encode())) for r, w in zip(rows, words, strict=True)]
    table, texts = spark.createDataFrame(rows, "node binary, n long, sig binary"), spark.createDataFrame(packed, "node binary, packed binary")
    members = spark.createDataFrame([(1, n, 40) for n, *_ in rows[:40]] + [(2, n, 1260) for n, *_ in rows[40:]] + [(3, rows[0][0], 9)],
                                    "key long, node binary, k long")
    links, component = neardup.near_links(
        members, lambda pairs: neardup.verified(neardup.likely(pairs, table, registers, 0.8), texts, 5, 0.8),
        lambda wide: neardup.wide_links(wide, table, texts, registers, 5, 0.8))
    found = {tuple(int.from_bytes(x, "big") for x in r) for r in links.select("a", "b").collect()}
    assert len(found) >= 3 and found <= {(5, 7), (5, 9), (7, 9), (1100, 1200)}
    heads = {int.from_bytes(r[0], "big"): int.from_bytes(r[1], "big") for r in component.collect()}
    assert heads == {5: 5, 7: 5, 9: 5, 1100: 1100, 1200: 1100}
