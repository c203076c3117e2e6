"""Repeated strings against a brute-force count of all windows."""

import hashlib
import random
from collections import defaultdict

import pytest

from locusflow.llm import repeats

SF = "/root/testdata/sf0.01"


def brute(texts, min_len, keep_first=False):
    places = defaultdict(list)
    data = [(t or "").encode() for t in texts]
    for i, t in enumerate(data):
        for s in range(len(t) - min_len + 1):
            places[hash(t[s:s + min_len])].append((i, s))
    gone = [bytearray(len(t)) for t in data]
    for found in places.values():
        if len(found) > 1:
            for i, s in sorted(found)[1 if keep_first else 0:]:
                gone[i][s:s + min_len] = b"\1" * min_len
    out = {}
    for i, (t, g) in enumerate(zip(data, gone, strict=True)):
        kept = bytes(b for b, x in zip(t, g, strict=True) if not x)
        spans = sum(1 for k in range(len(g)) if g[k] and (k == 0 or not g[k - 1]))
        out[i] = (len(t), sum(g), spans, hashlib.sha256(kept).hexdigest())
    return out


def texts_with_copies():
    rng = random.Random(3)
    word = lambda n: " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 8))) for _ in range(n))
    passage, page = word(120), word(400)
    out = [None, "", "short", "a" * 1500, "a" * 399, "ab" * 600, page, page, page[:900] + "X" + page[901:], page[37:], word(600)]
    out += [word(rng.randint(5, 80)) + passage[rng.randint(0, 9):] + word(rng.randint(5, 80)) for _ in range(40)]
    out += [passage[:399], passage[:400], passage[:401] + " x " + passage[:401], "é" * 500, word(30) + "\n" + "line of text\n" * 60]
    return out


@pytest.mark.parametrize("keep_first", [False, True])
def test_repeats_equal_brute_force(spark, tmp_path, monkeypatch, keep_first):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    texts = texts_with_copies()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, n_bytes string").repartition(3)
    # by text order of ids: equal texts under different ids are told apart by id
    want = brute(texts, 400, keep_first)
    for hot in (4096, 3):
        monkeypatch.setattr(repeats, "HOT_CONTEXTS", hot)
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(docs, keep_first=keep_first).collect()}
        assert got == want


def test_repeats_on_documents(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    want = brute([r.text for r in rows], 400)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(docs).collect()}
    assert got == {r.doc_id: want[i] for i, r in enumerate(rows)}


def test_repeated_rows_null_ids_and_segments(spark, tmp_path, monkeypatch):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    monkeypatch.setattr(repeats, "SEGMENT", 700)
    rng = random.Random(5)
    page = "".join(rng.choice("abcdefgh ") for _ in range(5000))
    rows = [(1, page), (1, page), (None, "x" + page[100:4000]), (None, "y" * 50), (2, "z" + page[1:])]
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in
                 repeats.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got == [(0, 50, 0), (0, 3901, 3900), (1, 5000, 5000), (1, 5000, 5000), (2, 5000, 4999)]
    assert repeats.remove_repeats(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
