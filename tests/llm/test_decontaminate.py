"""Spaced seeds against a comparison of every item with every place of every document."""

import itertools
import random
import re

from locusflow.llm import decontaminate


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())


def brute(docs, items, least=0.8):
    out = set()
    for i, t in enumerate(docs):
        w = split(t)
        for k, item in enumerate(items):
            x = split(item)
            if not x:
                continue
            for d in range(-len(x) + 1, len(w)):
                pairs = [(w[d + j], x[j]) for j in range(len(x)) if 0 <= d + j < len(w)]
                same = sum(a == b for a, b in pairs)
                if same >= least * len(x) - 1e-9:
                    out.add((i, k, max(d, 0), len(pairs), same))
    return out


def test_found_as_by_brute_force(spark, tmp_path, monkeypatch):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(5))
    items = [" ".join(word() for _ in range(rng.randint(15, 40))) for _ in range(12)] + ["too short item", None, "a b " * 10]
    docs = [None, "", "x", "a b " * 30, items[0], items[0]]
    for k in range(40):
        w = split(items[k % 12])
        for at in rng.sample(range(len(w)), k % 5 * len(w) // 18):
            w[at] = word()
        docs.append(" ".join(word() for _ in range(k * 7 % 50)) + " " + ", ".join(w).upper() + ". " + word())
    docs += [" ".join(split(items[1])[:-2]), items[2][: len(items[2]) // 2]]
    d = spark.createDataFrame([(i, t, 0) for i, t in enumerate(docs)], "doc_id bigint, text string, n_words int")
    b = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    want = brute(docs, items)
    for most in (500_000, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", most)
        got = {(r.id, r["item"], r.first_word, r.n_words, r.n_same) for r in decontaminate.contaminated(d, b).collect()}
        assert got == want
        left = {r.doc_id for r in decontaminate.without_contaminated(d, b).collect()}
        assert left == set(range(len(docs))) - {w[0] for w in want}
    assert decontaminate.contaminated(d.limit(0), b).count() == 0 and decontaminate.contaminated(d, b.limit(0)).count() == 0


def test_no_accepted_damage_without_a_seed():
    """All choices of the most words that may differ, for every length; beyond 20 words counting places is enough."""
    for n in range(1, 26):
        masks, changed = decontaminate.masks_for(n, 0.8), n // 5
        places = [{at + k for k in m} for m in masks for at in range(n - m[-1])]
        for hit in itertools.combinations(range(n), changed):
            assert any(p.isdisjoint(hit) for p in places), (n, hit)
        assert n < 5 or any(m[-1] + 1 > len(m) for m in masks)  # a mask that skips a place
    for n in range(21, 2000):
        assert decontaminate.masks_for(n, 0.8) == ((0, 1, 2, 4),) and n - 4 > 4 * (n // 5)


def test_every_place_of_items_of_any_length(spark, tmp_path, monkeypatch):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(7))
    items = [" ".join(word() for _ in range(n)) for n in range(1, 27)] + ["", None, "!!"]
    docs = []
    for n in range(1, 27):
        w = split(items[n - 1])
        hits = list(itertools.combinations(range(n), n // 5))
        lost = [h for h in ((0,), (1, 2), (5, 6, 7), (3, 7, 11)) if len(h) == n // 5 and h[-1] < n]
        for hit in lost + rng.sample(hits, min(len(hits), 12)):
            copy = [word() if k in hit else x for k, x in enumerate(w)]
            docs += [" ".join([word(), word(), *copy, word()])]
        cut = n // 5
        docs += [" ".join(w[cut:]), " ".join(w[:n - cut]), " ".join(w[:n - cut - 1])]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id bigint, text string")
    b = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    want = set()
    for i, t in enumerate(docs):
        w = split(t)
        for k, x in enumerate(map(split, items)):
            for at in range(-len(x) + 1, len(w)):
                pairs = [(w[at + j], x[j]) for j in range(len(x)) if 0 <= at + j < len(w)]
                same = sum(p == q for p, q in pairs)
                if x and same >= 0.8 * len(x) - 1e-9:
                    want.add((i, k, max(at, 0), len(pairs), same))
    for most in (500_000, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", most)
        got = {(r.id, r["item"], r.first_word, r.n_words, r.n_same) for r in decontaminate.contaminated(d, b).collect()}
        assert got == want
