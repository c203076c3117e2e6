"""Personal data against the plain patterns; reliabilities on planted votes."""

import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from locusflow.llm import personal

KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def good(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        if not 13 <= len(digits) <= 19:
            return False
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    text = text or ""
    return [(k, m.start(), m.end()) for k, p in KINDS.items() for m in re.finditer(p, text) if good(k, m[0])]


TEXTS = [None, "", "a@b.c", "a@b.co_x@y.zz.", "x..%+@h-.a..b", "mail: joe.x@mail.example.com, 1.2.3.4.5 and 256.1.1.1 1.1.1.001", "é😀 é@é.com a@é.fr é.x@b.de",
         "4111 1111 1111 1111 and 4111-1111-1111-1112", "+1 (988) 555-2485 or", "+4 12 ++49 30 123456789 +1", "00000000000000.1.2.3", "1" * 50000,
         "a" * 50000 + "@", "a.b@" * 3000, "1 " * 20000, "+" * 3000 + "1 2", "call (555) 234-5678 ssn 123-45-6789", "IBAN DE89 3704 0044 0532 0130 00 ok",
         "a@b.c" * 5, "1.2.3.4" * 4, "5500000000000004+15551234567"]


def test_spans(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    rng = random.Random(7)
    texts = TEXTS + ["".join(rng.choice("a.@+-1 (%)23é") for _ in range(120)) for _ in range(300)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, spans string")
    got = {r.doc_id: r for r in personal.scan_personal(docs).collect()}
    for i, t in enumerate(texts):
        want = brute(t)
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert got[i].base_sha256 == hashlib.sha256(text.encode()).hexdigest(), (t or "")[:80]
        assert [got[i][f"n_{k}"] for k in KINDS] == [sum(w[0] == k for w in want) for k in KINDS]
        assert got[i].spans.startswith(text)
    assert "tel:5:19" in got[16].spans and "ssn:24:35" in got[16].spans and "iban:5:32" in got[17].spans
    assert personal.scan_personal(docs.limit(0)).count() == 0


def test_reliabilities_of_planted_votes():
    rng = random.Random(1)
    truth, seen = [0.95, 0.85, 0.7, 0.6], {}
    for _ in range(20000):
        real = rng.random() < 0.6
        votes = tuple((1 if real else -1) * (1 if rng.random() < a else -1) for a in truth)
        seen[votes] = seen.get(votes, 0) + 1
    patterns = [("email", v, n) for v, n in sorted(seen.items())]
    model = personal.estimate(patterns)
    assert all(abs(a - b) < 0.05 for a, b in zip(model["accuracy"], truth, strict=True))
    w = personal.train_span_classifier(patterns, model["posterior"])
    assert w[0] > w[1] > w[2] > w[3] > 0


def test_many_matches_in_one_text_cost_linear_time(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    n = 100_000
    text = " ".join(f"mail a{i}@b.com" for i in range(n))
    began = time.time()
    row = personal.scan_personal(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert time.time() - began < 120 and row.n_email == n
    spans = [f"email:{m.start()}:{m.end()}" for m in re.finditer(r"a\d+@b\.com", text)]
    assert row.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()


def test_places_and_surroundings_over_block_borders(spark):
    rng = random.Random(4)
    text = "".join(rng.choice(["x1@y.de", "1.2.3.4", " ", "é", "call ", "ab", "-"]) for _ in range(20_000))
    for kind in ("email", "ip", "card"):
        got = spark.createDataFrame([(text,)], "t string").select(personal._matches(F.col("t"), personal.BASE[kind], F.lit(True)).alias("m")).first().m
        assert len(got) > 300
        for m in got:
            assert text[m.start:m.end] == m.value and m.before == text[max(0, m.start - 32):m.start] and m.after == text[m.end:m.end + 1]
