"""Line dedup against a plain loop; filters and index through insertions and deletions."""

import random

import numpy as np
import pytest

import __spark_entry__ as entry
from checks.compare import compare, duck_connection
from locusflow.llm import lines
from locusflow.llm.cuckoo import Cuckoo

SF = "/root/testdata/sf0.001"


def key(line):
    k = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    return k if len(k) >= 20 else None


def plain(rows, min_docs=3):
    """``(id, text, n_lines, n_dropped)`` of every row; a missing id is smaller than all others."""
    held = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if key(line) is not None:
                held.setdefault(key(line), set()).add(-1 if i is None else i)
    out = []
    for i, text in rows:
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if key(x) is None or len(held[key(x)]) < min_docs or max(held[key(x)]) == (-1 if i is None else i)]
        out.append((-1 if i is None else i, "\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return sorted(out)


def found(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect())


def corpus(n=120, seed=3):
    rng = random.Random(seed)
    pool = [f"Shared line number {k} of the corpus {'é' * (k % 3)}" for k in range(40)] + ["short", "", "éééééééééééééééééééé", "ééééééééééééééééééé"]
    rows = []
    for i in range(n):
        own = [f"own line {i} {j} {rng.random()}" for j in range(rng.randrange(4))]
        some = [rng.choice([str.upper, str, lambda s: f"\t {s} \r", lambda s: s + "\x0b"])(rng.choice(pool)) for _ in range(rng.randrange(12))]
        both = own + some + some[:2]
        rng.shuffle(both)
        rows.append((i, "\n".join(both)))
    return rows


SHAPE = "doc_id bigint, text string"


def test_lines_like_a_plain_loop(spark, tmp_path, monkeypatch):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    hot = "The one line that stands in every third document"
    rows = corpus() + [(200 + i, f"{hot}\n{hot}\nx") for i in range(60)] + [(None, hot), (None, "first own line of nobody"), (None, None), (300, None), (301, ""),
             (302, "\n\n"), (303, (hot + "\n") * 20_000 + "end"), (200, f"{hot}\nanother text of one id"), (201, f"{hot}\n{hot}\nx"), (-5, hot)]
    docs = spark.createDataFrame(rows, SHAPE)
    want = plain(rows)
    assert found(lines.deduplicate_lines(docs)) == want
    clash = docs.selectExpr("doc_id", "text", "'a' AS hi", "1 AS lo", "2 AS n_docs", "3 AS last", "'x' AS id", "0 AS th", "1 AS shard", "2 AS n_lines", "9 AS keys")
    assert found(lines.deduplicate_lines(clash)) == want
    monkeypatch.setattr(lines, "FILTER_BYTES", 0)  # filters too large: every line is joined
    assert found(lines.deduplicate_lines(docs)) == want
    monkeypatch.setattr(lines, "SHARD_KEYS", 4)
    assert found(lines.deduplicate_lines(docs)) == want


def test_nothing_to_read(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    assert found(lines.deduplicate_lines(spark.createDataFrame([], SHAPE))) == []
    assert found(lines.deduplicate_lines(spark.createDataFrame([(None, None)], SHAPE))) == [(-1, "", 1, 0)]


@pytest.mark.parametrize("shard_keys", [65_536, 5])
def test_index_grows_and_shrinks_reversibly(spark, tmp_path, monkeypatch, shard_keys):
    monkeypatch.setattr(lines, "SHARD_KEYS", shard_keys)
    spark.sparkContext.setCheckpointDir(str(tmp_path / "c"))
    rows = corpus(90)
    a, b = spark.createDataFrame(rows[:50], SHAPE), spark.createDataFrame(rows[30:], SHAPE)
    first = lines.LineIndex.of(a)
    both = first.insert(b)  # 20 documents are known already
    everything = spark.createDataFrame(rows, SHAPE)
    assert found(both.deduplicated(everything)) == plain(rows)
    back = both.delete(spark.createDataFrame([(i,) for i in range(50, 95)], "doc_id bigint"))
    assert found(back.deduplicated(a)) == plain(rows[:50])
    state = lambda x: (sorted(map(tuple, x.refs.select("hi", "lo", "n_docs", "last").collect())), sorted(map(tuple, x.holders.collect())))
    assert state(back) == state(first)
    repeated = [(r.hi, r.lo) for r in back.refs.filter("n_docs >= 3").collect()]
    assert back.asker()(np.array(repeated)).all()
    entries = sum(int((Cuckoo.of_bytes(r["filter"]).buckets > 0).sum()) for r in back.filters.collect())
    assert entries == len(repeated)
    none = back.delete(a.select("doc_id"))
    assert none.refs.count() == 0 and none.holders.count() == 0
    assert sum(int((Cuckoo.of_bytes(r["filter"]).buckets > 0).sum()) for r in none.filters.collect()) == 0
    back.save(str(tmp_path / "kept"))
    assert found(lines.LineIndex.load(spark, str(tmp_path / "kept")).insert(b).deduplicated(everything)) == plain(rows)


def test_cuckoo_filter_holds_and_forgets():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 7, 1000, 52_000):
        members, others = rng.integers(-2**63, 2**63 - 1, n), rng.integers(-2**63, 2**63 - 1, 20_000)
        held = Cuckoo.of_bytes(Cuckoo.holding(members).to_bytes())
        assert held.contains(members).all() and held.contains(others).mean() < 0.001
        held.delete(members[::2])
        assert held.contains(members[1::2]).all()
        assert held.insert(members[::2]) and held.contains(members).all()
        held.delete(members)
        assert not held.buckets.any()
    small = Cuckoo.sized(8)
    assert not small.insert(rng.integers(-2**63, 2**63 - 1, 100))
    with pytest.raises(ValueError):
        Cuckoo.sized(4).delete(np.array([5]))


def test_query_equals_sql(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    ok, note = compare(spark, SF, entry.queries()["op12_line_dedup"], entry.oracle_sql()["op12_line_dedup"], duck_connection(SF))
    assert ok, note
