"""Every stage of the pipeline against its own plain version, on the small tables."""

import re
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from locusflow.llm import secrets

from test_decontaminate import brute as leaks
from test_neardup import classes

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    extra = spark.createDataFrame([(None, None, None, None, None), (5, "", "en", "s", 0), (5, "", "en", "s", 0)],
                                  "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = [spark.read.parquet(f"{SF}/documents.parquet").unionByName(extra)]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return [df.collect() for df in out], [df.columns for df in out]


def test_columns_stay(stages):
    _, columns = stages
    assert all(c == columns[0] for c in columns[:-1])


def test_quality_stage(spark, stages):
    rows, _ = stages
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in rows[1]}
    good = [i for i, q in label.items() if q == 1]
    bad = [i for i, q in label.items() if q == 0]
    assert sum(i in kept for i in good) >= 0.98 * len(good) and sum(i in kept for i in bad) <= 0.1 * len(bad)


def test_near_duplicate_stage(stages):
    rows, _ = stages
    docs = sorted(rows[1], key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None))
    first = classes([r.text for r in docs])
    assert len(rows[2]) == len(set(first))
    by_id = {}
    for i, r in enumerate(docs):
        by_id.setdefault((r.doc_id, r.text), first[i])
    assert {by_id[r.doc_id, r.text] for r in rows[2]} == set(first)


def test_decontamination_stage(spark, stages):
    rows, _ = stages
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").collect()]
    found = {x[0] for x in leaks([r.text for r in rows[2]], items)}
    assert {r.doc_id for r in rows[3]} == {r.doc_id for i, r in enumerate(rows[2]) if i not in found} and found


def test_secret_stage(stages):
    rows, _ = stages
    before, after = {r.doc_id: r for r in rows[3]}, {r.doc_id: r for r in rows[4]}
    assert before.keys() == after.keys()
    owners, holders = {}, {}
    for r in rows[3]:
        for _, _, _, v in secrets.candidates(r.text or ""):
            owners.setdefault(v, set()).add(r.source)
            holders.setdefault(v, set()).add(r.doc_id)
    looks_live = lambda v: len(holders[v]) <= 5 or len(owners[v]) <= 3 and len(holders[v]) <= 100
    for i, r in before.items():
        live = sorted((s, e) for _, s, e, v in secrets.candidates(r.text or "") if looks_live(v))
        out, at = [], 0
        for s, e in live:
            if e > at:
                out += [(r.text)[at:s], "[secret]"] if s >= at else []
                at = e
        want = None if r.text is None else "".join([*out, r.text[at:]])
        assert after[i].text == want and after[i].n_chars == (None if want is None else len(want))
    assert any("[secret]" in (r.text or "") for r in rows[4])


def test_packing_stage(stages):
    rows, _ = stages
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for r in rows[5]:
        pieces.setdefault(r.doc_id, []).append(r)
    assert pieces.keys() == {r.doc_id for r in rows[4]}
    for d in rows[4]:
        ids, at = [*library.encode(d.text or "", add_special_tokens=False).ids, 2], 0
        for r in sorted(pieces[d.doc_id], key=lambda r: r.start):
            assert r.start == at and r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[at:at + r.length]))
            at += r.length
        assert at == len(ids) == r.doc_tokens


def test_run(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and re.match("doc_id", out.columns[0])
