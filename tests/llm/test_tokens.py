"""Token counts and packing against the tokenizer library itself."""

import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from locusflow.llm import packing, token_counts, tokens

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "\n", "a", " a", "a ", "a  b", "a \n b", "a\n\n\nb c", "\ta b\t", "it's we'll DON'T x'", "a<|endoftext|>b", "é É ß Σας ΟΔΟΣ",
       "İstanbul I", "日本語 テスト 한국어", "a b", "x\x1cy", "a b", "é café", "😀 ok 👍🏽", "1234 5.6e-7 !!! %%% a|b",
       "w" * 5000, "ab " * 3000, "́x", "\r\n a\r\n", "a\tb c\t d", "<|startoftext|> A", "Ǆ ǅ ǆ ﬁ ½ Ⅷ ²", "\x85 z", "a\x0bb", "\x00\x01"]


@pytest.mark.parametrize("kind,path", [("byte", BYTE), ("word", WORD)])
def test_lookup_equals_library(kind, path):
    library, ids, counts = Tokenizer.from_file(path), tokens.TwoTier(path, kind, True), tokens.TwoTier(path, kind, False)
    for text in ODD:
        want = library.encode(text, add_special_tokens=False).ids
        assert ids(text) == b"".join(i.to_bytes(4, "little") for i in want), text
        assert counts(text) == len(want), text


def test_checked_characters_split_alike():
    library, lookup = Tokenizer.from_file(BYTE), tokens.TwoTier(BYTE, "byte", True)
    checked = [chr(c) for c in range(0x20, 0x3100) if not tokens._UNCHECKED.match(chr(c))]
    for c in checked:
        text = f"a{c}b 1{c}2 {c}{c} !{c}?"
        assert lookup(text) == b"".join(i.to_bytes(4, "little") for i in library.encode(text, add_special_tokens=False).ids), hex(ord(c))


def _frame(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, n_tokens string")


def test_counts(spark):
    texts = [None, *ODD, "same", "same"]
    library = Tokenizer.from_file(BYTE)
    got = {r.doc_id: r for r in token_counts.count_tokens(_frame(spark, texts), BYTE).collect()}
    for i, t in enumerate(texts):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((t or "").encode()), n > 512)
    assert token_counts.count_tokens(_frame(spark, []), BYTE).count() == 0


def test_packing_round_trip(spark):
    texts = [None, *ODD, *[f"word{i} " * (i * 37 % 900) for i in range(60)]]
    library = Tokenizer.from_file(WORD)
    rows = packing.pack_documents(_frame(spark, texts).repartition(3), WORD, block_tokens=20_000).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, t in enumerate(texts):
        ids, at = [*library.encode(t or "", add_special_tokens=False).ids, 2], 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            piece = b"".join(x.to_bytes(4, "little") for x in ids[r.start:r.start + r.length])
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(piece))
            at += r.length
        assert at == len(ids)
    short = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= pieces[0].window <= 4096
        short += at < pieces[0].window
    assert short <= 3 + sum(r.length for r in rows) // 20_000
    assert packing.pack_documents(_frame(spark, []), WORD).count() == 0


def test_steps_are_balanced():
    windows = packing.pack_lengths([i * 131 % 3000 + 1 for i in range(400)])
    steps = packing.step_groups(windows, 16)
    load = {}
    for (size, _), s in zip(windows, steps, strict=True):
        load[s] = load.get(s, 0) + size
    assert max(load.values()) <= 1.3 * min(load.values())
