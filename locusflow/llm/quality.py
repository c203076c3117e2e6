"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from locusflow.llm import words

BITS = 18
_U = np.uint64


def _shape_table() -> bytes:
    """Letters by case, digits and characters beyond ASCII as one sign each; white space as a blank; other signs as they are."""
    return bytes(ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 else ord("0") if 48 <= b <= 57
                 else ord("e") if b >= 128 else 32 if b in (9, 10, 11, 12, 13, 32) else b for b in range(256))


_SHAPES = _shape_table()


def _grams(hashes: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``n`` neighbours within a text, and each one's text."""
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    if len(hashes) < n:
        return hashes[:0], doc[:0]
    size = len(hashes) - n + 1
    out = hashes[:size].copy()
    for k in range(1, n):
        out = out * _U(0x9E3779B97F4A7C15) + hashes[k:k + size]
    same = doc[:size] == doc[n - 1:]
    return words.mix(out[same]), doc[:size][same]


def _shape_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the shape of every white-space separated word: runs of equal signs count as one sign."""
    data, at = words.joined([t.translate(_SHAPES) for t in texts])
    keep = np.concatenate([[True], data[1:] != data[:-1]]) | (data == 0)
    new_at = np.concatenate([[0], np.cumsum(keep)])[at]
    data = data[keep]
    start, end = words.runs((data != 32) & (data != 0))
    sums, down = words.prefix_sums(data)
    return words.span_hash(sums, down, start, end), np.searchsorted(start, new_at)


def _pieces(column: pa.Array):
    """``first, end, texts, before``: small pieces of a column of texts, and the last word before each piece in its slice of 1 MB."""
    for a, _, texts in words.slices(column, 1 << 20):
        for c, d in words.chunks(texts, 1 << 18):
            before = next((found[-1] for t in reversed(texts[:c]) if (found := words.words_of(t.decode()))), b"")
            yield a + c, a + d, texts[c:d], before


def features(texts: list[bytes], before: bytes = b"") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots, values and texts of all n-grams: words, word pairs, runs of up to three word shapes, and word repeats.

    The values of each kind add up to one in every text that has any, so that a score doesn't grow with the length.
    ``before`` is the word before the first one; it counts for repeats.
    """
    word, at = words.word_hashes(texts)
    shape, shape_at = _shape_hashes(texts)
    pair, pair_doc = _grams(word, at, 2)
    one, one_doc = _grams(word, at, 1)
    head, _ = words.word_hashes([before])
    again = np.where(np.concatenate([word[:1] == head if len(head) else [False], word[1:] == word[:-1]])[:len(word)], _U(1), _U(2))
    parts = [(one, one_doc), (pair, pair_doc), (words.mix(again), one_doc)]
    for n in (1, 2, 3):
        parts.append(_grams(shape, shape_at, n))
    slots, values, docs = [], [], []
    for k, (hashes, doc) in enumerate(parts):
        share = 1.0 / np.maximum(np.bincount(doc, minlength=len(texts)), 1)
        slots.append((words.mix(hashes + _U(k + 1)) >> _U(64 - BITS)).astype(np.int32))
        values.append(share[doc])
        docs.append(doc)
    return np.concatenate(slots), np.concatenate(values), np.concatenate(docs)


def _sparse(texts: list[bytes], before: bytes = b""):
    """Distinct slots with their values, text by text."""
    slots, values, docs = features(texts, before)
    key, where = np.unique(docs.astype(np.int64) << BITS | slots, return_inverse=True)
    values = np.bincount(where, values, len(key))
    docs, slots = key >> BITS, (key & ((1 << BITS) - 1)).astype(np.int32)
    cut = np.searchsorted(docs, np.arange(len(texts) + 1))
    for i in range(len(texts)):
        yield slots[cut[i]:cut[i + 1]], values[cut[i]:cut[i + 1]]


def train_ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = 4, alpha: float = 2.0, beta: float = 1.0,
               l1: float = 1e-3, l2: float = 1e-3) -> np.ndarray:
    """Weights (the bias last) after ``epochs`` passes over ``(label, slots, values)`` in the given order."""
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(at):
        zz, root = z[at], np.sqrt(n[at])
        return np.where(np.abs(zz) <= l1, 0.0, -(zz - np.sign(zz) * l1) / ((beta + root) / alpha + l2))

    for _ in range(epochs):
        for label, slots, values in rows:
            at, x = np.append(slots, size), np.append(values, 1.0)
            w = weights(at)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - label) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(np.arange(size + 1))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        train_docs: int = 6000) -> np.ndarray:
    """Weights learned from at most ``train_docs`` labelled rows: those of the smallest hashes of their id.

    Rows whose ``crc32`` of the id as text leaves 1 modulo 3 are held out. Null ids, null labels and repeated ids (the
    largest label counts) are handled; without any labelled row all scores are 0.5.
    """
    chosen = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
              .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(train_docs))
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .join(F.broadcast(chosen), "id").select("id", "label", "text"))  # at most train_docs rows

    def sparse(batches):
        for batch in batches:
            got = [x for _, _, texts, before in _pieces(batch.column(2)) for x in _sparse(texts, before)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([s.tobytes() for s, _ in got], pa.binary()),
                 pa.array([v.astype(np.float32).tobytes() for _, v in got], pa.binary())], ["id", "label", "slots", "vals"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = (rows.mapInArrow(sparse, f"id {kind}, label int, slots binary, vals binary")
             .groupBy("id").agg(F.min(F.struct("label", "slots", "vals")).alias("r")).collect())  # an id may have many texts
    found.sort(key=lambda r: (zlib.crc32(str(r.id).encode()), str(r.id)))
    return train_ftrl([(r.r.label, np.frombuffer(r.r.slots, np.int32), np.frombuffer(r.r.vals, np.float32).astype(float))
                       for r in found])


def held_out(key):
    """Rows kept for the test: crc32 of the id as text leaves 1 modulo 3. Null ids aren't held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_documents(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
                    keep: list[str] | None = None) -> DataFrame:
    """``keep`` (the id by default), ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) of every row.

    Only the text decides. A null or empty text gets the score of the bias alone; repeated rows give repeated rows.
    """
    keep = [id_col] if keep is None else keep
    model = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    names = [f"k{i}" for i in range(len(keep))]
    rows = docs.select(F.col(text_col).alias("t"), *[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)])
    schema = ", ".join([*[f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(keep, names, strict=True)],
                        "score double, predicted int"])

    def score(batches):
        w = model.value
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for a, b, texts, before in _pieces(batch.column(0)):
                slots, values, doc = features(texts, before)
                out[a:b] = np.bincount(doc, w[slots] * values, b - a)
            p = 1.0 / (1.0 + np.exp(-np.clip(out + w[-1], -35, 35)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))], [*names, "score", "predicted"])

    scored = rows.mapInArrow(score, schema)
    return scored.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], "score", "predicted")


def accepted(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows the classifier rejects; all columns stay."""
    return score_documents(docs, weights, id_col, text_col, keep=docs.columns).filter("predicted = 1").select(*docs.columns)
