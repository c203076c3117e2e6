"""Line dedup: sharded cuckoo filters in front of exact reference counts, for corpora that grow and lose documents."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from locusflow.llm.cuckoo import Cuckoo
from locusflow.operators.scaling import checkpointed, same_join

BLANK = b" \t\n\x0b\x0c\r"
SHARD_KEYS = 65_536  # repeated lines of a filter, about
FILTER_BYTES = 64 << 20  # filters that are broadcast at most
KEY = ["hi", "lo"]


def line_key(line: bytes, least: int) -> bytes | None:
    """What two lines are compared by (UTF-8, blanks off, A-Z lower-cased), or nothing if it has under ``least`` code points."""
    key = line.strip(BLANK).lower()
    if len(key) < least or len(key) < 4 * least and len(key.decode("utf-8", "replace")) < least:
        return None
    return key


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _numbers(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)


def _texts(batch, column: int):
    return (x or b"" for x in batch.column(column).cast(pa.large_binary()).to_pylist())


def _per_key(docs: DataFrame, id_col: str, text_col: str, least: int, asks=None) -> DataFrame:
    """``id, th, hi, lo`` for the distinct keys of every text; ``th`` tells texts of one id apart. ``asks`` keeps some keys."""
    kind = docs.schema[id_col].dataType.simpleString()

    def keys(batches):
        for batch in batches:
            rows, found = [], []
            for i, text in enumerate(_texts(batch, 2)):
                own = {digest(k) for k in (line_key(x, least) for x in text.split(b"\n")) if k is not None}
                rows += [i] * len(own)
                found += own
            pair, rows = _numbers(found), np.array(rows, np.int64)
            if asks is not None and len(pair):
                kept = asks(pair)
                pair, rows = pair[kept], rows[kept]
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(pair[:, 0].copy()), pa.array(pair[:, 1].copy())],
                                             ["id", "th", *KEY])

    rows = docs.select(F.col(id_col).alias("id"), _text_hash(text_col).alias("th"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(keys, f"id {kind}, th bigint, hi bigint, lo bigint")


def _text_hash(text_col: str):
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def postings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 20) -> DataFrame:
    """``hi, lo, id``: which document (id) holds which line key, once each."""
    return _per_key(docs, id_col, text_col, least).select(*KEY, "id").distinct()


def _counted(rows: DataFrame) -> DataFrame:
    """Exact references of every key: its number of documents and the largest id (null is the smallest)."""
    return rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("last"))


@dataclass(frozen=True)
class LineIndex:
    """Which lines stand in how many documents.

    ``refs`` (key, ``n_docs``, ``last``) and ``holders`` (key, document) are exact. ``filters`` holds a cuckoo filter per shard
    of the keys in at least ``min_docs`` documents: a key that its filter denies need not be looked up. Inserting and
    deleting documents return a new index and touch the filters only where a key reaches or falls below ``min_docs``, so
    that deleting what was inserted restores every answer. A document is its id: repeated rows count once, rows without id
    are one document, smaller than all others; inserting a known (line, document) pair again changes nothing.
    """

    holders: DataFrame
    refs: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int
    least: int

    @classmethod
    def of(cls, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 3, least: int = 20, keep: bool = True) -> LineIndex:
        """The index of ``docs``. Without ``keep`` the holders are not stored, which deduplication alone does without."""
        holders = postings(docs, id_col, text_col, least)
        holders = checkpointed(holders) if keep else holders
        return cls._around(holders, checkpointed(_counted(holders)), min_docs, least)

    @classmethod
    def _around(cls, holders, refs, min_docs, least) -> LineIndex:
        repeated = refs.filter(F.col("n_docs") >= min_docs)
        shards = 1 + repeated.count() // SHARD_KEYS
        return cls(holders, refs, checkpointed(_built(repeated, shards)), shards, min_docs, least)

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
        new = checkpointed(_less(postings(docs, id_col, text_col, self.least), self.holders, [*KEY, "id"]))
        both = (self.refs.withColumn("old", F.col("n_docs")).unionByName(_counted(new).withColumn("old", F.lit(0).cast("long")))
                .groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("last").alias("last"), F.sum("old").alias("old")))
        both = checkpointed(both)
        return self._after(checkpointed(self.holders.unionByName(new)), both.drop("old"),
                           both.filter((F.col("old") < self.min_docs) & (F.col("n_docs") >= self.min_docs)).select(*KEY, F.lit(True).alias("up")))

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> LineIndex:
        """The index without the documents of ``ids``; ids that it doesn't hold change nothing."""
        gone = ids.select(F.col(id_col).alias("id")).distinct()
        lost = same_join(self.holders, gone, ["id"], "left_semi").select(*KEY).distinct()
        holders = checkpointed(_less(self.holders, gone, ["id"]))
        lost = checkpointed(lost)
        counted = checkpointed(_counted(holders.join(lost, KEY, "left_semi")))
        fell = (self.refs.filter(F.col("n_docs") >= self.min_docs).join(lost, KEY, "left_semi")
                .join(counted.filter(F.col("n_docs") >= self.min_docs), KEY, "left_anti"))
        refs = checkpointed(self.refs.join(lost, KEY, "left_anti").unionByName(counted))
        return self._after(holders, refs, fell.select(*KEY, F.lit(False).alias("up")))

    def _after(self, holders, refs, changes) -> LineIndex:
        """The index with filters brought up to date; shards that have grown full are built anew from the exact table."""
        if 1 + refs.filter(F.col("n_docs") >= self.min_docs).count() // SHARD_KEYS > 2 * self.shards:
            return self._around(holders, refs, self.min_docs, self.least)
        filters = checkpointed(_updated(self.filters, changes, self.shards))
        full = filters.filter("filter is null").select("shard")
        if full.count():
            repeated = refs.filter(F.col("n_docs") >= self.min_docs).join(full, _shard(self.shards) == F.col("shard"), "left_semi")
            filters = checkpointed(filters.filter("filter is not null").unionByName(_built(repeated, self.shards)))
        return LineIndex(holders, refs, filters, self.shards, self.min_docs, self.least)

    def asker(self):
        """A function that tells for rows of ``hi, lo`` which may be repeated lines, or None if the filters are too large to broadcast."""
        size = self.filters.agg(F.sum(F.length("filter"))).first()[0] or 0
        if size > FILTER_BYTES:
            return None
        spark, shards = self.filters.sparkSession, self.shards
        blobs = spark.sparkContext.broadcast({r.shard: bytes(r["filter"]) for r in self.filters.collect()})
        opened: dict[int, Cuckoo] = {}

        def ask(pair: np.ndarray) -> np.ndarray:
            out, shard = np.zeros(len(pair), bool), np.mod(pair[:, 0], shards)
            order = np.argsort(shard, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
                k = int(shard[rows[0]])
                if k in blobs.value:
                    if k not in opened:
                        opened[k] = Cuckoo.of_bytes(blobs.value[k])
                    out[rows] = opened[k].contains(pair[rows, 1])
            return out

        return ask

    def dropped(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``id, th, keys``: the keys whose lines go, per document that loses any.

        Lines that the filters deny stay without a look at the exact table; what they let pass is joined with it. With
        filters too large to broadcast every line is joined.
        """
        asked = _per_key(docs, id_col, text_col, self.least, self.asker())
        known = self.refs.filter(F.col("n_docs") >= self.min_docs).select(*KEY, "last")
        goes = asked.join(known, KEY).filter(~F.col("id").eqNullSafe(F.col("last")))
        # a document has at most as many keys as lines
        return goes.groupBy("id", "th").agg(F.collect_set(F.struct(*KEY)).alias("keys"))

    def deduplicated(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``docs`` without the repeated lines: id, text, ``n_lines`` (before) and ``n_dropped``; other columns are left out."""
        kind, least = docs.schema[id_col].dataType.simpleString(), self.least

        def rewrite(batches):
            for batch in batches:
                texts, before, lost = [], [], []
                for text, keys in zip(_texts(batch, 1), batch.column(2).to_pylist(), strict=True):
                    lines = text.split(b"\n")
                    kept = lines
                    if keys:
                        goes = set(zip(*[iter(keys)] * 2, strict=True))
                        kept = [x for x in lines if (k := line_key(x, least)) is None or tuple(_numbers([digest(k)])[0].tolist()) not in goes]
                    texts.append(b"\n".join(kept) if keys else text)
                    before.append(len(lines))
                    lost.append(len(lines) - len(kept))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(before, pa.int64()),
                                                  pa.array(lost, pa.int64())], ["id", "t", "n_lines", "n_dropped"])

        drops = checkpointed(self.dropped(docs, id_col, text_col)).select("id", "th", F.flatten(F.transform("keys", lambda k: F.array(k.hi, k.lo))).alias("keys"))
        rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"), _text_hash(text_col).alias("th"))
        out = same_join(rows, drops, ["id", "th"], "left").select("id", "t", "keys").mapInArrow(rewrite, f"id {kind}, t string, n_lines bigint, n_dropped bigint")
        return out.select(F.col("id").alias(id_col), F.col("t").alias(text_col), "n_lines", "n_dropped")

    def save(self, folder: str) -> None:
        """Writes the index as Parquet tables below ``folder``, which must not exist."""
        for name in ("holders", "refs", "filters"):
            getattr(self, name).write.parquet(f"{folder}/{name}")
        spark = self.refs.sparkSession
        spark.createDataFrame([(self.shards, self.min_docs, self.least)], "shards int, min_docs int, least int").coalesce(1).write.parquet(f"{folder}/about")

    @classmethod
    def load(cls, spark, folder: str) -> LineIndex:
        about = spark.read.parquet(f"{folder}/about").first()
        return cls(*[spark.read.parquet(f"{folder}/{name}") for name in ("holders", "refs", "filters")], *about)


def _less(rows: DataFrame, gone: DataFrame, on: list[str]) -> DataFrame:
    return same_join(rows, gone.select(*on), on, "left_anti")


def _shard(shards: int):
    return F.pmod(F.col("hi"), F.lit(shards)).cast("int")


def _built(repeated: DataFrame, shards: int) -> DataFrame:
    """A filter per shard; a shard has about ``SHARD_KEYS`` distinct keys."""
    def build(key, part):
        return pd.DataFrame({"shard": [key[0]], "filter": [Cuckoo.holding(part["lo"].to_numpy()).to_bytes()]})

    return repeated.select(_shard(shards).alias("shard"), "lo").groupBy("shard").applyInPandas(build, "shard int, filter binary")


def _updated(filters: DataFrame, changes: DataFrame, shards: int) -> DataFrame:
    """Filters after keys came (``up``) or went; null for a filter that is too full."""
    def update(key, old, part):
        if not len(old):
            return pd.DataFrame({"shard": [key[0]], "filter": [Cuckoo.holding(part["lo"].to_numpy()).to_bytes()]})
        if not len(part):
            return old
        held, up = Cuckoo.of_bytes(old["filter"].iloc[0]), part["up"].to_numpy(bool)
        held.delete(part["lo"].to_numpy()[~up])
        fits = held.insert(part["lo"].to_numpy()[up])
        return pd.DataFrame({"shard": [key[0]], "filter": [held.to_bytes() if fits else None]})

    rows = changes.select(_shard(shards).alias("shard"), "lo", "up")
    return filters.groupBy("shard").cogroup(rows.groupBy("shard")).applyInPandas(update, "shard int, filter binary")


def deduplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 3, least: int = 20) -> DataFrame:
    """Documents without lines that stand in at least ``min_docs`` documents, except in the one with the largest id.

    Texts are split at ``\\n`` (a null or empty text is one empty line). Lines are equal by their key: blanks stripped, A-Z
    lower-cased; keys of under ``least`` code points always stay. In the document that keeps a line all its places stay.
    Rows with one id are one document, and lose or keep the same lines; rows without id are one document that is smaller
    than all others. Ties can't occur, as ids differ. An empty table gives no rows; other columns are left out.
    """
    return LineIndex.of(docs, id_col, text_col, min_docs, least, keep=False).deduplicated(docs, id_col, text_col)
