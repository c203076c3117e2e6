"""Near-duplicate texts by ProbMinHash sketches of their sets of word shingles, banding and exact verification.

Texts with equal sets of shingles form one node. A bucket (nodes with an equal band) is searched by stars: all its
members are compared with its most connected member; only buckets whose members then still lie in several
components are looked at again, with the members outside the first component. What is then still apart in wide buckets
is compared all with all inside blocks of bounded size, of which only links leave, so that none is lost.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from locusflow.llm import words
from locusflow.llm.components import connected_components, settled
from locusflow.operators.scaling import checkpointed

_U = np.uint64
SHINGLE, SIMILARITY, BANDS, ROWS = 5, 0.8, 40, 8
FEW = 8  # so many members of a bucket may all be compared with its others at once
BLOCK, BLOCK_SHINGLES = 512, 1 << 21  # members of a wide bucket, and their shingles, that meet as many others in one task
_GOLD = 0x9E3779B97F4A7C15


def shingles(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text with their counts, and where each text's start (one more entry than texts).

    A text with fewer words than a shingle has is one shingle; a text without words has none.
    """
    word, at = words.word_hashes(texts)
    n = np.diff(at)
    each = np.maximum(n - size + 1, (n > 0).astype(n.dtype))
    doc = np.repeat(np.arange(len(texts)), each)
    first = at[:-1][doc] + np.arange(len(doc)) - np.repeat(np.cumsum(each) - each, each)
    last = np.minimum(first + size, at[1:][doc])
    hashes = np.zeros(len(doc), _U)
    for k in range(size):
        inside = first + k < last
        hashes[inside] = words.mix(hashes[inside] * _U(_GOLD) + word[(first + k)[inside]])
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.flatnonzero(np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])]))[:len(hashes)]
    counts = np.diff(np.append(new, len(hashes)))
    return hashes[new], counts, np.searchsorted(doc[new], np.arange(len(texts) + 1))


def sketch(hashes: np.ndarray, weights: np.ndarray, at: np.ndarray, registers: int) -> np.ndarray:
    """ProbMinHash: for each register the element whose exponential arrival came first. One row for each text.

    Every element sends arrivals with gaps of rate ``weight`` to registers of its own choice and stops as soon as its
    next one comes after the latest of the text's registers. Two texts agree in a register with the probability Jaccard
    similarity of their weights. Rows of texts without elements are zero.
    """
    n_texts = len(at) - 1
    best, sig = np.full(n_texts * registers, np.inf), np.zeros(n_texts * registers, np.uint32)
    doc = np.repeat(np.arange(n_texts), np.diff(at))
    time, latest, lap = np.zeros(len(hashes)), np.full(n_texts, np.inf), 0
    while len(hashes):
        lap += 1
        draw = words.mix(hashes + _U(lap * _GOLD & (1 << 64) - 1))
        time = time - np.log(((draw >> _U(12)).astype(float) + 0.5) * 2.0 ** -52) / weights
        alive = time < latest[doc]
        hashes, weights, doc, time, draw = hashes[alive], weights[alive], doc[alive], time[alive], draw[alive]
        where = doc * registers + (words.mix(draw + _U(1)) % _U(registers)).astype(np.int64)
        np.minimum.at(best, where, time)
        won = best[where] == time
        sig[where[won]] = (hashes[won] >> _U(32)).astype(np.uint32)
        latest = best.reshape(n_texts, registers).max(axis=1)
    return sig.reshape(n_texts, registers)


def _bands(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(sig), bands), _U)
    for b in range(bands):
        key = np.full(len(sig), b + 1, _U)
        for r in range(rows):
            key = words.mix(key * _U(_GOLD) + sig[:, b * rows + r].astype(_U))
        out[:, b] = key
    return out


def sketches(docs: DataFrame, id_col: str, text_col: str, size: int, bands: int, rows: int) -> DataFrame:
    """``id, th`` (hash of the text), ``node`` (digest of the set of shingles), ``n`` shingles, ``bands`` and ``sig`` (a byte of
    each register).

    Texts of fewer than four shingles get no bands: at a similarity of 0.8 they match equal sets only, which are one node.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def scan(batches):
        for batch in batches:
            for a, b, texts in words.slices(batch.column(2), 1 << 20):
                hashes, _, at = shingles(texts, size)
                doc = np.repeat(np.arange(b - a), np.diff(at))
                mixed = words.mix(hashes + _U(_GOLD))
                two = np.zeros((b - a, 2), _U)
                np.add.at(two[:, 0], doc, mixed)
                np.add.at(two[:, 1], doc, words.mix(mixed ^ _U(_GOLD)))
                n = np.diff(at)
                large = np.flatnonzero(n >= 4)
                use = np.isin(doc, large)
                at_large = np.concatenate([[0], np.cumsum(n[large])])
                drawn = np.zeros((b - a, bands * rows), np.uint32)
                drawn[large] = sketch(hashes[use], np.ones(at_large[-1]), at_large, bands * rows)
                keys = _bands(drawn[large], bands, rows).view(np.int64)
                lists = np.zeros(b - a, np.int64)
                lists[large] = bands
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array([r.tobytes() for r in two], pa.binary()),
                     pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lists)]), pa.int32()),
                                                                       pa.array(keys.ravel())),
                     pa.array([r.tobytes() for r in drawn.astype(np.uint8)], pa.binary())], ["id", "th", "node", "n", "bands", "sig"])

    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    return keyed.mapInArrow(scan, f"id {kind}, th bigint, node binary, n bigint, bands array<bigint>, sig binary")


def _texts(docs: DataFrame, id_col: str, text_col: str, nodes: DataFrame) -> DataFrame:
    """``node, packed``: the compressed text of the row that stands for each node."""
    kind = docs.schema[id_col].dataType.simpleString()

    def pack(batches):
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(
                [squeeze(t) for _, _, texts in words.slices(batch.column(2)) for t in texts], pa.binary())], ["id2", "th2", "packed"])

    packed = (docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
              .mapInArrow(pack, f"id2 {kind}, th2 bigint, packed binary"))
    return (packed.join(nodes, F.col("id2").eqNullSafe(F.col("id")) & (F.col("th2") == F.col("th")))
            .select("node", "packed").dropDuplicates(["node"]))


def _unpacked_shingles(packed: list[bytes], size: int) -> list[np.ndarray]:
    back = zstandard.ZstdDecompressor().decompress
    texts = [back(p) for p in packed]
    out = []
    for a, b in words.chunks(texts, 1 << 19):
        hashes, _, at = shingles(texts[a:b], size)
        out += [hashes[at[i]:at[i + 1]] for i in range(b - a)]
    return out


def _alike(x: np.ndarray, y: np.ndarray, least: float) -> bool:
    common = 0
    if min(len(x), len(y)) >= least * max(len(x), len(y)):
        common = len(np.intersect1d(x, y, assume_unique=True))
    return common >= least * (len(x) + len(y) - common) - 1e-9


def verified(pairs: DataFrame, texts: DataFrame, size: int, least: float) -> DataFrame:
    """The pairs of nodes whose shingle sets have a Jaccard similarity of at least ``least``."""
    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("packed").alias("pa")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("packed").alias("pb")), "b").select("a", "b", "pa", "pb")

    def verify(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                one = _unpacked_shingles(part.column(2).to_pylist(), size)
                hubs = part.column(3).to_pylist()  # neighbours in the batch mostly share theirs
                distinct = list(dict.fromkeys(hubs))
                other = dict(zip(distinct, _unpacked_shingles(distinct, size), strict=True))
                keep = []
                for x, hub in zip(one, hubs, strict=True):
                    keep.append(_alike(x, other[hub], least))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(verify, "a binary, b binary")


def _floor(registers: int, least: float) -> float:
    return least - 5.0 * (least * (1.0 - least) / registers) ** 0.5


def likely(pairs: DataFrame, sigs: DataFrame, registers: int, least: float) -> DataFrame:
    """The pairs whose sketches agree in nearly enough registers: at most five standard deviations below ``least``."""
    floor = _floor(registers, least)
    both = (pairs.join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a")
            .join(sigs.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b").select("a", "b", "sa", "sb"))

    def agree(batches):
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, registers) for i in (2, 3))
            keep = pa.array((one == two).mean(axis=1) >= floor, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(keep)

    return both.mapInArrow(agree, "a binary, b binary")


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def wide_links(wide: DataFrame, sigs: DataFrame, texts: DataFrame, registers: int, size: int, least: float) -> DataFrame:
    """Links ``a, b`` that connect the members (``key, node, component``) of a bucket that lie in different components.

    Sets of similarity ``least`` differ in size by at most that factor, so a member meets its own class of sizes and the
    next. The members that meet are cut into blocks by hash; every two blocks are one group of about ``2 * BLOCK`` rows.
    There the pairs with like sketches are checked by their shingles, unless links found before connect them already; so
    a group returns fewer links than it has rows.
    """
    floor, step = _floor(registers, least), 1e-9 - math.log(least)
    level = F.floor(F.log("n") / step)
    rows = settled(wide.join(sigs.select("node", "n"), "node").select("key", "node", "component", "n", level.alias("level"))
                   .withColumn("g", F.explode(F.array("level", F.col("level") - 1))))
    blocks = F.greatest(F.ceil(F.col("met") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    sizes = (rows.groupBy("key", "g").agg(F.count(F.lit(1)).alias("met"), F.sum("n").alias("shingles"),
                                          F.sum((F.col("level") == F.col("g")).cast("int")).alias("own"))
             .filter("own > 0 and met > 1").select("key", "g", blocks.alias("blocks")))
    tiles = (rows.join(sizes, ["key", "g"]).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", "g", "node", "component", "level", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
             .join(sigs.select("node", "sig"), "node").join(texts, "node"))

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        sig = np.frombuffer(b"".join(part["sig"]), np.uint8).reshape(-1, registers)
        names, component = np.unique(part["component"].to_numpy(), return_inverse=True)
        like = []
        for x in np.flatnonzero((part["level"] == part["g"]).to_numpy()):
            y = np.flatnonzero(component != component[x])
            like += [(x, k) for k in y[(sig[y] == sig[x]).mean(axis=1) >= floor]]
        used = sorted({x for pair in like for x in pair})
        sets = dict(zip(used, _unpacked_shingles(part["packed"].iloc[used].tolist(), size), strict=True))
        up, node, found = list(range(len(names))), part["node"].to_numpy(), []

        def head(c):
            while up[c] != c:
                up[c] = up[up[c]]
                c = up[c]
            return c

        for x, y in like:
            one, two = head(component[x]), head(component[y])
            if one != two and _alike(sets[x], sets[y], least):
                up[max(one, two)] = min(one, two)
                found.append((min(node[x], node[y]), max(node[x], node[y])))
        return pd.DataFrame(found, columns=["a", "b"])

    return tiles.groupBy("key", "g", "i", "j").applyInPandas(compare, "a binary, b binary").distinct()


def near_links(members: DataFrame, check, meet) -> tuple[DataFrame, DataFrame]:
    """Links of the nodes of the buckets (``key, node, k``: bucket size) by pairs that pass ``check``, and their components.

    A pair needs no check when its nodes are known to be connected. So every bucket is first searched around its most
    connected member. Then only members outside the bucket's largest component are left to ask: in buckets with up to
    ``FEW`` of them, all are compared with the whole bucket; in wider ones the most connected of them is, round after
    round as long as links turn up. What wide buckets then still hold in different components goes through ``meet``,
    which returns the links that connect them. So the pairs made grow with the members, never with the square of a
    bucket.
    """
    fame = members.groupBy("node").agg(F.sum("k").alias("fame"))
    known = settled(members.drop("k").join(fame, "node"))
    hubs = settled(known.groupBy("key").agg(F.max(F.struct("fame", "node")).alias("h")).select("key", F.col("h.node").alias("hub")))
    tried = settled(known.join(hubs, "key").filter("node != hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct())
    links = settled(check(tried))
    while True:
        component = connected_components(links)
        placed = known.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
        per = settled(placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("k"), F.max(F.struct("fame", "node")).alias("h")))
        mixed = settled(per.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("k", "component")).alias("m"),
                                                    F.sum("k").alias("k")).filter("n > 1")
                             .select("key", F.col("m.component").alias("main"), (F.col("k") - F.col("m.k")).alias("outside")))
        rest = settled(placed.join(mixed, "key"))
        known = rest.select("key", "node", "fame")  # the other buckets have nothing left to find
        few = rest.filter((F.col("component") != F.col("main")) & (F.col("outside") <= FEW))
        one = (per.join(mixed, "key").filter((F.col("component") != F.col("main")) & (F.col("outside") > FEW)).groupBy("key")
               .agg(F.max(F.struct(F.col("h.fame").alias("fame"), F.col("h.node").alias("o"), F.col("component").alias("c"))).alias("h"))
               .select("key", "h.o", "h.c"))
        asking = few.select("key", F.col("node").alias("o"), F.col("component").alias("c")).unionByName(one)
        pairs = settled(rest.join(asking, "key").filter("component != c").select(*_ordered("node", "o")).distinct()
                             .join(tried.select(*_ordered("a", "b")), ["a", "b"], "left_anti"))
        new = settled(check(pairs))
        tried = settled(tried.unionByName(pairs))
        if new.isEmpty():
            break
        links = settled(links.unionByName(new))
    wide = rest.filter(F.col("outside") > FEW).select("key", "node", "component")
    if wide.isEmpty():
        return links, component
    new = settled(meet(wide))
    if new.isEmpty():
        return links, component
    links = settled(links.unionByName(new))
    return links, connected_components(links)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, least: float = SIMILARITY,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: id, ``th`` (hash of the text), ``class_id`` and ``kept``.

    Two texts are linked when the sets of their ``size``-word shingles have a Jaccard similarity of at least ``least``;
    classes are the components of the links, named by their smallest id. ``kept`` marks the rows of the first text (by id
    and hash) of each class; rows repeated with id and text are all marked. The search takes the same similarity: every
    distinct shingle weighs 1, however often it stands in a text. All texts without words (null and empty ones too) form one class; null ids come first in
    ``kept`` and never name a class that has another; an empty table gives no rows.
    """
    drawn = checkpointed(sketches(docs, id_col, text_col, size, bands, rows))
    nodes = checkpointed(drawn.groupBy("node").agg(F.min(F.struct("id", "th")).alias("r"), F.min("id").alias("least"), F.first("bands").alias("bands"),
                                             F.first("sig").alias("sig"), F.first("n").alias("n")))
    banded = nodes.select("node", F.explode("bands").alias("key"))
    shared = checkpointed(banded.groupBy("key").agg(F.count(F.lit(1)).alias("k")).filter("k > 1"))
    members = checkpointed(banded.join(shared, "key"))
    asked = checkpointed(members.select("node").distinct().join(nodes.select("node", "sig", "n", "r.*"), "node"))
    texts = checkpointed(_texts(docs, id_col, text_col, asked.drop("sig", "n")))
    _, component = near_links(
        members, lambda pairs: verified(settled(likely(pairs, asked, bands * rows, least)), texts, size, least),
        lambda wide: wide_links(wide, asked, texts, bands * rows, size, least))
    placed = nodes.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    heads = placed.groupBy("component").agg(F.min("least").alias("class_id"), F.min("r").alias("first"))
    by_node = checkpointed(placed.select("node", "component").join(heads, "component").select("node", "class_id", "first"))
    kept = F.col("first.id").eqNullSafe(F.col("id")) & (F.col("first.th") == F.col("th"))
    return (drawn.drop("bands", "sig").join(by_node, "node")
            .select(F.col("id").alias(id_col), "th", "class_id", kept.alias("kept"), F.col("n").alias("n_shingles")))


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of every class of near duplicates, the first by id and text hash; all columns stay.

    Rows repeated with id and text count once; of their other columns the least row stays, so that a task that is run again
    keeps the same one.
    """
    classes = near_duplicates(docs, id_col, text_col, **options)
    kept = classes.filter("kept").select(F.col(id_col).alias("_id"), F.col("th").alias("_th")).distinct()
    others = [c for c in docs.columns if c != id_col]
    rows = (docs.withColumn("_h", F.xxhash64(text_col)).groupBy(id_col, "_h").agg(F.min(F.struct(*others)).alias("_least"))
            .select(id_col, "_h", "_least.*"))
    same = F.col("_id").eqNullSafe(F.col(id_col)) & (F.col("_th") == F.col("_h"))
    return rows.join(checkpointed(kept), same, "left_semi").select(*docs.columns)
