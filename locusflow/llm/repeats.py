"""Repeated byte strings across a corpus by longest previous factors over a sparse suffix order.

Every window of ``min_len`` bytes holds an anchor: the position of its smallest ``GRAM``-byte hash. Equal windows have
equal anchors at the same place, so windows need only be compared where anchors share their hash. The windows around
one anchor form its context. Equal contexts are counted by hash; only contexts that share an anchor hash but differ
are cut from the texts and compared byte by byte: their parts right and left of the anchor are put in suffix order
with the lengths of their common prefixes, and for every place of the anchor the windows that agree lie together, so
that the previous and the next one in text order are an earlier and a later copy.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from locusflow.llm import words
from locusflow.operators.scaling import checkpointed

GRAM = 128
_U = np.uint64
_PLACE = 24  # bits of a sort key that hold the place inside a segment
SEGMENT = 1 << 18
HOT_CONTEXTS = 4096  # buckets with more differing contexts are split by window


def _segments(texts: list[bytes], min_len: int):
    """Pieces ``(text, offset, bytes)`` of about a segment; neighbours overlap so that each window lies in exactly one."""
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - min_len + 1), SEGMENT):
            yield i, at, t[at:at + SEGMENT + min_len - 1]


def _anchors(texts: list[bytes], min_len: int):
    """Arrays ``text, lo, a, m, gram, ctx``: ``m`` windows from ``lo`` on share the anchor at ``lo + a``."""
    width = min_len - GRAM + 1
    pieces = [p for p in _segments(texts, min_len) if len(p[2]) >= min_len]
    for first, last in words.chunks([p[2] for p in pieces], SEGMENT):
        part = pieces[first:last]
        data, at = words.joined([p[2] for p in part])
        sums, down = words.prefix_sums(data)
        n = len(data)
        grams = words.mix((sums[GRAM:] - sums[:n - GRAM + 1]) * down[:n - GRAM + 1])
        key = (grams >> _U(_PLACE) << _U(_PLACE)) | np.arange(len(grams), dtype=_U)
        rows = -(-len(key) // width)
        blocks = np.full(rows * width, np.iinfo(_U).max, _U)
        blocks[:len(key)] = key
        blocks = blocks.reshape(rows, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        sizes = np.diff(at) - 1
        starts = np.concatenate([np.arange(s, s + z - min_len + 1) for s, z in zip(at[:-1], sizes, strict=True)])
        owner = np.repeat(np.arange(len(part)), sizes - min_len + 1)
        place = (np.minimum(behind[starts], ahead[starts + width - 1]) & _U((1 << _PLACE) - 1)).astype(np.int64)
        new = np.concatenate([[True], (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])])
        edge = np.flatnonzero(new)
        lo, place, owner = starts[edge], place[edge], owner[edge]
        m = np.diff(np.append(edge, len(starts)))
        ctx = words.mix(words.span_hash(sums, down, lo, lo + m + min_len - 1) + (place - lo).astype(_U))
        text = np.array([p[0] for p in part])[owner]
        yield text, lo - at[owner] + np.array([p[1] for p in part])[owner], place - lo, m, grams[place], ctx


def anchors(docs: DataFrame, id_col: str, text_col: str, min_len: int) -> DataFrame:
    """``id, th`` (hash of the text), ``gram, ctx, lo`` and ``am`` (anchor place and number of windows) of all anchors."""
    kind = docs.schema[id_col].dataType.simpleString()

    def scan(batches):
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(2).to_pylist()]
            for text, lo, a, m, gram, ctx in _anchors(texts, min_len):
                where = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(where), batch.column(1).take(where), pa.array(gram.view(np.int64)), pa.array(ctx.view(np.int64)),
                     pa.array(lo, pa.int64()), pa.array((a << 10 | m).astype(np.int32))], ["id", "th", "gram", "ctx", "lo", "am"])

    rows = _keyed(docs, id_col, text_col)
    return rows.mapInArrow(scan, f"id {kind}, th bigint, gram bigint, ctx bigint, lo bigint, am int")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))


def _packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, th`` and the text as compressed bytes, which shuffle at a third of their size."""
    kind = docs.schema[id_col].dataType.simpleString()

    def pack(batches):
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            packed = pa.array([squeeze((t or "").encode()) for t in batch.column(2).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], ["id", "th", "packed"])

    return _keyed(docs, id_col, text_col).mapInArrow(pack, f"id {kind}, th bigint, packed binary")


def _unpack(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _common(matrix: np.ndarray, sizes: np.ndarray, order: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Common prefix length of each row with the one before it in ``order``; -1 across buckets and at the start."""
    out = np.full(len(order), -1)
    for a in range(1, len(order), 8192):
        here = order[a:a + 8192]
        before = order[a - 1:a - 1 + len(here)]
        differ = matrix[here] != matrix[before]
        lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), matrix.shape[1])
        lcp = np.minimum(lcp, np.minimum(sizes[here], sizes[before]))
        out[a:a + len(here)] = np.where(bucket[here] == bucket[before], lcp, -1)
    return out


def factor_runs(bucket: np.ndarray, rank: np.ndarray, a: np.ndarray, m: np.ndarray, slices: list[bytes],
                min_len: int) -> tuple[np.ndarray, np.ndarray]:
    """For every context and window: has the window an equal one earlier, and any equal one, in its bucket?

    ``rank`` orders the contexts by position. The result is two boolean arrays of contexts by windows.
    """
    n, width = len(slices), int(m.max())
    right = [s[k:] for s, k in zip(slices, a.tolist(), strict=True)]
    left = [s[:k][::-1] for s, k in zip(slices, a.tolist(), strict=True)]
    earlier, other = np.zeros((n, width), bool), np.zeros((n, width), bool)
    orders = []
    for parts in (right, left):
        sizes = np.fromiter(map(len, parts), np.int64, n)
        full = max(1, int(sizes.max()))
        matrix = np.frombuffer(b"".join(p.ljust(full, b"\0") for p in parts), np.uint8).reshape(n, full)
        keys = bucket.tolist()
        order = np.array(sorted(range(n), key=lambda i: (keys[i], parts[i])))
        orders.append((order, _common(matrix, sizes, order, bucket), sizes))
    (by_right, lcp_right, n_right), (by_left, lcp_left, n_left) = orders
    class_right, class_left = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(int(a.max()) + 1):  # the anchor's place in the window
        valid = np.flatnonzero((a >= o) & (a - o < m) & (n_left >= o) & (n_right >= min_len - o))
        if len(valid) < 2:
            continue
        class_right[by_right] = np.cumsum(lcp_right < min_len - o)
        class_left[by_left] = np.cumsum(lcp_left < o)
        key = class_right[valid] * (n + 1) + class_left[valid]
        order = np.lexsort((rank[valid], key))
        same = key[order][1:] == key[order][:-1]
        later, sooner = valid[order[1:][same]], valid[order[:-1][same]]
        earlier[later, a[later] - o] = True
        other[later, a[later] - o] = True
        other[sooner, a[sooner] - o] = True
    return earlier, other


def _runs_of(flags: np.ndarray) -> list[dict]:
    start, end = words.runs(flags)
    return [{"s": int(s), "e": int(e)} for s, e in zip(start, end, strict=True)]


_RUNS = "array<struct<s:int, e:int>>"


def _compare(cut: DataFrame, min_len: int) -> DataFrame:
    """``gram, ctx, earlier, other``: runs of windows of each context that occur in another context of its bucket."""
    runs = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))

    def compare(batches):
        held = []

        def flush():
            gram, ctx, where, a, m, part = zip(*held, strict=True)
            order = sorted(range(len(held)), key=where.__getitem__)  # null ids first, as in Spark
            rank = np.empty(len(held), np.int64)
            rank[order] = np.arange(len(held))
            earlier, other = factor_runs(np.array(gram), rank, np.array(a), np.array(m), list(part), min_len)
            return pa.RecordBatch.from_arrays(
                [pa.array(gram, pa.int64()), pa.array(ctx, pa.int64()), pa.array([_runs_of(r) for r in earlier], runs),
                 pa.array([_runs_of(r) for r in other], runs)], ["gram", "ctx", "earlier", "other"])

        for batch in batches:
            for gram, ctx, key, th, lo, am, part in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if len(held) >= 8192 and gram != held[-1][0]:
                    yield flush()
                    held = []
                held.append((gram, ctx, (key is not None, key if key is not None else 0, th, lo + (am >> 10)), am >> 10, am & 1023, part))
        if held:
            yield flush()

    ordered = cut.repartition("gram").sortWithinPartitions("gram")
    return ordered.mapInArrow(compare, f"gram bigint, ctx bigint, earlier {_RUNS}, other {_RUNS}")


def _cut(asked: DataFrame, packed: DataFrame, min_len: int) -> DataFrame:
    """The bytes of the asked contexts, from one join of the texts with each text's list of contexts."""
    lists = (asked.groupBy("id", "th").agg(F.collect_list(F.struct("gram", "ctx", "lo", "am")).alias("asked")))
    kind = asked.schema["id"].dataType.simpleString()
    joined = (packed.withColumnRenamed("id", "id2").withColumnRenamed("th", "th2").dropDuplicates(["id2", "th2"])
              .join(lists, F.col("id2").eqNullSafe(F.col("id")) & (F.col("th2") == F.col("th")))
              .select("id", "th", "packed", "asked"))

    def cut(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                text, asked_here = _unpack(batch.column(2)[i].as_py()), batch.column(3)[i].as_py()
                where = pa.array([i] * len(asked_here))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x["gram"] for x in asked_here], pa.int64()), pa.array([x["ctx"] for x in asked_here], pa.int64()),
                     batch.column(0).take(where), batch.column(1).take(where), pa.array([x["lo"] for x in asked_here], pa.int64()),
                     pa.array([x["am"] for x in asked_here], pa.int32()),
                     pa.array([text[x["lo"]:x["lo"] + (x["am"] & 1023) + min_len - 1] for x in asked_here], pa.binary())],
                    ["gram", "ctx", "id", "th", "lo", "am", "part"])

    return joined.mapInArrow(cut, f"gram bigint, ctx bigint, id {kind}, th bigint, lo bigint, am int, part binary")


def _split_by_window(cut: DataFrame, min_len: int) -> DataFrame:
    """As ``_compare`` for buckets too large for one task: a row per window, grouped by the window itself.

    The windows of an anchor place that agree are what a class of the suffix order holds; its first position is an
    aggregate, so that no task ever holds a bucket.
    """
    place = F.explode(F.sequence(F.lit(0), F.col("am").bitwiseAND(1023) - 1))
    rows = cut.withColumn("w", place).withColumn("window", F.substring("part", F.col("w") + 1, F.lit(min_len)))
    rows = rows.select("gram", "ctx", "w", F.xxhash64("window").alias("h1"), F.crc32("window").alias("h2"),
                       F.struct("id", "th", (F.col("lo") + F.col("w")).alias("p")).alias("at"))
    key = ["gram", "h1", "h2"]
    classes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first")).filter("n > 1")
    hits = rows.join(classes, key)
    marks = hits.groupBy("gram", "ctx").agg(
        F.sort_array(F.collect_set(F.when(F.col("at") > F.col("first"), F.col("w")))).alias("earlier"),
        F.sort_array(F.collect_set("w")).alias("other"))
    one = lambda c: F.transform(c, lambda w: F.struct(w.cast("int").alias("s"), (w + 1).cast("int").alias("e")))
    return marks.select("gram", "ctx", one("earlier").alias("earlier"), one("other").alias("other"))


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_len: int = 400,
                    keep_first: bool = False, packed: DataFrame | None = None) -> DataFrame:
    """``id, th, ranges``: byte ranges of each text covered by windows of ``min_len`` bytes that occur elsewhere.

    With ``keep_first`` only windows with an earlier copy count (texts in the order of id, hash and position), so one
    copy of everything stays; rows with equal id and text can't be told apart and count as one place.
    """
    if min_len < 2 * GRAM or min_len > GRAM + 1000:
        raise ValueError("min_len must lie between 256 and 1128")
    packed = _packed(docs, id_col, text_col) if packed is None else packed
    every = checkpointed(anchors(docs, id_col, text_col, min_len))
    # an anchor hash seen once has no copy; if all its contexts are equal nothing needs comparing
    grams = (every.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("ctx").alias("c0"), F.max("ctx").alias("c1"))
             .filter("n > 1").select("gram", (F.col("c0") == F.col("c1")).alias("alike")))
    shared = checkpointed(every.join(checkpointed(grams), "gram"))  # both sides as shuffles of their own: hot hashes can be split
    contexts = (shared.groupBy("gram", "ctx", "alike").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "th", "lo", "am")).alias("r"))
                .select("gram", "ctx", "alike", "n", "r.*"))
    contexts = checkpointed(contexts)
    unlike = contexts.filter(~F.col("alike"))
    hot = unlike.groupBy("gram").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") > HOT_CONTEXTS).select("gram", F.lit(True).alias("hot"))
    cut = checkpointed(_cut(unlike.select("id", "th", "gram", "ctx", "lo", "am"), packed, min_len).join(hot, "gram", "left"))
    columns = ["gram", "ctx", "id", "th", "lo", "am", "part"]
    runs = (_compare(cut.filter(F.col("hot").isNull()).select(*columns), min_len)
            .unionByName(_split_by_window(cut.filter("hot").select(*columns), min_len)))
    windows = F.col("am").bitwiseAND(1023)
    whole = F.array(F.struct(F.lit(0).alias("s"), windows.cast("int").alias("e")))
    first = (F.col("r.id").eqNullSafe(F.col("id"))) & (F.col("r.th") == F.col("th")) & (F.col("r.lo") == F.col("lo"))
    kept = contexts.select("gram", "ctx", "n", F.struct("id", "th", "lo").alias("r")).join(runs, ["gram", "ctx"], "left")
    found = shared.join(checkpointed(kept), ["gram", "ctx"])
    empty = F.array().cast(_RUNS)
    if keep_first:
        marks = F.when(first, F.coalesce("earlier", empty)).otherwise(whole)
    else:
        marks = F.when(F.col("n") > 1, whole).otherwise(F.coalesce("other", empty))
    found = found.select("id", "th", "lo", marks.alias("marks")).filter(F.size("marks") > 0)
    ranges = F.transform("marks", lambda x: F.struct((F.col("lo") + x["s"]).alias("s"), (F.col("lo") + x["e"] + min_len - 1).alias("e")))
    return found.groupBy("id", "th").agg(F.flatten(F.collect_set(ranges)).alias("ranges"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_len: int = 400, keep_first: bool = False,
                   with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` (and the kept bytes).

    Texts are taken as UTF-8 bytes; matches never cross texts. A null text counts as empty; repeated rows are copies of
    each other; a null id is kept; other columns are left out; an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    packed = _packed(docs, id_col, text_col)
    ranges = repeated_ranges(docs, id_col, text_col, min_len, keep_first, packed).withColumnsRenamed({"id": "id2", "th": "th2"})
    rows = (packed.join(ranges, F.col("id").eqNullSafe(F.col("id2")) & (F.col("th") == F.col("th2")), "left")
            .select("id", "packed", "ranges"))
    schema = f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"

    def strip(batches):
        for batch in batches:
            out = []
            for packed_text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                text, kept, at, n = _unpack(packed_text), [], 0, 0
                merged = []
                for s, e in sorted((x["s"], x["e"]) for x in spans or ()):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([s, e])
                for s, e in merged:
                    kept.append(text[at:s])
                    at, n = e, n + e - s
                kept = b"".join([*kept, text[at:]])
                out.append((len(text), n, len(merged), hashlib.sha256(kept).hexdigest(), kept if with_text else None))
            columns = list(zip(*out, strict=True)) or [()] * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                                             ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    out = rows.mapInArrow(strip, schema).withColumnRenamed("id", id_col)
    return out if with_text else out.drop("kept")
