"""Hierarchical packing of documents into training sequences of several context sizes.

Every task packs its documents in blocks of about ``block_tokens`` tokens, so nothing is shuffled and no task
holds more than one block. Inside a block documents are routed to the smallest context size that holds them,
longer windows are filled up from the shorter tiers, and a document is cut only where nothing fits the gap
whole. All windows but the last of a block are full.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from locusflow.llm import tokens, words

TIERS = (512, 1024, 2048, 4096)
_SCHEMA = ("start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, "
           "window bigint, step_group bigint")


def pack_lengths(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Windows of a block: ``(size, [(document, start, length), ...])``; each position lies in exactly one piece."""
    top, windows, waiting = tiers[-1], [], {t: [] for t in tiers}

    def route(doc: int, start: int, n: int) -> None:
        insort(waiting[next(t for t in tiers if n <= t)], (n, doc, start))

    for doc, n in enumerate(lengths):
        start = 0
        while n - start >= top:
            windows.append((top, [(doc, start, top)]))
            start += top
        if n > start:
            route(doc, start, n - start)
    for size in reversed(tiers):
        while waiting[size]:
            n, doc, start = waiting[size].pop()
            pieces, gap = [(doc, start, n)], size - n
            while gap:
                found = None
                for t in reversed([t for t in tiers if t <= size]):  # the longest that fits whole
                    at = bisect_right(waiting[t], (gap, 1 << 62, 0))
                    if at:
                        found = waiting[t].pop(at - 1)
                        break
                if found is None:  # nothing fits: cut the shortest that is left
                    tier = next((t for t in tiers if waiting[t]), None)
                    if tier is None:
                        break
                    n, doc, start = waiting[tier].pop(0)
                    route(doc, start + gap, n - gap)
                    found = (gap, doc, start)
                n, doc, start = found
                pieces.append((doc, start, n))
                gap -= n
            windows.append((size, pieces))
    return windows


def step_groups(windows: list, per_step: int) -> list[int]:
    """A step for each window, ``per_step`` windows each, dealt back and forth by attention cost so that steps weigh alike."""
    steps = max(1, -(-len(windows) // per_step))
    order = sorted(range(len(windows)), key=lambda i: (-windows[i][0], -sum(p[2] ** 2 for p in windows[i][1]), i))
    out = [0] * len(windows)
    for rank, i in enumerate(order):
        lap, at = divmod(rank, steps)
        out[i] = at if lap % 2 == 0 else steps - 1 - at
    return out


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2,
                   tiers: tuple[int, ...] = TIERS, block_tokens: int = 1 << 20, per_step: int = 64) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``, ``window``,
    ``step_group``.

    A document is its ids without added special tokens, then ``end_id``; a null or empty text is ``end_id`` alone.
    Repeated rows are packed one by one; a null id is kept; other columns are left out; an empty table gives no rows.
    ``window`` is the context size; sequences shorter than their window occur once per block. Sequence and step numbers
    hold the task's number in their upper bits. Texts longer than a block form a block of their own.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def pack(batches):
        lookup = tokens.worker_lookup(path, "word", True)
        base = TaskContext.get().partitionId() << 33
        end = end_id.to_bytes(4, "little")
        held, total, n_sequences, n_steps = [], 0, 0, 0

        def flush():
            nonlocal n_sequences, n_steps
            windows = pack_lengths([len(ids) // 4 for _, ids in held], tiers)
            steps = step_groups(windows, per_step)
            rows = []
            for (size, pieces), step in zip(windows, steps, strict=True):
                offset = 0
                for doc, start, n in pieces:
                    key, ids = held[doc]
                    rows.append((key, start, n, zlib.crc32(ids[4 * start:4 * (start + n)]), len(ids) // 4,
                                 base + n_sequences, offset, size, base + n_steps + step))
                    offset += n
                n_sequences += 1
            n_steps += max(steps, default=-1) + 1
            return rows

        def out(rows):
            columns = list(zip(*rows, strict=True)) or [()] * 9
            names = ["id", *[c.split()[0] for c in _SCHEMA.split(", ")]]
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], id_type), *[pa.array(c, pa.int64()) for c in columns[1:]]], names)

        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for a, b, texts in words.slices(batch.column(1)):
                for key, text in zip(batch.column(0).slice(a, b - a).to_pylist(), texts, strict=True):
                    ids = lookup(text.decode()) + end
                    held.append((key, ids))
                    total += len(ids) // 4
                    if total >= block_tokens:
                        yield out(flush())
                        held, total = [], 0
        if held:
            yield out(flush())

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(pack, f"id {kind}, {_SCHEMA}").withColumnRenamed("id", id_col)
