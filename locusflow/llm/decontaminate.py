"""Benchmark decontamination by spaced seeds that no accepted damage can hit all at once, with DataFrame functions only."""

from __future__ import annotations

import math
from functools import cache
from itertools import combinations

from pyspark.sql import DataFrame, functions as F

from locusflow.operators.scaling import Landing, checkpointed

# Word places that a mask looks at, as offsets from its first; the others may differ.
SPACED = ((0, 1, 2, 4), (0, 1, 3, 4), (0, 2, 3, 4))
RUN = (0, 1, 2, 3)  # beside the spaced ones for the shortest items, which have no room for a place to ignore
BROADCAST_SEEDS = 500_000  # up to so many benchmark seeds (24 bytes each) are broadcast


def _covers(masks: tuple, n: int, changed: int) -> bool:
    """Whether every choice of ``changed`` among ``n`` words leaves a mask without one of them.

    By counting where that is enough: a changed word lies in as many places of a mask as the mask has words. Else all
    choices are tried.
    """
    if any(n - m[-1] > len(m) * changed for m in masks):
        return True
    if math.comb(n, changed) > 20_000:
        return False
    places = [sum(1 << at + k for k in m) for m in masks for at in range(n - m[-1])]
    return all(any(not p & hit for p in places) for hit in (sum(1 << k for k in c) for c in combinations(range(n), changed)))


@cache
def masks_for(n: int, least: float) -> tuple:
    """Masks of which one at least is whole in every copy of ``n`` words that keeps ``least`` of them in place.

    At 0.8 one spaced mask is complete for items of more than 20 words, by counting; shorter ones get up to four masks,
    proved by trying all changes. Items that must be whole are one seed. At other shares that the masks don't serve, items
    are looked up by the longest run of words that must be left.
    """
    changed = n - math.ceil(least * n - 1e-9)
    if changed == 0:
        return (tuple(range(n)),)
    for masks in (*[SPACED[:k] for k in range(1, len(SPACED) + 1)], (*SPACED, RUN)):
        if _covers(masks, n, changed):
            return masks
    return (tuple(range(max(min(-(-(n - changed) // (changed + 1)), len(RUN)), 1))),)


def word_hashes(text):
    """A 64-bit hash of every lower-cased word (run of letters, digits and characters beyond ASCII); null: none."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.transform(F.array_remove(parts, ""), lambda w: F.xxhash64(w))


def seeds(rows: DataFrame, keep: list[str], masks: dict) -> DataFrame:
    """``keep``, ``pos`` and ``seed``, one row for each mask at every place of ``w`` that holds all its words.

    ``masks`` maps each mask to the numbers of words of the rows that it is for (None: all).
    """
    span = 1 + max((m[-1] for m in masks), default=0)
    columns = [F.slice("w", k + 1, F.size("w")) for k in range(span)]  # null past the end
    spans = F.arrays_zip(*[c.alias(f"w{k}") for k, c in enumerate(columns)], F.sequence(F.lit(0), F.size("w") - 1).alias("pos"))
    size = F.size("w").alias("size")
    rows = rows.filter(F.size("w") > 0).select(*keep, size, F.inline(spans).alias(*[f"w{k}" for k in range(span)], "pos"))
    each = []
    for mask, sizes in masks.items():
        fits = F.col(f"w{mask[-1]}").isNotNull()
        seed = F.xxhash64(F.lit(sum(1 << k for k in mask)), *[F.col(f"w{k}") for k in mask])
        each.append(F.when(fits if sizes is None else fits & F.col("size").isin(sizes), seed))
    each = F.array(*each) if each else F.array().cast("array<bigint>")
    return rows.select(*keep, "pos", F.explode(each).alias("seed")).filter(F.col("seed").isNotNull())


def _aligned(hits: DataFrame, least: float) -> DataFrame:
    """The hits whose words, laid side by side with the whole item, agree in at least ``least`` of the item's words."""
    start = F.greatest(F.col("diagonal"), F.lit(0))
    skip = start - F.col("diagonal")
    overlap = F.least(F.size("w") - start, F.size("iw") - skip)
    rows = (hits.withColumn("first_word", start).withColumn("n_words", overlap).filter(F.col("n_words") > 0)
            .withColumn("same", F.zip_with(F.slice("w", start + 1, overlap), F.slice("iw", skip + 1, overlap), lambda a, b: a == b))
            .withColumn("n_same", F.size(F.filter("same", lambda x: x))))
    return rows.filter(F.col("n_same") >= F.ceil(F.lit(least) * F.size("iw") - 1e-9))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", least: float = 0.8) -> DataFrame:
    """``id, th`` (hash of the text), ``item``, ``first_word``, ``n_words`` and ``n_same`` of each place where a document holds
    a benchmark item with at least ``least`` of its words unchanged and in place.

    Every such place is found, also of the shortest items (of fewer than 5 words, all have to be there at a ``least`` of
    0.8); an item without words is nowhere. A null text has no words; equal rows give one result; null ids are kept; an
    empty table gives no rows. The benchmark's seeds are counted: up to
    ``BROADCAST_SEEDS`` they are broadcast, beyond that both sides are shuffled by seed and the words fetched afterwards.
    """
    items = checkpointed(benchmark.select(F.col(item_col).alias("item"), word_hashes(F.col(item_text_col)).alias("iw"))
                         .filter(F.size("iw") > 0).distinct())
    masks: dict = {}
    for (n,) in items.select(F.size("iw")).distinct().collect():
        for mask in masks_for(n, least):
            masks.setdefault(mask, []).append(n)
    marks = checkpointed(seeds(items.withColumnRenamed("iw", "w"), ["item"], masks).withColumnRenamed("pos", "ipos").distinct())
    masks = dict.fromkeys(masks)
    n_seeds = marks.count()
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), word_hashes(F.col(text_col)).alias("w"))
    keys = ["id", "th", "item", "first_word", "n_words", "n_same"]
    if n_seeds <= BROADCAST_SEEDS:
        hits = seeds(rows, ["id", "th", "w"], masks).join(F.broadcast(marks), "seed")
        # an item of n words has at least n - 3 seeds, and one at least
        hits = hits.withColumn("diagonal", F.col("pos") - F.col("ipos")).join(F.broadcast(items), "item")
        return _aligned(hits, least).select(*keys).distinct()
    hits = (seeds(rows, ["id", "th"], masks).join(marks, "seed").select("id", "th", "item", (F.col("pos") - F.col("ipos")).alias("diagonal"))
            .distinct())
    found = hits.withColumnsRenamed({"id": "id2", "th": "th2"})
    joined = (found.join(rows.distinct(), F.col("id2").eqNullSafe(F.col("id")) & (F.col("th2") == F.col("th"))).join(items, "item"))
    return _aligned(joined, least).select(*keys).distinct()


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all other rows and all columns stay."""
    found = contaminated(docs, benchmark, id_col, text_col, **options).select(F.col("id").alias("_id"), F.col("th").alias("_th")).distinct()
    same = F.col("_id").eqNullSafe(F.col(id_col)) & (F.col("_th") == F.xxhash64(text_col))
    # landed with its true size, so that a short list is broadcast and the documents stay where they are
    return docs.join(Landing(docs.sparkSession).land(found), same, "left_anti")
