"""Prefix trie of conversations: nodes by digests of their turns, subtree totals by parallel tree contraction."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from locusflow.operators.scaling import Landing, checkpointed, same_join, tiled_scan

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 20  # conversations that share one opening
TILE = 4096  # turns of a conversation, or conversations of an ending, that one group holds at most
NODE = ["k1", "k2"]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``c, p, g1, g2, words``: every turn at its place (from 1) in its conversation, as digest of role and text and number of words.

    Turns are in the order of ``turn`` (null first), then role and text; rows without ``conv_id`` are left out. Repeated
    rows are counted first and turns are ranked by range, so a conversation of any length is spread over several tasks.
    """
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("c"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counted = rows.groupBy("c", "turn", "role", "text").agg(F.count(F.lit(1)).alias("m"))
    order = ["c", F.col("turn").asc_nulls_first(), "role", "text"]
    placed = (counted.repartitionByRange(*order).sortWithinPartitions(*order)
              .select("c", "m", F.xxhash64("role", "text").alias("g1"), F.xxhash64(F.lit(1), "text", "role").alias("g2"),
                      F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
                      F.monotonically_increasing_id().alias("o"), F.spark_partition_id().alias("tile")))
    ranked = tiled_scan(checkpointed(placed), ["c"], "tile", ["o"], {"p": ("sum", F.col("m"), "upto")})
    return ranked.select("c", F.explode(F.sequence(F.col("p") - F.col("m") + 1, F.col("p"))).alias("p"), "g1", "g2", "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations with the opening of the first one of their block: turns (as given, at their new place) and ``c, length``.

    Conversation c takes the first h = crc32(c) % 4 turns of conversation c - c % 20, then its own after its first h.
    """
    donor = F.col("c") - F.col("c") % BLOCK
    h = (F.crc32(F.col("c").cast("string").cast("binary")) % 4).alias("h")
    own = turns.groupBy("c").agg(F.count(F.lit(1)).alias("n")).select("c", "n", h, donor.alias("donor"))
    given = own.select(F.col("c").alias("donor"), F.col("n").alias("dn"))
    convs = checkpointed(own.join(given, "donor", "left").select("c", "n", "h", "donor", F.when(F.col("dn").isNull(), 0).otherwise(F.least("h", "dn")).cast("long").alias("k")))
    kept = turns.join(convs, "c").filter("p > h").select("c", (F.col("p") - F.col("h") + F.col("k")).alias("p"), "g1", "g2", "words")
    opening = turns.filter((donor == F.col("c")) & (F.col("p") <= 3)).withColumnRenamed("c", "donor")  # three turns a donor at most
    taken = opening.join(convs.select("c", "donor", "h"), "donor").filter("p <= h").select("c", "p", "g1", "g2", "words")
    length = F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return kept.unionByName(taken), convs.select("c", length.cast("long").alias("length"))


def _paths(turns: DataFrame) -> DataFrame:
    """Every turn with the node that its prefix leads to (``k1, k2``) and the one before (``p1, p2``).

    A node's digest is the XOR of the digests of its places, so that it is a running total like any other.
    """
    placed = turns.select("c", "p", "words", F.xxhash64("p", "g1", "g2").alias("h1"), F.xxhash64("g2", "p", F.lit(7), "g1").alias("h2"),
                          F.floor(F.col("p") / TILE).alias("tile"))
    scanned = tiled_scan(placed, ["c"], "tile", ["p"], {"k1": ("xor", F.col("h1"), "upto"), "k2": ("xor", F.col("h2"), "upto")})
    return scanned.select("c", "p", "words", *NODE, F.col("k1").bitwiseXOR(F.col("h1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("h2")).alias("p2"))


def _endings(ends: DataFrame) -> DataFrame:
    """``k1, k2, ends``: SHA-256 of the conversations that end in a node, ascending and comma-joined.

    Ids are sorted and joined within blocks of 4,096 numbers; a node of several blocks is hashed block after block from a
    sorted stream, in constant memory, as that digest can't be taken in parts.
    """
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda c: c.cast("string")), ",")
    blocks = checkpointed(ends.groupBy(*NODE, F.shiftright("c", 12).alias("block")).agg(ids.alias("ids")))
    parts = blocks.groupBy(*NODE).agg(F.count(F.lit(1)).alias("parts"))
    alone = blocks.join(parts.filter("parts = 1"), NODE).select(*NODE, F.sha2("ids", 256).alias("ends"))

    def stream(batches):
        node, state = None, None
        for batch in batches:
            found = []
            for k1, k2, ids in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if (k1, k2) != node:
                    if node is not None:
                        found.append((*node, state.hexdigest()))
                    node, state = (k1, k2), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _ended(found)
        if node is not None:
            yield _ended([(*node, state.hexdigest())])

    many = (blocks.join(parts.filter("parts > 1"), NODE).repartition(*NODE).sortWithinPartitions(*NODE, "block")
            .select(*NODE, "ids").mapInArrow(stream, "k1 bigint, k2 bigint, ends string"))
    return alone.unionByName(many)


def _ended(rows):
    kinds = [pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], [*NODE, "ends"])


def subtree_totals(nodes: DataFrame, values: list[str]) -> DataFrame:
    """Sums of ``values`` over the subtree of every node of a tree (``k1, k2``, parent ``p1, p2``, null at the root).

    Each round rakes all leaves onto their parents and compresses chains: of neighbours with one child each, about a
    quarter give their value to their parent and their child to it too, never two in a row. So the rounds grow with the
    logarithm of the nodes, however deep the tree is. Compressed nodes are then re-expanded, last round first: their total
    is their value and their child's total. Children are summed and counted on the map side, a node with any number of
    them is one row in every join. Rounds are landed as Parquet and removed at the end.
    """
    land = Landing(nodes.sparkSession)
    up = [F.col("p1").alias("k1"), F.col("p2").alias("k2")]
    same = lambda a, b: (F.col(f"{a}.k1") == F.col(f"{b}.k1")) & (F.col(f"{a}.k2") == F.col(f"{b}.k2"))
    tree, done, spliced, rounds = land.land(nodes.select(*NODE, "p1", "p2", *values)), [], [], 0
    while True:
        # every node tells its parent that it is there: nodes and what they are told are summed up together
        told = tree.withColumns({"kids": F.lit(0), "kid": F.lit(None).cast("struct<k1:bigint,k2:bigint>")}).unionByName(
            tree.filter("p1 IS NOT NULL").select(*up, F.lit(1).alias("kids"), F.struct(*NODE).alias("kid")), allowMissingColumns=True)
        seen = land.land(told.groupBy(*NODE).agg(*[F.max(c).alias(c) for c in ("p1", "p2")], *[F.sum(v).alias(v) for v in values], F.sum("kids").alias("kids"),
                                                 F.min("kid").alias("kid"))
                         .withColumn("chain", (F.col("kids") == 1) & F.col("p1").isNotNull())
                         .withColumn("coin", F.col("chain") & (F.xxhash64(*NODE, F.lit(rounds)).bitwiseAND(F.lit(1)) == 1)))
        if seen.filter("p1 IS NOT NULL").isEmpty():
            done.append(seen.select(*NODE, *values))
            break
        raked = seen.filter("kids = 0 AND p1 IS NOT NULL").select(*NODE, "p1", "p2", *values)
        below = seen.filter("kids > 0 AND NOT coin").select(*NODE)
        upper = seen.filter("coin").select(*[F.col(k).alias(f"v{k}") for k in NODE], "p1", "p2", *values, "kid.*")
        out = land.land(upper.join(below, NODE))
        # what stays, what it gains, its new parent and what goes, again in one sum
        moved = F.struct(F.col("p1"), F.col("p2")).alias("q")
        parts = [seen.filter("kids > 0 OR p1 IS NULL").select(*NODE, "p1", "p2", *values, F.lit(False).alias("gone")), raked.select(*up, *values), out.select(*up, *values),
                 out.select(*NODE, moved), out.select(F.col("vk1").alias("k1"), F.col("vk2").alias("k2"), F.lit(True).alias("gone"))]
        for part in parts[1:]:
            parts[0] = parts[0].unionByName(part, allowMissingColumns=True)
        summed = parts[0].groupBy(*NODE).agg(F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.max("q").alias("q"), F.max("gone").alias("gone"),
                                             *[F.sum(v).alias(v) for v in values])
        new = land.land(summed.filter("NOT gone").select(*NODE, F.coalesce("q.p1", "p1").alias("p1"), F.coalesce("q.p2", "p2").alias("p2"), *values))
        done.append(raked.select(*NODE, *values))
        spliced.append(out)
        land.drop(tree)
        tree, rounds = new, rounds + 1
    total = done.pop()
    while spliced:
        total = total.unionByName(done.pop())
        out = spliced.pop()
        if not out.isEmpty():
            again = out.alias("a").join(total.alias("b"), same("a", "b")).select(
                F.col("vk1").alias("k1"), F.col("vk2").alias("k2"), *[(F.col(f"a.{v}") + F.col(f"b.{v}")).alias(v) for v in values])
            total = total.unionByName(land.land(again))
    total = checkpointed(total)
    land.close()
    return total


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the trie of ``turns`` (``c, p, g1, g2, words``) of the conversations ``convs`` (``c, length``).

    ``k1, k2`` (digest of the prefix; 0, 0 is the root), ``depth``, ``conv_id`` (smallest member), ``parent_conv_id``,
    ``n_convs`` (members), ``n_children``, ``n_leaves`` and ``saved_tokens`` (over the subtree) and ``ends_sha256``. No
    conversation gives no node.
    """
    paths = checkpointed(_paths(turns))
    zero = [F.lit(0).cast("long").alias(k) for k in NODE]
    none = [F.lit(None).cast("long").alias(k) for k in ("p1", "p2")]
    nodes = (paths.groupBy(*NODE).agg(F.min("p").alias("depth"), F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("words").alias("words"),
                                      F.min("p1").alias("p1"), F.min("p2").alias("p2")))
    root = (convs.agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
            .select(*zero, F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs", F.lit(0).cast("long").alias("words"), *none))
    nodes = checkpointed(nodes.unionByName(root))
    kids = nodes.filter("p1 IS NOT NULL").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = checkpointed(nodes.join(kids, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")))
    own = nodes.select(*NODE, "p1", "p2", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
                       ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    totals = subtree_totals(own, ["n_leaves", "saved_tokens"])
    last = paths.join(convs.withColumnRenamed("length", "p"), ["c", "p"]).select(*NODE, "c")
    ends = _endings(last.unionByName(convs.filter("length = 0").select(*zero, "c")))
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(totals, NODE).join(ends, NODE, "left")
    out = same_join(out, parents, ["p1", "p2"], "left")
    return out.select(*NODE, "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The prefix trie of all rebuilt conversations of a table ``conv_id, turn, role, text``.

    Null roles and texts count as empty; rows without ``conv_id`` are left out; turns that tie are ordered by role and
    text, so repeated rows are turns of their own; a conversation whose turns are all taken away is a member of the root
    and ends there; an empty table gives no rows; other columns are left out.
    """
    turns, convs = rebuilt(checkpointed(ordered_turns(conversations)))
    return prefix_trie(turns, convs)
