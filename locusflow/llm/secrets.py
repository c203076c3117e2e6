"""Secret scans: candidates by pattern, judged by how many repositories and owners hold the same value across the corpus."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from locusflow.llm import words
from locusflow.operators.scaling import Landing, checkpointed

# The kinds in their order, and their patterns.
BASE_KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]{16,}")
# Prefixes that services put before their tokens.
_ISSUED = re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}|xox[baprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}")
_OPAQUE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
FEW_REPOS, MAX_REPOS = 5, 100  # documents that may be mirrors of one credential; documents that a few owners' credential may stand in
_HINTS = ("passw", "secret", "token", "api")


def entropy(value: str) -> float:
    """Bits per character."""
    return sum(-n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def candidates(text: str) -> list[tuple[str, int, int, str]]:
    """``(kind, start, end, value)`` of base kinds, issued tokens and opaque high-entropy strings, in code points."""
    out = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        out += [("assign", m.start(), m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    out += [("hex", m.start(), m.end(), m[0]) for m in _HEX.finditer(text)]
    out += [("issued", m.start(), m.end(), m[0]) for m in _ISSUED.finditer(text)]
    taken = sorted((s, e) for _, s, e, _ in out)
    at = reach = 0  # spans that start before an opaque string ends, and how far they reach
    for m in _OPAQUE.finditer(text):
        v = m[0]
        while at < len(taken) and taken[at][0] < m.end():
            reach = max(reach, taken[at][1])
            at += 1
        if reach <= m.start() and any(c.isdigit() for c in v) and any(c.isupper() for c in v) and any(c.islower() for c in v) and entropy(v) >= 3.5:
            out.append(("opaque", m.start(), m.end(), v))
    return out


_ORDER = {k: i for i, k in enumerate((*BASE_KINDS, "issued", "opaque"))}
_SCHEMA = ("n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, "
           "found array<struct<kind:string, start:bigint, end:bigint, value:binary>>")


def find_candidates(docs: DataFrame, id_col: str, owner_col: str, text_col: str) -> DataFrame:
    """``row`` (hash of id, owner and text), id, owner, base counts and digest, and the candidates with hashed values."""
    kinds = [docs.schema[c].dataType.simpleString() for c in (id_col, owner_col)]
    struct = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.binary())])

    def one(text):
        found = sorted(candidates(text or ""), key=lambda c: (c[1], _ORDER[c[0]]))
        base = [c for c in found if c[0] in BASE_KINDS]
        n = Counter(c[0] for c in base)
        digest = hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e, _ in base).encode()).hexdigest()
        values = [{"kind": k, "start": s, "end": e, "value": hashlib.sha256(v.encode()).digest()[:16]} for k, s, e, v in found]
        return n["assign"], n["access"], n["hex"], digest, values

    def scan(batches):
        for batch in batches:
            rows = [one(t.decode()) for _, _, texts in words.slices(batch.column(3)) for t in texts]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *[pa.array(c, t) for c, t in zip(columns, (*[pa.int64()] * 3, pa.string(), pa.list_(struct)), strict=True)]],
                ["row", "id", "owner", "n_assign", "n_access", "n_hex", "base_sha256", "found"])

    rows = docs.select(row_key(id_col, owner_col, text_col).alias("row"), F.col(id_col).alias("id"),
                       F.col(owner_col).alias("owner"), F.col(text_col).alias("text"))
    return rows.mapInArrow(scan, f"row bigint, id {kinds[0]}, owner {kinds[1]}, {_SCHEMA}")


def row_key(id_col: str, owner_col: str, text_col: str):
    """Equal for equal rows; tells rows with the same id and another text apart."""
    return F.xxhash64(id_col, owner_col, text_col)


def ownership(found: DataFrame) -> DataFrame:
    """For every candidate value: in how many places, distinct documents (repositories) and with how many owners it stands.

    Counted in three steps, by value and document, by value and owner and then by value, so that a value copied
    everywhere is summed before it is shuffled. Rows repeated with id, owner and text are one document.
    """
    each = found.select("row", "owner", F.explode("found").alias("c")).select("row", "owner", "c.value")
    by_document = each.groupBy("value", "owner", "row").agg(F.count(F.lit(1)).alias("n"))
    by_owner = by_document.groupBy("value", "owner").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_repos"))
    return by_owner.groupBy("value").agg(F.sum("n").alias("n_places"), F.sum("n_repos").alias("n_repos"),
                                         F.count(F.lit(1)).alias("n_owners"))


def looks_live(max_owners: int, few_repos: int, max_repos: int):
    """Held by few documents, whoever owns them (mirrors), or by few owners in not too many documents."""
    return (F.col("n_repos") <= few_repos) | ((F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos))


def judged(found: DataFrame, max_owners: int = 3, few_repos: int = FEW_REPOS, max_repos: int = MAX_REPOS) -> DataFrame:
    """For every row with candidates: ``verdicts``, the candidates with ``n_owners``, ``n_repos`` and ``live``."""
    each = found.select("row", F.explode("found").alias("c")).distinct()
    counts = ownership(found)
    live = looks_live(max_owners, few_repos, max_repos).alias("live")
    rows = (each.withColumn("value", F.col("c.value")).join(counts, "value")
            .select("row", F.struct(F.col("c.start").alias("start"), F.col("c.end").alias("end"), F.col("c.kind").alias("kind"),
                                    "n_owners", "n_repos", "n_places", live).alias("v")))
    return rows.groupBy("row").agg(F.array_sort(F.collect_list("v")).alias("verdicts"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", owner_col: str = "source", text_col: str = "text",
                 max_owners: int = 3, few_repos: int = FEW_REPOS, max_repos: int = MAX_REPOS) -> DataFrame:
    """One row per row of ``docs``: base counts and digest, all ``spans``, ``n_live`` and ``n_example``.

    Base spans and issued tokens always count as found; opaque strings only if they look live. A value looks live
    (``n_live``) if it stands in at most ``few_repos`` documents, or in at most ``max_repos`` of at most ``max_owners``
    owners; else it is a widely copied example (``n_example``). A null text
    counts as empty, null owners as one owner; repeated rows give repeated rows; other columns are left out.
    """
    found = checkpointed(find_candidates(docs, id_col, owner_col, text_col))
    verdicts = judged(found.filter(F.size("found") > 0), max_owners, few_repos, max_repos)
    rank = F.create_map(*[F.lit(x) for k, i in _ORDER.items() for x in (k, i)])
    kept = F.filter("verdicts", lambda v: (v["kind"] != "opaque") | v["live"])
    ordered = F.array_sort(F.transform(kept, lambda v: F.struct(
        v["start"].alias("start"), rank[v["kind"]].alias("rank"), v["end"].alias("end"), v["kind"].alias("kind"))))
    spans = F.array_join(F.transform(ordered, lambda v: F.concat_ws(":", v["kind"], v["start"], v["end"])), ",")
    count = lambda live: F.coalesce(F.size(F.filter("verdicts", lambda v: v["live"] == live)), F.lit(0)).cast("long")
    return (found.drop("found", "owner").join(verdicts, "row", "left")
            .select(F.col("id").alias(id_col), "n_assign", "n_access", "n_hex", "base_sha256", F.coalesce(spans, F.lit("")).alias("spans"),
                    F.when(F.col("verdicts").isNull(), 0).otherwise(count(True)).cast("long").alias("n_live"),
                    F.when(F.col("verdicts").isNull(), 0).otherwise(count(False)).cast("long").alias("n_example")))


def redact(docs: DataFrame, id_col: str = "doc_id", owner_col: str = "source", text_col: str = "text", max_owners: int = 3,
           mark: str = "[secret]", few_repos: int = FEW_REPOS, max_repos: int = MAX_REPOS) -> DataFrame:
    """``docs`` with every live-looking value's span replaced by ``mark``; widely copied examples stay. All rows stay."""
    found = checkpointed(find_candidates(docs, id_col, owner_col, text_col).filter(F.size("found") > 0))
    live = (judged(found, max_owners, few_repos, max_repos).select("row", F.filter("verdicts", lambda v: v["live"]).alias("_spans"))
            .filter(F.size("_spans") > 0))
    live = Landing(docs.sparkSession).land(live)  # with its true size, so that few spans are broadcast and the documents stay where they are
    text = F.col(text_col)
    # spans in order; what a span shares with those before it is already gone
    cut = F.aggregate("_spans", F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at")), lambda a, v: F.when(
        v["end"] <= a["at"], a).otherwise(F.struct(F.concat(
            a["done"], text.substr((a["at"] + 1).cast("int"), F.greatest(v["start"] - a["at"], F.lit(0)).cast("int")),
            F.when(v["start"] < a["at"], F.lit("")).otherwise(F.lit(mark))).alias("done"), v["end"].alias("at"))))
    rest = F.struct(cut.alias("c"))
    out = docs.withColumn("_row", row_key(id_col, owner_col, text_col)).join(live.withColumnRenamed("row", "_row"), "_row", "left")
    out = out.withColumn("_cut", F.when(F.col("_spans").isNotNull(), rest["c"]))
    clean = F.concat("_cut.done", text.substr((F.col("_cut.at") + 1).cast("int"), F.length(text)))
    return (out.withColumn(text_col, F.coalesce(clean, text)).select(*docs.columns))
