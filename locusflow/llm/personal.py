"""Personal data: patterns, gazetteers and context vote, a model of their reliability trains the final span classifier.

Everything that touches documents is a DataFrame expression. Only the table of vote patterns (at most a few hundred
rows: kinds times combinations of votes) reaches the driver, where the reliabilities are estimated.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from locusflow.operators.scaling import checkpointed

# Base kinds in their order with their patterns. Possessive where nothing can be given back, and a local
# part or number only starts where its run starts (or where the match before ended), so that long runs cost linear time.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# Further kinds, found by the vote alone.
MORE = {
    "tel": r"(?<![0-9+)-])(?<![0-9+)-] )(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
}
# What a text must hold before a pattern is tried.
_NEEDS = {"email": "@", "phone": "+"}
# Gazetteers as patterns on the value.
GAZETTEER = {
    "email": r"(?i)\.(com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu|ch|at|us)$",
    "ip": r"^(?!0*(0|10|127|255)\.|0*192\.0*168\.|0*169\.0*254\.)",
    "card": r"^(4|5[1-5]|2[2-7]|3[47]|6011|65)",
    "phone": r"^\+(1|33|34|39|41|43|44|49)(?![0-9]{11})",
    "tel": r"^\(?[2-9]",
    "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)",
    "iban": r"^(AT|BE|CH|DE|ES|FR|GB|IT|NL|PL|PT)",
}
# Words that announce a value.
CONTEXT = {
    "email": r"(?i)(mail|contact|write|reach)",
    "ip": r"(?i)(\bip\b|address|host|server)",
    "card": r"(?i)(card|visa|credit|payment)",
    "phone": r"(?i)(phone|tel|call|mobile|fax)",
    "tel": r"(?i)(phone|tel|call|mobile|fax)",
    "ssn": r"(?i)(ssn|social security)",
    "iban": r"(?i)(iban|account|bank)",
}
# The stricter form of each kind.
STRICT = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@([A-Za-z0-9-]+\.)+[A-Za-z]{2,}$",
    "ip": r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$",
    "card": r"^([0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\2[0-9]{4}\2[0-9]{1,7})$",
    "phone": r"^\+[0-9]{1,3}[ -]?(\([0-9]{1,4}\)|[0-9])[0-9 .-]*$",
    "tel": r"^\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}$|^([0-9]{3})([.-])[0-9]{3}\2[0-9]{4}$",
    "ssn": r"^[0-9-]+$",
    "iban": r"^[A-Z]{2}[0-9]{2}( [A-Z0-9]{4})+( [A-Z0-9]{1,3})?$|^[A-Z0-9]+$",
}
LABELERS = ("strict", "gazetteer", "context", "edges")
_EMPTY = "array<struct<start:int, end:int, value:string, before:string, after:string>>"
BLOCK = 256  # matches whose places are added up one after the other
CONTEXT_CHARS = 32


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _matches(text: Column, pattern: str, needs: Column) -> Column:
    """All matches with their places, up to 32 characters ``before`` them and the one ``after``.

    Places are sums of the lengths of matches and of the pieces between them, first within blocks of 256 matches, then
    over the blocks: a list grows by a copy, so one long list would cost the square of its length. What stands before a
    match is taken from the pieces, not from the text.
    """
    last = lambda x: F.right(x, F.lit(CONTEXT_CHARS))

    def block(rows, b):
        lead = F.slice(rows, F.greatest(b * BLOCK - CONTEXT_CHARS + 1, F.lit(1)), F.least(F.lit(CONTEXT_CHARS), b * BLOCK))
        start = F.struct(F.lit(0).alias("at"), last(F.array_join(F.transform(lead, lambda x: F.concat(x["p"], x["m"])), "")).alias("tail"),
                         F.array().cast(_EMPTY).alias("out"))

        def add(acc, x):
            s = acc["at"] + F.length(x["p"])
            e = s + F.length(x["m"])
            before = last(F.concat(acc["tail"], x["p"]))
            found = F.struct(s.alias("start"), e.alias("end"), x["m"].alias("value"), before.alias("before"), x["after"].alias("after"))
            return F.struct(e.alias("at"), last(F.concat(before, x["m"])).alias("tail"), F.array_append(acc["out"], found).alias("out"))

        return F.aggregate(F.slice(rows, b * BLOCK + 1, F.lit(BLOCK)), start, add, lambda acc: F.struct(acc["at"].alias("size"), acc["out"].alias("out")))

    def placed(blocks):
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        offsets = F.aggregate(blocks, start, lambda acc, x: F.struct((acc["at"] + x["size"]).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")),
                              lambda acc: acc["out"])
        moved = lambda s, at: F.struct((s["start"] + at).alias("start"), (s["end"] + at).alias("end"), s["value"].alias("value"),
                                       s["before"].alias("before"), s["after"].alias("after"))
        return F.flatten(F.zip_with(blocks, offsets, lambda x, at: F.transform(x["out"], lambda s: moved(s, at))))

    def spans(cut):
        n = F.size(cut["m"])
        following = F.slice(F.concat(F.slice(cut["m"], F.lit(2), n), F.array(F.lit(""))), F.lit(1), n)
        rows = F.zip_with(F.zip_with(F.slice(cut["p"], F.lit(1), n), cut["m"], lambda p, m: F.struct(p.alias("p"), m.alias("m"))),
                          F.zip_with(F.slice(cut["p"], F.lit(2), n), following, lambda p, m: F.left(F.concat(p, m), F.lit(1))),
                          lambda x, after: F.struct(x["p"].alias("p"), x["m"].alias("m"), after.alias("after")))
        blocks = lambda rows: F.transform(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")), lambda b: block(rows, b))
        return F.when(n > 0, _let(rows, lambda r: _let(blocks(r), placed))).otherwise(F.array().cast(_EMPTY))

    cut = F.struct(F.split(text, pattern, -1).alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    return F.when(needs, _let(cut, spans)).otherwise(F.array().cast(_EMPTY))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total, i):
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(value, r"\."), lambda p: F.when(F.length(part(p)) > 3, F.lit(False)).otherwise(
            F.when(part(p) == "", 0).otherwise(part(p).cast("int")) <= 255))
    if kind == "card":
        return F.when(F.length(_digits(value)).between(13, 19), _luhn(_digits(value))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _votes(kind: str, span: Column) -> Column:
    """One vote for each labeler: 1 personal, -1 not, 0 no opinion."""
    before, left, right = span["before"], F.right(span["before"], F.lit(1)), span["after"]
    sign = lambda yes: F.when(yes, 1).otherwise(-1)
    votes = (sign(span["value"].rlike(STRICT[kind])), sign(span["value"].rlike(GAZETTEER[kind])),
             F.when(before.rlike(CONTEXT[kind]), 1).otherwise(0), sign(~left.rlike("[A-Za-z0-9]") & ~right.rlike("[A-Za-z0-9]")))
    return F.struct(F.lit(kind).alias("kind"), span["start"].alias("start"), span["end"].alias("end"),
                    *[v.cast("int").alias(n) for n, v in zip(LABELERS, votes, strict=True)])


def find_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, base`` and ``more``: spans with their votes, base kinds in order and the others."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("digit", F.col("text").rlike("[0-9][ .()-]?[ .()-]?[0-9]"))
    t = F.col("text")
    rows = rows.withColumns({f"m_{k}": _matches(t, p, t.contains(_NEEDS[k]) if k in _NEEDS else F.col("digit")) for k, p in (BASE | MORE).items()})
    voted = lambda kind, spans: F.transform(spans, lambda s: _votes(kind, s))
    passing = lambda kind: F.filter(f"m_{kind}", lambda s: _valid(kind, s["value"]))
    return rows.select("id", F.concat(*[voted(k, passing(k)) for k in BASE]).alias("base"),
                       F.concat(*[voted(k, F.col(f"m_{k}")) for k in MORE]).alias("more"))


def estimate(patterns: list[tuple[str, tuple[int, ...], int]], rounds: int = 50) -> dict:
    """Expectation-maximisation over vote patterns: ``accuracy`` of each labeler, ``prior`` of each kind, ``posterior`` of each."""
    accuracy = [0.8] * len(LABELERS)
    prior = dict.fromkeys({k for k, _, _ in patterns}, 0.5)
    posterior = {}
    for _ in range(rounds):
        for kind, votes, _ in patterns:
            odds = math.log(prior[kind] / (1 - prior[kind])) + sum(v * math.log(a / (1 - a)) for v, a in zip(votes, accuracy, strict=True))
            posterior[kind, votes] = 1 / (1 + math.exp(-odds))
        for k in range(len(LABELERS)):  # one pseudo-count of either kind keeps an accuracy inside (0, 1)
            right = sum(n * (posterior[kind, v] if v[k] > 0 else 1 - posterior[kind, v]) for kind, v, n in patterns if v[k])
            accuracy[k] = min(0.99, max(0.51, (right + 8) / (sum(n for _, v, n in patterns if v[k]) + 10)))
        for kind in prior:
            mine = [(posterior[k, v], n) for k, v, n in patterns if k == kind]
            prior[kind] = min(0.95, max(0.05, (sum(p * n for p, n in mine) + 1) / (sum(n for _, n in mine) + 2)))
    return {"accuracy": accuracy, "prior": prior, "posterior": posterior}


def train_span_classifier(patterns: list[tuple[str, tuple[int, ...], int]], posterior: dict, rounds: int = 400, rate: float = 0.5) -> list[float]:
    """Logistic regression on the votes (and a bias, last) with the posteriors as soft labels."""
    w = [0.0] * (len(LABELERS) + 1)
    total = sum(n for _, _, n in patterns) or 1
    for _ in range(rounds):
        g = [0.0] * len(w)
        for kind, votes, n in patterns:
            x = (*votes, 1)
            p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, x, strict=True))))
            for k, v in enumerate(x):
                g[k] += n / total * (p - posterior[kind, votes]) * v
        w = [a - rate * b - rate * 1e-4 * a for a, b in zip(w, g, strict=True)]
    return w


def scan_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: counts of the base kinds, digest of the base spans, all ``spans`` and ``n_likely``.

    Base spans always stay; spans of further kinds are added when the classifier gives them at least ``least`` and no
    base span overlaps them. ``n_likely`` counts all spans the classifier takes for personal. A null text counts as empty;
    repeated rows give repeated rows; a null id is kept; other columns are left out; without any span all weights are 0.
    """
    found = checkpointed(find_spans(docs, id_col, text_col))
    votes = found.select(F.explode(F.concat("base", "more")).alias("s")).select("s.kind", *[f"s.{n}" for n in LABELERS])
    counted = votes.groupBy("kind", *LABELERS).agg(F.count(F.lit(1)).alias("n"))  # at most kinds x 3^labelers rows
    patterns = sorted((r.kind, tuple(r[n] for n in LABELERS), r.n) for r in counted.collect())
    weights = train_span_classifier(patterns, estimate(patterns)["posterior"])

    def likely(s):
        score = sum((s[n] * w for n, w in zip(LABELERS, weights, strict=False)), F.lit(weights[-1]))
        return 1 / (1 + F.exp(-score)) >= least

    clear = lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    rows = found.withColumn("added", F.filter("more", lambda s: likely(s) & clear(s)))
    name = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.select(
        F.col("id").alias(id_col), *[count(k) for k in BASE], F.sha2(name(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        name(F.concat("base", "added")).alias("spans"), F.size(F.filter(F.concat("base", "added"), likely)).cast("long").alias("n_likely"))
