"""Personal data by weak supervision, in DataFrame functions only.

Patterns, word lists and context words vote on every candidate span;
expectation-maximisation estimates how reliable each voter is, and a logistic
classifier trained on its posteriors decides which spans beyond the base kinds count.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featloom.llm.common import keyed, labelled, materialize, with_spans

BASE = ("email", "ip", "card", "phone")
LOOSE = ("masked_email", "local_phone", "national_id", "iban", "titled_name")
KINDS = (*BASE, *LOOSE)

# The base patterns of the contract in a form that takes time in proportion to the text and no deep recursion:
# a match can only begin where a run begins or the last match ended, and a repeated group is a lazy run up to where it must end.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9-][A-Za-z0-9.-]*?(?=\.\.|\.?(?![A-Za-z0-9.-]))"
)
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?=[\x20-]?[0-9])[0-9\x20-]+?(?<=[0-9])(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PATTERNS = {
    "masked_email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}+ ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z]{2,12}(?![A-Za-z])",
    "local_phone": r"(?<![0-9+)-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "titled_name": r"(?<![\p{L}])(?:Mr|Mrs|Ms|Dr|Herr|Frau|Mme|Señora?)\.? \p{Lu}[\p{L}'-]{1,40}",
}
# Word lists of the voters.
DOMAINS = "com|org|net|edu|gov|io|de|fr|es|uk|eu|info|it|nl|ch|at|us|ca"
FOR = r"(?i)\b(?:e-?mail|mail|correo|courriel|contact|kontakt|contacto|phone|tel|telefon|t[eé]l[eé]phone|call|mobile|fax|host|server|client|card|karte|carte|tarjeta|visa|ssn|social|iban|konto|cuenta|compte|name|nom|nombre)\b"
AGAINST = r"(?i)\b(?:version|build|release|isbn|sku|order|bestellung|commande|pedido|invoice|page|seite|serial|model|chapter|example)\b"
VOTERS = ("format", "gazetteer", "context", "against", "edges")
ROUNDS, STEPS = 10, 60


def valid(kind: str, hit: Column) -> Column:
    """Whether a match of a base pattern counts."""
    digits = F.regexp_replace(hit, "[^0-9]", "")
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
        return hit.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _votes() -> dict[str, Column]:
    """1 for, -1 against, 0 for no opinion, from ``kind``, ``hit``, ``before`` and ``after``."""
    kind, hit, before, after = (F.col(c) for c in ("kind", "hit", "before", "after"))
    digits = F.regexp_replace(hit, "[^0-9]", "")
    sure = kind.isin(*BASE)
    area = F.substring(digits, 1, 3)
    return {
        "format": F.when(kind == "email", F.when(hit.rlike(rf"(?i)\.(?:{DOMAINS})$"), 1).otherwise(0))
        .when(kind == "masked_email", F.when(hit.rlike(rf"(?i)(?:\(|\[| )dot(?:\)|\]| ) ?(?:{DOMAINS})$"), 1).otherwise(-1))
        .when(kind == "national_id", F.when(area.isin("000", "666") | (area >= "900") | hit.rlike("-00-|-0000$"), -1).otherwise(1))
        .when(kind == "local_phone", F.when(hit.rlike("^\\(?[2-9]"), 1).otherwise(-1))
        .when(kind == "iban", F.when(F.length(F.regexp_replace(hit, " ", "")).between(15, 34), 1).otherwise(-1))
        .when(kind == "ip", F.when(hit.rlike(r"^(?:0|127|255)\."), -1).otherwise(1))
        .otherwise(F.when(sure, 1).otherwise(0)),
        "gazetteer": F.when(kind.isin("email", "masked_email"), F.when(hit.rlike(rf"(?i)(?:{DOMAINS})$"), 1).otherwise(-1))
        .when(kind == "iban", F.when(hit.rlike("^(?:DE|FR|ES|IT|NL|BE|AT|CH|GB|PT|IE|LU|PL)"), 1).otherwise(-1))
        .when(kind == "phone", F.when(hit.rlike(r"^\+(?:1|3[0-9]|4[0-9]|5[0-9]|6[0-9]|7|8[0-9]|9[0-9])"), 1).otherwise(-1))
        .when(kind == "titled_name", F.when(hit.rlike(r"^(?:Mrs|Herr|Frau|Mme|Se)"), 1).otherwise(0))
        .otherwise(0),
        "context": F.when(before.rlike(FOR), 1).otherwise(0),
        "against": F.when(before.rlike(AGAINST), -1).otherwise(0),
        "edges": F.when(before.rlike(r"[\p{L}\p{N}]$") | after.rlike(r"^[\p{L}\p{N}]"), -1).otherwise(1),
    }


@dataclass(frozen=True)
class SpanModel:
    """``reliability[voter][vote] = (share among true spans, share among others)``; ``weights`` of the span classifier."""

    prior: float
    reliability: dict[str, dict[int, tuple[float, float]]]
    weights: dict[str, float]

    def probability(self) -> Column:
        """The classifier's probability for a row of spans, as one expression."""
        z = F.lit(self.weights["one"])
        for name, value, feature in FEATURES:
            z = z + F.when(F.col(name) == value, self.weights[feature]).otherwise(0.0)
        return 1 / (1 + F.exp(-z))


#: Column, value and name of every feature of the classifier: votes, kinds and sizes.
FEATURES = [
    *[(v, s, f"{v}={s}") for v in VOTERS for s in (1, -1)], *[("kind", k, f"kind={k}") for k in KINDS], *[("size", s, f"size={s}") for s in range(5)],
]


def fit(spans: DataFrame) -> SpanModel:
    """Fit on all candidate spans through the counts of equal kind, size and votes.

    There are at most 9 kinds, 5 sizes and 3 votes of 5 voters, so the driver gets
    a table of bounded size, whatever the number of spans. Expectation: the
    probability that a span with these votes is true; maximisation: the share of
    each vote among true and other spans, smoothed by one. The logistic classifier
    is then trained on the resulting probabilities. Without spans the starting
    values stay.
    """
    counts = [(r["n"], r) for r in spans.groupBy("kind", "size", *VOTERS).agg(F.count("*").alias("n")).collect()]
    prior, shares = 0.5, {v: {1: (0.6, 0.3), -1: (0.1, 0.4), 0: (0.3, 0.3)} for v in VOTERS}
    total = sum(n for n, _ in counts)
    truth = []
    for _ in range(ROUNDS if counts else 0):
        odds = [math.log(prior / (1 - prior)) + sum(math.log(shares[v][r[v]][0] / shares[v][r[v]][1]) for v in VOTERS) for _, r in counts]
        truth = [_sigmoid(x) for x in odds]
        yes = sum(n * p for (n, _), p in zip(counts, truth))
        prior = (yes + 1) / (total + 2)
        for v in VOTERS:
            for s in (1, -1, 0):
                mine = sum(n * p for (n, r), p in zip(counts, truth) if r[v] == s)
                others = sum(n * (1 - p) for (n, r), p in zip(counts, truth) if r[v] == s)
                shares[v][s] = ((mine + 1) / (yes + 3), (others + 1) / (total - yes + 3))
    weights = {"one": 0.0, **{feature: 0.0 for _, _, feature in FEATURES}}
    active = [["one", *[f for name, value, f in FEATURES if r[name] == value]] for _, r in counts]
    mass = {f: sum(n for (n, _), a in zip(counts, active) if f in a) for f in weights}
    for _ in range(STEPS if counts else 0):
        slope = dict.fromkeys(weights, 0.0)
        for (n, _), p, a in zip(counts, truth, active):
            error = n * (p - _sigmoid(sum(weights[f] for f in a)))
            for f in a:
                slope[f] += error
        for f in weights:  # a step for each feature by how many spans have it
            weights[f] += (slope[f] - 0.01 * weights[f]) / (mass[f] + 1)
    return SpanModel(prior, shares, weights)


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), threshold: float = 0.5) -> DataFrame:
    """One row for each input row: ``key``, the base spans (``email``, ``ip``, ``card``, ``phone``), ``added`` spans, and ``keep``.

    Base spans are all valid matches in the whole text; the voters and the
    classifier add spans of other kinds that no base span touches. Base spans are
    ``array<struct<start, end, hit, before, after>>``, added ones
    ``array<struct<start, order, end, kind>>``. Null text counts as empty.
    Repeated rows and null keys are judged each by itself. ``keep`` names columns
    of ``docs`` to carry along instead of ``key``; others are not read.
    """
    body = F.coalesce(text, F.lit(""))
    rows = docs.select(F.col(key).alias("key"), F.struct(F.lit(1).alias("one"), *keep).alias("kept"), body.alias("body"))
    b = F.col("body")
    some = b.rlike("[0-9]")
    tests = {
        "email": (EMAIL, b.contains("@")), "ip": (IP, some & b.contains(".")), "card": (CARD, some), "phone": (PHONE, b.contains("+")),
        "masked_email": (PATTERNS["masked_email"], b.contains("dot")), "local_phone": (PATTERNS["local_phone"], some),
        "national_id": (PATTERNS["national_id"], some & b.contains("-")), "iban": (PATTERNS["iban"], some), "titled_name": (PATTERNS["titled_name"], None),
    }
    rows = with_spans(rows, "body", tests, before=40, after=8).drop("body")
    check = lambda kind: lambda s: valid(kind, s.hit)
    named = lambda kind: lambda s: F.struct(F.lit(kind).alias("kind"), s.alias("s"))
    rows = rows.withColumns({k: F.filter(k, check(k)) for k in BASE})
    found = keyed(rows, "uid", "pii-scan")
    every = F.concat(*[F.transform(k, named(k)) for k in KINDS])
    spans = found.select("uid", F.explode(every).alias("e")).select("uid", "e.kind", "e.s.*")
    spans = spans.withColumns(_votes()).withColumn("size", F.least(F.length("hit") / 8, F.lit(4)).cast("int"))
    spans = materialize(spans.drop("hit", "before", "after"), "pii-spans")
    model = fit(spans)
    # A loose span must not touch a base span: the furthest base end so far, and the next base start.
    base = F.col("kind").isin(*BASE)
    w = Window.partitionBy("uid").orderBy("start", "end", "kind")
    spans = spans.withColumns({
        "far": F.max(F.when(base, F.col("end"))).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        "next": F.min(F.when(base, F.col("start"))).over(Window.partitionBy("uid").orderBy(F.desc("start"), F.desc("end"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)),
        "previous": F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)),
    })
    free = (F.coalesce("far", F.lit(0)) <= F.col("start")) & (F.coalesce("next", F.col("end")) >= F.col("end"))
    added = spans.where(~base & free & (model.probability() >= threshold))
    order = F.element_at(F.create_map(*[F.lit(x) for k, kind in enumerate(KINDS) for x in (kind, k)]), F.col("kind"))
    added = added.groupBy("uid").agg(F.collect_list(F.struct("start", order.alias("order"), "end", "kind")).alias("added"))
    added = materialize(added, "added-spans")  # few rows as a rule; their file size decides whether the texts have to move for the join
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
    out = found.join(added, "uid", "left")
    names = [F.col(f"kept.{c}").alias(c) for c in keep] if keep else [F.col("key").alias(key)]
    return out.select(*names, *BASE, F.coalesce("added", none).alias("added"))


def base_spans() -> Column:
    return F.concat(*[labelled(F.col(k), k, n) for n, k in enumerate(BASE)])


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by ``[KIND]``; overlapping spans become one, under the name of the first.

    ``spans`` is ``array<struct<start, order, end, kind>>`` in any order.
    """
    merged = F.aggregate(
        F.array_sort(spans),
        F.array().cast("array<struct<start:int,end:int,kind:string>>"),
        lambda out, s: F.when(
            (F.size(out) > 0) & (F.element_at(out, -1).end > s.start),
            F.concat(
                F.slice(out, 1, F.size(out) - 1),
                F.array(F.struct(F.element_at(out, -1).start.alias("start"), F.greatest(F.element_at(out, -1).end, s.end).alias("end"), F.element_at(out, -1).kind.alias("kind"))),
            ),
        ).otherwise(F.concat(out, F.array(F.struct(s.start.alias("start"), s.end.alias("end"), s.kind.alias("kind"))))),
    )
    whole = F.concat(F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit("").alias("kind"))), merged)
    parts = F.transform(
        whole,
        lambda s, i: F.concat(
            F.when(i > 0, F.concat(F.lit("["), F.upper(s.kind), F.lit("]"))).otherwise(""),
            F.substring(text, s.end + 1, F.coalesce(F.get(whole, i + 1).start, F.length(text)) - s.end),
        ),
    )
    return F.when(F.size(spans) > 0, F.array_join(parts, "")).otherwise(text)
