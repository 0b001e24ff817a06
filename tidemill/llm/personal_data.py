"""Personal data by weak supervision, in SQL expressions only.

Candidates are the base spans of four kinds and looser forms of them: phones
without a plus sign, e-mails written with [at] and [dot], digit runs of card
length that fail the checksum, and dotted quads out of range.  Labelers vote
on every candidate: its format, its own structure, a gazetteer and the words
around it.  One aggregate counts the vote patterns of the whole corpus;
expectation-maximisation on these counts estimates how far each labeler can be
trusted, and a logistic span classifier is fitted to the resulting
probabilities with features of the span that no labeler sees.  Base spans
always stay; other candidates are added if the classifier accepts them.

The pattern table has at most one row per combination of votes and features
(:data:`MAX_PATTERNS`), whatever the corpus; it alone reaches the driver.

Every pattern is linear: runs match possessively from their first character,
and dots or blanks between characters of a run are first replaced by
U+FFFF, so no repeated group recurses.  Null and empty texts have no spans.
Texts are read whole; repeated rows give repeated results.  Offsets are code
points, ends exclusive.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
MARK = "\uffff"
AROUND = 40
LABELERS = ("v_format", "v_structure", "v_gazetteer", "v_context")
MAX_PATTERNS = len(KINDS) * 3 ** len(LABELERS) * 4 * 4
ACCEPT = 0.5

# The base patterns, over texts in which inner dots (e-mail) or inner separators (card) are U+FFFF.
_LOCAL = f"A-Za-z0-9._%+{MARK}-"
EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++{MARK}[A-Za-z0-9{MARK}-]++"
INNER_DOT = r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
IN_RANGE = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"
CARD = f"[0-9{MARK}]{{13,}}+"
INNER_SEPARATOR = r"(?<=[0-9])[ -](?=[0-9])"
CARD_HINT = r"[0-9](?:[ -]?[0-9]){12}"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

LOOSE_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:\[at\]|\(at\)) ?[A-Za-z0-9-]++(?: ?(?:\[dot\]|\(dot\)|\.) ?[A-Za-z0-9-]++)++"
LOOSE_PHONE = r"(?<![0-9.+-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-])"

# Gazetteers and cue words of the labelers.
TOP_DOMAINS = "com org net edu gov io info de fr es uk eu us ca in".split()
CALLING_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92".split()
CUES = {
    "email": r"e-?mail|mail|contact|write|reach|courriel|correo",
    "ip": r"\bip\b|address|server|host|login|adresse|direcci",
    "card": r"card|visa|master|payment|credit|karte|carte|tarjeta",
    "phone": r"phone|call|tel|mobile|fax|whatsapp|anruf|appel|llam",
}
AGAINST = r"isbn|version|invoice|order|ticket|serial|checksum|release|section|\bno\."


def _pieces(text: Column, pattern: str) -> tuple[Column, Column]:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)


def _spans(text: Column, pattern: str) -> Column:
    """Start and value of all matches: the lengths of gaps and matches, added up."""
    hits, gaps = _pieces(text, pattern)
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,value:string>>").alias("out"))

    def step(state: Column, piece: Column) -> Column:
        start = state["at"] + F.length(piece["gap"])
        return F.struct((start + F.length(piece["hit"])).alias("at"), F.concat(state["out"], F.array(F.struct(start.alias("start"), piece["hit"].alias("value")))).alias("out"))

    def located(found: Column) -> Column:
        pairs = F.arrays_zip(found.alias("hit"), F.slice(gaps, F.lit(1), F.size(found)).alias("gap"))
        return F.aggregate(F.transform(pairs, lambda p: F.struct(p["hit"].alias("hit"), p["gap"].alias("gap"))), first, step, lambda s: s["out"])

    return F.when(F.size(hits) > 0, located(hits)).otherwise(F.array().cast("array<struct<start:int,value:string>>"))


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the checksum."""
    place = F.sequence(F.lit(1), F.length(digits))

    def add(total: Column, k: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - k + 1, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(k % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(place, F.lit(0), add) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def _kind(spans: Column, kind: str, keep, strict: bool) -> Column:
    """Candidates of one kind; ``keep`` says which values pass the base rule."""
    return F.transform(
        spans,
        lambda s: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            s["start"].alias("start"),
            (s["start"] + F.length(s["value"])).alias("end"),
            s["value"].alias("value"),
            (F.coalesce(keep(s["value"]), F.lit(False)) if strict else F.lit(False)).alias("base"),
        ),
    )


def with_candidates(docs: DataFrame, text: str, out: str) -> DataFrame:
    """``docs`` with all candidates of ``text``: kind, start, end, value, base, and the characters around."""
    plain = F.coalesce(F.col(text), F.lit(""))
    has = lambda sign: F.instr(F.col("_plain"), sign) > 0
    staged = docs.withColumn("_plain", F.replace(plain, F.lit(MARK), F.lit("\ufffe")))
    staged = staged.withColumn("_dotted", F.when(has("@"), F.regexp_replace("_plain", INNER_DOT, MARK))).withColumn(
        "_spaced", F.when(F.rlike("_plain", F.lit(CARD_HINT)), F.regexp_replace("_plain", INNER_SEPARATOR, MARK))
    )
    none = F.array().cast("array<struct<start:int,value:string>>")
    email = F.coalesce(_spans(F.col("_dotted"), EMAIL), none)
    card = F.coalesce(_spans(F.col("_spaced"), CARD), none)
    always = lambda value: F.lit(True)
    size = lambda value, low, high: F.length(_digits(value)).between(low, high)
    card_ok = lambda value: F.when(size(value, 13, 19), luhn(_digits(value))).otherwise(False)
    likely_card = lambda s: size(s["value"], 13, 19)
    staged = staged.withColumn(
        out,
        F.concat(
            _kind(email, "email", always, True),
            _kind(F.when(F.rlike("_plain", F.lit(r"[0-9]\.[0-9]")), _spans(F.col("_plain"), IP)).otherwise(none), "ip", lambda v: F.rlike(v, F.lit(IN_RANGE)), True),
            _kind(F.filter(card, likely_card), "card", card_ok, True),
            _kind(F.when(has("+"), F.filter(_spans(F.col("_plain"), PHONE), lambda s: size(s["value"], 9, 15))).otherwise(none), "phone", always, True),
            _kind(F.when(has("at]") | has("at)"), _spans(F.col("_plain"), LOOSE_EMAIL)).otherwise(none), "email", always, False),
            _kind(F.when(F.rlike("_plain", F.lit(r"[0-9]{3}[ .-][0-9]{4}")), _spans(F.col("_plain"), LOOSE_PHONE)).otherwise(none), "phone", always, False),
        ),
    )
    # A loose candidate that touches a base span says nothing new.
    base = F.filter(out, lambda c: c["base"])
    fresh = F.filter(out, lambda c: c["base"] | ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    around = F.transform(
        fresh,
        lambda c: c.withField("before", F.lower(F.substring(F.col("_plain"), F.greatest(c["start"] - AROUND, F.lit(0)) + 1, F.least(c["start"], F.lit(AROUND)))))
        .withField("after", F.substring(F.col("_plain"), c["end"] + 1, F.lit(1))),
    )
    return staged.withColumn(out, F.when(F.size(out) > 0, around).otherwise(F.filter(around, lambda c: F.lit(False)))).drop("_plain", "_dotted", "_spaced")


def labeled(candidate: Column) -> Column:
    """Votes of all labelers (1 for, -1 against, 0 none) and the features of a candidate."""
    kind, value = candidate["kind"], candidate["value"]
    digits = _digits(value)
    tail = F.lower(F.regexp_extract(F.replace(value, F.lit(MARK), F.lit(".")), r"([A-Za-z0-9-]+)$", 1))
    is_kind = lambda name: kind == KINDS.index(name)
    shape = (
        F.when(is_kind("card"), F.when(F.when(F.length(digits) <= 19, luhn(digits)).otherwise(False), 1).otherwise(-1))
        .when(is_kind("ip"), F.when(F.rlike(value, F.lit(IN_RANGE)), 1).otherwise(-1))
        .when(is_kind("phone"), F.when(F.length(digits).between(10, 13), 1).otherwise(0))
        .otherwise(F.when(F.rlike(tail, F.lit("^[a-z]{2,}$")), 1).otherwise(0))
    )
    code = F.array(*[F.lit(c) for c in CALLING_CODES])
    known = (
        F.when(is_kind("email"), F.when(tail.isin(*TOP_DOMAINS), 1).otherwise(0))
        .when(is_kind("phone"), F.when(F.exists(code, lambda c: F.startswith(digits, c)) & F.startswith(value, F.lit("+")), 1).otherwise(0))
        .when(is_kind("card"), F.when(F.substring(digits, 1, 1).isin("3", "4", "5", "6"), 1).otherwise(-1))
        .otherwise(F.when(F.rlike(value, F.lit(r"^(?:0|255)\.")), -1).otherwise(0))
    )
    cue = F.lit(0)
    for name, words in CUES.items():
        cue = F.when(is_kind(name), F.when(F.rlike(candidate["before"], F.lit(words)), 1).otherwise(0)).otherwise(cue)
    cue = F.when(F.rlike(candidate["before"], F.lit(AGAINST)), -1).otherwise(cue)
    edge = lambda c: F.when(F.coalesce(F.length(c), F.lit(0)) == 0, 0).when(F.rlike(c, F.lit(r"\s")), 1).when(F.rlike(c, F.lit(r"[\p{L}\p{N}]")), 2).otherwise(3)
    return F.struct(
        kind.alias("kind"),
        F.when(candidate["base"], 1).otherwise(F.lit(-1)).alias("v_format"),
        shape.alias("v_structure"),
        known.alias("v_gazetteer"),
        cue.alias("v_context"),
        edge(F.substring(candidate["before"], -1, 1)).alias("left"),
        edge(candidate["after"]).alias("right"),
    )


@dataclass
class SpanModel:
    """Weights of the span classifier by feature and value, and the estimated reliabilities of the labelers."""

    weights: dict[tuple[str, int, int], float]
    reliability: dict[tuple[str, str], float]


def estimate(patterns: list[dict], rounds: int = 40) -> tuple[list[float], dict[tuple[str, str], float]]:
    """Probability of each vote pattern, and the share of right votes of each labeler and kind.

    Expectation-maximisation on counted patterns, per kind; a labeler's votes
    are independent given whether the span is personal data.
    """
    chance = [min(0.95, max(0.05, 0.5 + 0.2 * sum(p[v] for v in LABELERS))) for p in patterns]
    likely: dict = {}
    for _ in range(rounds):
        total: dict = {}
        votes: dict = {}
        for p, c in zip(patterns, chance, strict=True):
            for truth, share in ((1, c), (0, 1 - c)):
                amount = share * p["n"]
                total[p["kind"], truth] = total.get((p["kind"], truth), 1.0) + amount
                for v in LABELERS:
                    votes[p["kind"], truth, v, p[v]] = votes.get((p["kind"], truth, v, p[v]), 0.0) + amount
        # A prior of one vote in the direction of the truth keeps the two classes from changing places.
        likely = {
            (kind, truth, v, vote): (votes.get((kind, truth, v, vote), 0.0) + (2.0 if (vote > 0) == (truth == 1) and vote else 0.5)) / (total[kind, truth] + 3.0)
            for kind, truth in total
            for v in LABELERS
            for vote in (-1, 0, 1)
        }
        for k, p in enumerate(patterns):
            odds = math.log(total[p["kind"], 1] / total[p["kind"], 0])
            odds += sum(math.log(likely[p["kind"], 1, v, p[v]] / likely[p["kind"], 0, v, p[v]]) for v in LABELERS)
            chance[k] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    right: dict[tuple[str, str], list[float]] = {}
    for p, c in zip(patterns, chance, strict=True):
        for v in LABELERS:
            if p[v]:
                entry = right.setdefault((KINDS[p["kind"]], v), [0.0, 0.0])
                entry[0] += p["n"] * (c if p[v] > 0 else 1 - c)
                entry[1] += p["n"]
    return chance, {name: good / cast for name, (good, cast) in right.items()}


def fit_classifier(patterns: list[dict], chance: list[float], rounds: int = 300, rate: float = 0.5) -> dict[tuple[str, int, int], float]:
    """Logistic weights by ``(feature, kind, value)``, fitted to the estimated probabilities by gradient descent."""
    features = [*LABELERS, "left", "right"]
    weights: dict[tuple[str, int, int], float] = {}
    names = [[("bias", p["kind"], 0)] + [(f, p["kind"], p[f]) for f in features] for p in patterns]
    total = {kind: sum(p["n"] for p in patterns if p["kind"] == kind) for kind in {p["kind"] for p in patterns}}
    for _ in range(rounds):
        slope: dict[tuple[str, int, int], float] = {}
        for p, c, own in zip(patterns, chance, names, strict=True):
            score = sum(weights.get(name, 0.0) for name in own)
            pull = (c - 1 / (1 + math.exp(-max(-30.0, min(30.0, score))))) * p["n"] / total[p["kind"]]
            for name in own:
                slope[name] = slope.get(name, 0.0) + pull
        for name, value in slope.items():
            weights[name] = weights.get(name, 0.0) * 0.9995 + rate * value
    return weights


def fit(docs: DataFrame, text: str = "text") -> SpanModel:
    """Reliabilities and classifier from the vote patterns of all candidates of ``docs``."""
    found = with_candidates(docs.select(text), text, "found")
    names = ["kind", *LABELERS, "left", "right"]
    counted = found.select(F.explode("found").alias("c")).select(labeled(F.col("c")).alias("p")).groupBy(*[F.col(f"p.{n}").alias(n) for n in names]).count()
    patterns = [row.asDict() | {"n": row["count"]} for row in counted.limit(MAX_PATTERNS + 1).collect()]
    patterns.sort(key=lambda p: [p[n] for n in names])
    chance, reliability = estimate(patterns)
    return SpanModel(fit_classifier(patterns, chance), reliability)


def score(candidate: Column, model: SpanModel) -> Column:
    """Probability of the span classifier."""
    marks = labeled(candidate)
    total = F.lit(0.0)
    for feature in ("bias", *LABELERS, "left", "right"):
        own = {name: weight for name, weight in model.weights.items() if name[0] == feature}
        if own:
            table = F.create_map(*[F.lit(x) for (_, kind, value), weight in sorted(own.items()) for x in (kind * 10 + value + 1, weight)])
            value = F.lit(0) if feature == "bias" else marks[feature]
            total = total + F.coalesce(table[marks["kind"] * 10 + value + 1], F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def find_personal_data(docs: DataFrame, model: SpanModel, text: str = "text", out: str = "personal_data") -> DataFrame:
    """``docs`` with the spans of ``text`` by kind and start; a column named ``out`` is replaced."""
    found = with_candidates(docs.drop(out), text, out)
    kept = F.filter(out, lambda c: c["base"] | (F.when(c["base"], 1.0).otherwise(score(c, model)) >= ACCEPT))
    named = F.transform(kept, lambda c: F.struct(c["kind"], c["start"], c["end"], c["base"]))
    return found.withColumn(out, F.sort_array(named))


def kind_name(span: Column) -> Column:
    return F.array(*[F.lit(k) for k in KINDS])[span["kind"]]


def masked(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in brackets; of overlapping spans the first one counts."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), kind_name(s).alias("name"))))
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        joined = F.concat(state["out"], gap, F.lit("["), F.upper(span["name"]), F.lit("]"))
        free = span["start"] >= state["at"]
        return F.struct(F.when(free, span["end"]).otherwise(F.greatest(state["at"], span["end"])).alias("at"), F.when(free, joined).otherwise(state["out"]).alias("out"))

    replaced = F.aggregate(ordered, first, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, replaced).otherwise(text)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", kind_name(s), s["start"], s["end"])))


def personal_data_digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per text the counts of base spans, the hash of their positions, and all spans as text."""
    found = find_personal_data(docs.select(key, text), fit(docs, text), text)
    base = F.filter("personal_data", lambda s: s["base"])
    of_base = F.transform(base, lambda s: kind_name(s))
    counts = [(F.size(of_base) - F.size(F.array_remove(of_base, name))).cast("long").alias(f"n_{name}") for name in KINDS]
    return found.select(key, *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("personal_data")).alias("spans"))
